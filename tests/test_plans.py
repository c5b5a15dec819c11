"""Physical-plan properties the operators are built for."""

import re

from clickpanes.operators.parse import click_times
from clickpanes.plans import catalog
from clickpanes.sources.tables import event_lines
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_is_parsed_once_per_row(spark):
    p = plan(click_times(event_lines(catalog._t(spark, SF_SMALL, "events"))))
    assert p.count("gettimestamp(") == 1, p


def test_views_count_panes_before_first_shuffle(spark):
    p = plan(catalog.views(spark, SF_SMALL))
    # bottom-most exchange on the click side is fed by a partial count
    assert re.search(r"Exchange hashpartitioning\(product_id#\d+L, state#\d+, pane#\d+", p), p
    assert "partial_count(1)" in p
    # the 12-way expansion happens on pane counts, above that exchange
    expand_at = p.index("Expand")
    pane_exchange_at = p.index("pane#")
    assert expand_at < pane_exchange_at


def test_dimension_scans_are_pruned_and_filtered(spark):
    p = plan(catalog.clicks_with_state(spark, SF_SMALL))
    scan = next(line for line in p.splitlines() if "customer.parquet" in line)
    assert "c_name" not in scan and "c_acctbal" not in scan
    assert "PushedFilters" in scan
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_no_query_deals_rows_round_robin(spark):
    for name in ("parse_clicks", "clicks_with_state", "product_views_sliding", "view_grid", "featured_all_days", "zip_states"):
        assert "RoundRobinPartitioning" not in plan(catalog.QUERIES[name](spark, SF_SMALL)), name


def test_featured_broadcasts_the_top_rows(spark):
    p = plan(catalog.q_featured_top(spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=10" in p
    assert "SortMergeJoin" not in p
    assert re.search(r"BroadcastHashJoin \[product_id#\d+L\], \[cast\(product_id#\d+ as bigint\)\], Inner, BuildLeft", p), p
    # each pane goes straight to its window: no expansion of the counts
    counts = p[: p.index("HashAggregate(keys=[pane")] if "HashAggregate(keys=[pane" in p else p
    assert "Expand" not in counts.split("Generate")[0]


def test_daily_top_is_limited_before_the_shuffle(spark):
    from clickpanes.operators.featured import daily_totals, top_products_per_day

    top = top_products_per_day(daily_totals(catalog.views(spark, SF_SMALL)))
    p = plan(top)
    assert p.count("WindowGroupLimit") == 2, p
    assert "SortMergeJoin" not in p


def test_grid_has_no_cartesian_product(spark):
    p = plan(catalog.q_fill_views(spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Generate explode" in p
    # the grid's rows are generated above every shuffle
    assert p.index("Generate explode") < p.index("Exchange")


def test_daily_report_broadcasts_ranked_rows(spark):
    from clickpanes.operators.featured import featured_products_daily

    rep = featured_products_daily(catalog.views(spark, SF_SMALL), catalog.products(spark, SF_SMALL))
    rep.collect()  # adaptive execution measures the ranked rows
    final = plan(rep).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final, final


def test_report_on_store_reads_only_the_days_hours(spark, scratch):
    from clickpanes.plans.featured import featured_report
    from clickpanes.sinks import write_views
    from clickpanes.sources.files import read_views

    store = scratch("store")
    write_views(catalog.views(spark, SF_SMALL), store)
    # Whole filters in the plan's text, however long the column ids have become.
    length = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        rep = featured_report(read_views(spark, store), "2024-01-15", catalog.products(spark, SF_SMALL))
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(rep))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", length)
    day = [f for f in filters if ">= 2024011500" in f and "<= 2024011523" in f]
    first_hour = [f for f in day if "% 100) = 0" in f]
    assert day and first_hour, filters
