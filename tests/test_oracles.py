"""Every registered query equals its DuckDB oracle (sf0.001, whole tables)."""

import pytest

import __spark_entry__ as E
from clickpanes.plans.catalog import QUERIES
from compare import compare, duck
from conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLES, f"{name} has no oracle"
    assert name in E.queries()
    res = compare(E.queries()[name](spark, SF_SMALL), con, ORACLES[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["match"], res


def test_entry_has_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns[:2] == ["product_id", "no_views"]
    views = [r.no_views for r in rows]
    assert views == sorted(views, reverse=True)
