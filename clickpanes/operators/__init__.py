"""DataFrame -> DataFrame operators of the click pipeline."""

from clickpanes.operators.parse import click_records, click_times
from clickpanes.operators.dims import (
    distinct_states,
    distinct_zip_states,
    with_state,
)
from clickpanes.operators.views import (
    pane_counts,
    product_views,
    shape_views,
    views_by_window,
    views_from_panes,
)
from clickpanes.operators.featured import (
    closing_minute,
    closing_starts,
    daily_totals,
    daily_totals_from_panes,
    enrich_daily,
    featured_products_daily,
    top_products_per_day,
    day_number,
    day_totals,
    enrich,
    featured_from_store,
    featured_products,
    hour_slice,
    hour_slice_stored,
    product_totals,
    report_layout,
    top_products,
)
from clickpanes.operators.grid import fill_views, series_keys, series_of, view_grid

__all__ = [
    "click_records",
    "click_times",
    "distinct_states",
    "distinct_zip_states",
    "with_state",
    "pane_counts",
    "product_views",
    "views_from_panes",
    "shape_views",
    "views_by_window",
    "closing_minute",
    "closing_starts",
    "featured_from_store",
    "hour_slice_stored",
    "daily_totals",
    "daily_totals_from_panes",
    "enrich_daily",
    "featured_products_daily",
    "top_products_per_day",
    "day_totals",
    "day_number",
    "enrich",
    "featured_products",
    "hour_slice",
    "product_totals",
    "report_layout",
    "top_products",
    "fill_views",
    "series_keys",
    "series_of",
    "view_grid",
]
