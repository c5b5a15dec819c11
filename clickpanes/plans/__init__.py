"""The four jobs, composed from sources, operators and sinks."""

from clickpanes.plans.record import record_clicks
from clickpanes.plans.views import (
    start_views_per_state,
    views_per_state,
    views_per_state_stream,
)
from clickpanes.plans.featured import featured_from_clicks, featured_report, run_featured
from clickpanes.plans.grid import backfill_grid, gap_filled_views

__all__ = [
    "record_clicks",
    "start_views_per_state",
    "views_per_state",
    "views_per_state_stream",
    "featured_from_clicks",
    "featured_report",
    "run_featured",
    "backfill_grid",
    "gap_filled_views",
]
