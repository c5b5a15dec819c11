"""Column-level building blocks; each returns a Spark ``Column``."""

from clickpanes.functions.parsing import (
    click_time,
    field,
    lenient_float,
    lenient_integer,
    pipe_fields,
)
from clickpanes.functions.timekeys import (
    hour_key,
    pane_start,
    stamps_after,
)
from clickpanes.functions.sampling import stable_bucket

__all__ = [
    "click_time",
    "field",
    "lenient_float",
    "lenient_integer",
    "pipe_fields",
    "hour_key",
    "pane_start",
    "stamps_after",
    "stable_bucket",
]
