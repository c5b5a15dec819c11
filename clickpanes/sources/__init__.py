"""Sources: Kafka and file streams of click lines, dimension files, and the
click lines and dimensions derived from the shared test tables."""

from clickpanes.sources.kafka import kafka_lines
from clickpanes.sources.files import (
    dev_zip_states,
    read_categories,
    read_departments,
    read_products,
    read_views,
    read_zip_states,
    rows,
    text_lines_stream,
)
from clickpanes.sources.tables import (
    categories_from_part,
    departments_from_region,
    edge_lines,
    edge_lines_stream,
    event_lines,
    events_stream,
    products_from_part,
    read_table,
    zip_states_from_customers,
)

__all__ = [
    "kafka_lines",
    "dev_zip_states",
    "read_categories",
    "read_departments",
    "read_products",
    "read_views",
    "read_zip_states",
    "rows",
    "text_lines_stream",
    "categories_from_part",
    "departments_from_region",
    "edge_lines",
    "edge_lines_stream",
    "event_lines",
    "events_stream",
    "products_from_part",
    "read_table",
    "zip_states_from_customers",
]
