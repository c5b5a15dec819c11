"""Structured Streaming forms: watermarked window counts and sinks."""

from clickpanes.streaming.views import open_views, windowed_views
from clickpanes.streaming.sinks import (
    apply_trigger,
    epoch_sink,
    read_epochs,
    start_console,
    start_fan_out,
    start_file_sink,
    start_store_sink,
)

__all__ = [
    "open_views",
    "windowed_views",
    "apply_trigger",
    "epoch_sink",
    "read_epochs",
    "start_console",
    "start_fan_out",
    "start_file_sink",
    "start_store_sink",
]
