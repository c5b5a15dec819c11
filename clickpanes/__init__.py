"""clickpanes: clickstream analytics as Spark DataFrame operators.

Every public operator maps DataFrames to DataFrames with built-in Spark
functions, so the same code serves batch jobs and Structured Streaming
queries and Catalyst plans it end to end.
"""

from clickpanes.config import ViewWindow, DEFAULT_WINDOW, DEV_WINDOW

__all__ = ["ViewWindow", "DEFAULT_WINDOW", "DEV_WINDOW"]
