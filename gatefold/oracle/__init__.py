"""Check SQL for the registered queries, written independently of the Spark code."""

from .tables import compose, rounded  # noqa: F401
