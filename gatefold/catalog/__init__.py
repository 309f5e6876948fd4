"""Registered queries: one Spark callable per operator, with check SQL where SQL can say it."""

from .registry import Entry, oracle_sql, queries  # noqa: F401
