"""Unions and row counts over several tables, and scalar comparisons."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame], name: str = "row_count") -> DataFrame:
    """(table_name, row count) of every table, sorted by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("table_name"), name)
        for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def union_sources(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Union by column name (batch or streaming); duplicates are kept."""
    return reduce(DataFrame.unionByName, more, first)


def compare_scalars(
    left: tuple[DataFrame, Column], right: tuple[DataFrame, Column], op: str = ">"
) -> Column:
    """Compare two independent one-value aggregates as scalar subqueries."""
    a = left[0].agg(left[1].alias("value")).scalar()
    b = right[0].agg(right[1].alias("value")).scalar()
    return {
        ">": a > b, ">=": a >= b, "<": a < b, "<=": a <= b, "==": a == b, "!=": a != b,
    }[op]
