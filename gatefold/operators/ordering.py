"""Sorting and top-k. Sorting belongs to presentation; stored tables are not sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_by(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Mixed ascending/descending order; a leading ``-`` on a name means descending."""
    cols = [
        k if isinstance(k, Column) else (F.desc(k[1:]) if k.startswith("-") else F.asc(k))
        for k in keys
    ]
    return df.orderBy(*cols)


def order_by_agg(
    df: DataFrame, by: Sequence[str], aggs: Sequence[Column], sort_expr: Column
) -> DataFrame:
    """Group and sort by an aggregate that is not part of the output."""
    return project_after(df.groupBy(*by).agg(*aggs, sort_expr.alias("_sort")), "_sort")


def project_after(df: DataFrame, sort_hidden: str) -> DataFrame:
    """Sort by a column and hide it."""
    return df.orderBy(sort_hidden).drop(sort_hidden)


def top_k(
    df: DataFrame,
    order: Sequence[Column | str],
    k: int,
    cond: Column | None = None,
    tie_break: str | None = None,
) -> DataFrame:
    """Filter, sort, first k. Planned as per-partition heaps (TakeOrderedAndProject).

    Without ``tie_break`` (a unique column) rows tied at position k are chosen freely.
    """
    kept = df if cond is None else df.filter(cond)
    keys = [*order, tie_break] if tie_break else list(order)
    return order_by(kept, keys).limit(k)
