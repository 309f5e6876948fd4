"""Aggregate column expressions. All are algebraic, so Spark combines them map-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import ColumnLike, _c, is_true, round_to


def n_rows() -> Column:
    return F.count(F.lit(1))


def count_where(cond: ColumnLike) -> Column:
    """Rows for which ``cond`` is true; 0, never NULL."""
    return F.count_if(_c(cond))


def count_distinct_where(col: ColumnLike, cond: ColumnLike) -> Column:
    return F.count_distinct(F.when(_c(cond), _c(col)))


def max_where(col: ColumnLike, cond: ColumnLike, default=0) -> Column:
    """Maximum over rows where ``cond`` holds; the other rows count as ``default``."""
    return F.max(F.when(_c(cond), _c(col)).otherwise(F.lit(default)))


def any_flag(cond: ColumnLike) -> Column:
    """True when any row has a true flag; a NULL flag counts as false."""
    return F.bool_or(is_true(cond))


def any_flag_nullable(cond: ColumnLike) -> Column:
    """Like :func:`any_flag`, but all-NULL input stays NULL."""
    return F.bool_or(_c(cond))


def mean_of(col: ColumnLike, digits: int, scale: int = 1) -> Column:
    """Rounded mean, optionally scaled (``scale=100`` for percentages).

    Sum and count are kept apart so that decimal money is added exactly and divided once.
    """
    total = F.sum(_c(col)).cast("double")
    return round_to(total / F.nullif(F.count(_c(col)), F.lit(0)) * F.lit(scale), digits)


def rate(cond: ColumnLike, digits: int = 4) -> Column:
    """Share of rows for which ``cond`` is true."""
    return round_to(count_where(cond).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)), digits)


def pct(cond: ColumnLike, digits: int = 1, of: ColumnLike | None = None) -> Column:
    """Percentage of rows (or of the rows where ``of`` holds) for which ``cond`` is true."""
    base = F.count(F.lit(1)) if of is None else count_where(of)
    return round_to(count_where(cond).cast("double") * F.lit(100.0) / F.nullif(base, F.lit(0)), digits)
