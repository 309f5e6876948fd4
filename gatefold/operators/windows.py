"""Ordered computations: running sums, moving averages, ranks and shares.

A window without PARTITION BY runs in one task. The functions here cut the global order into
slices first, so that no task holds more than a slice, and carry small per-slice totals over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import round_to
from .prefix import prefix_sums

# Rows in a slice of positions.
SLICE_WIDTH = 4096


def running_sum(
    df: DataFrame,
    col: str | Column,
    order: str,
    name: str,
    by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Running total over an ``order`` key that is unique within ``by``; NULL before the first value.

    Slices hold ranges of rows, not of key values, so sparse keys such as seconds or ids are
    spread as evenly as dense ones.
    """
    value = F.col(col) if isinstance(col, str) else col
    valued = df.withColumns({"_value": value, "_seen": value.isNotNull().cast("long")})
    summed = prefix_sums(valued, by, [order], ["_value", "_seen"], slices)
    total = F.col("_value_before") + F.coalesce(F.col("_value"), F.lit(0))
    filled = F.when(F.col("_seen_before") + F.col("_seen") > 0, total)
    helpers = [f"{c}{end}" for c in ("_value", "_seen") for end in ("", "_before", "_total")]
    return summed.withColumn(name, filled).drop(*helpers)


def moving_avg(
    df: DataFrame,
    col: str,
    order: str,
    name: str,
    n: int = 3,
    digits: int | None = None,
    width: int = SLICE_WIDTH,
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean of the current and ``n - 1`` preceding rows by an ``order`` key unique within ``by``.

    Rows get their exact position from :func:`running_sum`, are cut into slices of ``width``
    positions, and each slice borrows the ``n - 1`` rows before its first.
    """
    placed = running_sum(df, F.lit(1).cast("long"), order, "_pos", by)
    placed = placed.withColumn("_pos", F.col("_pos") - 1)
    home = F.floor(F.col("_pos") / F.lit(width))
    borrowed = F.floor((F.col("_pos") + F.lit(n - 1)) / F.lit(width))
    spread = placed.withColumn("_home", home).withColumn(
        "_slice", F.explode(F.sequence(home, borrowed))
    )
    frame = Window.partitionBy(*by, "_slice").orderBy("_pos").rowsBetween(-(n - 1), 0)
    mean = F.avg(F.col(col)).over(frame)
    out = spread.withColumn(name, mean if digits is None else round_to(mean, digits))
    return out.filter(F.col("_slice") == F.col("_home")).drop("_pos", "_home", "_slice")


def running_sum_scalable(
    df: DataFrame, col: str, order: Sequence[str], name: str, slices: int | None = None
) -> DataFrame:
    """Running total over any unique order (numbers, dates, strings, several columns)."""
    own = F.coalesce(F.col(col), F.lit(0))
    summed = prefix_sums(df, [], order, [col], slices)
    return summed.withColumn(name, F.col(f"{col}_before") + own).drop(f"{col}_before", f"{col}_total")


def _ranked(df: DataFrame, by: Sequence[str], order: str, name: str, dense: bool) -> DataFrame:
    """Ranks computed per distinct (by, order) pair and joined back.

    Pairs are counted map-side first and ranked with :func:`prefix_sums`, so neither a group
    with very many rows nor one with very many order values is held in one task.
    """
    keys = [*by, order]
    step = F.lit(1).cast("long") if dense else F.count(F.lit(1))
    levels = df.groupBy(*keys).agg(step.alias("_n"))
    ranks = prefix_sums(levels, by, [order], ["_n"]).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], (F.col("_n_before") + 1).cast("int").alias(name)
    )
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(ranks, match).drop(*[f"_k_{k}" for k in keys])


def rank_in(df: DataFrame, by: Sequence[str], order: str, name: str = "rank") -> DataFrame:
    """``rank()`` of every row within ``by``."""
    return _ranked(df, by, order, name, dense=False)


def dense_rank_in(df: DataFrame, by: Sequence[str], order: str, name: str = "dense_rank") -> DataFrame:
    """``dense_rank()`` of every row within ``by``."""
    return _ranked(df, by, order, name, dense=True)


def share_of_total(
    df: DataFrame,
    by: Sequence[str | Column],
    measure: Column,
    name: str,
    extra: Sequence[Column] = (),
    few_groups: bool = False,
) -> DataFrame:
    """Group, aggregate ``measure``, and give each group's percentage of the grand total.

    The total is a scalar subquery over the input and the groups stay distributed. Where ``by`` is
    known to have a handful of values, ``few_groups`` sums the finished groups in one window
    instead and reads the input once.
    """
    grouped = df.groupBy(*by).agg(measure.alias("_measure"), *extra)
    if few_groups:
        total = F.sum("_measure").over(Window.partitionBy()).cast("double")
    else:
        total = df.agg(measure.alias("_total")).scalar().cast("double")
    share = F.col("_measure").cast("double") * 100.0 / F.nullif(total, F.lit(0.0))
    return grouped.withColumn(name, round_to(share, 1)).drop("_measure")


def share_within(
    df: DataFrame, by: Sequence[str], within: Sequence[str], measure: Column, name: str,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Percentage of each group's measure within the coarser ``within`` group.

    The window runs over aggregated rows: one per group, not one per input row.
    """
    grouped = df.groupBy(*within, *by).agg(measure.alias("_measure"), *extra)
    total = F.sum("_measure").over(Window.partitionBy(*within)).cast("double")
    share = F.col("_measure").cast("double") * 100.0 / F.nullif(total, F.lit(0.0))
    return grouped.withColumn(name, round_to(share, 1)).drop("_measure")
