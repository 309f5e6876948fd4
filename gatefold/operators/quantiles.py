"""Exact quantiles without gathering a group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer. Here values
are counted, their ranks come from :func:`prefix_sums`, and only the rows that hold a wanted
rank go into the result, so the work of one hot group is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import round_to
from .prefix import prefix_sums


def exact_quantiles(
    df: DataFrame, by: Sequence[str], cols: Sequence[str], ps: Sequence[float]
) -> DataFrame:
    """(by..., column_name, n_values, mean, min, max, q0, q1, ...) per group and column.

    Quantiles interpolate linearly between neighbours. All ``cols`` go through one pass.
    NULLs are ignored; a group whose column holds only NULLs gives no row. Values are doubles of
    any size; NaN sorts last and makes the mean NaN.
    """
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v"))
            for c in cols
        ]
    )
    keys = [*by, "column_name"]
    values = df.select(*by, F.inline(cells)).filter(F.col("_v").isNotNull())
    freq = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = prefix_sums(freq, keys, ["_v"], ["_n"])
    start, size, v = F.col("_n_before"), F.col("_n_total"), F.col("_v")
    weighted = F.sum(v * F.col("_n"))
    aggs = [
        F.sum("_n").alias("n_values"),
        (weighted / F.sum("_n")).alias("mean"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    ]
    outs = []
    for i, p in enumerate(ps):
        at = (size - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (start <= rank) & (rank < start + F.col("_n"))
            aggs.append(F.max(F.when(holds, v)).alias(f"_{side}{i}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"_f{i}"))
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append((lo + (hi - lo) * F.col(f"_f{i}")).alias(f"q{i}"))
    found = ranked.groupBy(*keys).agg(*aggs)
    return found.select(*keys, "n_values", "mean", "min", "max", *outs)


def percentiles(
    df: DataFrame, by: Sequence[str], col: str, named: Mapping[str, float],
    mean: str | None = None, maximum: str | None = None,
) -> DataFrame:
    """One row per group with the exact percentiles ``{output name: p}`` of ``col``, and its
    mean and maximum under the given names."""
    found = exact_quantiles(df, by, [col], list(named.values()))
    more = [F.col(s).alias(n) for s, n in (("mean", mean), ("max", maximum)) if n]
    return found.select(*by, *[F.col(f"q{i}").alias(n) for i, n in enumerate(named)], *more)


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_values, mean, min, p25, p75, max) per column, quartiles exact."""
    found = exact_quantiles(df, [], cols, [0.25, 0.75])
    return found.select(
        "column_name", "n_values", "mean", "min",
        F.col("q0").alias("p25"), F.col("q1").alias("p75"), "max",
    )


def median_profile(df: DataFrame, by: str, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """One row per group with the rounded exact median of every column."""
    medians = exact_quantiles(df, [by], cols, [0.5])
    return medians.groupBy(by).agg(
        *[
            round_to(F.max(F.when(F.col("column_name") == c, F.col("q0"))), digits).alias(c)
            for c in cols
        ]
    )
