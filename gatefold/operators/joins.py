"""Equi-joins of the star schema.

No broadcast hints on tables: the optimizer and AQE broadcast a side only after checking its size.
Facts are reduced to the join key before they meet a dimension wherever the result allows
it; where raw fact rows must be joined, heavy keys are salted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import round_to


# A key is heavy above this share of all rows (so there are at most 10,000) and this many rows.
HEAVY_SHARE = 1e-4
HEAVY_ROWS = 10_000


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread: Sequence[str] | None = None,
    how: str = "inner",
    heavy_share: float = HEAVY_SHARE,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """``fact`` joined (inner or left) to ``dim`` on equal keys, heavy keys dealt over many tasks.

    Keys are counted map-side first. A key above ``heavy_share`` of the rows and ``heavy_rows`` gets
    a salt per that many rows: its fact rows are spread by a hash of ``spread`` (default: all columns),
    only its dimension rows are repeated. The list of heavy keys has at most ``1 / heavy_share`` rows,
    which bounds its broadcast. Null keys match nothing but are spread likewise in a left join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    share = counts.agg((F.sum("__n") * F.lit(heavy_share)).alias("__limit")).scalar()
    limit = F.greatest(F.ceil(share), F.lit(heavy_rows).cast("long"))
    heavy = counts.where(F.col("__n") > limit).select(
        *[F.col(k).alias(f"__{k}") for k in on], F.ceil(F.col("__n") / limit).alias("__salts")
    )

    def with_salts(df: DataFrame) -> DataFrame:
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in on]
        salted = df.join(F.broadcast(heavy), same, "left").drop(*[f"__{k}" for k in on])
        return salted.withColumn("__salts", F.coalesce("__salts", F.lit(1).cast("long")))

    dealt = F.pmod(F.xxhash64(*(spread or fact.columns)), F.col("__salts"))
    facts = with_salts(fact).withColumn("__salt", dealt).drop("__salts")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__salts") - 1))
    dims = with_salts(dim).withColumn("__salt", copies).drop("__salts")
    return facts.join(dims, [*on, "__salt"], how).drop("__salt")


def left_agg_join(dim: DataFrame, aggs: Sequence[DataFrame], key: str) -> DataFrame:
    """Dimension LEFT JOIN pre-aggregated facts (one row per key each)."""
    return reduce(lambda left, right: left.join(right, key, "left"), aggs, dim)


def enrich(
    fact: DataFrame, dim: DataFrame, key: str, cols: Sequence[str], prefix: str = "dim_"
) -> DataFrame:
    """Fact LEFT JOIN selected dimension columns, which get ``prefix`` to stay apart."""
    picked = dim.select(key, *[F.col(c).alias(prefix + c) for c in cols])
    return salted_join(fact, picked, [key], how="left")


def cohort_join(timeline: DataFrame, second: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Customer timeline with second visit and customer attributes; timeline rows are kept."""
    return left_agg_join(timeline, [second, dim], key)


def attach_labels(
    features: DataFrame, labels: DataFrame, key: str, defaults: Mapping[str, object]
) -> DataFrame:
    """Features LEFT JOIN labels; missing labels take ``defaults``."""
    return features.join(labels, key, "left").fillna(dict(defaults))


def star_join(base: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner star on one key: every exchange is on ``key``, so it is shuffled once per table
    (not at all for tables stored in buckets of ``key``)."""
    return reduce(lambda left, right: left.join(right, key), tables, base)


def fact_by_event(
    fact: DataFrame, events: DataFrame, key: str, by: str, partial: Sequence[Column],
    aggs: Sequence[Column],
) -> DataFrame:
    """Fact INNER JOIN event dimension, aggregated by an event attribute.

    ``partial`` reduces the fact to one row per event before the join, ``aggs`` combines those rows:
    a hot event is summed map-side and never meets the dimension as raw rows.
    """
    return fact.groupBy(key).agg(*partial).join(events.select(key, by), key).groupBy(by).agg(*aggs)


def fact_by_customer(
    fact: DataFrame, customers: DataFrame, key: str, cols: Sequence[str], cond: Column | None = None
) -> DataFrame:
    """Fact INNER JOIN customer attributes; ``cond`` is applied before the join."""
    kept = fact if cond is None else fact.filter(cond)
    return salted_join(kept, customers.select(key, *cols), [key])


def left_join_then_profile(
    left: DataFrame, right: DataFrame, key: str, by: str, aggs: Sequence[Column]
) -> DataFrame:
    """LEFT JOIN, then one row per ``by`` (a NULL group holds the unmatched rows)."""
    return left.join(right, key, "left").groupBy(by).agg(*aggs)


def with_reference_value(df: DataFrame, ref: DataFrame, expr: Column, name: str) -> DataFrame:
    """Attach a one-row aggregate of ``ref`` to every row as a scalar subquery."""
    return df.withColumn(name, ref.agg(expr.alias(name)).scalar())


def index_against_mean(df: DataFrame, col: str, name: str, digits: int = 3) -> DataFrame:
    """``col`` divided by its mean over all rows, NULL taken as 0."""
    value = F.coalesce(F.col(col).cast("double"), F.lit(0.0))
    exact = F.coalesce(F.col(col).cast("decimal(28,8)"), F.lit(0).cast("decimal(28,8)"))
    mean = df.agg(
        (F.sum(exact).cast("double") / F.count(F.lit(1))).alias("overall_mean")
    ).scalar()
    return df.withColumn(name, round_to(value / F.nullif(mean, F.lit(0.0)), digits))
