"""Mixing sources to target weights by temperature.

Source token shares are raised to an exponent between 0 (uniform) and 1 (as found). The exponent is
bisected on a fixed grid until the mixture meets a repetition limit or a target entropy. Each source
then gets a token budget, served as whole permutations of its documents and the beginning of one
more. No document is left out: the source that is cut back most is used exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, picked, stored_copy

MAX_REPEATS = 2.0
# The exponent is a multiple of 1 / GRID; every round splits the bracket FAN ways.
GRID = 1 << 20
FAN = 32
SEED = 17


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _key(source: Column) -> Column:
    """Sources as map keys: null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_tokens(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source_key, tokens) per source."""
    rows = picked(docs, source=source, text=text)
    return rows.groupBy(_key(F.col("source").cast("string")).alias("source_key")).agg(
        F.sum(tokens_of(F.col("text"))).alias("tokens")
    )


def _bracket(shares: DataFrame, holds: Callable[[dict], bool]) -> int:
    """Smallest grid step of the exponent at which ``holds``, which must be monotone and true at GRID.

    Every round is one aggregation over the sources for FAN exponents at once.
    """
    low, high = -1, GRID
    while high - low > 1:
        steps = sorted({low + (high - low) * k // FAN for k in range(1, FAN)} - {low, high})
        exponent = (F.col("step") / F.lit(float(GRID))).alias("exponent")
        powered = shares.select(
            "share", "ratio", F.explode(F.array(*[F.lit(s) for s in steps])).alias("step")
        ).select("step", "share", "ratio", exponent)
        mass = F.pow("share", "exponent")
        found = {
            r.step: r.asDict()
            for r in powered.groupBy("step").agg(
                F.sum(mass).alias("mass"), F.sum(mass * F.log("share")).alias("log_mass"),
                F.max("exponent").alias("exponent"),
                F.max(F.pow("ratio", 1 - F.col("exponent"))).alias("repeats"),
            ).collect()
        }
        for step in steps:
            if holds(found[step]):
                high = step
                break
            low = step
    return high


def _entropy(row: dict) -> float:
    import math

    return math.log(row["mass"]) - row["exponent"] * row["log_mass"] / row["mass"]


def exponent_step(
    tokens: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None
) -> int:
    """The exponent in grid steps.

    With ``max_repeats``: the flattest mixture in which no source is repeated more often. With
    ``target_entropy`` (nats): the one nearest to the found shares whose entropy reaches it, or the
    uniform one where none does.
    """
    used = tokens.where("tokens > 0")
    total = used.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("top")).first()
    if not total["all"]:
        return GRID
    shares = used.select(
        (F.col("tokens") / F.lit(float(total["all"]))).alias("share"),
        (F.lit(float(total.top)) / F.col("tokens")).alias("ratio"),
    )
    if target_entropy is None:
        return _bracket(shares, lambda r: r["repeats"] <= max_repeats)
    # entropy falls as the exponent grows: one step before the first that misses the target
    natural = shares.agg(F.sum(-F.col("share") * F.log("share")).alias("h")).first().h
    if natural >= target_entropy:
        return GRID
    return max(0, _bracket(shares, lambda r: _entropy(r) < target_entropy) - 1)


def plan_sources(tokens: DataFrame, step: int) -> DataFrame:
    """Per source: target tokens, whole permutations, and tokens of the last partial one."""
    top = tokens.agg(F.max("tokens").alias("top")).first().top or 0
    ratio = F.pow(F.lit(float(top)) / F.col("tokens"), F.lit(1.0 - step / GRID))
    target = F.when(F.col("tokens") > 0, F.floor(F.col("tokens") * ratio)).otherwise(0)
    return tokens.withColumn("target", target.cast("long")).select(
        "source_key", "tokens", "target",
        F.when(F.col("tokens") > 0, F.expr("target div tokens")).otherwise(1).alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("target % tokens")).otherwise(0).alias("rest"),
    )


def _rank(doc_id: Column, block: Column) -> Column:
    """Place of a document in the permutation of a block: a keyed hash, as 32 hex digits."""
    return F.md5(
        F.concat_ws(":", F.lit(SEED).cast("string"), block.cast("string"), doc_id.cast("string")).cast("binary")
    )


def cut_points(ranked: DataFrame) -> DataFrame:
    """(source_key, last): the last rank that the partial block of a source still takes.

    ``ranked`` has ``source_key, rest, rank, tokens``. Token sums by leading hex digits find the slice
    of ranks in which the budget ends; only that slice is summed document by document. No source is
    ever ordered as a whole.
    """
    ranked = ranked.where("rest > 0")
    sliced = ranked.withColumn("slice", F.substring("rank", 1, 4))
    sums = sliced.groupBy("source_key", "slice").agg(
        F.sum("tokens").alias("in_slice"), F.max("rest").alias("rest")
    )
    earlier = Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sums.withColumn("before", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)))
        .where("before < rest and before + in_slice >= rest")
        .select(F.col("source_key").alias("of"), F.col("slice").alias("end_slice"), "before")
    )
    last = sliced.join(ends, (F.col("source_key") == F.col("of")) & (F.col("slice") == F.col("end_slice")))
    inside = (
        Window.partitionBy("source_key").orderBy("rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        last.withColumn("upto", F.col("before") + F.sum("tokens").over(inside))
        .where("upto - tokens < rest")
        .groupBy("source_key")
        .agg(F.max("rank").alias("last"))
    )


def mix(
    docs: DataFrame,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The input rows, each repeated per block it is in, with ``block`` (from 1) and ``block_rank``.

    Tokens are words. Sorting a source's rows by (block, block_rank) gives its permutations. The
    partial block ends with the document that reaches the budget, so a source misses its target by
    less than one document. Null source is a source; sources without tokens are used once; rows that
    share an id share their rank and stay together; a null id ranks as an empty one. An empty table
    gives no rows. A column named ``block`` or ``block_rank`` is replaced.
    """
    tokens = stored_copy(source_tokens(docs, source, text), "mixing-sources")
    step = exponent_step(tokens, max_repeats, target_entropy)
    plan = stored_copy(plan_sources(tokens, step), "mixing-plan")
    keyed = picked(docs, doc_id=doc_id, source=source, text=text).select(
        "doc_id", _key(F.col("source").cast("string")).alias("source_key"),
        tokens_of(F.col("text")).alias("tokens"),
    )
    # one row per source, of a size Spark knows when it plans the joins
    ranked = keyed.join(plan.drop("tokens"), "source_key").withColumn(
        "rank", _rank(F.col("doc_id"), F.col("whole") + 1)
    )
    cuts = stored_copy(cut_points(ranked), "mixing-cuts").withColumnRenamed("source_key", "cut_key")
    named = docs.drop("block", "block_rank")
    key, whole, last = fresh(named, "key", "whole", "last")
    limits = plan.join(cuts, plan.source_key == cuts.cut_key, "left").select(
        F.col("source_key").alias(key), F.col("whole").alias(whole), F.col("last").alias(last)
    )
    joined = named.join(limits, _key(F.col(f"`{source}`").cast("string")) == F.col(key))
    extra = F.coalesce(_rank(F.col(f"`{doc_id}`"), F.col(whole) + 1) <= F.col(last), F.lit(False))
    blocks = F.sequence(F.lit(1).cast("long"), F.col(whole) + extra.cast("long"))
    return (
        joined.withColumn("block", F.explode(blocks))
        .withColumn("block_rank", _rank(F.col(f"`{doc_id}`"), F.col("block")))
        .drop(key, whole, last)
    )
