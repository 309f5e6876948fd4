"""Bottom-k sketches of word-shingle hashes as column expressions.

A sketch is the sorted array of the k smallest distinct shingle hashes. Sketches of parts merge
into the sketch of the whole, and two sketches estimate resemblance, containment and the number
of distinct shingles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions_of, picked, words_of
from ..session import ensure_checkpoint_dir

K = 64
WIDTH = 5
# Hashes are signed 64-bit: their spread is 2**64 and the smallest is -2**63.
_SPREAD, _LOWEST = float(2**64), float(-(2**63))


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all runs of ``width`` words; fewer words count as one run, none as no run."""
    words = words_of(text)

    def runs(w: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(1), F.size(w) - F.lit(width - 1)),
            lambda i: F.xxhash64(*[F.get(w, i + F.lit(k - 1)) for k in range(width)]),
        )
        one = F.array(F.xxhash64(w))
        return (
            F.when(F.size(w) >= width, several)
            .when(F.size(w) > 0, one)
            .otherwise(F.array().cast("array<bigint>"))
        )

    # transform over a one-element array binds the words once instead of splitting per use
    return F.get(F.transform(F.array(words), runs), F.lit(0))


def bottom_k(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct hashes, ascending."""
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """Sketch of a text; null and blank texts have the empty sketch."""
    return bottom_k(shingle_hashes(text, width), k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two parts."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's sketch that both sides hold.

    Two empty sketches are alike (1), an empty and a full one are not (0).
    """
    both = F.size(F.array_intersect(merged(a, b, k), F.array_intersect(a, b)))
    union = F.size(merged(a, b, k))
    return F.when(union == 0, F.lit(1.0)).otherwise(both.cast("double") / union)


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    reach = (F.get(s, F.lit(k - 1)).cast("double") - F.lit(_LOWEST)) / F.lit(_SPREAD)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.lit(k - 1.0) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds: common shingles over those of a."""
    common = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), common / distinct_count(a, k))
    )


def fingerprint(s: Column) -> Column:
    """A sketch as text: 16 hex digits per hash."""
    return F.concat_ws("", F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0")))


def merge_sketches(parts: DataFrame, by: Sequence[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One merged sketch per group, for any number of parts per group.

    Hashes are made distinct map-side, and the rank filter below keeps k rows per task before
    the shuffle, so a hot group sends k hashes per task.
    """
    hashes = parts.select(*by, F.explode(column).alias("hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("hash"))
    kept = hashes.withColumn("rank", rank).where(F.col("rank") <= k)
    return kept.groupBy(*by).agg(F.array_sort(F.collect_list("hash")).alias(column))


def next_ids(ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """(doc_id, next_id): the following distinct id, after the last one the first.

    Ids are range-partitioned into slices, checkpointed, and ordered inside their slice; the last
    id of a slice takes the first of the next one. Null ids have no place in the order.
    """
    spark = ids.sparkSession
    ensure_checkpoint_dir(spark)
    placed = (
        ids.where(F.col(column).isNotNull())
        .select(F.col(column).alias("doc_id"))
        .distinct()
        .repartitionByRange(partitions_of(spark), "doc_id")
        .withColumn("slice", F.spark_partition_id())
        .checkpoint()
    )
    firsts = placed.groupBy("slice").agg(F.min("doc_id").alias("first"))
    # one row per slice
    across = Window.orderBy("slice")
    heads = firsts.select(
        "slice",
        F.coalesce(
            F.lead("first").over(across),
            F.min("first").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("after"),
    )
    inside = placed.select(
        "doc_id",
        "slice",
        F.lead("doc_id").over(Window.partitionBy("slice").orderBy("doc_id")).alias("inner_next"),
    )
    return inside.join(heads, "slice").select(
        "doc_id", F.coalesce("inner_next", "after").alias("next_id")
    )


def fingerprints(
    docs: DataFrame, k: int = K, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_chars, text, sketch`` per row. Null text is empty; other columns are ignored."""
    rows = picked(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "text",
        sketch(F.col("text"), k, width).alias("sketch"),
    )


def edited_fingerprints(
    docs: DataFrame, k: int = K, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Sketch of each text, of its edited text and of the next document, with both likenesses.

    The edited text swaps the last quarter of the code points for the first ones of the next
    document by ascending id. Rows that share an id have the same next document; as a next
    document, the smallest of their texts stands for the id. A row without id has no next
    document: its tail is cut and ``near_next`` is 0.
    """
    rows = picked(docs, doc_id=doc_id, text=text)
    filled = F.coalesce("text", F.lit(""))
    # Both joins below need the same three columns under a key that is never null, so the texts are
    # shuffled once and that shuffle is used twice. A row without id has a key no id equals.
    own = rows.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), filled.alias("text"),
        sketch(filled, k, width).alias("sketch"),
    )
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    # How many code points the row before may ask for; a narrow scan that makes no sketch.
    asked = rows.groupBy("doc_id").agg(F.max(F.floor(F.char_length(filled) / 4)).cast("int").alias("need"))
    needs = (
        next_ids(rows)
        .join(asked, "doc_id")
        .select(
            F.coalesce(F.col("next_id").cast("string"), F.lit("")).alias("next_key"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("prev_key"), "need",
        )
    )
    tails = (
        own.join(needs, own.key == needs.next_key)
        .select("prev_key", F.expr("left(text, need)").alias("head"), F.col("sketch").alias("next_sketch"))
        .groupBy("prev_key")
        .agg(F.min(F.struct("head", "next_sketch")).alias("next"))
    )
    joined = own.join(tails, own.key == tails.prev_key, "left").select(
        F.expr("try_cast(key AS BIGINT)").alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"), "text", "sketch", "next",
    )
    edited = joined.withColumn(
        "edited",
        F.concat(
            F.expr("left(text, int(n_chars - floor(n_chars / 4)))"),
            F.coalesce(F.substring(F.col("next.head"), F.lit(1), quarter), F.lit("")),
        ),
    ).withColumn("edited_sketch", sketch(F.col("edited"), k, width))
    return edited.select(
        "doc_id", "n_chars", "text", "edited", "sketch", "edited_sketch",
        F.col("next.next_sketch").alias("next_sketch"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        F.coalesce(
            resemblance(F.col("sketch"), F.col("next.next_sketch"), k), F.lit(0.0)
        ).alias("near_next"),
    )
