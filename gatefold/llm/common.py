"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# A word is a run of anything but ASCII white space; ``bytes.split()`` cuts at the same bytes.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text, in order; an empty array for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns under the operator's own names; all others are left behind."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


# Spark's switch to remove the shuffle files of a query as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_copy(df: DataFrame, label: str, buckets: dict[str, int] | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts lineage like a checkpoint, but as a scan whose size the optimizer knows and from which
    columns can be pruned. The shuffles behind it leave the executors' disks once it is written. ``buckets``
    names a column and a number of buckets: the copy is read as dealt by that column, without another exchange.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"{label}-{uuid.uuid4().hex[:6]}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        if not buckets:
            df.write.mode("overwrite").parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        ((column, n),) = buckets.items()
        table = f"gatefold_{uuid.uuid4().hex}"
        df.write.bucketBy(n, column).option("path", path).saveAsTable(table, format="parquet")
        return spark.table(table)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(value: bytes | None) -> str:
    return "" if value is None else value.decode("utf-8", "replace")


def chunks(rows: Iterable, size_of, limit: int = 8 << 20, most: int = 4096) -> Iterator[list]:
    """Lists of rows of about ``limit`` bytes and at most ``most`` rows: bounds memory, not rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= limit or len(held) >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
