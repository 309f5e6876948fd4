"""Tables stored per layer (bronze / silver / gold) as Parquet tables of the Spark catalog.

A base folder is a database with that location. Buckets and key contracts are kept by the catalog,
appends are plain inserts, and tables that are streamed are cut into numbered deliveries.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DELIVERY = "delivery"
_KEYS = "gatefold.keys"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def table_name(spark: SparkSession, base: str, layer: str, name: str) -> str:
    """Catalog name of a stored table; its database is made on first use."""
    base = base.rstrip("/")
    database = f"gatefold_{hashlib.md5(base.encode()).hexdigest()[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}'")
    return f"{database}.{layer}_{name}"


def _existing(spark: SparkSession, base: str, layer: str, name: str) -> str:
    table = table_name(spark, base, layer, name)
    if not spark.catalog.tableExists(table):
        raise FileNotFoundError(f"no table {layer}.{name} under {base}")
    return table


def read_layer(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """A stored table, with its buckets if it has any."""
    return spark.table(_existing(spark, base, layer, name))


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _save(df: DataFrame, table: str, mode: str, bucket_by: str | None, buckets: int | None) -> None:
    if bucket_by is None:
        # Bucketed tables keep the default: a scan orders their files by size, and fitted models see that order.
        df.write.mode(mode).format("parquet").option("compression", "zstd").saveAsTable(table)
        return
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(n, bucket_by).write.mode(mode).format("parquet")
        .bucketBy(n, bucket_by).sortBy(bucket_by).saveAsTable(table)
    )


def _staged(df: DataFrame, table: str, bucket_by: str | None, buckets: int | None) -> str:
    staged = f"{table}_{uuid.uuid4().hex[:12]}"
    _save(df, staged, "error", bucket_by, buckets)
    return staged


def _swap(spark: SparkSession, staged: str, table: str) -> DataFrame:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    return spark.table(table)


def write_layer(
    df: DataFrame,
    base: str,
    layer: str,
    name: str,
    mode: str = "overwrite",
    bucket_by: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Store a table and return it read back.

    ``overwrite`` replaces data and schema; ``df`` may read the table it replaces, and a failed
    write leaves the old table. ``append`` inserts by column name and keeps buckets; a keyed table
    refuses it, as nothing would check the keys. With ``bucket_by`` the rows are stored in hash buckets
    of that (unique) key, so later joins and aggregations on it need no shuffle.
    """
    spark = df.sparkSession
    table = table_name(spark, base, layer, name)
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "append" and spark.catalog.tableExists(table):
        if _KEYS in _properties(spark, table):
            raise ValueError(f"{layer}.{name} is keyed: overwrite it instead")
        found = _bucket_spec(spark, table)
        _save(df, table, "append", *(found or (None, None)))
        return spark.table(table)
    return _swap(spark, _staged(df, table, bucket_by, buckets), table)


def _bucket_spec(spark: SparkSession, table: str) -> tuple[str, int] | None:
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if "Num Buckets" not in described:
        return None
    return described["Bucket Columns"].strip("[]`"), int(described["Num Buckets"])


class KeyViolation(ValueError):
    """A keyed table has NULL or repeated keys."""


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter((F.col("n_rows") > 1) | null_key)


def write_keyed(
    df: DataFrame,
    base: str,
    layer: str,
    name: str,
    keys: Sequence[str],
    bucket_by: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Create or overwrite a table with a primary-key contract.

    The rows are stored under another name, checked as stored, and only then take the table's name;
    on a violation the previous table stays.
    """
    spark = df.sparkSession
    table = table_name(spark, base, layer, name)
    staged = _staged(df, table, bucket_by, buckets)
    bad = key_violations(spark.table(staged), keys).limit(3).collect()
    if bad:
        spark.sql(f"DROP TABLE {staged}")
        raise KeyViolation(f"{layer}.{name}: NULL or repeated key, for example {bad}")
    spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ('{_KEYS}' = '{','.join(keys)}')")
    return _swap(spark, staged, table)


# ---------------------------------------------------------------- deliveries


def last_delivery(spark: SparkSession, base: str, layer: str, name: str) -> int:
    """Number of the latest delivery of a table, 0 if it has none yet."""
    table = table_name(spark, base, layer, name)
    if not spark.catalog.tableExists(table):
        return 0
    return spark.table(table).agg(F.max(DELIVERY)).first()[0] or 0


def append_delivery(df: DataFrame, base: str, layer: str, name: str) -> int:
    """Add the rows as the next delivery of a table, a partition of its own; returns its number.

    One writer at a time: numbers are taken from what is stored.
    """
    spark = df.sparkSession
    number = last_delivery(spark, base, layer, name) + 1
    numbered = df.withColumn(DELIVERY, F.lit(number))
    numbered.write.mode("append").format("parquet").partitionBy(DELIVERY).saveAsTable(
        table_name(spark, base, layer, name)
    )
    return number


def rewrite_deliveries(df: DataFrame, base: str, layer: str, name: str) -> None:
    """Replace the deliveries that occur in ``df`` (which may read the table); others stay.

    Streams that have read them skip the rewritten rows.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    table = _existing(spark, base, layer, name)
    rows = df.select(*spark.table(table).columns).checkpoint()
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE, before)
