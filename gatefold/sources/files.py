"""File sources: JSON drops as a stream, stored tables as a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .layers import DELIVERY, read_layer, table_name


LEDGER = "path string, length long, schema string, n_columns int, looked_at timestamp"


def _with_lineage(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_name").alias("_source_filename"),
    )


def _kept(spark: SparkSession, store: str) -> DataFrame | None:
    """The ledger of inspected files, None before the first look."""
    try:
        return spark.read.schema(LEDGER).parquet(store)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def inferred_schema(spark: SparkSession, path: str, store: str | None = None) -> StructType:
    """Schema over all files dropped so far, new columns included.

    With ``store`` a ledger of the files looked at (path, length) is kept in that folder, together with
    the schema they gave. Only files that are not in it are read, whatever their age: their new columns
    are added, known ones keep their type. A file that grew is looked at again.
    """
    if store is None:
        return spark.read.json(path).schema
    ledger = _kept(spark, store)
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    )
    fresh, schema = listed, StructType()
    if ledger is not None:
        latest = ledger.agg(F.max_by("schema", F.struct("looked_at", "n_columns")).alias("s")).first().s
        schema = StructType.fromDDL(latest) if latest else schema
        fresh = listed.join(ledger.select("path", "length"), ["path", "length"], "left_anti")
    new = fresh.collect()  # as long as the list of new files that the stream's source keeps anyway
    if not new:
        return schema
    found = spark.read.json([r.path for r in new]).schema
    merged = StructType([*schema.fields, *[f for f in found.fields if f.name not in schema.names]])
    noted = spark.createDataFrame(new, "path string, length long").select(
        "*", F.lit(merged.toDDL()).alias("schema"), F.lit(len(merged)).alias("n_columns"),
        F.current_timestamp().alias("looked_at"),
    )
    noted.coalesce(1).write.mode("append").parquet(store)
    return merged


def stream_json(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    lineage: bool = True,
    infer: bool = False,
    schema_store: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """JSON files of a landing folder as a stream; each file is read once per checkpoint.

    A value that does not fit the declared schema becomes NULL and its row is kept. With
    ``infer`` the schema is taken from the files present at start; restart the stream after
    files with new columns arrive and the columns are added. ``schema_store`` keeps it between starts.
    """
    if (schema is None) != infer:
        raise ValueError("give a schema, or ask for infer=True")
    reader = spark.readStream.schema(inferred_schema(spark, path, schema_store) if infer else schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.json(path)
    return _with_lineage(df) if lineage else df


def stream_table(
    spark: SparkSession, base: str, layer: str, name: str, since: int = 0,
    max_files: int | None = None, max_bytes: int | None = None,
) -> DataFrame:
    """A table of deliveries as a stream of its rows; each file is read once per checkpoint.

    Rows of deliveries up to ``since`` are left out, so deliveries that were consumed and then
    rewritten do not come again. ``max_files`` or ``max_bytes`` bound a micro-batch: a long history is
    taken in steps. Give at most one of them.
    """
    if max_files and max_bytes:
        raise ValueError("bound a batch by files or by bytes, not both")
    schema = read_layer(spark, base, layer, name).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    folder = _folder(spark, table_name(spark, base, layer, name))
    return reader.parquet(folder).where(F.col(DELIVERY) > since).drop(DELIVERY)


def _folder(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'")
    return described.first().data_type
