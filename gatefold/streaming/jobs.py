"""Streaming jobs: append-only, stateless, resumable from their checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Rules, dq_report, expect, expect_or_drop, quarantine, split
from ..operators.sets import union_sources
from ..sources.files import stream_json, stream_table
from ..sources.layers import last_delivery


def run_stream(df: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything available now and append it to parquet files, exactly once."""
    (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _run_batches(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    (
        df.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingest_stream(
    spark: SparkSession, landing: str, schema: str, out: str, checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Landing folder to bronze table with lineage columns."""
    run_stream(stream_json(spark, landing, schema, max_files=max_files), out, checkpoint)


def consumed(spark: SparkSession, checkpoint: str) -> dict[str, int]:
    """Last delivery of each table that finished runs over this checkpoint have taken in."""
    try:
        noted = spark.read.schema("name string, upto int").parquet(f"{checkpoint}-deliveries")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r.name: r.upto for r in noted.groupBy("name").agg(F.max("upto").alias("upto")).collect()}


def run_from_tables(
    spark: SparkSession, base: str, layer: str, names: Sequence[str], job: Callable[..., None],
    checkpoint: str, max_files: int | None = None, max_bytes: int | None = None,
) -> None:
    """Run ``job(*streams)`` over tables of deliveries until all that is there is taken in.

    Each table is a source with offsets of its own and bounded micro-batches. After the run the
    deliveries that were there before it are noted as consumed: rewriting them later changes nothing
    for this job. A run that dies notes nothing and is resumed from its checkpoint.
    """
    since = consumed(spark, checkpoint)
    upto = [(name, last_delivery(spark, base, layer, name)) for name in names]
    job(*[stream_table(spark, base, layer, n, since.get(n, 0), max_files, max_bytes) for n in names])
    noted = spark.createDataFrame(upto, "name string, upto int")
    noted.coalesce(1).write.mode("append").parquet(f"{checkpoint}-deliveries")


def silver_stream(
    seed: DataFrame,
    new: DataFrame,
    enrich: Callable[[DataFrame], DataFrame] | tuple[Callable, Callable],
    rules: Rules,
    out: str,
    checkpoint: str,
    warn: Rules | None = None,
    warn_out: str | None = None,
) -> None:
    """Two sources, one enrichment each, hard rules, one table.

    With ``warn`` the violations of those rules among the kept rows are observed while a batch is
    written, without another pass, and noted in ``warn_out``; a replayed batch overwrites its own
    folders.
    """
    first, second = enrich if isinstance(enrich, tuple) else (enrich, enrich)
    kept = expect_or_drop(union_sources(first(seed), second(new)), rules)
    if warn is None:
        run_stream(kept, out, checkpoint)
    else:
        _run_batches(kept, _watched_writer(warn, out, warn_out), checkpoint)


def _watched_writer(warn: Rules, out: str, warn_out: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        watched, seen = expect(batch, warn)
        watched.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        counts = seen.get
        rows = [(rule, counts["rows_seen"], counts[rule]) for rule in warn]
        noted = batch.sparkSession.createDataFrame(rows, "rule string, total_rows long, violations long")
        noted.coalesce(1).write.mode("overwrite").parquet(f"{warn_out}/batch_id={batch_id}")

    return write


def union_streams(sources: Mapping[str, DataFrame], out: str, checkpoint: str) -> None:
    """Any number of sources into one table, each with a checkpoint of its own.

    All run side by side, so a slow source holds up no other, and a source may join or leave between
    runs, which one query over a union cannot survive. Rows carry ``source``; a replayed batch
    overwrites its own folder.
    """

    def writer(name: str) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/source={name}/batch_id={batch_id}")

        return write

    running = [
        df.writeStream.foreachBatch(writer(name)).option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(availableNow=True).start()
        for name, df in sources.items()
    ]
    for query in running:
        query.awaitTermination()


def quarantine_stream(
    spark: SparkSession,
    landing: str,
    schema: str,
    reasons: Sequence[tuple[str, str]],
    out: str,
    checkpoint: str,
) -> None:
    """Independent second reader of a landing folder that keeps only the bad rows."""
    source = stream_json(spark, landing, schema).withColumnRenamed("_ingested_at", "quarantine_ts")
    run_stream(quarantine(source, reasons), out, checkpoint)


def split_stream(stream: DataFrame, rules: Rules, good_out: str, bad_out: str, checkpoint: str) -> None:
    """One reader, two tables. A replayed batch overwrites its own folder, so both stay exact."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split(batch, rules)
            good.write.mode("overwrite").parquet(f"{good_out}/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{bad_out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    _run_batches(stream, write, checkpoint)


def dq_metrics_stream(stream: DataFrame, rules: Rules, out: str, checkpoint: str) -> None:
    """Violation counts of every micro-batch: (rule, total_rows, violations, batch_id)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        report = dq_report(batch, rules).withColumn("_written_at", F.current_timestamp())
        report.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    _run_batches(stream, write, checkpoint)
