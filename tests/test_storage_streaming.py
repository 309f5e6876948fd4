import json

import pytest
from pyspark.sql import functions as F

from gatefold.operators.quality import expect_or_drop
from gatefold.sources.files import stream_json, stream_table
from gatefold.sources.layers import (
    KeyViolation,
    append_delivery,
    last_delivery,
    read_layer,
    rewrite_deliveries,
    write_keyed,
    write_layer,
)
from gatefold.streaming import jobs

SCHEMA = "ticket_id STRING, ticket_price DOUBLE"
RULES = {"ticket_id_not_null": "ticket_id IS NOT NULL", "price_positive": "ticket_price > 0"}


def drop(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_overwrite_replaces_schema_while_the_old_table_is_read(spark, tmp_path):
    base = str(tmp_path)
    first = write_layer(spark.range(5).withColumnRenamed("id", "a"), base, "gold", "t")
    second = write_layer(first.select((F.col("a") * 2).alias("b")), base, "gold", "t")
    assert second.columns == ["b"] and read_layer(spark, base, "gold", "t").count() == 5
    write_layer(second, base, "gold", "t", mode="append")
    assert sorted(r.b for r in read_layer(spark, base, "gold", "t").collect()) == sorted([0, 2, 4, 6, 8] * 2)
    with pytest.raises(ValueError):
        write_layer(second, base, "gold", "t", mode="merge")
    with pytest.raises(FileNotFoundError):
        read_layer(spark, base, "gold", "other")


def test_failed_overwrite_keeps_the_old_table(spark, tmp_path):
    base = str(tmp_path)
    write_layer(spark.range(3), base, "gold", "t")
    with pytest.raises(Exception, match="boom"):
        write_layer(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), base, "gold", "t")
    assert read_layer(spark, base, "gold", "t").count() == 3


def test_keyed_write_keeps_the_previous_version_on_violation(spark, tmp_path):
    base = str(tmp_path)
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_keyed(good, base, "gold", "f", ["k"])
    for bad in ([("a", 1), ("a", 2)], [(None, 1)]):
        with pytest.raises(KeyViolation):
            write_keyed(spark.createDataFrame(bad, "k string, v int"), base, "gold", "f", ["k"])
    assert read_layer(spark, base, "gold", "f").count() == 2
    write_keyed(good.limit(1), base, "gold", "f", ["k"])
    assert read_layer(spark, base, "gold", "f").count() == 1


def test_bucketed_keyed_table_recovers_after_a_violation(spark, tmp_path):
    base = str(tmp_path)
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(KeyViolation):
        write_keyed(twice, base, "gold", "b", ["k"], bucket_by="k")
    with pytest.raises(FileNotFoundError):
        read_layer(spark, base, "gold", "b")
    stored = write_keyed(twice.limit(1), base, "gold", "b", ["k"], bucket_by="k", buckets=2)
    assert stored.count() == read_layer(spark, base, "gold", "b").count() == 1


def test_json_is_ingested_once_with_lineage_and_nulls_for_bad_values(spark, tmp_path):
    landing = tmp_path / "landing"
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    drop(landing, "a.json", {"ticket_id": "t1", "ticket_price": 5.0}, {"ticket_id": "t2", "ticket_price": "oops"})
    jobs.ingest_stream(spark, str(landing), SCHEMA, out, check)
    drop(landing, "b.json", {"ticket_id": "t3", "ticket_price": 1.0, "extra": 1})
    for _ in range(2):
        jobs.ingest_stream(spark, str(landing), SCHEMA, out, check)
    got = {r.ticket_id: r for r in spark.read.parquet(out).collect()}
    assert len(got) == spark.read.parquet(out).count() == 3
    assert got["t2"].ticket_price is None
    assert got["t3"]._source_filename == "b.json" and got["t3"]._source_file.endswith("b.json")
    assert got["t1"]._ingested_at is not None


def test_inferred_schema_grows_after_restart(spark, tmp_path):
    landing = tmp_path / "landing"
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    drop(landing, "a.json", {"k": "x"})
    jobs.run_stream(stream_json(spark, str(landing), infer=True, lineage=False), out, check)
    drop(landing, "b.json", {"k": "y", "n": 7})
    jobs.run_stream(stream_json(spark, str(landing), infer=True, lineage=False), out, check)
    merged = spark.read.option("mergeSchema", "true").parquet(out)
    assert sorted(tuple(r) for r in merged.select("k", "n").collect()) == [("x", None), ("y", 7)]
    with pytest.raises(ValueError):
        stream_json(spark, str(landing))


def test_union_quarantine_split_and_metrics(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path)
    rows = [{"ticket_id": "a", "ticket_price": 2.0}, {"ticket_id": None, "ticket_price": 2.0}, {"ticket_id": "c", "ticket_price": 0.0}, {"ticket_id": "d"}]
    drop(landing, "a.json", *rows)
    seed = spark.createDataFrame([("s", 3.0)], "ticket_id string, ticket_price double")
    append_delivery(seed, base, "bronze", "seed")

    def streams():
        return (
            stream_table(spark, base, "bronze", "seed"),
            stream_json(spark, str(landing), SCHEMA, lineage=False),
        )

    jobs.silver_stream(*streams(), lambda d: d.withColumn("twice", F.col("ticket_price") * 2), RULES, f"{base}/silver", f"{base}/c1")
    assert sorted((r.ticket_id, r.twice) for r in spark.read.parquet(f"{base}/silver").collect()) == [("a", 4.0), ("s", 6.0)]

    reasons = [("no_id", "ticket_id IS NULL"), ("no_price", "ticket_price <= 0")]
    jobs.quarantine_stream(spark, str(landing), SCHEMA, reasons, f"{base}/bad", f"{base}/c2")
    bad = spark.read.parquet(f"{base}/bad")
    assert sorted(r.quarantine_reason for r in bad.collect()) == ["no_id", "no_price"]
    assert {"quarantine_ts", "_source_file", "_source_filename"} <= set(bad.columns)

    for _ in range(2):
        jobs.split_stream(streams()[1], RULES, f"{base}/g", f"{base}/b", f"{base}/c3")
        jobs.dq_metrics_stream(streams()[1], RULES, f"{base}/m", f"{base}/c4")
    assert spark.read.parquet(f"{base}/g").count() == 1 and spark.read.parquet(f"{base}/b").count() == 3
    metrics = {r.rule: (r.total_rows, r.violations) for r in spark.read.parquet(f"{base}/m").collect()}
    assert metrics == {"ticket_id_not_null": (4, 1), "price_positive": (4, 2)}
    batch = spark.read.schema(SCHEMA).json(str(landing))
    assert expect_or_drop(batch, RULES).count() == spark.read.parquet(f"{base}/g").count()


def test_table_stream_skips_a_rewrite_and_reads_later_deliveries(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(5).withColumnRenamed("id", "a")

    def run(job="c", out="out"):
        jobs.run_from_tables(
            spark, base, "bronze", ["t"], lambda s: jobs.run_stream(s, f"{base}/{out}", f"{base}/{job}"), f"{base}/{job}"
        )
        return sorted(r.a for r in spark.read.parquet(f"{base}/{out}").collect())

    assert last_delivery(spark, base, "bronze", "t") == 0
    append_delivery(rows, base, "bronze", "t")
    assert run() == [0, 1, 2, 3, 4]
    append_delivery(rows.selectExpr("a + 10 as a"), base, "bronze", "t")
    table = read_layer(spark, base, "bronze", "t")
    rewrite_deliveries(table.where("a < 3"), base, "bronze", "t")  # delivery 1 only
    assert read_layer(spark, base, "bronze", "t").count() == 8
    assert run() == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14] == run()
    assert run("d", "out2") == [0, 1, 2, 10, 11, 12, 13, 14]  # a new job reads what is stored


def test_table_stream_takes_a_long_history_in_bounded_batches(spark, tmp_path):
    base = str(tmp_path)
    append_delivery(spark.range(60).repartition(6), base, "bronze", "t")
    with pytest.raises(ValueError):
        stream_table(spark, base, "bronze", "t", max_files=1, max_bytes=1)
    for bound, batches in (({"max_files": 2}, 3), ({"max_bytes": 1}, 6)):
        out = f"{base}/{batches}"

        def job(rows, out=out):
            jobs.silver_stream(
                rows, rows.where("false"), lambda d: d, {"known": "id >= 0"}, f"{out}/o", f"{out}/c",
                {"small": "id < 50", "known": "id IS NOT NULL"}, f"{out}/w",
            )

        jobs.run_from_tables(spark, base, "bronze", ["t"], job, f"{out}/c", **bound)
        written = spark.read.parquet(f"{out}/o")
        assert written.count() == 60 and written.select("batch_id").distinct().count() == batches
        warned = spark.read.parquet(f"{out}/w").groupBy("rule").agg(F.sum("total_rows").alias("n"), F.sum("violations").alias("v"))
        assert {r.rule: (r.n, r.v) for r in warned.collect()} == {"small": (60, 10), "known": (60, 0)}


def test_warn_counts_survive_a_replayed_batch(spark, tmp_path):
    write = jobs._watched_writer({"small": "id < 3"}, str(tmp_path / "o"), str(tmp_path / "w"))
    for _ in range(2):
        write(spark.range(5), 7)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 5
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "w")).collect()] == [("small", 5, 2, 7)]


def test_a_source_joins_a_running_union_later(spark, tmp_path):
    base = str(tmp_path)

    def run(*names):
        sources = {n: stream_table(spark, base, "bronze", n) for n in names}
        jobs.union_streams(sources, f"{base}/out", f"{base}/c")
        return sorted((r.source, r.id) for r in spark.read.parquet(f"{base}/out").select("source", "id").collect())

    append_delivery(spark.range(2), base, "bronze", "a")
    assert run("a") == [("a", 0), ("a", 1)]
    append_delivery(spark.range(5, 6), base, "bronze", "a")
    append_delivery(spark.range(7, 8), base, "bronze", "b")
    assert run("a", "b") == [("a", 0), ("a", 1), ("a", 5), ("b", 7)] == run("b", "a")


def test_buckets_spare_shuffles_and_take_appends(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(40).selectExpr("id as k", "id % 7 as v")
    write_layer(rows, base, "gold", "b", bucket_by="k", buckets=4)
    write_layer(rows.selectExpr("k + 40 as k", "v"), base, "gold", "b", mode="append")
    again = read_layer(spark, base, "gold", "b")
    assert again.count() == 80
    plan = again.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    write_keyed(rows, base, "gold", "f", ["k"])
    with pytest.raises(ValueError):
        write_layer(rows, base, "gold", "f", mode="append")


def test_expectations_ride_along_a_stream(spark, tmp_path):
    from gatefold.operators.quality import expect

    landing = tmp_path / "in"
    drop(landing, "1.json", {"ticket_id": "a", "ticket_price": 2.0}, {"ticket_id": None, "ticket_price": -1.0})
    stream = stream_json(spark, str(landing), SCHEMA, lineage=False)
    with pytest.raises(ValueError):
        expect(stream, RULES)
    watched, _ = expect(stream, RULES, "w")
    query = (
        watched.writeStream.format("parquet").option("path", str(tmp_path / "o"))
        .option("checkpointLocation", str(tmp_path / "k")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    seen = [p.observedMetrics["w"] for p in query.recentProgress if "w" in p.observedMetrics]
    assert [(s.rows_seen, s.ticket_id_not_null, s.price_positive) for s in seen] == [(2, 1, 1)]


def test_stored_tables_follow_their_source(spark, tmp_path):
    from gatefold.plans.stored import source_state

    (tmp_path / "t.parquet").write_text("x")
    first = source_state(spark, str(tmp_path))
    assert first == source_state(spark, str(tmp_path))
    (tmp_path / "u.parquet").write_text("y")
    assert first != source_state(spark, str(tmp_path))


def test_inferred_schema_is_kept_and_grows(spark, tmp_path):
    from gatefold.sources.files import inferred_schema

    landing, store = tmp_path / "in", str(tmp_path / "schema")
    drop(landing, "1.json", {"a": 1})
    assert inferred_schema(spark, str(landing), store).names == ["a"]
    drop(landing, "2.json", {"b": "x", "a": 2})
    assert inferred_schema(spark, str(landing), store).names == ["a", "b"]
    import os

    drop(landing, "0.json", {"c": 1.5, "a": 3})
    os.utime(landing / "0.json", (1_000_000_000, 1_000_000_000))  # copied in with an old time
    assert inferred_schema(spark, str(landing), store).names == ["a", "b", "c"]
    assert inferred_schema(spark, str(landing), store).names == ["a", "b", "c"]
    looked = spark.read.parquet(store)
    assert looked.count() == 3 == looked.select("path").distinct().count()
