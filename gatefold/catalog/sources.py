"""Sources, sinks and streaming jobs.

Landing folders are written by Spark from the mapped tables, streamed with availableNow and
read back. Half of the files arrive before the first run and the rest before the second, so
every query also shows that a second run picks up only what is new.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import roles
from ..plans import silver
from ..session import scratch_dir
from ..sources.files import stream_json
from ..sources.layers import append_delivery, read_layer, rewrite_deliveries, write_keyed, write_layer
from ..streaming import jobs
from .quality import ACCEPTED, warn_sql
from .registry import query

TICKET_SCHEMA = (
    "ticket_id STRING, customer_id STRING, game_id STRING, game_date DATE, section_tier STRING, "
    "seat_row STRING, seat_number STRING, ticket_price DOUBLE, purchase_channel STRING, "
    "purchase_ts DATE, is_promo_ticket BOOLEAN, is_jersey_night_game BOOLEAN, "
    "is_lapsed_reactivation BOOLEAN, season_phase STRING"
)
CUSTOMER_SCHEMA = (
    "customer_id STRING, full_name STRING, email STRING, phone STRING, zip_code STRING, state STRING, "
    "acquisition_channel STRING, initial_segment STRING, is_season_holder BOOLEAN, signup_date DATE, "
    "is_jersey_night_acq BOOLEAN, is_deeply_lapsed BOOLEAN"
)
QUARANTINE_SCHEMA = (
    "ticket_id STRING, customer_id STRING, game_id STRING, ticket_price DOUBLE, "
    "purchase_channel STRING, season_phase STRING"
)
AS_DOUBLE = "* REPLACE (CAST(ticket_price AS DOUBLE) AS ticket_price)"


def _drops(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows in two deliveries, cut by a hash of the whole row: together they are all rows."""
    first = F.xxhash64(*df.columns) >= 0
    return df.filter(first), df.filter(~first)


def _land(df: DataFrame, folder: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(folder)


def _two_runs(t, name: str, df: DataFrame, job) -> tuple[str, str]:
    """Land half, run, land the rest, run again; returns (output, landing) folders."""
    root = scratch_dir(t.spark, name)
    landing, out = f"{root}/landing", f"{root}/out"
    for part in _drops(df):
        _land(part, landing)
        job(landing, out, f"{root}/checkpoint")
    return out, landing


def _ingested(t, name: str, table: str, schema: str) -> DataFrame:
    def job(landing, out, checkpoint):
        jobs.ingest_stream(t.spark, landing, schema, out, checkpoint)

    out, _ = _two_runs(t, name, t(table), job)
    return t.spark.read.parquet(out)


@query("src_stream_json_tickets", f"SELECT {AS_DOUBLE} FROM raw_tickets_stream")
def _(t):
    return _ingested(t, "src_tickets", "raw_tickets_stream", TICKET_SCHEMA)


@query("src_stream_json_customers", "SELECT * FROM raw_customers_stream")
def _(t):
    return _ingested(t, "src_customers", "raw_customers_stream", CUSTOMER_SCHEMA)


@query(
    "src_json_infer_evolve",
    "SELECT customer_id, full_name, CASE WHEN is_season_holder THEN state END AS state FROM raw_customers_stream",
)
def _(t):
    """The second delivery brings a new column; after the restart it is part of the table."""
    root = scratch_dir(t.spark, "src_infer")
    landing, out, checkpoint = f"{root}/landing", f"{root}/out", f"{root}/checkpoint"
    people = t("raw_customers_stream")
    holder = F.col("is_season_holder")
    deliveries = [
        people.filter(~holder).select("customer_id", "full_name"),
        people.filter(holder).select("customer_id", "full_name", "state"),
    ]
    for delivery in deliveries:
        _land(delivery, landing)
        stream = stream_json(t.spark, landing, infer=True, schema_store=f"{root}/schema")
        jobs.run_stream(stream, out, checkpoint)
    merged = t.spark.read.option("mergeSchema", "true").parquet(out)
    return merged.select("customer_id", "full_name", "state")


@query("src_stream_table", f"SELECT {AS_DOUBLE} FROM raw_tickets_stream")
def _(t):
    """A first delivery, which is then rewritten by itself, and a second one."""
    root = scratch_dir(t.spark, "src_table_stream")
    first, second = _drops(t("raw_tickets_stream"))

    def run():
        jobs.run_from_tables(
            t.spark, root, "bronze", ["tickets"],
            lambda rows: jobs.run_stream(rows, f"{root}/out", f"{root}/checkpoint"), f"{root}/checkpoint",
        )

    append_delivery(first, root, "bronze", "tickets")
    run()
    rewrite_deliveries(read_layer(t.spark, root, "bronze", "tickets"), root, "bronze", "tickets")
    run()
    append_delivery(second, root, "bronze", "tickets")
    run()
    return t.spark.read.parquet(f"{root}/out")


@query("src_table", "SELECT customer_id, full_name, tenure_days FROM dim_customer")
def _(t):
    root = scratch_dir(t.spark, "src_table")
    write_layer(t("dim_customer"), root, "silver", "dim_customer")
    return read_layer(t.spark, root, "silver", "dim_customer").select("customer_id", "full_name", "tenure_days")


@query("sink_overwrite", "SELECT game_id, game_number, result AS outcome FROM dim_game")
def _(t):
    """The second version is computed from the first while that is current."""
    root = scratch_dir(t.spark, "sink_overwrite")
    first = write_layer(t("dim_game"), root, "silver", "dim_game")
    narrow = first.select("game_id", "game_number", F.col("result").alias("outcome"))
    write_layer(narrow, root, "silver", "dim_game", mode="overwrite")
    return read_layer(t.spark, root, "silver", "dim_game")


@query("sink_append", "SELECT customer_id, full_name FROM raw_customers UNION ALL SELECT customer_id, full_name FROM raw_customers_stream")
def _(t):
    root = scratch_dir(t.spark, "sink_append")
    for name in ("raw_customers", "raw_customers_stream"):
        part = t(name).select("customer_id", "full_name")
        write_layer(part, root, "bronze", "customers", mode="append")
    return read_layer(t.spark, root, "bronze", "customers")


@query("sink_stream_append", "SELECT customer_id, acquisition_channel, signup_date FROM raw_customers_stream")
def _(t):
    def job(landing, out, checkpoint):
        stream = stream_json(t.spark, landing, CUSTOMER_SCHEMA, lineage=False)
        kept = stream.select("customer_id", "acquisition_channel", "signup_date")
        jobs.run_stream(kept, out, checkpoint)

    out, _ = _two_runs(t, "sink_stream", t("raw_customers_stream"), job)
    return t.spark.read.parquet(out)


@query("sink_keyed_overwrite", "SELECT customer_id, frequency_games, monetary_net FROM fan_features")
def _(t):
    root = scratch_dir(t.spark, "sink_keyed")
    features = t("fan_features").select("customer_id", "frequency_games", "monetary_net")
    for _ in range(2):
        write_keyed(features, root, "gold", "fan_features", ["customer_id"])
    return read_layer(t.spark, root, "gold", "fan_features")


@query("stream_ingest_once", f"SELECT 1 AS times_seen, count(*) AS n FROM raw_tickets_stream")
def _(t):
    """How often each landed row was ingested over three runs (the third without new files)."""
    from pyspark.sql.functions import count

    def job(landing, out, checkpoint):
        jobs.ingest_stream(t.spark, landing, TICKET_SCHEMA, out, checkpoint, max_files=4)

    rows = t("raw_tickets_stream")
    out, landing = _two_runs(t, "ingest_once", rows, job)
    job(landing, out, out.rsplit("/", 1)[0] + "/checkpoint")
    keys = ["ticket_id", "customer_id", "game_id", "seat_number", "ticket_price", "purchase_ts"]
    text = [F.col(c).cast("double") if c == "ticket_price" else F.col(c) for c in keys]
    landed = rows.select(*text).toDF(*keys).groupBy(*keys).agg(count(F.lit(1)).alias("expected"))
    stored_rows = t.spark.read.parquet(out).groupBy(*keys).agg(count(F.lit(1)).alias("got"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in keys]
    joined = landed.alias("l").join(stored_rows.alias("s"), same, "full")
    ratio = (F.coalesce("got", F.lit(0)) / F.col("expected")).cast("int")
    return joined.groupBy(ratio.alias("times_seen")).agg(F.sum("expected").alias("n"))


# Files of a table stream in one micro-batch.
FILES_PER_BATCH = 6


def _union_enriched(t):
    """Past sales as a table stream and new drops as a second source; returns the job's folder."""
    root = scratch_dir(t.spark, "union_enrich")
    seats = {c: F.col(c).cast("string") for c in ("seat_row", "seat_number")}
    append_delivery(t("raw_tickets").withColumns(seats), root, "bronze", "raw_tickets")

    def enriched(seed, new):
        jobs.silver_stream(
            seed, new, lambda df: silver.enrich_ticket(df, roles.TIER_RANKS), silver.TICKET_DROP_RULES,
            f"{root}/out", f"{root}/checkpoint", silver.warn_rules("fact_tickets", **ACCEPTED), f"{root}/warned",
        )

    for part in _drops(t("raw_tickets_stream")):
        append_delivery(part, root, "bronze", "raw_tickets_stream")
        jobs.run_from_tables(
            t.spark, root, "bronze", ["raw_tickets", "raw_tickets_stream"], enriched, f"{root}/checkpoint",
            max_files=FILES_PER_BATCH,
        )
    return root


@query("stream_union_enrich", f"SELECT {AS_DOUBLE} FROM fact_tickets")
def _(t):
    """The ticket fact as a streaming table, its history taken in bounded batches."""
    return t.spark.read.parquet(f"{_union_enriched(t)}/out").drop("batch_id")


@query("stream_warn_tickets", warn_sql("fact_tickets", "fact_tickets"))
def _(t):
    """Warn counts of the streamed ticket fact, added up over its batches."""
    return _warned(t, _union_enriched(t))


def _warned(t, root):
    return t.spark.read.parquet(f"{root}/warned").groupBy("rule").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("violations").alias("violations")
    )


def _customer_stream(t) -> str:
    """Seed customers as a table stream and sign-ups as a second one, in two deliveries."""
    root = scratch_dir(t.spark, "dim_customer")
    append_delivery(t("raw_customers"), root, "bronze", "raw_customers")
    cleaned = tuple(
        lambda df, label=label: silver.clean_customer(df, label, roles.AS_OF) for label in ("seed", "simulator")
    )

    def enriched(seed, new):
        jobs.silver_stream(
            seed, new, cleaned, silver.CUSTOMER_DROP_RULES, f"{root}/out", f"{root}/checkpoint",
            silver.warn_rules("dim_customer", **ACCEPTED), f"{root}/warned",
        )

    for part in _drops(t("raw_customers_stream")):
        append_delivery(part, root, "bronze", "raw_customers_stream")
        jobs.run_from_tables(
            t.spark, root, "bronze", ["raw_customers", "raw_customers_stream"], enriched, f"{root}/checkpoint",
            max_files=FILES_PER_BATCH,
        )
    return root


@query("stream_dim_customer", "SELECT * FROM dim_customer")
def _(t):
    """The customer dimension as a streaming table."""
    return t.spark.read.parquet(f"{_customer_stream(t)}/out").drop("batch_id")


@query("stream_warn_customer", warn_sql("dim_customer", "dim_customer"))
def _(t):
    """Warn counts of the streamed customer dimension, added up over its batches."""
    return _warned(t, _customer_stream(t))


@query("stream_quarantine", "SELECT * FROM quarantine_tickets")
def _(t):
    def job(landing, out, checkpoint):
        jobs.quarantine_stream(
            t.spark, landing, QUARANTINE_SCHEMA, silver.QUARANTINE_REASONS, out, checkpoint
        )

    out, _ = _two_runs(t, "quarantine", t("raw_tickets_all"), job)
    return t.spark.read.parquet(out)


@query(
    "stream_split",
    """SELECT ticket_id, customer_id, game_id, CAST(ticket_price AS DOUBLE) AS ticket_price,
        coalesce(ticket_id IS NOT NULL AND customer_id IS NOT NULL AND game_id IS NOT NULL AND ticket_price > 0, FALSE) AS is_good
        FROM raw_tickets_stream""",
)
def _(t):
    """One reader, two sinks: good and rejected rows together are all rows."""
    def job(landing, out, checkpoint):
        stream = stream_json(t.spark, landing, TICKET_SCHEMA, lineage=False)
        jobs.split_stream(stream, silver.TICKET_DROP_RULES, f"{out}/good", f"{out}/bad", checkpoint)

    out, _ = _two_runs(t, "stream_split", t("raw_tickets_stream"), job)
    cols = ["ticket_id", "customer_id", "game_id", "ticket_price"]
    good = t.spark.read.parquet(f"{out}/good").select(*cols, F.lit(True).alias("is_good"))
    return good.unionByName(
        t.spark.read.parquet(f"{out}/bad").select(*cols, F.lit(False).alias("is_good"))
    )


@query(
    "stream_dq_metrics",
    """SELECT rule, total_rows, violations FROM (
        SELECT 'ticket_id_not_null' AS rule, count(*) AS total_rows, count(*) FILTER (ticket_id IS NULL) AS violations FROM raw_tickets_stream
        UNION ALL SELECT 'customer_id_not_null', count(*), count(*) FILTER (customer_id IS NULL) FROM raw_tickets_stream
        UNION ALL SELECT 'game_id_not_null', count(*), count(*) FILTER (game_id IS NULL) FROM raw_tickets_stream
        UNION ALL SELECT 'price_positive', count(*), count(*) FILTER ((ticket_price > 0) IS NOT TRUE) FROM raw_tickets_stream)""",
)
def _(t):
    """Per-batch counts, added up over the batches."""
    def job(landing, out, checkpoint):
        stream = stream_json(t.spark, landing, TICKET_SCHEMA)
        jobs.dq_metrics_stream(stream, silver.TICKET_DROP_RULES, out, checkpoint)

    out, _ = _two_runs(t, "dq_metrics", t("raw_tickets_stream"), job)
    per_batch = t.spark.read.parquet(out)
    return per_batch.groupBy("rule").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("violations").alias("violations")
    )
