"""The pipeline's stored tables for one source folder, built on first use.

Every layer reads the layer below as stored, as a production run would; a table is computed
once per application and state of the source folder, in the shared scratch folder. Silver tables
count their warn-only expectations while they are written.
"""

from __future__ import annotations

import contextlib
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import roles
from ..operators.grouping import customer_measures
from ..operators.sets import union_sources
from ..session import scratch_dir
from ..sources.layers import write_keyed, write_layer
from . import gold, silver

_BUILT: dict[tuple[str, str, str, str], DataFrame] = {}
# (rows and violations per rule) of the silver tables, by the same key
EXPECTED: dict[tuple[str, str, str, str], dict[str, int]] = {}


def _bronze(name: str):
    return lambda spark, sf: getattr(roles, name)(spark, sf)


def _raw_tickets_all(spark, sf):
    text = {c: F.col(c).cast("string") for c in ("seat_row", "seat_number")}
    return union_sources(
        stored(spark, sf, "raw_tickets").withColumns(text), stored(spark, sf, "raw_tickets_stream")
    )


def _dim_game(spark, sf):
    return silver.build_dim_game(stored(spark, sf, "raw_events"))


def _dim_customer(spark, sf):
    return silver.build_dim_customer(
        stored(spark, sf, "raw_customers"), stored(spark, sf, "raw_customers_stream"), roles.AS_OF
    )


def _fact_tickets(spark, sf):
    return silver.build_fact(
        stored(spark, sf, "raw_tickets"), stored(spark, sf, "raw_tickets_stream"), roles.TIER_RANKS
    )


def _bridge_promo(spark, sf):
    return silver.build_bridge_promo(stored(spark, sf, "raw_promotions"), roles.DEEP, roles.MODERATE)


def _quarantine(spark, sf):
    return silver.build_quarantine(stored(spark, sf, "raw_tickets_all"))


def _customer_measures(spark, sf):
    return customer_measures(stored(spark, sf, "fact_tickets"), roles.AS_OF, events=stored(spark, sf, "dim_game"))


def _customer_360(spark, sf):
    tables = [stored(spark, sf, n) for n in ("dim_customer", "fact_tickets", "bridge_promo")]
    return gold.customer_360(*tables, roles.AS_OF, measures=stored(spark, sf, "customer_measures"))


def _game_revenue(spark, sf):
    return gold.game_revenue(*(stored(spark, sf, n) for n in ("dim_game", "fact_tickets", "bridge_promo")))


def _retention_cohort(spark, sf):
    tables = [stored(spark, sf, n) for n in ("fact_tickets", "dim_customer", "dim_game")]
    return gold.retention_cohort(*tables, measures=stored(spark, sf, "customer_measures"))


def _fan_features(spark, sf):
    return gold.fan_features(stored(spark, sf, "customer_360"), stored(spark, sf, "retention_cohort"))


def _segments(spark, sf):
    return roles.rule_segments(stored(spark, sf, "fan_features"))


def _scores(spark, sf):
    return roles.rule_scores(stored(spark, sf, "fan_features"))


# name -> (layer, builder, unique key the stored rows are bucketed by); a "view" is not stored.
TABLES = {
    "raw_events": ("bronze", _bronze("raw_events"), None),
    "raw_customers": ("bronze", _bronze("raw_customers"), None),
    "raw_customers_stream": ("bronze", _bronze("raw_customers_stream"), None),
    "raw_tickets": ("bronze", _bronze("raw_tickets"), None),
    "raw_tickets_stream": ("bronze", _bronze("raw_tickets_stream"), None),
    "raw_tickets_all": ("view", _raw_tickets_all, None),
    "raw_promotions": ("bronze", _bronze("raw_promotions"), None),
    "dim_game": ("silver", _dim_game, None),
    "dim_customer": ("silver", _dim_customer, "customer_id"),
    "fact_tickets": ("silver", _fact_tickets, None),
    "bridge_promo": ("silver", _bridge_promo, None),
    "quarantine_tickets": ("silver", _quarantine, None),
    "customer_measures": ("gold", _customer_measures, "customer_id"),
    "customer_360": ("gold", _customer_360, "customer_id"),
    "game_revenue": ("gold", _game_revenue, None),
    "retention_cohort": ("gold", _retention_cohort, "customer_id"),
    "fan_features": ("gold", _fan_features, "customer_id"),
    "ml_fan_segments": ("gold", _segments, "customer_id"),
    "ml_churn_scores": ("gold", _scores, "customer_id"),
}


# Source bytes per shuffle partition while a table is built, and the size up to which adaptive execution
# merges partitions again: what a task sorts or hashes stays as small however large the source is.
SOURCE_BYTES_PER_TASK = 4 << 20
TASK_BYTES = 8 << 20


def _source_files(spark: SparkSession, sf_dir: str) -> list:
    """Source files, two folder levels deep."""
    top = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [
        file for entry in fs.listStatus(top)
        for file in (fs.listStatus(entry.getPath()) if entry.isDirectory() else [entry])
    ]


def source_state(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the names, sizes and times of the source files, two folder levels deep."""
    seen = [f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in _source_files(spark, sf_dir)]
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()


@contextlib.contextmanager
def sized_tasks(spark: SparkSession, source_bytes: int):
    """Shuffles planned inside have partitions by the size of the source, never fewer than the session asks for."""
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": max(
            int(spark.conf.get("spark.sql.shuffle.partitions")), -(-source_bytes // SOURCE_BYTES_PER_TASK)
        ),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stored table ``name`` for the source folder ``sf_dir``, built anew once files change."""
    state = source_state(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, state, name)
    if key not in _BUILT:
        layer, build, bucket_key = TABLES[name]
        tag = hashlib.md5(f"{sf_dir} {state}".encode()).hexdigest()[:10]
        base = f"{scratch_dir(spark)}/tables-{tag}"
        with sized_tasks(spark, sum(f.getLen() for f in _source_files(spark, sf_dir))):
            df, watched = build(spark, sf_dir), None
            if layer == "silver" and silver.warn_rules(name):
                accepted = {"sections": tuple(roles.TIER_RANKS), "channels": roles.SALES_CHANNELS}
                df, watched = silver.with_expectations(df, name, **accepted)
            if layer == "view":
                _BUILT[key] = df
            elif name == "fan_features":
                _BUILT[key] = write_keyed(df, base, layer, name, ["customer_id"], bucket_by=bucket_key)
            else:
                _BUILT[key] = write_layer(df, base, layer, name, bucket_by=bucket_key)
        if watched is not None:
            EXPECTED[key] = dict(watched.get)
    return _BUILT[key]
