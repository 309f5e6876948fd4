"""Registration of queries and the result shape both engines can be compared on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..oracle import compose
from ..plans.stored import stored


class Tables:
    """Stored tables of one source folder by name: ``t("fact_tickets")``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return stored(self.spark, self.sf_dir, name)

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


_ENTRIES: dict[str, Entry] = {}

# Load stamps depend on the run and are left out of compared results.
RUN_STAMPS = ("_ingested_at", "_gold_refreshed_at", "quarantine_ts", "_source_file", "_source_filename")


def query(name: str, sql: str | None = None):
    """Register ``fn(t) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in _ENTRIES:
            raise ValueError(f"query {name!r} registered twice")
        _ENTRIES[name] = Entry(name, fn, sql)
        return fn

    return add


def publish(df: DataFrame) -> DataFrame:
    """Decimals as doubles, run stamps dropped."""
    casts = {
        f.name: F.col(f.name).cast("double")
        for f in df.schema.fields
        if isinstance(f.dataType, DecimalType)
    }
    df = df.drop(*RUN_STAMPS)
    return df.withColumns({k: v for k, v in casts.items() if k in df.columns}) if casts else df


def _load() -> None:
    from . import (  # noqa: F401
        aggregations,
        dashboards,
        joins_windows,
        machine_learning,
        marts,
        projections,
        quality,
        sources,
        validations,
    )


def _callable(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return publish(entry.build(Tables(spark, sf_dir)))

    run.__name__ = entry.name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: _callable(e) for name, e in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: compose(e.sql) for name, e in _ENTRIES.items() if e.sql is not None}
