"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run relies on. Executor sizes and shuffle.partitions belong to the
# cluster; AQE merges small partitions and splits skewed ones at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "gatefold", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the library's defaults; keyword dots are written ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temp folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="gatefold-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the shared checkpoint folder unless it already has one."""
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        spark.sparkContext.setCheckpointDir(_shared_base(spark))
        current = spark.sparkContext.getCheckpointDir()
    return current


_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str | None = None) -> str:
    """A folder under the shared base; one per application, or a fresh one per ``label`` call."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = os.path.join(_shared_base(spark), f"gatefold-{app}-{uuid.uuid4().hex[:8]}")
    root = _SCRATCH[app]
    return root if label is None else os.path.join(root, f"{label}-{uuid.uuid4().hex[:8]}")
