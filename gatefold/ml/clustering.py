"""Customer segmentation with distributed k-means."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import map_values
from ..operators.quantiles import median_profile

# Clustering inputs.
CLUSTER_FEATURES = [
    "recency_days", "frequency_games", "monetary_net", "promo_sensitivity",
    "advance_purchase_rate", "avg_seat_tier_rank", "tenure_days", "is_season_holder",
    "channels_used",
]


def _filled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


def _scaler(df: DataFrame, cols: Sequence[str]) -> PipelineModel:
    """Assembler and fitted scaler, as one reusable model."""
    assembler = VectorAssembler(inputCols=list(cols), outputCol="_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True)
    return PipelineModel([assembler, scaler.fit(assembler.transform(_filled(df, cols)))])


# Rows that starting centres are drawn from; every later step reads all rows.
START_ROWS = 4096
_MOVED = 1e-4
_SUMS = "centers int, cluster int, n long, cost double, total array<double>"


def _starts(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows, each drawn with the odds of its squared distance to those drawn before."""
    rng = np.random.default_rng(seed)
    picked = [rows[rng.integers(len(rows))]]
    for _ in range(1, k):
        gaps = np.min([((rows - p) ** 2).sum(axis=1) for p in picked], axis=0)
        total = gaps.sum()
        picked.append(rows[rng.choice(len(rows), p=gaps / total) if total > 0 else rng.integers(len(rows))])
    return np.array(picked)


def _add_rows(total: np.ndarray, near: np.ndarray, columns: np.ndarray) -> None:
    """``np.add.at(total, near, columns.T)``, the same additions in the same order, by counts with weights."""
    at = np.concatenate([np.arange(len(total)), near])
    for i, column in enumerate(columns):
        total[:, i] = np.bincount(at, np.concatenate([total[:, i], column]), minlength=len(total))


def _sums(scaled: DataFrame, sets: Mapping[int, np.ndarray]) -> list:
    """Size, cost and vector sum of every cluster of every set of centres, from one scan.

    A task sends one row per set and cluster; the driver gets as many, whatever the number of rows.
    """
    shipped = {i: c.copy() for i, c in sets.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {i: (np.zeros(len(c)), np.zeros(len(c)), np.zeros(c.shape)) for i, c in shipped.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            norms, columns = (x * x).sum(axis=1), np.ascontiguousarray(x.T)
            for i, c in shipped.items():
                gaps = norms[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
                near = gaps.argmin(axis=1)
                n, cost, total = found[i]
                n += np.bincount(near, minlength=len(c))
                cost += np.bincount(near, np.maximum(gaps[np.arange(len(x)), near], 0), minlength=len(c))
                _add_rows(total, near, columns)
        rows = [(i, j, int(n[j]), cost[j], total[j]) for i, (n, cost, total) in found.items() for j in range(len(n))]
        columns = list(zip(*rows, strict=True))
        types = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
        names = ["centers", "cluster", "n", "cost", "total"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    d = len(next(iter(shipped.values()))[0])
    totals = F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(d)])
    return (
        scaled.mapInArrow(add, _SUMS).groupBy("centers", "cluster")
        .agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), totals.alias("total")).collect()
    )


def fit_many(scaled: DataFrame, ks: Sequence[int], restarts: int, max_iter: int, seed: int) -> dict[int, tuple[float, np.ndarray]]:
    """Per k the lowest cost and its centres over all restarts, on array rows ``x``.

    All restarts of all k go through the rows together: one job per iteration, and a set of centres
    leaves once it stands still. Centres start on rows of a bounded sample by hash; empty clusters stay
    where they are.
    """
    sample = scaled.orderBy(F.xxhash64("x"), "x").limit(START_ROWS).collect()
    if not sample:
        raise ValueError("no rows to cluster")
    start = np.array([r.x for r in sample])
    sets = {
        i: _starts(start, k, seed + i % restarts) for i, k in enumerate(k for k in ks for _ in range(restarts))
    }
    of_k = {i: len(c) for i, c in sets.items()}
    best: dict[int, tuple[float, np.ndarray]] = {}
    moving = dict(sets)
    for step in range(max_iter + 1):
        after: dict[int, np.ndarray] = {i: c.copy() for i, c in moving.items()}
        costs = dict.fromkeys(moving, 0.0)
        for r in _sums(scaled, moving):
            costs[r.centers] += r.cost
            if r.n:
                after[r.centers][r.cluster] = np.array(r.total) / r.n
        for i in list(moving):
            if step == max_iter or ((after[i] - moving[i]) ** 2).sum(axis=1).max() <= _MOVED**2:
                k = of_k[i]
                if k not in best or costs[i] < best[k][0]:
                    best[k] = costs[i], after[i]
                del moving[i]
            else:
                moving[i] = after[i]
        if not moving:
            break
    return best


def _model(centers: np.ndarray) -> KMeansModel:
    """Spark's model of given centres."""
    gateway = SparkContext._active_spark_context._gateway
    jvm, vectors = gateway.jvm, gateway.jvm.java.util.ArrayList()
    for center in centers:
        values = gateway.new_array(jvm.double, len(center))
        for i, v in enumerate(center):
            values[i] = float(v)
        vectors.add(jvm.org.apache.spark.mllib.linalg.Vectors.dense(values))
    held = jvm.org.apache.spark.mllib.clustering.KMeansModel(vectors)
    made = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"kmeans_{uuid.uuid4().hex[:12]}", held))
    return made.setFeaturesCol("_scaled").setPredictionCol("segment_id")


def _scaled_rows(df: DataFrame, prepared: PipelineModel, cols: Sequence[str]) -> DataFrame:
    return prepared.transform(_filled(df, cols)).select("_scaled", vector_to_array("_scaled").alias("x"))


def elbow(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(2, 9), seed: int = 42,
    restarts: int = 10, max_iter: int = 300,
) -> DataFrame:
    """(k, inertia, silhouette) for each candidate k.

    The silhouette is computed over all rows: the squared-euclidean form needs one pass over
    per-cluster totals, so no sample is drawn.
    """
    scaled = _scaled_rows(df, _scaler(df, cols), cols).persist(StorageLevel.MEMORY_AND_DISK)
    judge = ClusteringEvaluator(featuresCol="_scaled", predictionCol="segment_id")
    try:
        best = fit_many(scaled.select("x"), list(ks), restarts, max_iter, seed)
        rows = []
        for k in ks:
            cost, centers = best[k]
            placed = assign(scaled, centers.tolist(), F.col("x"))
            rows.append((int(k), float(cost), float(judge.evaluate(placed))))
    finally:
        scaled.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def fit_segments(
    df: DataFrame, cols: Sequence[str] = CLUSTER_FEATURES, k: int = 5, restarts: int = 10,
    max_iter: int = 300, seed: int = 42,
) -> PipelineModel:
    """Scaler and k-means in one model; the restart with the lowest cost wins."""
    prepared = _scaler(df, cols)
    scaled = _scaled_rows(df, prepared, cols).select("x").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _, centers = fit_many(scaled, [k], restarts, max_iter, seed)[k]
    finally:
        scaled.unpersist()
    return PipelineModel([*prepared.stages, _model(centers)])


def centers_of(model: PipelineModel) -> list[list[float]]:
    """Centroids in scaled space: k rows of one number per feature."""
    return [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]


def assign(
    df: DataFrame, centroids: Sequence[Sequence[float]], cols: Sequence[str] | Column,
    label: str = "segment_id", distance: str = "distance_to_centroid",
) -> DataFrame:
    """Nearest centroid and its euclidean distance; ties go to the lowest number.

    ``cols`` are numeric columns, or one array column. The centroids are literals, so this is
    a projection without shuffle or join.
    """
    if isinstance(cols, Column):
        parts = [cols.getItem(i) for i in range(len(centroids[0]))]
    else:
        parts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]
    distances = []
    for center in centroids:
        squares = [(p - F.lit(float(x))) * (p - F.lit(float(x))) for p, x in zip(parts, center)]
        total = squares[0]
        for s in squares[1:]:
            total = total + s
        distances.append(F.sqrt(total))
    near = df.withColumn("_distances", F.array(*distances))
    smallest = F.array_min("_distances")
    return near.withColumns(
        {label: (F.array_position("_distances", smallest) - 1).cast("int"), distance: smallest}
    ).drop("_distances")


def label_segments(
    profile: DataFrame, names: Mapping[int, str] | None = None, key: str = "segment_id"
) -> DataFrame:
    """Name the clusters of a profile (one row per cluster).

    With ``names`` the given map is used. Otherwise, one after the other: highest recency is
    Lapsed, of the rest highest promo sensitivity is Promo Hunter, highest frequency is
    Season Core, shortest tenure is High Value New; what remains is Casual Fan. The windows
    hold k rows.
    """
    if names is not None:
        return profile.withColumn("segment_label", map_values(key, dict(names)))
    picks = [
        ("Lapsed", F.desc("recency_days")),
        ("Promo Hunter", F.desc("promo_sensitivity")),
        ("Season Core", F.desc("frequency_games")),
        ("High Value New", F.asc("tenure_days")),
    ]
    named = profile.withColumn("segment_label", F.lit(None).cast("string"))
    for name, order in picks:
        free = F.col("segment_label").isNull()
        first = F.row_number().over(Window.partitionBy(free).orderBy(order, key)) == 1
        named = named.withColumn(
            "segment_label", F.when(free & first, F.lit(name)).otherwise(F.col("segment_label"))
        )
    return named.withColumn("segment_label", F.coalesce("segment_label", F.lit("Casual Fan")))


def nearest(
    model: PipelineModel, features: DataFrame, cols: Sequence[str] = CLUSTER_FEATURES,
    key: str = "customer_id",
) -> DataFrame:
    """Key, cluster, distance and the scaled inputs as an array, per customer."""
    scaled = PipelineModel(model.stages[:-1]).transform(_filled(features.select(key, *cols), cols))
    placed = scaled.select(key, vector_to_array("_scaled").alias("_scaled_array"))
    return assign(placed, centers_of(model), F.col("_scaled_array"))


def segment_scores(
    model: PipelineModel, features: DataFrame, cols: Sequence[str] = CLUSTER_FEATURES,
    names: Mapping[int, str] | None = None, key: str = "customer_id",
    version: str = "kmeans_k5_v1", model_name: str = "kmeans_fan_segmentation",
) -> DataFrame:
    """Segment table: one row per customer with cluster, name and distance.

    The k names are looked up as literals, so customers are not shuffled by cluster.
    """
    keep = [key, *cols, "churn_flag"]
    scored = PipelineModel(model.stages[:-1]).transform(_filled(features.select(*keep), cols))
    near = assign(scored, centers_of(model), vector_to_array("_scaled"))
    if names is None:
        profile = median_profile(near, "segment_id", [*cols, "churn_flag"])
        named_clusters = label_segments(profile).select("segment_id", "segment_label").collect()
        names = {r.segment_id: r.segment_label for r in named_clusters}
    named = label_segments(near, names)
    return named.select(
        key,
        "segment_id",
        "segment_label",
        "distance_to_centroid",
        F.current_timestamp().alias("scored_at"),
        F.lit(version).alias("model_version"),
        F.lit(model_name).alias("model_name"),
    )
