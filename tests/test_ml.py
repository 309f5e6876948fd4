import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from gatefold.ml import churn, clustering, metrics, scaling


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        c = i % 3
        rows.append((f"c{i}", 10.0 * c + rng.random(), -5.0 * c + rng.random(), 1.0, int(c == 2)))
    return spark.createDataFrame(rows, "customer_id string, a double, b double, flat double, churn_flag int").repartition(3)


def test_standardize(spark, blobs):
    got = scaling.standardize(blobs, ["a", "flat"]).agg(
        F.avg("a_z").alias("m"), F.stddev_pop("a_z").alias("s"), F.max("flat_z").alias("f")
    ).first()
    assert (got.m, got.s, got.f) == (pytest.approx(0, abs=1e-9), pytest.approx(1), 0.0)


def test_elbow_falls_and_prefers_three(spark, blobs):
    rows = clustering.elbow(blobs, ["a", "b"], ks=[2, 3, 4], restarts=2).orderBy("k").collect()
    assert rows[0].inertia > rows[1].inertia
    assert max(rows, key=lambda r: r.silhouette).k == 3


def test_segments_follow_the_blobs_and_distances_are_consistent(spark, blobs):
    model = clustering.fit_segments(blobs, ["a", "b"], k=3, restarts=3)
    out = clustering.segment_scores(model, blobs, ["a", "b"], names={0: "x", 1: "y", 2: "z"})
    assert out.columns == [
        "customer_id", "segment_id", "segment_label", "distance_to_centroid", "scored_at", "model_version", "model_name",
    ]
    blob = F.expr("int(substring(customer_id, 2)) % 3")
    assert out.groupBy(blob.alias("blob")).agg(F.count_distinct("segment_id").alias("n")).filter("n > 1").count() == 0
    # Spark's own model class: it places the rows as the table does.
    again = model.transform(blobs).select("customer_id", "segment_id")
    assert out.select("customer_id", "segment_id").exceptAll(again).count() == 0


def _jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_are_added_to_their_clusters_in_order():
    """To the bit what np.add.at gives, as last digits decide when a set of centres stands still."""
    rng = np.random.default_rng(5)
    x, near, total = rng.normal(size=(500, 3)) * 1e6, rng.integers(0, 4, 500), rng.normal(size=(5, 3))
    wanted = total.copy()
    np.add.at(wanted, near, x)
    clustering._add_rows(total, near, x.T)
    assert np.array_equal(total, wanted)


def test_all_restarts_share_their_scans_and_match_single_fits(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rng = random.Random(3)
    rows = [([rng.gauss(i % 4 * 3, 1), rng.gauss(i % 3 * 3, 1), rng.random()],) for i in range(900)]
    x = spark.createDataFrame(rows, "x array<double>").repartition(3).cache()
    found, many = _jobs(spark, "ten", lambda: clustering.fit_many(x, [4, 6], 10, 300, 1))
    _, few = _jobs(spark, "one", lambda: clustering.fit_many(x, [4, 6], 1, 300, 1))
    vectors = x.select(array_to_vector("x").alias("features")).cache()
    for k in (4, 6):
        single = min(KMeans(k=k, seed=s, maxIter=300).fit(vectors).summary.trainingCost for s in range(10))
        assert found[k][0] <= single * 1.001 and found[k][1].shape == (k, 3)
    # As many jobs as rounds of the slowest set: not ten times as many.
    assert many < 6 * few


def test_many_equal_rows_and_one_row_cluster(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 50, "x array<double>")
    cost, centers = clustering.fit_many(same, [3], 2, 10, 1)[3]
    assert cost == pytest.approx(0) and centers.tolist() == [[1.0, 2.0]] * 3
    with pytest.raises(ValueError):
        clustering.fit_many(same.limit(0), [2], 1, 5, 1)


def test_assign_breaks_ties_to_the_lowest_number(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (5.0,), (None,)], "x double").coalesce(1)
    got = [(r.segment_id, r.distance_to_centroid) for r in clustering.assign(df, [[1.0], [-1.0], [4.0]], ["x"]).collect()]
    assert got == [(0, 1.0), (0, 1.0), (2, 1.0), (0, 1.0)]


def test_labels_from_profile(spark):
    rows = [(0, 900.0, 0.9, 1.0, 10.0), (1, 50.0, 0.8, 5.0, 50.0), (2, 10.0, 0.1, 30.0, 500.0), (3, 20.0, 0.2, 4.0, 30.0), (4, 20.0, 0.2, 4.0, 90.0)]
    profile = spark.createDataFrame(rows, "segment_id int, recency_days double, promo_sensitivity double, frequency_games double, tenure_days double")
    got = {r.segment_id: r.segment_label for r in clustering.label_segments(profile).collect()}
    assert got == {0: "Lapsed", 1: "Promo Hunter", 2: "Season Core", 3: "High Value New", 4: "Casual Fan"}


@pytest.mark.parametrize("sizes", [(1, 0), (1, 7), (333, 1000)])
def test_stratified_split_is_exact(spark, sizes):
    rows = [(f"{label}-{i}", label) for label, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, y int").repartition(3)
    got = {r.k for r in churn.stratified_split(df, "y", "k", 0.2, 42).filter("is_test").collect()}
    for label, n in enumerate(sizes):
        ordered = sorted((k for k, y in rows if y == label), key=lambda k: hashlib.md5(f"{k}42".encode()).hexdigest())
        assert {k for k in got if k.startswith(f"{label}-")} == set(ordered[: math.ceil(0.2 * n)])


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,)], "y int")
    assert tuple(churn.class_weight(df, "y").first()) == (2, 1, 2.0)
    assert churn.class_weight(df.filter("y = 0"), "y").first().scale_pos_weight is None


def test_metrics_against_evaluator_and_numpy(spark):
    rng = random.Random(1)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "y int, p double").repartition(3)
    y, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    pos, neg = p[y == 1], p[y == 0]
    won = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    got = metrics.auc(df, "y", "p").first().auc
    assert got == pytest.approx(won / len(pos) / len(neg), abs=1e-6)
    judge = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="p")
    assert got == pytest.approx(judge.evaluate(df), abs=1e-6)
    assert metrics.auc(df.filter("y = 1"), "y", "p").first().auc is None
    guess = (p >= 0.5).astype(int)
    assert metrics.accuracy(df, "y", "p").first().accuracy == pytest.approx((guess == y).mean(), abs=1e-4)
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion(df, "y", "p").collect()}
    assert cells == {(a, b): int(((y == a) & (guess == b)).sum()) for a in (0, 1) for b in (0, 1)}
    report = {r["class"]: r for r in metrics.class_report(df, "y", "p").collect()}
    assert report[1].precision == pytest.approx(y[guess == 1].mean(), abs=1e-4)
    assert report[1].recall == pytest.approx(guess[y == 1].mean(), abs=1e-4)
    lonely = metrics.class_report(df.filter("y = 1 AND p >= 0.5"), "y", "p").collect()
    assert {r["class"]: (r.precision, r.f1) for r in lonely}[0] == (0.0, 0.0)


def test_churn_model_learns_and_scores(spark, blobs):
    marked = churn.stratified_split(blobs, "churn_flag", "customer_id")
    train, test = marked.filter("NOT is_test"), marked.filter("is_test")
    model = churn.fit_churn(train, test, ["a", "b", "flat"], rounds=5)
    scored = churn.score_churn(model, blobs, ["a", "b", "flat"])
    assert scored.count() == 240 and scored.filter("risk_tier IS NULL OR churn_probability NOT BETWEEN 0 AND 1").count() == 0
    joined = scored.join(blobs.select("customer_id", "churn_flag"), "customer_id")
    assert metrics.auc(joined, "churn_flag", "churn_probability").first().auc > 0.99
    weights = churn.importances(model, spark, ["a", "b", "flat"]).collect()
    assert weights[-1].importance == 0.0 and sum(r.importance for r in weights) == pytest.approx(1)


def test_boosting_keeps_the_best_prefix_with_patience():
    falling = [1.0 - 0.01 * i for i in range(30)]
    assert churn.best_round(falling + [0.9] * 19, 20) == (30, False)
    assert churn.best_round(falling + [0.9] * 20, 20) == (30, True)
    assert churn.best_round(falling + [0.9] * 20 + [0.0], 20) == (30, True)
    assert churn.best_round([0.5], 20) == (1, False)


def test_noisy_data_takes_many_trees(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        x = [rng.random() for _ in range(5)]
        p = 1 / (1 + math.exp(-(3 * x[0] + 3 * x[1] * x[2] - 2 * x[3] - 1.4)))
        rows.append((f"c{i}", *x, int(rng.random() < p)))
    cols = [f"x{k}" for k in range(5)]
    df = spark.createDataFrame(rows, "customer_id string, " + ", ".join(f"{c} double" for c in cols) + ", churn_flag int")
    marked = churn.stratified_split(df, "churn_flag", "customer_id")
    train, test = marked.filter("NOT is_test"), marked.filter("is_test")
    inner = churn.stratified_split(train, "churn_flag", "customer_id", seed=43, name="is_valid")

    def auc(rounds):
        model = churn.fit_churn(inner.filter("NOT is_valid"), inner.filter("is_valid"), cols, rounds=rounds, rate=0.1, patience=5)
        scored = churn.score_churn(model, test, cols).join(test.select("customer_id", "churn_flag"), "customer_id")
        return model.stages[-1].getNumTrees, metrics.auc(scored, "churn_flag", "churn_probability").first().auc

    (one, alone), (many, together) = auc(1), auc(60)
    assert one == 1 < many and together > alone


def test_the_first_trees_of_a_fit_are_a_shorter_fit(spark, blobs):
    """One fit of many rounds, cut, predicts what a fit of that many rounds does."""
    train, valid = blobs.filter("hash(customer_id) % 2 = 0"), blobs.filter("hash(customer_id) % 2 <> 0")
    cols = ["a", "b", "flat"]
    long, short = (churn.fit_churn(train, valid, cols, rounds=n, patience=50) for n in (12, 4))
    assembler, trees = long.stages
    cut = PipelineModel([assembler, churn.first_trees(trees, min(4, trees.getNumTrees))])
    kept = short.stages[-1].getNumTrees
    assert cut.stages[-1].getNumTrees == min(4, trees.getNumTrees) and len(long.validation_losses) == 12
    cut = PipelineModel([assembler, churn.first_trees(trees, kept)]) if kept <= trees.getNumTrees else cut
    one, two = (
        {r.customer_id: r.churn_probability for r in churn.score_churn(m, blobs, cols).collect()} for m in (cut, short)
    )
    assert one == two


def test_split_of_very_many_classes(spark):
    rows = [(f"{label}-{i}", label) for label in range(150) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, y int")
    got = churn.stratified_split(df, "y", "k").filter("is_test").groupBy("y").count().collect()
    assert len(got) == 150 and all(r["count"] == 1 for r in got)


def test_boosting_rows_are_dealt_over_the_cores(spark):
    """Rows that lie in one partition are spread, in whole waves beyond the number of cores."""
    cores = spark.sparkContext.defaultParallelism
    lump = spark.range(1000).coalesce(1)
    assert churn._spread(lump, 1000).rdd.getNumPartitions() == 1
    assert churn._spread(lump, 1000, per_task=1000 // cores).rdd.getNumPartitions() == cores
    assert churn._spread(lump, 1000, per_task=1000 // (2 * cores) + 1).rdd.getNumPartitions() == 2 * cores
    assert sorted(r.id for r in churn._spread(lump, 1000, per_task=100).collect()) == list(range(1000))
