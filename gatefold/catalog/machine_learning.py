"""Models and their quality. Fitted models have no SQL twin; everything around them has."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import round_to
from ..ml import churn, clustering, metrics, scaling
from ..operators.grouping import value_counts
from ..operators.ordering import top_k
from ..operators.quantiles import median_profile
from ..oracle import rounded as R
from ..plans.stored import source_state
from ..session import ensure_checkpoint_dir
from .registry import query

Z = ["recency_days", "monetary_net", "promo_sensitivity", "tenure_days"]


@query(
    "ml_standardize",
    "SELECT customer_id, "
    + ", ".join(
        R(f"(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER ()", 4) + f" AS {c}_z"
        for c in Z
    )
    + " FROM fan_features",
)
def _(t):
    scaled = scaling.standardize(t("fan_features"), Z)
    return scaled.select("customer_id", *[round_to(f"{c}_z", 4).alias(f"{c}_z") for c in Z])


@query(
    "ml_elbow",
    "SELECT CAST(k AS INTEGER) AS k, TRUE AS inertia_falls, TRUE AS silhouette_valid FROM range(2, 9) AS r(k)",
)
def _(t):
    """Each candidate k: more clusters fit closer, and the silhouette is a silhouette."""
    found = clustering.elbow(t("fan_features"), clustering.CLUSTER_FEATURES)
    fewer = F.lag("inertia").over(Window.orderBy("k"))  # one row per candidate
    return found.select(
        "k",
        F.coalesce(F.col("inertia") < fewer, F.col("inertia") > 0).alias("inertia_falls"),
        F.col("silhouette").between(-1, 1).alias("silhouette_valid"),
    )


FEATURE_ROWS = ", ".join(f"('{f}')" for f in clustering.CLUSTER_FEATURES)


@query(
    "ml_kmeans_fit",
    f"""SELECT CAST(k AS INTEGER) AS segment_id, f AS feature, TRUE AS center_is_mean
        FROM range(5) AS r(k) CROSS JOIN (VALUES {FEATURE_ROWS}) AS v(f)""",
)
def _(t):
    """Each cluster and feature of the fitted segmentation: the centre is its members' mean."""
    model = _segmentation(t)
    near = clustering.nearest(model, t("fan_features"))
    features = clustering.CLUSTER_FEATURES
    means = near.groupBy("segment_id").agg(
        *[F.avg(F.get("_scaled_array", F.lit(i))).alias(f) for i, f in enumerate(features)]
    )
    centers = clustering.centers_of(model)
    held = F.array(*[F.array(*[F.lit(x) for x in c]) for c in centers])
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            (F.abs(F.col(f) - F.get(F.get(held, F.col("segment_id")), F.lit(i))) < 1e-3).alias("center_is_mean"),
        )
        for i, f in enumerate(features)
    ]
    return means.select("segment_id", F.inline(F.array(*cells)))


# Literal centroids in the plane (games, promo rate in percent).
CENTROIDS = [[10.0, 30.0], [30.0, 45.0], [36.0, 40.0], [1.0, 25.0]]
DISTANCES = [
    f"sqrt((frequency_games - {a}) * (frequency_games - {a}) + (promo_pct - {b}) * (promo_pct - {b}))" for a, b in CENTROIDS
]


@query(
    "ml_assign_nearest",
    f"""SELECT customer_id, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS segment_id, {R("list_min(d)", 4)} AS distance_to_centroid
        FROM (SELECT customer_id, [{", ".join(DISTANCES)}] AS d
              FROM (SELECT customer_id, CAST(frequency_games AS DOUBLE) AS frequency_games,
                           CAST(promo_rate * CAST(100 AS DOUBLE) AS DOUBLE) AS promo_pct FROM fan_features))""",
)
def _(t):
    plane = t("fan_features").select(
        "customer_id", "frequency_games", (F.col("promo_rate") * 100.0).alias("promo_pct")
    )
    near = clustering.assign(plane, CENTROIDS, ["frequency_games", "promo_pct"])
    return near.select(
        "customer_id", "segment_id", round_to("distance_to_centroid", 4).alias("distance_to_centroid")
    )


PROFILE = ["recency_days", "promo_sensitivity", "frequency_games", "tenure_days"]
PROFILE_SQL = "SELECT segment_id, " + ", ".join(f"{R(f'median({c})', 3)} AS {c}" for c in PROFILE) + " FROM ml_fan_segments JOIN fan_features USING (customer_id) GROUP BY 1"


@query(
    "ml_label_clusters",
    f"""WITH p AS ({PROFILE_SQL}),
        a AS (SELECT segment_id FROM p ORDER BY recency_days DESC, segment_id LIMIT 1),
        b AS (SELECT segment_id FROM p WHERE segment_id NOT IN (FROM a) ORDER BY promo_sensitivity DESC, segment_id LIMIT 1),
        c AS (SELECT segment_id FROM p WHERE segment_id NOT IN (FROM a UNION ALL FROM b) ORDER BY frequency_games DESC, segment_id LIMIT 1),
        d AS (SELECT segment_id FROM p WHERE segment_id NOT IN (FROM a UNION ALL FROM b UNION ALL FROM c) ORDER BY tenure_days, segment_id LIMIT 1)
        SELECT p.*, CASE WHEN segment_id IN (FROM a) THEN 'Lapsed' WHEN segment_id IN (FROM b) THEN 'Promo Hunter'
               WHEN segment_id IN (FROM c) THEN 'Season Core' WHEN segment_id IN (FROM d) THEN 'High Value New'
               ELSE 'Casual Fan' END AS segment_label FROM p""",
)
def _(t):
    fans = t("ml_fan_segments").select("customer_id", "segment_id").join(t("fan_features"), "customer_id")
    return clustering.label_segments(median_profile(fans, "segment_id", PROFILE))


@query(
    "agg_median_profile",
    "SELECT segment_id, "
    + ", ".join(f"{R(f'median({c})', 3)} AS {c}" for c in [*clustering.CLUSTER_FEATURES, "churn_flag"])
    + " FROM ml_fan_segments JOIN fan_features USING (customer_id) GROUP BY 1",
)
def _(t):
    fans = t("ml_fan_segments").select("customer_id", "segment_id").join(t("fan_features"), "customer_id")
    return median_profile(fans, "segment_id", [*clustering.CLUSTER_FEATURES, "churn_flag"])


@query("agg_value_counts", "SELECT segment_label, count(*) AS n FROM ml_fan_segments GROUP BY 1")
def _(t):
    return value_counts(t("ml_fan_segments"), "segment_label")


@query(
    "ml_segment_table",
    """SELECT customer_id, TRUE AS label_known, TRUE AS nearest_centroid,
              'kmeans_k5_v1' AS model_version FROM fan_features""",
)
def _(t):
    """Each customer of the segment table: a known name, and the distance of the nearest centroid."""
    model, features = _segmentation(t), t("fan_features")
    table = clustering.segment_scores(model, features)
    again = clustering.nearest(model, features).select("customer_id", "_scaled_array")
    distances = [
        F.sqrt(F.aggregate(
            F.zip_with("_scaled_array", F.array(*[F.lit(x) for x in c]), lambda a, b: (a - b) * (a - b)),
            F.lit(0.0), lambda s, x: s + x,
        ))
        for c in clustering.centers_of(model)
    ]
    own = F.get(F.array(*distances), F.col("segment_id"))
    return table.join(again, "customer_id").select(
        "customer_id",
        F.col("segment_label").isin(
            "Lapsed", "Promo Hunter", "Season Core", "High Value New", "Casual Fan"
        ).alias("label_known"),
        ((F.abs(F.col("distance_to_centroid") - F.array_min(F.array(*distances))) < 1e-9)
         & (F.abs(own - F.array_min(F.array(*distances))) < 1e-9)).alias("nearest_centroid"),
        "model_version",
    )


SPLIT = """SELECT customer_id, churn_flag,
    row_number() OVER (PARTITION BY churn_flag ORDER BY md5(customer_id || '42')) <= ceil(CAST(count(*) OVER (PARTITION BY churn_flag) * CAST(0.2 AS DOUBLE) AS DOUBLE)) AS is_test
    FROM fan_features"""


@query("ml_stratified_split", SPLIT)
def _(t):
    rows = t("fan_features").select("customer_id", "churn_flag")
    return churn.stratified_split(rows, "churn_flag", "customer_id")


@query(
    "ml_class_weight",
    f"""SELECT count(*) FILTER (churn_flag = 0) AS negatives, count(*) FILTER (churn_flag = 1) AS positives,
        {R("CAST(count(*) FILTER (churn_flag = 0) AS DOUBLE) / nullif(count(*) FILTER (churn_flag = 1), 0)", 2)} AS scale_pos_weight
        FROM fan_features""",
)
def _(t):
    return churn.class_weight(t("fan_features"), "churn_flag")


_MODELS: dict[tuple, object] = {}


def _once(t, name, fit):
    """Fit a model once per application and state of the source folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, source_state(t.spark, t.sf_dir), name)
    if key not in _MODELS:
        _MODELS[key] = fit()
    return _MODELS[key]


def _segmentation(t):
    return _once(t, "segments", lambda: clustering.fit_segments(t("fan_features")))


def _splits(t):
    """Train / validation / test from two nested splits, made once; the test rows stay unseen."""

    def split():
        ensure_checkpoint_dir(t.spark)
        marked = churn.stratified_split(t("fan_features"), "churn_flag", "customer_id").checkpoint()
        inner = churn.stratified_split(
            marked.filter(~F.col("is_test")), "churn_flag", "customer_id", seed=43, name="is_valid"
        ).checkpoint()
        return inner.filter(~F.col("is_valid")), inner.filter("is_valid"), marked.filter("is_test")

    return _once(t, "splits", split)


def _churn_model(t):
    train, valid, _ = _splits(t)
    return _once(t, "churn", lambda: churn.fit_churn(train, valid))


def _held_out_auc(t, model):
    test = _splits(t)[2]
    scored = churn.score_churn(model, test).join(test.select("customer_id", "churn_flag"), "customer_id")
    return metrics.auc(scored, "churn_flag", "churn_probability")


@query(
    "ml_churn_fit",
    f"""SELECT count(*) FILTER (churn_flag = 1) AS positives, count(*) FILTER (churn_flag = 0) AS negatives,
               TRUE AS auc_valid, TRUE AS better_than_one_tree FROM ({SPLIT}) WHERE is_test""",
)
def _(t):
    """Held-out rows, a valid AUC on them, and a held-out loss below that of the first tree alone.

    The test rows took no part in the choice of the number of trees.
    """
    model = _churn_model(t)
    losses = churn.round_losses(model, _splits(t)[2])
    return _held_out_auc(t, model).select(
        "positives", "negatives", F.col("auc").between(0, 1).alias("auc_valid"),
        F.lit(len(losses) > 1 and losses[-1] < losses[0]).alias("better_than_one_tree"),
    )


@query("ml_churn_table")
def _(t):
    """The score table of the fitted churn model."""
    return churn.score_churn(_churn_model(t), t("fan_features")).drop("scored_at")


@query("ml_segments_fitted")
def _(t):
    """The segment table of the fitted segmentation."""
    return clustering.segment_scores(_segmentation(t), t("fan_features")).drop("scored_at")


@query("ml_importances_fitted")
def _(t):
    """Importance of every input of the fitted churn model."""
    return churn.importances(_churn_model(t), t.spark)


@query(
    "ml_churn_score",
    """SELECT customer_id, TRUE AS probability_valid, TRUE AS tier_fits,
              'champion_v1' AS model_version FROM fan_features""",
)
def _(t):
    """Each customer of the score table: a probability, and the tier its rounded value allows."""
    p, tier = F.col("churn_probability"), F.col("risk_tier")
    fits = (
        ((tier == "Low") & (p <= 0.4)) | ((tier == "Medium") & p.between(0.4, 0.7)) | ((tier == "High") & (p >= 0.7))
    )
    return churn.score_churn(_churn_model(t), t("fan_features")).select(
        "customer_id", p.between(0, 1).alias("probability_valid"), fits.alias("tier_fits"), "model_version"
    )


INPUT_ROWS = ", ".join(f"('{f}')" for f in churn.CHURN_FEATURES)


@query(
    "ml_feature_importance",
    f"SELECT f AS feature, TRUE AS share_valid, TRUE AS shares_add_up FROM (VALUES {INPUT_ROWS}) AS v(f)",
)
def _(t):
    """Each model input: its importance is a share, and the shares add up to one."""
    found = churn.importances(_churn_model(t), t.spark)
    total = F.sum("importance").over(Window.partitionBy())  # one row per model input
    return found.select(
        "feature", F.col("importance").between(0, 1).alias("share_valid"),
        (F.abs(total - 1) < 1e-6).alias("shares_add_up"),
    )


@query(
    "topk_list",
    f"""SELECT customer_id, {R("total_spend", 2)} AS total_spend FROM customer_360
        WHERE total_spend IS NOT NULL ORDER BY total_spend DESC, customer_id LIMIT 5""",
)
def _(t):
    spent = t("customer_360").select("customer_id", "total_spend").filter("total_spend IS NOT NULL")
    best = top_k(spent, ["-total_spend"], 5, tie_break="customer_id")
    return best.select("customer_id", round_to("total_spend", 2).alias("total_spend"))


SCORED = "(SELECT churn_flag, churn_probability FROM fan_features JOIN ml_churn_scores USING (customer_id))"
GUESS = "CAST(churn_probability >= 0.5 AS INTEGER)"


def _scored(t):
    return t("fan_features").select("customer_id", "churn_flag").join(
        t("ml_churn_scores").select("customer_id", "churn_probability"), "customer_id"
    )


@query(
    "ml_auc",
    f"""SELECT p AS positives, n AS negatives, {R("(s - CAST(p AS DOUBLE) * (p + 1) / 2) / (CAST(p AS DOUBLE) * n)", 6)} AS auc
        FROM (SELECT count(*) FILTER (churn_flag = 1) AS p, count(*) FILTER (churn_flag = 0) AS n,
                     sum(r) FILTER (churn_flag = 1) AS s
              FROM (SELECT churn_flag, rank() OVER (ORDER BY churn_probability)
                           + (count(*) OVER (PARTITION BY churn_probability) - 1) / CAST(2 AS DOUBLE) AS r FROM {SCORED}))""",
)
def _(t):
    return metrics.auc(_scored(t), "churn_flag", "churn_probability")


@query(
    "ml_accuracy",
    f"""SELECT count(*) AS n_rows, {R(f"CAST(count(*) FILTER ({GUESS} = churn_flag) AS DOUBLE) / count(*)", 4)} AS accuracy FROM {SCORED}""",
)
def _(t):
    return metrics.accuracy(_scored(t), "churn_flag", "churn_probability")


@query(
    "ml_confusion",
    f"""SELECT actual, predicted, count(churn_flag) AS n
        FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS g(actual, predicted)
        LEFT JOIN {SCORED} ON churn_flag = actual AND {GUESS} = predicted GROUP BY 1, 2""",
)
def _(t):
    return metrics.confusion(_scored(t), "churn_flag", "churn_probability")


@query(
    "ml_class_report",
    f"""SELECT c AS class, {R("pr", 4)} AS precision, {R("rc", 4)} AS recall,
        {R("coalesce(2 * pr * rc / nullif(pr + rc, 0), 0)", 4)} AS f1, support
        FROM (SELECT c, coalesce(CAST(count(*) FILTER (churn_flag = c AND {GUESS} = c) AS DOUBLE) / nullif(count(*) FILTER ({GUESS} = c), 0), 0) AS pr,
                     coalesce(CAST(count(*) FILTER (churn_flag = c AND {GUESS} = c) AS DOUBLE) / nullif(count(*) FILTER (churn_flag = c), 0), 0) AS rc,
                     count(*) FILTER (churn_flag = c) AS support
              FROM {SCORED} CROSS JOIN (VALUES (0), (1)) AS k(c) GROUP BY c)""",
)
def _(t):
    return metrics.class_report(_scored(t), "churn_flag", "churn_probability")
