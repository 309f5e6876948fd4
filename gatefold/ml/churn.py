"""Churn model: stratified split, class weight, gradient-boosted trees, scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import risk_tier, round_to
from ..session import ensure_checkpoint_dir

# Model inputs. Recency is left out on purpose, it would leak the label.
CHURN_FEATURES = [
    "frequency_games", "monetary_net", "promo_sensitivity", "promo_rate",
    "advance_purchase_rate", "avg_days_before_game", "avg_seat_tier_rank", "tenure_days",
    "is_season_holder", "channels_used", "jersey_night_attendee", "hot_start_buyer",
    "slump_buyer", "was_lapsed_reactivation", "returned_30d", "is_one_and_done",
    "is_jersey_night_cohort",
]

# Hex digits of the hash that form a bucket: 65536 even buckets per label.
_BUCKET_DIGITS = 4
# Rounds without a better validation loss before later ones are cut off.
PATIENCE = 20
# Training or validation rows in a partition.
ROWS_PER_TASK = 50_000


def stratified_split(
    df: DataFrame, label: str, key: str, frac: float = 0.2, seed: int = 42, name: str = "is_test"
) -> DataFrame:
    """Mark exactly ``ceil(frac * n)`` rows of every label as test, chosen by a seeded hash.

    The cut is found from hash-bucket counts; only the one bucket per label that holds the
    cut is ranked. Hash values are even, so neither a dominant label nor a large table
    gathers in one task. The cuts, one row per class, are joined back; a table of that size is
    broadcast once its size is known, and beyond that AQE splits a dominant label. ``key`` must
    be unique.
    """
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))))
    bucket = F.substring("_h", 1, _BUCKET_DIGITS)
    counts = hashed.groupBy(label, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(label)
    cuts = (
        counts.withColumn("_upto", F.sum("_n").over(ordered))
        .withColumn("_want", F.ceil(F.sum("_n").over(whole) * F.lit(frac)))
        .filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select(
            F.col(label).alias("_l"),
            F.col("_b").alias("_cut_bucket"),
            (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_take"),
        )
    )
    same_label = F.col(label).eqNullSafe(F.col("_l"))
    inside = hashed.select(label, "_h").join(cuts, same_label & (bucket == F.col("_cut_bucket")))
    position = F.row_number().over(Window.partitionBy("_l").orderBy("_h"))
    limits = (
        inside.withColumn("_at", position)
        .filter(F.col("_at") == F.col("_take"))
        .select("_l", F.col("_h").alias("_limit"))
    )
    marked = hashed.join(limits, same_label, "left")
    test = F.coalesce(F.col("_h") <= F.col("_limit"), F.lit(False))
    return marked.withColumn(name, test).drop("_h", "_l", "_limit")


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives, positives and their ratio (NULL without positives), in one pass."""
    positives, negatives = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    ratio = negatives.cast("double") / F.nullif(positives, F.lit(0))
    return df.agg(
        negatives.alias("negatives"),
        positives.alias("positives"),
        round_to(ratio, 2).alias("scale_pos_weight"),
    )


def _filled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


def best_round(losses: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(number of rounds to keep, has the patience run out) for validation losses per round.

    Boosting with patience would stop ``patience`` rounds after the lowest loss so far; later losses are not seen.
    """
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` rounds of a fit: its first trees with their weights."""
    fitted = model._java_obj
    gateway = SparkContext._active_spark_context._gateway
    kinds = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(kinds.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    all_trees, all_weights = fitted.trees(), fitted.treeWeights()
    for i in range(n):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    kept = kinds.classification.GBTClassificationModel(
        fitted.uid(), trees, weights, fitted.numFeatures(), fitted.numClasses()
    )
    made = model._copyValues(GBTClassificationModel(kept))
    made._transfer_params_to_java()
    return made


def _prepared(df: DataFrame, assembler: VectorAssembler, label: str, weight: float) -> DataFrame:
    """Label, feature vector and weight; positives weigh ``weight``."""
    rows = _filled(df, [*assembler.getInputCols(), label]).withColumn(
        "_weight", F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0))
    )
    return assembler.transform(rows).select(label, "_features", "_weight")


def _spread(rows: DataFrame, n: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``n`` rows dealt over a task per ``per_task`` of them, and from a task per core on over whole waves.

    Adaptive execution leaves as many partitions as their bytes ask for, and a boosting round passes over the
    rows several times: too few partitions idle most cores, many small ones cost more than they save.
    """
    parts, cores = -(-n // per_task), rows.sparkSession.sparkContext.defaultParallelism
    if parts <= 1:
        return rows.coalesce(1)
    return rows.repartition(parts if parts <= cores else -(-parts // cores) * cores)


def round_losses(model: PipelineModel, rows: DataFrame, label: str = "churn_flag") -> list[float]:
    """Weighted loss of a fitted churn model on ``rows`` after each of its rounds, in one pass."""
    assembler, trees = model.stages
    prepared = _prepared(rows, assembler, label, model.positive_weight)
    return list(trees.evaluateEachIteration(_spread(prepared, rows.count())))


def fit_churn(
    train: DataFrame, valid: DataFrame, cols: Sequence[str] = CHURN_FEATURES,
    label: str = "churn_flag", rounds: int = 300, depth: int = 4, rate: float = 0.05,
    subsample: float = 0.8, colsample: float = 0.8, seed: int = 42, patience: int = PATIENCE,
) -> PipelineModel:
    """Boosted trees with positive-class weight, cut on ``valid`` with patience.

    All rounds are fitted once. A round only adds a tree, so the model of any earlier round is a prefix
    of the ensemble: the validation loss of every round comes from one pass, and the trees up to the
    best round before the patience ran out are kept without another fit. The losses of all rounds are in
    ``validation_losses``. ``valid`` must not be the test set, or the reported quality is too good.
    """
    ensure_checkpoint_dir(train.sparkSession)
    balance = class_weight(train, label).first()
    weight = 1.0 if balance.scale_pos_weight is None else float(balance.scale_pos_weight)
    assembler = VectorAssembler(inputCols=list(cols), outputCol="_features")
    # A round runs a job per level of the tree.
    seen = _spread(_prepared(train, assembler, label, weight), balance.positives + balance.negatives).persist()
    unseen = _spread(_prepared(valid, assembler, label, weight), valid.count()).persist()
    try:
        model = GBTClassifier(
            labelCol=label, featuresCol="_features", weightCol="_weight", maxIter=rounds, maxDepth=depth,
            stepSize=rate, subsamplingRate=subsample, featureSubsetStrategy=str(colsample), seed=seed,
            checkpointInterval=10,
        ).fit(seen)
        losses = list(model.evaluateEachIteration(unseen))
        keep, _ = best_round(losses, patience)
    finally:
        seen.unpersist()
        unseen.unpersist()
    pipeline = PipelineModel([assembler, first_trees(model, keep)])
    pipeline.validation_losses, pipeline.positive_weight = losses, weight
    return pipeline


def score_churn(
    model: PipelineModel, features: DataFrame, cols: Sequence[str] = CHURN_FEATURES,
    key: str = "customer_id", version: str = "champion_v1",
    model_name: str = "gbt_churn_predictor", right_closed: bool = True,
) -> DataFrame:
    """Probability (4 decimals), tier cut on the unrounded probability, and provenance."""
    scored = model.transform(_filled(features.select(key, *cols), cols))
    p = vector_to_array("probability")[1]
    return scored.select(
        key,
        round_to(p, 4).alias("churn_probability"),
        risk_tier(p, right_closed=right_closed).alias("risk_tier"),
        F.current_timestamp().alias("scored_at"),
        F.lit(version).alias("model_version"),
        F.lit(model_name).alias("model_name"),
    )


def importances(model: PipelineModel, spark, cols: Sequence[str] = CHURN_FEATURES) -> DataFrame:
    """(feature, importance), most important first; one row per model input."""
    found = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(w)) for c, w in zip(cols, found)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
