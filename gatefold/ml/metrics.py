"""Quality of a binary classifier from scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import round_to
from ..operators.prefix import prefix_sums


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve by the rank-sum formula, ties counted half.

    Rows are counted per distinct score first; the ranks come from a range-partitioned
    running sum, so no task sees the whole score list. NULL without both classes.
    """
    counted = (
        df.filter(F.col(score).isNotNull())
        .groupBy(score)
        .agg(
            F.count_if(F.col(label) == 1).alias("_pos"),
            F.count_if(F.col(label) == 0).alias("_neg"),
        )
    )
    below = prefix_sums(counted, [], [score], ["_neg"])
    won = F.sum(
        F.col("_pos").cast("decimal(18,0)")
        * (F.col("_neg_before") * 2 + F.col("_neg")).cast("decimal(20,0)")
    )
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return below.agg(
        F.sum("_pos").alias("positives"),
        F.sum("_neg").alias("negatives"),
        round_to(won.cast("double") / 2 / F.nullif(pairs, F.lit(0.0)), 6).alias("auc"),
    )


def _predicted(score: str, threshold: float) -> Column:
    return F.when(F.col(score) >= threshold, 1).otherwise(0)


def accuracy(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Share of rows on the right side of the threshold."""
    right = F.count_if(_predicted(score, threshold) == F.col(label)).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        round_to(right / F.nullif(F.count(F.lit(1)), F.lit(0)), 4).alias("accuracy"),
    )


def _cells(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    guess = _predicted(score, threshold)
    return df.agg(
        *[
            F.count_if((F.col(label) == actual) & (guess == said)).alias(f"_n{actual}{said}")
            for actual in (0, 1)
            for said in (0, 1)
        ]
    )


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All four cells (actual, predicted, count), empty ones included, in one pass."""
    cells = [
        F.struct(
            F.lit(actual).alias("actual"),
            F.lit(said).alias("predicted"),
            F.col(f"_n{actual}{said}").alias("n"),
        )
        for actual in (0, 1)
        for said in (0, 1)
    ]
    return _cells(df, label, score, threshold).select(F.inline(F.array(*cells)))


def class_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class; an empty denominator counts as 0."""

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0)), F.lit(0.0))

    rows = []
    for cls, other in ((0, 1), (1, 0)):
        hit = F.col(f"_n{cls}{cls}")
        precision = ratio(hit, hit + F.col(f"_n{other}{cls}"))
        recall = ratio(hit, hit + F.col(f"_n{cls}{other}"))
        rows.append(
            F.struct(
                F.lit(cls).alias("class"),
                round_to(precision, 4).alias("precision"),
                round_to(recall, 4).alias("recall"),
                round_to(ratio(precision * recall * 2, precision + recall), 4).alias("f1"),
                (hit + F.col(f"_n{cls}{other}")).alias("support"),
            )
        )
    return _cells(df, label, score, threshold).select(F.inline(F.array(*rows)))
