"""Standardisation as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Add z-scores (population standard deviation, NULL taken as 0, constant columns give 0).

    Means and deviations of all columns come from one pass, as a single scalar subquery.
    """
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    stats = []
    for c in cols:
        stats.append(F.avg(filled[c]).alias(f"m_{c}"))
        stats.append(F.stddev_pop(filled[c]).alias(f"s_{c}"))
    moments = df.agg(F.struct(*stats).alias("moments")).scalar()
    scores = {}
    for c in cols:
        spread = F.coalesce(F.nullif(moments.getField(f"s_{c}"), F.lit(0.0)), F.lit(1.0))
        scores[c + suffix] = (filled[c] - moments.getField(f"m_{c}")) / spread
    return df.withColumns(scores)
