"""Running sums over any order, spread over many tasks.

Rows are range-partitioned by (group, order) into slices. Inside a slice a window adds up; the
totals of the earlier slices, one row per slice and group, are carried over. A group of any
size is cut into as many slices as it needs, so it never sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


# Rows in a slice, about; the ranges are drawn from a sample of the order.
SLICE_ROWS = 2_000_000


def _match(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]


def _sliced(df: DataFrame) -> DataFrame:
    return df.withColumn("_slice", F.spark_partition_id()).checkpoint()


def prefix_sums(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    measures: Sequence[str],
    slices: int | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``<m>_before`` (sum over earlier rows of the group) and ``<m>_total`` per measure.

    (by, order) must be unique. The sliced rows are checkpointed: the slice of a row is then a
    stored fact that every later read agrees on, also after an executor is lost. Rows are counted while
    they are stored; if there are more than ``slice_rows`` a slice, they are cut again into as many
    slices as their number asks for.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = Observation()
    dealt = df.repartitionByRange(n, *by, *order).observe(counted, F.count(F.lit(1)).alias("rows"))
    placed = _sliced(dealt)
    wanted = -(-counted.get["rows"] // slice_rows)
    if slices is None and wanted > n:
        placed = _sliced(placed.drop("_slice").repartitionByRange(wanted, *by, *order))
    parts = placed.groupBy(*by, "_slice").agg(*[F.sum(m).alias(f"_part_{m}") for m in measures])
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        *[F.col(k).alias(f"_k_{k}") for k in [*by, "_slice"]],
        *[F.sum(f"_part_{m}").over(earlier).alias(f"_carry_{m}") for m in measures],
        *[F.sum(f"_part_{m}").over(group).alias(f"{m}_total") for m in measures],
    )
    inside = (
        Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = placed.withColumns({f"_inside_{m}": F.sum(m).over(inside) for m in measures})
    joined = summed.join(carried, _match([*by, "_slice"]))
    zero = F.lit(0)
    before = {
        f"{m}_before": F.coalesce(F.col(f"_inside_{m}"), zero) + F.coalesce(F.col(f"_carry_{m}"), zero)
        for m in measures
    }
    helpers = [f"_k_{k}" for k in [*by, "_slice"]]
    helpers += [f"_{p}_{m}" for p in ("inside", "carry") for m in measures]
    return joined.withColumns(before).drop("_slice", *helpers)
