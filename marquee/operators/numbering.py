"""Consecutive numbers over groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import through_table

# Arrival positions per bucket: the most rows one task has to sort for numbering.
BUCKET_ROWS = 65_536


def position_bucket(pos: Column) -> Column:
    return F.floor(pos / BUCKET_ROWS).cast("long")


def number_rows(
    df: DataFrame, group: list[str], buckets: list[str], order: list[str], name: str
) -> DataFrame:
    """Number rows 0, 1, 2, ... inside each `group` by (`buckets`, `order`).

    A plain row_number over `group` would sort a whole group in one task. Here each bucket is
    numbered alone and starts at the row count of the buckets before it. `buckets` must be non-null
    and lead the sort order. The count pass reads only the bucket columns.
    """
    per_bucket = df.groupBy(*group, *buckets).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        *group, *buckets, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(*group, *buckets).orderBy(*order)
    return (
        df.join(starts, [*group, *buckets])
        .withColumn(name, F.col("_start") + F.row_number().over(within) - 1)
        .drop("_start")
    )


def number_by_range(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... inside each `group` by `order`, which tells all rows of a group apart.

    The rows are dealt by sampled bounds into ranges of (`group`, `order`), sorted there and written. A row's number is its
    place in its range, less that of its group's first row there, plus the group's rows in the ranges before. Counting
    reads the places only, so rows are shuffled once and no window holds more than a row for each range of a group.
    """
    keys = [*group, *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = through_table(placed, "numbered").select(
        *df.columns, F.expr("shiftright(_at, 33)").alias("_part"), F.expr("_at & 8589934591").alias("_place")
    )
    held = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        *(F.col(c).alias(f"_{c}") for c in group), F.col("_part").alias("_in"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"),
    )
    same = F.col("_part") == F.col("_in")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return placed.join(starts, same).select(*df.columns, (F.col("_start") + F.col("_place")).alias(name))
