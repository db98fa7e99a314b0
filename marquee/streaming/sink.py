"""A table made of one folder per micro-batch.

A batch that is run again after a lost driver replaces its own folder, so nothing is written twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

FIRST = -1


def create(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Start a table with rows that were there before the stream; they may be none."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={FIRST}")


def read(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The whole table, or what it held before a batch."""
    rows = spark.read.parquet(path)
    return rows if before is None else rows.where(F.col("batch") < before)


def run(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    batch_rows: Callable[[DataFrame, int], DataFrame],
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """One folder per micro-batch: everything available and then stop, or one batch per interval. With mode `update`
    a batch holds the rows that its input changed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_rows(batch, batch_id).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    pace = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**pace).start()
