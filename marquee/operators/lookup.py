"""Equi-joins against a keyed table when one key may hold a third of the left rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import fixed

# Session setting that says over how many tasks a key is spread; results don't depend on it.
SALTS_SETTING = "marquee.lookup.salts"
SALTS = 16


def salts_for(left: DataFrame, on: list[str], task_rows: int = 4_000_000) -> int:
    """Salts that leave no task more than `task_rows` rows of the key that most rows hold: the value for
    SALTS_SETTING, measured once before a run. It reads the key columns only."""
    most = left.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).head()
    return max(1, -(-(most.n or 0) // task_rows))


def salted_lookup(
    left: DataFrame, right: DataFrame, on: list[str], spread: list[str], how: str = "left", salts: int | None = None
) -> DataFrame:
    """Join `left` to a `right` that holds each key once, spreading every left key over `salts` tasks.

    `spread` names left columns that tell rows of one key apart. The right side is repeated once per
    salt, so it must be the smaller one; adaptive execution broadcasts it when it proves small.
    """
    salts = salts or int(left.sparkSession.conf.get(SALTS_SETTING, str(SALTS)))
    # A join with the salts, since the planner takes an exploded table to be as small as before and broadcasts all copies.
    copies = right.crossJoin(right.sparkSession.range(salts).select(F.col("id").cast("int").alias("_salt")))
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def venue_address(rows: DataFrame, addresses: DataFrame, spread: list[str]) -> DataFrame:
    """Rows with the street address of their venue, NULL where it is not known."""
    return salted_lookup(rows, addresses.select("venue", "address"), ["venue"], spread)


def known_addresses(spark: SparkSession) -> DataFrame:
    """Street addresses of venues without a feed of their own."""
    return spark.createDataFrame(list(fixed.VENUE_ADDRESSES.items()), "venue STRING, address STRING")
