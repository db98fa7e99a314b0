"""Usage log: one reading per message, totals per agent and session, weighted cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import fixed

FIELDS = fixed.USAGE_FIELDS


def latest_readings(lines: DataFrame) -> DataFrame:
    """The last reading of each message of a file (session, agent); copies collapse before the shuffle.

    The four readings share one ordering column, so they stay consistent, and every buffer is a
    plain number, so the aggregate hashes instead of sorting.
    """
    return lines.groupBy("session", "agent", "message_id").agg(
        *[F.max_by(f, "line_no").alias(f) for f in FIELDS]
    )


def totals(readings: DataFrame) -> DataFrame:
    """Sums per agent file, per session and overall. `scope` says which; the main file has agent ''."""
    sums = [F.sum(F.coalesce(f, F.lit(0))).alias(f) for f in FIELDS]
    level = F.grouping_id("session", "agent")
    rolled = readings.rollup("session", "agent").agg(
        *sums, F.count(F.lit(1)).alias("message_count"), level.alias("_level")
    )
    scope = (
        F.when(F.col("_level") == 3, "all")
        .when(F.col("_level") == 1, "session")
        .when(F.col("agent") == "", "main")
        .otherwise("agent")
    )
    return rolled.withColumn("scope", scope).drop("_level")


def report(readings: DataFrame, agents: DataFrame) -> DataFrame:
    """Totals with agent type and description, costliest first inside each session."""
    cost = F.lit(0)
    for f in FIELDS:
        cost = cost + F.col(f)
    return (
        totals(readings)
        .join(agents, ["session", "agent"], "left")
        .withColumn("agent_type", F.coalesce("agent_type", F.lit("")))
        .withColumn("description", F.coalesce("description", F.lit("")))
        .withColumn("total_tokens", cost)
    )


def ordered(reported: DataFrame) -> DataFrame:
    """Report order: sessions, main file first, agents by total, session total last."""
    place = F.when(F.col("scope") == "main", 0).when(F.col("scope") == "agent", 1).otherwise(2)
    return reported.orderBy(F.col("session").asc_nulls_last(), place, F.col("total_tokens").desc(), "agent")


def weighted(summed: DataFrame) -> DataFrame:
    """Totals with their cost in units of one input token."""
    cost = F.lit(0.0)
    for f, weight in fixed.USAGE_WEIGHTS.items():
        cost = cost + F.col(f) * weight
    return summed.withColumn("weighted_units", F.round(cost, 2))
