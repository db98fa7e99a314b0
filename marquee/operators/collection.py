"""From fetch logs and source results to manifest, day split and resume plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import clock
from marquee.operators.collapse import listed_day


def registry(spark: SparkSession) -> DataFrame:
    """Every collected source with its display name and payload format."""
    return spark.createDataFrame(fixed.SOURCES, "source STRING, name STRING, format STRING")


def yield_floors(spark: SparkSession) -> DataFrame:
    """The known smallest weekly yields."""
    return spark.createDataFrame(list(fixed.YIELD_FLOORS.items()), "source STRING, min_expected BIGINT")


def fetch_rollup(fetches: DataFrame) -> DataFrame:
    """One result per (week, source) from its logged page requests, whatever their number.

    All failed: the source failed. Some failed: it is ok with a note.
    """
    rolled = fetches.groupBy("week", "source").agg(
        F.sum(F.when(F.col("ok"), F.col("n_events")).otherwise(0)).alias("events"),
        F.count_if("ok").alias("n_ok"),
        F.count_if(~F.col("ok")).alias("n_failed"),
    )
    lost = (F.col("n_ok") == 0) & (F.col("n_failed") > 0)
    note = F.format_string("partial -- %d request(s) failed", "n_failed")
    reason = F.format_string("every request failed (%d attempted)", "n_failed")
    return rolled.select(
        "week",
        "source",
        F.when(lost, "failed").otherwise("ok").alias("status"),
        F.when(~lost, F.col("events")).alias("events"),
        F.when(lost, reason).alias("reason"),
        F.when(~lost & (F.col("n_failed") > 0), note).alias("note"),
    )


def build_manifest(results: DataFrame) -> DataFrame:
    """Manifest rows: one per (week, source); a source with any ok result is ok."""
    ok = F.col("status") == "ok"
    return (
        results.groupBy("week", "source")
        .agg(
            F.count_if(ok).alias("_ok"),
            F.sum(F.when(ok, F.coalesce("events", F.lit(0))).otherwise(0)).alias("_events"),
            F.min(F.when(~ok, F.coalesce("reason", F.lit(fixed.UNKNOWN_REASON)))).alias("_reason"),
            F.min("collected_at").alias("first_collected"),
            F.max("collected_at").alias("last_collected"),
        )
        .select(
            "week",
            "source",
            F.when(F.col("_ok") > 0, "ok").otherwise("failed").alias("status"),
            F.when(F.col("_ok") > 0, F.col("_events")).alias("events"),
            F.when(F.col("_ok") == 0, F.col("_reason")).alias("reason"),
            "first_collected",
            "last_collected",
        )
    )


def run_summary(manifest: DataFrame) -> DataFrame:
    """Sources and events per week and overall."""
    ok = F.col("status") == "ok"
    return manifest.rollup("week").agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.count_if(ok).alias("n_ok"),
        F.count_if(~ok).alias("n_failed"),
        F.sum(F.coalesce("events", F.lit(0))).alias("n_events"),
    )


def failure_list(manifest: DataFrame) -> DataFrame:
    """Failed sources as 'source (reason)', one row each; readers sort by source."""
    return manifest.where(F.col("status") == "failed").select(
        "week",
        "source",
        F.concat("source", F.lit(" ("), F.coalesce("reason", F.lit(fixed.UNKNOWN_REASON)), F.lit(")")).alias("failure"),
    )


def ok_events(manifest: DataFrame, events: DataFrame) -> DataFrame:
    """Events of sources the manifest calls ok; the file's own name for the source wins over its stem.

    One source may hold most of a week: adaptive execution splits its rows over several tasks. The manifest is not
    salted, as it may have a row for every few events.
    """
    good = manifest.where(F.col("status") == "ok").select("week", F.col("source").alias("stem"))
    return events.join(good, ["week", "stem"]).withColumn(
        "source", F.coalesce(F.col("source"), F.col("stem"))
    )


def calendar(weeks: DataFrame) -> DataFrame:
    """The seven days of every week, so that days without rows exist too."""
    return weeks.select("week").distinct().select(
        "week", F.explode(clock.week_days(F.col("week"))).alias("date")
    )


def out_of_window(candidates: DataFrame) -> DataFrame:
    """Candidates not listed under one of their week's seven days; writing must stop on any."""
    day = F.try_to_date(listed_day(candidates), "yyyy-MM-dd")
    inside = F.coalesce(day.between(F.col("week"), F.date_add("week", 6)), F.lit(False))
    return candidates.where(~inside)


def day_split(candidates: DataFrame) -> DataFrame:
    """Candidates per day, all seven days of each week present."""
    per_day = candidates.groupBy("week", F.try_to_date(listed_day(candidates), "yyyy-MM-dd").alias("date")).agg(
        F.count(F.lit(1)).alias("n_candidates")
    )
    return calendar(candidates).join(per_day, ["week", "date"], "left").na.fill(0, ["n_candidates"])


def resume_plan(registry: DataFrame, results: DataFrame) -> DataFrame:
    """Sources still to fetch: failed ones again, missing ones for the first time."""
    state = results.groupBy("source").agg(F.max((F.col("status") == "ok").cast("int")).alias("_ok"))
    return (
        registry.join(state, ["source"], "left")
        .where(F.coalesce("_ok", F.lit(0)) == 0)
        .withColumn("action", F.when(F.col("_ok").isNull(), "fetch").otherwise("retry"))
        .drop("_ok")
    )


def union_first_seen(snapshots: DataFrame) -> DataFrame:
    """Listings of overlapping snapshots, the first seen per (title, date) by snapshot, then position."""
    rest = [c for c in snapshots.columns if c not in ("title", "date", "snapshot", "pos")]
    first = F.min(F.struct("snapshot", "pos", *rest)).alias("f")
    return snapshots.groupBy("title", "date").agg(first).select(
        "title", "date", "f.snapshot", "f.pos", *[F.col(f"f.{c}").alias(c) for c in rest]
    )
