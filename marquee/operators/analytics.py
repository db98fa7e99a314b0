"""Weekly statistics: funnel, shares, health, histograms, deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import clock, money, text

PRICE_STEP = 10


def _counted(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def funnel(raw: DataFrame, candidates: DataFrame, listing: DataFrame, picks: DataFrame) -> DataFrame:
    """Rows left per week after each stage; every stage is counted on its own before the join."""
    stages = _counted(raw, "week", name="raw")
    for name, df in (("candidates", candidates), ("listed", listing), ("picked", picks)):
        stages = stages.join(_counted(df, "week", name=name), ["week"], "left")
    return stages.na.fill(0, ["candidates", "listed", "picked"])


def category_share(listing: DataFrame, picks: DataFrame) -> DataFrame:
    """Each category's share of a week's listing and of its picks."""
    week = Window.partitionBy("week")
    listed = _counted(listing, "week", "category", name="listed")
    picked = _counted(picks, "week", "category", name="picked")
    both = listed.join(picked, ["week", "category"], "full").na.fill(0, ["listed", "picked"])
    return both.select(
        "week",
        "category",
        "listed",
        "picked",
        F.round(100.0 * F.col("listed") / F.sum("listed").over(week), 4).alias("listed_pct"),
        F.round(100.0 * F.try_divide(F.col("picked"), F.sum("picked").over(week)), 4).alias("picked_pct"),
    )


def source_share(rows: DataFrame) -> DataFrame:
    """Each source's share of a week's rows."""
    week = Window.partitionBy("week")
    return _counted(rows, "week", "source").withColumn(
        "pct", F.round(100.0 * F.col("n") / F.sum("n").over(week), 4)
    )


def collection_health(manifest: DataFrame, floors: DataFrame) -> DataFrame:
    """Per week: sources by outcome, events, run length, silent sources and sources under their floor."""
    count = F.coalesce("events", F.lit(0))
    ok = F.col("status") == "ok"
    return (
        manifest.join(floors, ["source"], "left")
        .groupBy("week")
        .agg(
            F.count(F.lit(1)).alias("n_sources"),
            F.count_if(ok).alias("n_ok"),
            F.count_if(~ok).alias("n_failed"),
            F.sum(count).alias("n_events"),
            F.count_if(ok & (count == 0)).alias("n_silent"),
            F.count_if(ok & (F.coalesce("min_expected", F.lit(0)) > 0) & (count < F.col("min_expected"))).alias(
                "n_under_floor"
            ),
            F.timestamp_diff("SECOND", F.min("started"), F.max("completed")).alias("run_seconds"),
        )
    )


def price_histogram(rows: DataFrame) -> DataFrame:
    """Rows per week, price tier and step of ten dollars (NULL where no price is stated)."""
    step = F.floor(money.dollars(F.col("cost")) / PRICE_STEP).cast("long") * PRICE_STEP
    return rows.groupBy(
        "week", money.price_tier(F.col("cost"), F.col("sold_out")).alias("tier"), step.alias("price_from")
    ).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sold_out")).alias("n_sold_out"))


def time_histogram(rows: DataFrame) -> DataFrame:
    """Rows per week, weekday (Monday 1) and start hour; NULL hour where the time is not a single clock."""
    hour = F.floor(clock.clock_minutes(F.col("time")) / 60).cast("int")
    day = F.try_to_date(F.col("date").cast("string"), "yyyy-MM-dd")
    return rows.groupBy(
        "week", (F.weekday(day) + 1).alias("weekday"), hour.alias("hour")
    ).agg(F.count(F.lit(1)).alias("n"))


def venue_leaderboard(rows: DataFrame, places: int = 10) -> DataFrame:
    """The busiest venues of each week; equal counts share a place."""
    key = text.venue_key(F.lit(""), F.col("venue"))
    counts = rows.groupBy("week", key.alias("venue_key")).agg(F.count(F.lit(1)).alias("n"))
    by_count = Window.partitionBy("week").orderBy(F.col("n").desc())
    return counts.withColumn("place", F.dense_rank().over(by_count)).where(F.col("place") <= places)


def week_delta(rows: DataFrame) -> DataFrame:
    """Rows per source and week beside the source's previous week."""
    by_week = Window.partitionBy("source").orderBy("week")
    counts = _counted(rows, "week", "source")
    before = F.lag("n").over(by_week)
    return counts.withColumn("previous", before).withColumn("delta", F.col("n") - F.col("previous"))


def match_rate(titles: DataFrame, lookup: DataFrame, by: str) -> DataFrame:
    """Share of looked-up titles that were found."""
    return (
        titles.select(by, "title").distinct()
        .join(lookup, ["title"])
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("titles"),
            F.count_if(F.col("spotify_url").isNotNull()).alias("matched"),
        )
        .withColumn("rate", F.round(F.col("matched") / F.col("titles"), 4))
    )


def pick_histograms(picks: DataFrame) -> DataFrame:
    """Picks per week by venue, by category and by source, in one pass."""
    keyed = picks.withColumn("venue_key", text.venue_key(F.col("address"), F.col("venue")))
    counts = keyed.groupingSets(
        [["week", "venue_key"], ["week", "category"], ["week", "source"]],
        "week", "venue_key", "category", "source",
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_level"))
    level = F.col("_level")
    return counts.select(
        "week",
        F.when(level == 3, "venue").when(level == 5, "category").otherwise("source").alias("dimension"),
        F.when(level == 3, F.col("venue_key")).when(level == 5, F.col("category")).otherwise(F.col("source")).alias("label"),
        "n",
    )
