"""The append-only picks log: rows, keyed append, attendance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import category, money
from marquee.operators.lookup import salted_lookup
from marquee.operators.report import with_music_links

LOG_KEY = ["week_of", "title"]


def log_rows(picks: DataFrame, mentions: DataFrame, lookup: DataFrame, city: str = fixed.CITY) -> DataFrame:
    """Log rows of a selection: picks by rank, mentions as HM."""

    def rows(df: DataFrame, rank: object, link: object) -> DataFrame:
        return df.select(
            F.lit(city).alias("city"),
            F.col("week").cast("string").alias("week_of"),
            F.date_format(F.try_to_date(F.col("day").cast("string"), "yyyy-MM-dd"), "EEEE").alias("day"),
            F.col("day").cast("string").alias("date"),
            "title",
            "venue",
            category.slug(F.col("category")).alias("category"),
            "source",
            rank.alias("rank"),
            money.price_tier(F.col("cost"), F.col("sold_out")).alias("price_tier"),
            link.alias("spotify_link"),
            F.lit("").alias("tags"),
            F.lit("").alias("attended"),
        )

    linked = with_music_links(picks, lookup)
    top = rows(linked, F.col("rank").cast("string"), F.coalesce("spotify_url", F.lit("")))
    return top.unionByName(rows(mentions, F.lit("HM"), F.lit("")))


def new_rows(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows whose (week_of, title) the log does not hold yet.

    The log is cut down to the keys at hand before its keys are made distinct: few new rows are
    broadcast to the log's scan, and the log is not shuffled.
    """
    held = log.select(*LOG_KEY).join(rows.select(*LOG_KEY).distinct(), LOG_KEY, "left_semi").distinct()
    return rows.join(held, LOG_KEY, "left_anti")


def with_digests(rows: DataFrame) -> DataFrame:
    """Log rows with the two digests of their key that the side table of a log keeps."""
    return rows.withColumn("key_a", F.xxhash64(*LOG_KEY)).withColumn("key_b", F.xxhash64(F.lit(1), *LOG_KEY))


def new_rows_by_digest(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """What `new_rows` finds, from the key digests (week_of, key_a, key_b) of the log instead of the log.

    Only the weeks at hand are read. Two keys of a week are told apart by 128 bits.
    """
    digest = ["week_of", "key_a", "key_b"]
    held = keys.join(rows.select("week_of").distinct(), "week_of", "left_semi").select(*digest).distinct()
    return with_digests(rows).join(held, digest, "left_anti").select(*rows.columns)


def update_attendance(log: DataFrame, titles: DataFrame, week_of: str, city: str = fixed.CITY) -> DataFrame:
    """Log rows with `attended` set for one city and week: 'true' when the title is in the calendar.

    Only rows of that city and week take part in the join, and of the calendar only titles that they hold; a title
    many of them share is salted.
    """
    due = F.coalesce((F.col("city") == city) & (F.col("week_of") == week_of), F.lit(False))
    wanted = log.where(due).select("title").distinct()
    held = titles.select("title").join(wanted, "title", "left_semi").distinct().withColumn("_held", F.lit(True))
    matched = salted_lookup(log.where(due), held, ["title"], ["date", "rank", "venue"])
    seen = matched.withColumn("attended", F.when(F.col("_held"), "true").otherwise("false")).drop("_held")
    return log.where(~due).unionByName(seen.select(*log.columns))


def normalise(log: DataFrame) -> DataFrame:
    """Ranks in one spelling, and only true/false kept as attendance."""
    attended = F.lower(F.trim("attended"))
    return log.withColumn("rank", F.upper("rank")).withColumn(
        "attended", F.when(attended.isin("true", "false"), attended).otherwise("")
    )
