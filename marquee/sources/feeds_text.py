"""Rendered showtime text: one block per film with a rating, a running time and clock times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import clock
from marquee.sources.feeds_json import items, parsed

def films(body: Column) -> Column:
    """Text blocks that each start at a film's title line."""
    pieces = F.split(F.concat(F.lit("\n"), body), rf"\n(?={fixed.FILM_HEAD})")
    return F.transform(
        F.slice(pieces, 2, F.size(pieces)), lambda p: F.substring_index(p, fixed.NEARBY_LINE, 1)
    )


def show_time(found: Column) -> Column:
    hour = F.regexp_extract(found, fixed.SHOW_TIME, 1).try_cast("int")
    minute = F.regexp_extract(found, fixed.SHOW_TIME, 2).try_cast("int")
    late = F.when(F.regexp_extract(found, fixed.SHOW_TIME, 3) == "p", 720).otherwise(0)
    return clock.minutes_clock(hour % 12 * 60 + minute + late)


def showtime_text(payloads: DataFrame) -> DataFrame:
    """One row per film and page; equal times are listed once, in page order.

    A page body of NULL is a failed request; it yields nothing and is counted by the fetch log.
    """
    rows = items(payloads, films(F.coalesce("body", F.lit(""))), "context_date", "venue", "fallback_url")
    rows = rows.withColumn("broken", F.lit(False))
    film = F.col("item")
    rest = F.regexp_replace(film, fixed.FILM_BLOCK, "")
    times = F.array_distinct(F.transform(F.regexp_extract_all(rest, F.lit(fixed.SHOW_TIME), F.lit(0)), show_time))
    rating = F.btrim(F.regexp_extract(film, fixed.FILM_BLOCK, 2))
    return parsed(
        rows,
        F.col("context_date"),
        F.rlike(film, F.lit(fixed.FILM_BLOCK)) & (F.size(times) > 0),
        {
            "title": F.regexp_extract(film, fixed.FILM_BLOCK, 1),
            "venue": F.col("venue"),
            "time": F.array_join(times, ", "),
            "cost": F.lit(""),
            "url": F.col("fallback_url"),
            "description": F.concat(
                F.lit("Rated "), F.when(rating != "", rating).otherwise("Not Rated"),
                F.lit(". Runtime: "), F.btrim(F.regexp_extract(film, fixed.FILM_BLOCK, 3)), F.lit("."),
            ),
        },
    )
