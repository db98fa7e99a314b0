"""iCalendar feeds. A feed without events is a quiet week; a body that is no calendar is broken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import clock
from marquee.sources.feeds_json import items, parsed


def unescape(c: Column) -> Column:
    """Escapes undone one after the other: newline, comma, semicolon, backslash."""
    for escaped, plain in ((r"\n", "\n"), (r"\,", ","), (r"\;", ";"), ("\\\\", "\\")):
        c = F.replace(c, F.lit(escaped), F.lit(plain))
    return c


def blocks(body: Column) -> Column:
    """Contents of the closed VEVENT blocks, continuation lines unfolded; NULL if this is no calendar."""
    lines = F.replace(F.concat(F.lit("\n"), body, F.lit("\n")), F.lit("\r\n"), F.lit("\n"))
    unfolded = F.replace(lines, F.lit("\n "), F.lit(""))
    opened = F.split(unfolded, "\nBEGIN:VEVENT")
    closed = F.filter(F.slice(opened, 2, F.size(opened)), lambda b: F.contains(b, F.lit("\nEND:VEVENT")))
    cut = F.transform(closed, lambda b: F.substring_index(b, "\nEND:VEVENT", 1))
    return F.when(F.contains(body, F.lit("BEGIN:VCALENDAR")), cut)


def prop(block: Column, name: str) -> Column:
    """Value of a property, parameters ignored; the last one wins, '' if absent."""
    return F.regexp_extract(block, rf"(?s).*\n{name}(?:;[^:\n]*)?:([^\n]*)", 1)


def stamp(block: Column, pattern: str) -> Column:
    digits = F.regexp_extract(prop(block, "DTSTART"), pattern, 0)
    iso = F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})", "$1-$2-$3 $4:$5:$6")
    return F.substring(iso, 1, 19).try_cast("timestamp_ntz")


def _feed(payloads: DataFrame, start: Column, venue: Column, url: Column) -> DataFrame:
    rows = items(payloads, blocks(F.col("body")))
    return parsed(
        rows,
        start.cast("date"),
        F.lit(True),
        {
            "title": unescape(prop(F.col("item"), "SUMMARY")),
            "venue": venue,
            "time": clock.display_clock(start),
            "cost": F.lit(""),
            "url": url,
            "description": unescape(prop(F.col("item"), "DESCRIPTION")),
        },
    )


def ical_utc(payloads: DataFrame) -> DataFrame:
    """Stamps in UTC; a link as location means the event is online."""
    block = F.col("item")
    place = unescape(prop(block, "LOCATION"))
    online = place.startswith("http")
    start = clock.to_wall(stamp(block, r"^\d{8}T\d{6}Z?"))
    return _feed(
        payloads,
        start,
        F.when(online, fixed.ONLINE_SEE_DESCRIPTION).otherwise(place),
        F.when(online, place).otherwise(""),
    )


def ical_local(payloads: DataFrame) -> DataFrame:
    """Stamps in local time; no location, or a link as location, means the event is online."""
    block = F.col("item")
    place = unescape(prop(block, "LOCATION"))
    online = (place == "") | place.startswith("http")
    start = stamp(block, r"^\d{8}T\d{6}")
    return _feed(payloads, start, F.when(online, fixed.ONLINE_ANY).otherwise(place), prop(block, "URL"))
