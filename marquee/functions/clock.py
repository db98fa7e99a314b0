"""Dates, weeks and 12-hour clock times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import text

CLOCK = r"\A( ?[1-9]|0[1-9]|1[0-2]):([0-5][0-9]|[0-9])\s+([AaPp][Mm])\z"


def target_monday(day: Column) -> Column:
    """The Monday strictly after a date."""
    return F.next_day(day, "MO")


def week_of(day: Column) -> Column:
    """The Monday on or before a date."""
    return F.next_day(F.date_sub(day, 7), "MO")


def week_days(monday: Column) -> Column:
    return F.sequence(monday, F.date_add(monday, 6))


def clock_minutes(c: Column) -> Column:
    """Minutes after midnight of a single 12-hour clock time; NULL for anything else."""
    hour = F.regexp_extract(c, CLOCK, 1)
    minute = F.regexp_extract(c, CLOCK, 2)
    half = F.lower(F.regexp_extract(c, CLOCK, 3))
    total = (
        F.btrim(hour).try_cast("int") % 12 * 60
        + minute.try_cast("int")
        + F.when(half == "pm", 720).otherwise(0)
    )
    return F.when(F.rlike(c, F.lit(CLOCK)), total)


def display_clock(ts: Column) -> Column:
    """12-hour clock without a leading zero, e.g. 7:05 PM."""
    return F.date_format(ts, "h:mm a")


def minutes_clock(minutes: Column) -> Column:
    hour = F.floor(minutes / 60).cast("int")
    shown = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    half = F.when(hour < 12, "AM").otherwise("PM")
    return F.format_string("%d:%02d %s", shown, (minutes % 60).cast("int"), half)


def month_number(name: Column) -> Column:
    """Month of a name by its first three letters, NULL if it is none."""
    key = F.lower(F.substring(text.strip(name), 1, 3))
    at = F.array_position(F.array(*[F.lit(m) for m in fixed.MONTHS]), key)
    return F.nullif(at, F.lit(0)).cast("int")


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """A date, or NULL when the calendar has no such day."""
    parts = F.concat_ws("-", *[p.cast("string") for p in (year, month, day)])
    known = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(known, F.try_to_date(parts, "y-M-d"))


def nearest_date(month: Column, day: Column, week_start: Column) -> Column:
    """The (month, day) closest to `week_start` among its year and both neighbours; ties go to the earlier."""

    def closest(day_of_year: Column) -> Column:
        options = F.transform(
            F.array(*[F.lit(shift) for shift in (-1, 0, 1)]),
            lambda shift: calendar_date(F.year(week_start) + shift, day_of_year["month"], day_of_year["day"]),
        )
        known = F.filter(options, lambda d: d.isNotNull())
        return F.array_min(
            F.transform(known, lambda d: F.struct(F.abs(F.datediff(d, week_start)).alias("away"), d.alias("day")))
        )["day"]

    return text.once(F.struct(month.alias("month"), day.alias("day")), closest)


def range_label(monday: Column, sunday: Column) -> Column:
    same = F.concat(
        F.date_format(monday, "MMMM d"), F.lit("–"), F.date_format(sunday, "d, yyyy")
    )
    cross = F.concat(
        F.date_format(monday, "MMMM d"), F.lit(" – "), F.date_format(sunday, "MMMM d, yyyy")
    )
    return F.when(F.month(monday) == F.month(sunday), same).otherwise(cross)


def to_utc(wall: Column, zone: str = fixed.TIME_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)


def to_wall(utc: Column, zone: str = fixed.TIME_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def wall_start(day: Column, clock: Column) -> Column:
    """Wall-clock start of a listing; NULL when the time is missing or not a single clock time."""
    minutes = clock_minutes(text.unwrap_placeholder(clock))
    midnight = F.try_to_date(day.cast("string"), "yyyy-MM-dd").cast("timestamp_ntz")
    return midnight + F.make_dt_interval(mins=minutes)


def iso_offset(wall: Column, zone: str = fixed.TIME_ZONE) -> Column:
    """Wall-clock time with the zone's offset, e.g. 2026-07-20T19:00:00-04:00."""
    behind = F.timestamp_diff("MINUTE", wall, to_utc(wall, zone))
    sign = F.when(behind > 0, "-").otherwise("+")
    size = F.abs(behind)
    offset = F.format_string(
        "%s%02d:%02d", sign, F.floor(size / 60).cast("int"), (size % 60).cast("int")
    )
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), offset)


def instant(c: Column) -> Column:
    """ISO text as an instant; text without an offset counts as UTC."""
    t = text.strip(c)
    zoned = F.rlike(t, F.lit(r"(?:[Zz]|[+-]\d{2}:?\d{2})\z"))
    return F.when(zoned, t).otherwise(F.concat(t, F.lit("Z"))).try_cast("timestamp")


def local_part(c: Column) -> Column:
    """Wall-clock part of an ISO text, its offset left out."""
    return F.substring(c, 1, 19).try_cast("timestamp_ntz")
