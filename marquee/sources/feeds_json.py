"""JSON feeds: payload rows to parsed rows.

Every feed function takes payloads (schemas.PAYLOAD) and returns one row per item with
`broken` (the payload has no container at all), `in_week`, `event_date` and the event fields. A
payload without items keeps one row without fields, so the status of every source can be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import clock, markup, text

BASE = ["source", "week_start", "page"]


def within(day: Column) -> Column:
    """Inside the payload's Monday-to-Sunday week, both ends included."""
    return F.coalesce(day.between(F.col("week_start"), F.date_add("week_start", 6)), F.lit(False))


def items(payloads: DataFrame, container: Column, *keep: str) -> DataFrame:
    """Explode a container array; `broken` is set where there is no container."""
    rows = payloads.withColumn("_items", container)
    return rows.select(
        *BASE,
        *keep,
        F.col("_items").isNull().alias("broken"),
        F.posexplode_outer("_items").alias("pos", "item"),
    )


def parsed(rows: DataFrame, event_date: Column, keep: Column, fields: dict[str, Column], in_week: Column | None = None) -> DataFrame:
    dated = rows.withColumn("event_date", event_date)
    inside = within(F.col("event_date")) if in_week is None else in_week
    return dated.select(
        *BASE,
        "pos",
        "broken",
        (F.coalesce(keep, F.lit(False)) & F.coalesce(inside, F.lit(False))).alias("in_week"),
        "event_date",
        *[text.strip(text.text_or_empty(c)).alias(name) for name, c in fields.items()],
    )


def truthy(c: Column) -> Column:
    """JSON value, read as text, that counts as true."""
    return F.coalesce(~c.isin("", "false", "0", "0.0", "null", "[]", "{}"), F.lit(False))


def object_json(payloads: DataFrame) -> DataFrame:
    """{"events": [...]} pages. An id seen before is dropped, then ongoing listings."""
    schema = (
        "events ARRAY<STRUCT<id: STRING, title: STRING, excerpt: STRING, tz_adjusted_begin_date: STRING, "
        "is_ongoing: STRING, is_free: STRING, ticket_info: STRING, permalink: STRING, "
        "venue: STRUCT<title: STRING, city: STRING, state: STRING>>>"
    )
    rows = items(payloads, F.from_json("body", schema)["events"])
    # Rows without an id stand for themselves.
    key = F.coalesce(F.col("item.id"), F.concat(F.lit("#"), F.col("page"), F.lit("/"), F.coalesce("pos", F.lit(-1))))
    first = rows.groupBy("source", "week_start", key.alias("_key")).agg(
        F.min(F.struct("page", "pos", "broken", "item")).alias("r")
    )
    seen = first.select("source", "week_start", "r.*")
    start = clock.local_part(F.col("item.tz_adjusted_begin_date"))
    place = F.col("item.venue")
    venue = F.concat(
        text.strip(text.text_or_empty(place["title"])),
        F.when(text.filled(place["city"]), F.concat(F.lit(", "), place["city"])).otherwise(""),
        F.when(
            text.filled(place["city"]) & text.filled(place["state"]), F.concat(F.lit(", "), place["state"])
        ).otherwise(""),
    )
    link = text.text_or_empty(F.col("item.permalink"))
    return parsed(
        seen,
        start.cast("date"),
        ~truthy(F.col("item.is_ongoing")),
        {
            "title": F.col("item.title"),
            "venue": venue,
            "time": clock.display_clock(start),
            "cost": F.when(truthy(F.col("item.is_free")), "Free").otherwise(F.col("item.ticket_info")),
            "url": F.when(link != "", F.concat(F.lit(fixed.LINKS["object_json"]), link)).otherwise(""),
            "description": F.col("item.excerpt"),
        },
    )


def epoch_json(payloads: DataFrame) -> DataFrame:
    """Array of events in Unix seconds. A multi-date event belongs to every week it overlaps."""
    schema = (
        "ARRAY<STRUCT<title: STRING, slug: STRING, start_datetime: BIGINT, end_datetime: BIGINT, "
        "multidate: STRING, tags: ARRAY<STRING>, place: STRUCT<name: STRING, address: STRING>>>"
    )
    rows = items(payloads, F.from_json("body", schema))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def wall(seconds: Column) -> Column:
        return clock.to_wall(epoch + F.make_dt_interval(secs=seconds))

    start = wall(F.col("item.start_datetime"))
    end = F.when(F.col("item.end_datetime") != 0, wall(F.col("item.end_datetime")).cast("date"))
    spans = truthy(F.col("item.multidate")) & end.isNotNull()
    overlap = (F.col("event_date") <= F.date_add("week_start", 6)) & (end >= F.col("week_start"))
    place = F.col("item.place")
    name = text.text_or_empty(place["name"])
    return parsed(
        rows,
        start.cast("date"),
        F.lit(True),
        {
            "title": F.col("item.title"),
            "venue": F.when(
                text.filled(place["address"]), F.concat(name, F.lit(" ("), place["address"], F.lit(")"))
            ).otherwise(name),
            "time": clock.display_clock(start),
            "cost": F.lit(""),
            "url": F.concat(F.lit(fixed.LINKS["epoch_json"]), text.text_or_empty(F.col("item.slug"))),
            "description": F.array_join("item.tags", " / "),
        },
        F.when(spans, overlap).otherwise(within(F.col("event_date"))),
    )


def date_only_json(payloads: DataFrame) -> DataFrame:
    """Array of posts that carry a date but no real time: time stays blank."""
    schema = (
        "ARRAY<STRUCT<link: STRING, title: STRUCT<rendered: STRING>, acf: STRUCT<date: STRING, venue: STRING, "
        "price: STRING, external_link: STRING, external_artist: STRING>>>"
    )
    rows = items(payloads, F.from_json("body", schema))
    acf = F.col("item.acf")
    raw = F.array("item.title.rendered", "item.acf.venue", "item.acf.external_artist")
    rows = rows.withColumn("_plain", F.transform(raw, markup.unescape))
    title, venue, artist = (F.get("_plain", F.lit(i)) for i in range(3))
    return parsed(
        rows,
        F.try_to_date(F.substring(acf["date"], 1, 10), "yyyy-MM-dd"),
        F.lit(True),
        {
            "title": title,
            "venue": venue,
            "time": F.lit(""),
            "cost": acf["price"],
            "url": text.first_filled(F.col("item.link"), acf["external_link"]),
            "description": artist,
        },
    )


def calendar_json(payloads: DataFrame) -> DataFrame:
    """Calendar resources: timed or all-day, cancelled ones dropped, calendar-wide venue and link as fallback."""
    schema = (
        "items ARRAY<STRUCT<status: STRING, summary: STRING, location: STRING, description: STRING, "
        "htmlLink: STRING, start: STRUCT<dateTime: STRING, date: STRING>>>, venue STRING, fallback_url STRING"
    )
    opened = payloads.drop("venue", "fallback_url").withColumn("_doc", F.from_json("body", schema))
    opened = opened.withColumn("venue", F.col("_doc.venue")).withColumn("fallback_url", F.col("_doc.fallback_url"))
    rows = items(opened, F.col("_doc.items"), "venue", "fallback_url")
    timed = F.col("item.start.dateTime")
    start = clock.local_part(timed)
    all_day = F.try_to_date(F.col("item.start.date"), "yyyy-MM-dd")
    return parsed(
        rows,
        F.when(timed.isNotNull(), start.cast("date")).otherwise(all_day),
        ~F.coalesce(F.col("item.status") == "cancelled", F.lit(False)),
        {
            "title": F.col("item.summary"),
            "venue": text.first_filled(F.col("item.location"), F.col("venue")),
            "time": F.when(timed.isNotNull(), clock.display_clock(start)),
            "cost": F.lit(""),
            "url": text.first_filled(F.col("item.htmlLink"), F.col("fallback_url")),
            "description": F.col("item.description"),
        },
    )
