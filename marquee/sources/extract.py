"""From raw payloads to listings and per-source status, by payload format."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import text
from marquee.schemas import EVENT_FIELDS
from marquee.sources import feeds_html, feeds_ical, feeds_json, feeds_text

FORMATS = {
    "object_json": feeds_json.object_json,
    "epoch_json": feeds_json.epoch_json,
    "date_only_json": feeds_json.date_only_json,
    "calendar_json": feeds_json.calendar_json,
    "ical_utc": feeds_ical.ical_utc,
    "ical_local": feeds_ical.ical_local,
    "showtime_text": feeds_text.showtime_text,
    **{name: partial(feeds_html.parse, layout=layout) for name, layout in feeds_html.LAYOUTS.items()},
}


def parse(payloads: DataFrame, layout: str, details: DataFrame | None = None) -> DataFrame:
    """Payloads of one format. Only `json_ld` reads `details`, the pages that its cards lead to (url, body)."""
    if layout == "json_ld":
        if details is None:
            details = payloads.select(F.col("fallback_url").alias("url"), "body").limit(0)
        return feeds_html.json_ld(payloads, details)
    return FORMATS[layout](payloads)


def with_shown_body(payloads: DataFrame, limit: int = fixed.BODY_CHARS) -> DataFrame:
    """Payloads with `shown_body`, the body as a reader is shown it, and `truncated`. Parsers read the whole body."""
    return payloads.withColumn("shown_body", text.truncate_body(F.col("body"), limit)).withColumn(
        "truncated", F.char_length("body") > limit
    )


def listings(parsed: DataFrame) -> DataFrame:
    """Events of the target week.

    `date` is the true start; `listed_date` is the first day inside the week, which differs only for
    an event that began earlier.
    """
    rows = parsed.where("in_week").withColumn("date", F.col("event_date").cast("string"))
    listed = F.greatest("event_date", "week_start").cast("string").alias("listed_date")
    return rows.select("source", "week_start", "page", "pos", *EVENT_FIELDS, listed)


def status(parsed: DataFrame) -> DataFrame:
    """Per source and week: failed when no payload had a container, else ok with its event count.

    Containers without an event in the week are a quiet week, not a failure.
    """
    rolled = parsed.groupBy("source", "week_start").agg(
        F.min(F.col("broken").cast("int")).alias("_broken"), F.count_if("in_week").alias("n")
    )
    failed = F.col("_broken") == 1
    return rolled.select(
        "source",
        "week_start",
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.when(failed, "no listing containers found, the layout may have changed").alias("reason"),
        F.when(~failed, F.col("n")).alias("events"),
    )
