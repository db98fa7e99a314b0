"""HTML listings, one specification per page layout.

A page is split once into its tags. A layout names the opening tag of one listing and, where a date covers several
listings, the opening tag of that group; fields are elements and attributes found among the listing's tags. Tag, class
and attribute names are fixed values of the pages.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import fixed
from marquee.functions import clock, markup, pages, text
from marquee.functions.pages import Match, attribute, blocks, element, tag, words
from marquee.sources.feeds_json import parsed

# Positions of a group's listings: no array holds as many, so no two listings share a position.
GROUP_STEP = 2**31

# Stands between texts that are decoded together; a private-use character no page text needs.
SEPARATOR = "\ue000"

Tags = list[pages.Token]
Texts = dict[str, Column]


@dataclass(frozen=True)
class Layout:
    """How a page becomes listings.

    `of_group` and `of_listing` cut texts and raw attribute values out of the tags of a group and of a listing, inside an
    Arrow task; `date` and `fields` make the event from them once they are plain text. A date needs the texts in `dated`
    only, so the week filter runs before the others are decoded. The group is the whole page where the layout has no groups.
    """

    listing: Match
    of_listing: Callable[[Tags], dict[str, str]]
    dated: tuple[str, ...]
    date: Callable[[Texts], Column]
    fields: Callable[[Texts], Texts]
    of_group: Callable[[Tags], dict[str, str]] = lambda group: {}
    group: Match | None = None
    # Groups that count: others are cut away before listings are looked for.
    group_counts: Callable[[Tags], bool] | None = None
    # A page with groups but without listings is a quiet page, not a broken one.
    quiet_without_listings: bool = False
    # A page whose days mean nothing without its `context_date`: lacking that, the request was broken.
    needs_context: bool = False


def _cut(page: Tags, layout: Layout) -> Iterator[tuple]:
    """Listings of a page as (pos, broken, texts). A group without listings, or a page without groups, keeps one row."""
    groups = [page] if layout.group is None else pages.blocks(page, layout.group)
    if layout.group_counts is not None:
        groups = [g for g in groups if layout.group_counts(g)]
    if not groups:
        yield None, True, {}
    for g, group in enumerate(groups):
        shared = layout.of_group(group)
        listings = pages.blocks(group, layout.listing)
        if not listings:
            yield None, not layout.quiet_without_listings, shared
        for l, listing in enumerate(listings):  # noqa: E741
            yield g * GROUP_STEP + l, False, shared | layout.of_listing(listing)


# Listings that leave an Arrow task together.
BATCH = 10_000
KEYS = ["source", "week_start", "page", "context_date"]


def _opened(payloads: DataFrame, layout: Layout) -> DataFrame:
    """Raw texts of every listing, a page's keys with each."""
    names = [*layout.of_group([]), *layout.of_listing([])]
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    schema = T.StructType([
        *(payloads.schema[c] for c in KEYS), T.StructField("pos", T.LongType()), T.StructField("broken", T.BooleanType()), *texts
    ])

    def batch_of(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        at = pa.array([r[0] for r in rows], pa.int32())
        cut = [pa.array([r[3].get(n) for r in rows], pa.string()) for n in names]
        return pa.RecordBatch.from_arrays(
            [*(batch[c].take(at) for c in KEYS), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_()), *cut],
            names=[*KEYS, "pos", "broken", *names],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, body in enumerate(batch["body"]):
                for found in _cut(pages.tokens(body.as_py()), layout):
                    rows.append((at, *found))
                    if len(rows) == BATCH:
                        yield batch_of(batch, rows)
                        rows = []
            if rows:
                yield batch_of(batch, rows)

    return payloads.select(*KEYS, "body").mapInArrow(run, schema)


def parse(payloads: DataFrame, layout: Layout) -> DataFrame:
    rows = _opened(payloads, layout)
    if layout.needs_context:
        rows = rows.withColumn("broken", F.col("broken") | F.col("context_date").isNull())
    others = [n for n in [*layout.of_group([]), *layout.of_listing([])] if n not in layout.dated]

    # Filters that use a generator's column stay above it: texts are decoded and dates read once, not once per use.
    # Texts are decoded together, so that the plan holds the decoding once per kind.
    def decoded(df: DataFrame, kind: str, names: Sequence[str]) -> tuple[DataFrame, Texts]:
        texts = F.transform(F.array(*names, F.lit("")), markup.unescape)
        return df.select("*", F.explode(F.array(texts)).alias(kind)), {n: F.get(kind, F.lit(i)) for i, n in enumerate(names)}

    rows, named = decoded(rows, "_when", layout.dated)
    rows = rows.select("*", F.explode(F.array(layout.date(named))).alias("_date"))
    rows, rest = decoded(rows, "_texts", others)
    fields = layout.fields(named | rest)
    return parsed(rows, F.col("_date"), fields["title"].isNotNull(), fields)


def _month_day(found: Column, pattern: str, month_group: int) -> tuple[Column, Column]:
    month = clock.month_number(F.regexp_extract(found, pattern, month_group))
    day = F.regexp_extract(found, pattern, month_group + 1).try_cast("int")
    return month, day


def _text(part: Tags, *openings: Match) -> str:
    """Text of an element; of several openings each is looked for inside the one before."""
    for opening in openings:
        part = element(part, opening)
    return words(part)


# One dated link per event, several clock times.
_DATED_TIME, _TIME, _DATED_TITLE = tag("li", "event__detail--time"), tag("time"), tag(cls="event__title")
_TICKETS, _DETAIL, _DESCRIPTION = tag(cls="event__detail--tickets"), tag(cls="event__detail-value"), tag(cls="event__description")
_DATED, _DATED_DAY = tag("a", "event"), tag(cls="event__date")


def _dated_texts(block: Tags) -> dict[str, str]:
    return {
        "day": attribute(block, _DATED_DAY, "datetime"),
        "title": _text(block, _DATED_TITLE),
        "times": SEPARATOR.join([_text(b, _TIME) for b in blocks(block, _DATED_TIME)]),
        "cost": _text(block, _TICKETS, _DETAIL),
        "description": _text(block, _DESCRIPTION),
        "href": attribute(block, _DATED, "href"),
    }


def _dated_fields(t: Texts) -> Texts:
    times = F.transform(F.split(t["times"], SEPARATOR), text.strip)
    return {
        "title": t["title"],
        "venue": F.lit(fixed.VENUE_OF_FORMAT["html_dated"]),
        "time": F.array_join(F.filter(times, lambda x: x != ""), ", "),
        "cost": t["cost"],
        "url": text.first_filled(t["href"], F.lit(fixed.LINKS["html_dated"])),
        "description": t["description"],
    }


DATED = Layout(
    listing=_DATED,
    of_listing=_dated_texts,
    dated=("day",),
    date=lambda t: F.try_to_date(t["day"], "yyyy-MM-dd"),
    fields=_dated_fields,
)

# Month name, day, year and a loosely spaced 12-hour time in one paragraph.
_LINK, _PARAGRAPH = tag("a"), tag("p", "wp-block-paragraph")
_POST_TITLE, _POST_TERMS = tag(cls="wp-block-post-title"), tag(cls="wp-block-post-terms")
# A link without line breaks of any kind.
_MAP_LINK = tag("a", attr=("href", r"[^\n\r\x85\u2028\u2029]*(?:maps\.app\.goo\.gl|google\.com/maps)[^\n\r\x85\u2028\u2029]*"))


def _blocks_texts(block: Tags) -> dict[str, str]:
    return {
        "when": _text(block, _PARAGRAPH),
        "title": _text(block, _POST_TITLE, _LINK),
        "venue": _text(block, _MAP_LINK),
        "term": _text(block, _POST_TERMS, _LINK),
        "href": attribute(element(block, _POST_TITLE), _LINK, "href"),
    }


def _blocks_date(t: Texts) -> Column:
    month, day = _month_day(t["when"], fixed.DATE_AT_TIME, 1)
    return clock.calendar_date(F.regexp_extract(t["when"], fixed.DATE_AT_TIME, 3).try_cast("int"), month, day)


def _blocks_fields(t: Texts) -> Texts:
    hour, minute, half = (F.regexp_extract(t["when"], fixed.DATE_AT_TIME, i) for i in (4, 5, 6))
    late = F.when(F.lower(half) == "pm", 720).otherwise(0)
    minutes = hour.try_cast("int") % 12 * 60 + minute.try_cast("int") + late
    return {
        "title": t["title"],
        "venue": t["venue"],
        "time": text.once(minutes, clock.minutes_clock),
        "cost": F.lit(""),
        "url": text.first_filled(t["href"], F.lit(fixed.LINKS["html_blocks"])),
        "description": t["term"],
    }


BLOCKS = Layout(
    listing=tag("li", "wp-block-post event"),
    of_listing=_blocks_texts,
    dated=("when",),
    date=_blocks_date,
    fields=_blocks_fields,
)

# A date element without a year stands before the listing it dates.
_EVENT_DATE, _EVENT_TITLE = tag(attr=("id", "eventDate")), tag(attr=("id", "eventTitle"))
_VENUE_LINK, _TAGLINE = tag(cls="venueLink"), tag(cls="eventTagLine")
_LIST_TITLE, _LIST_TIME, _LIST_COST = (tag(cls=f"rhp-event__{c}--list") for c in ("title", "time-text", "cost-text"))


def _tagline_texts(block: Tags) -> dict[str, str]:
    return {
        "title": _text(block, _LIST_TITLE),
        "tagline": _text(block, _TAGLINE),
        "venue_text": _text(block, _VENUE_LINK),
        "time": _text(block, _LIST_TIME),
        "cost": _text(block, _LIST_COST),
        "href": attribute(block, _EVENT_TITLE, "href"),
        "venue": attribute(block, _VENUE_LINK, "title"),
    }


def _tagline_date(t: Texts) -> Column:
    month, day = _month_day(t["when"], fixed.WEEKDAY_DATE, 1)
    return clock.nearest_date(month, day, F.col("week_start"))


def _tagline_fields(t: Texts) -> Texts:
    title, tagline = t["title"], t["tagline"]
    both = (title != "") & (tagline != "")
    either = F.nullif(text.first_filled(title, tagline), F.lit(""))
    return {
        "title": F.when(both, F.concat(tagline, F.lit(" | "), title)).otherwise(either),
        "venue": text.first_filled(t["venue"], t["venue_text"]),
        "time": t["time"],
        "cost": t["cost"],
        "url": text.first_filled(t["href"], F.lit(fixed.LINKS["html_tagline"])),
        "description": tagline,
    }


TAGLINE = Layout(
    group=_EVENT_DATE,
    listing=tag("div", "rhp-event__info--list"),
    of_group=lambda group: {"when": _text(group, _EVENT_DATE)},
    of_listing=_tagline_texts,
    dated=("when",),
    date=_tagline_date,
    fields=_tagline_fields,
)

# Long dates whose year may be missing.
_ITEM_TITLE, _ITEM_ACTIONS = tag(cls="em-item-title"), tag(cls="em-item-actions")
_ITEM_DATE, _ITEM_PLACE = tag(cls="em-event-date"), tag(cls="em-event-location")


def _long_texts(block: Tags) -> dict[str, str]:
    return {
        "when": _text(block, _ITEM_DATE),
        "title": _text(block, _ITEM_TITLE, _LINK),
        "venue": _text(block, _ITEM_PLACE, _LINK),
        "actions": _text(block, _ITEM_ACTIONS),
        "href": attribute(element(block, _ITEM_TITLE), _LINK, "href"),
    }


def _long_date(t: Texts) -> Column:
    month, day = _month_day(t["when"], fixed.LONG_DATE, 1)
    year = F.nullif(F.regexp_extract(t["when"], fixed.LONG_DATE, 3), F.lit("")).try_cast("int")
    nearest = clock.nearest_date(month, day, F.col("week_start"))
    return F.when(year.isNotNull(), clock.calendar_date(year, month, day)).otherwise(nearest)


LONG_DATE = Layout(
    listing=tag("div", "em-event em-item"),
    of_listing=_long_texts,
    dated=("when",),
    date=_long_date,
    fields=lambda t: {
        "title": t["title"],
        "venue": t["venue"],
        "time": F.lit(""),
        "cost": F.lit(""),
        "url": t["href"],
        "description": t["actions"],
    },
)

# Two unnamed fields in a row: date with time, then venue.
_FIELD, _ANY_PARAGRAPH, _SHOW_TITLE = tag("p", "showdatevenue"), tag("p"), tag("h3")
_SHOW_PRICE, _BUTTON = tag(cls="showprice"), tag("a", "btn")


def _two_texts(block: Tags) -> dict[str, str]:
    return {
        "pair": SEPARATOR.join([_text(b, _ANY_PARAGRAPH) for b in blocks(block, _FIELD)]),
        "title": _text(block, _SHOW_TITLE),
        "cost": _text(block, _SHOW_PRICE),
        "href": attribute(block, _BUTTON, "href"),
    }


def _two_date(t: Texts) -> Column:
    when = F.split_part(t["pair"], F.lit(SEPARATOR), F.lit(1))
    month, day = _month_day(when, fixed.FULL_DATE, 1)
    year = F.regexp_extract(when, fixed.FULL_DATE, 3).try_cast("int")
    return F.when(F.contains(t["pair"], F.lit(SEPARATOR)), clock.calendar_date(year, month, day))


TWO_FIELDS = Layout(
    listing=tag("div", "showblock"),
    of_listing=_two_texts,
    dated=("pair",),
    date=_two_date,
    fields=lambda t: {
        "title": t["title"],
        "venue": F.split_part(t["pair"], F.lit(SEPARATOR), F.lit(2)),
        "time": F.regexp_extract(F.split_part(t["pair"], F.lit(SEPARATOR), F.lit(1)), fixed.TIME_IN_TEXT, 0),
        "cost": t["cost"],
        "url": text.first_filled(t["href"], F.lit(fixed.LINKS["html_two_fields"])),
        "description": t["title"],
    },
)

# Month grid: a day number per cell, the month from the request; cells of other months are left out.
_DAY, _OTHER_MONTH = tag(cls="day"), tag("td", "notmonth")


def _in_month_day(cell: Tags) -> bool:
    return not _OTHER_MONTH(cell[0]) and re.fullmatch("[0-9]+", _text(cell, _DAY)) is not None


def _grid_texts(block: Tags) -> dict[str, str]:
    ends = next((at for at, (name, _, _) in enumerate(block) if name == "/li"), len(block))
    return {
        "title": _text(block, _LINK),
        "whole": words(block[:ends]),
        "href": attribute(block, _LINK, "href"),
        "link": "a" if any(map(_LINK, block)) else "",
    }


def _grid_date(t: Texts) -> Column:
    context = F.col("context_date")
    return clock.calendar_date(F.year(context), F.month(context), t["day"].try_cast("int"))


def _grid_fields(t: Texts) -> Texts:
    linked = F.concat(F.lit(fixed.LINKS["html_month_grid"]), t["href"])
    return {
        "title": t["title"],
        "venue": F.lit(fixed.VENUE_OF_FORMAT["html_month_grid"]),
        "time": F.regexp_extract(t["whole"], fixed.TIME_AT_START, 1),
        "cost": F.lit(""),
        "url": F.when(t["link"] != "", linked).otherwise(""),
        "description": t["title"],
    }


MONTH_GRID = Layout(
    group=tag("td"),
    group_counts=_in_month_day,
    listing=tag("li", "anEvent"),
    of_group=lambda group: {"day": _text(group, _DAY)},
    of_listing=_grid_texts,
    dated=("day",),
    date=_grid_date,
    fields=_grid_fields,
    quiet_without_listings=True,
    needs_context=True,
)

LAYOUTS = {
    "html_dated": DATED,
    "html_blocks": BLOCKS,
    "html_tagline": TAGLINE,
    "html_long_date": LONG_DATE,
    "html_two_fields": TWO_FIELDS,
    "html_month_grid": MONTH_GRID,
}


def links(of: DataFrame, opening: markup.Match) -> DataFrame:
    """Every listing link of a page: position, href and text."""
    tagged = of.select("page_id", markup.tokens(F.col("html")).alias("tags"))
    found = tagged.select("page_id", F.posexplode(markup.blocks(F.col("tags"), opening)).alias("pos", "block"))
    link = markup.tag("a")
    return found.select(
        "page_id",
        "pos",
        markup.unescape(markup.attribute(F.col("block"), link, "href")).alias("href"),
        markup.unescape(markup.words(markup.element(F.col("block"), link))).alias("label"),
    )


# An index page of cards and one detail page per card with an embedded event description.
_CARD = markup.tag(attr=("data-hook", "events-card"))
_CARD_TITLE = markup.tag(attr=("data-hook", "title"))
_SCRIPT = r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json\b[^>]*>(.*?)</script\s*>"""
_EVENT = (
    "`@type` STRING, name STRING, description STRING, startDate STRING, "
    "location STRUCT<name: STRING, address: STRING>"
)


def json_ld(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """Cards of the index joined to their detail page; cards without a usable detail are left out.

    `details` holds url, body and, where pages are fetched again, fetched_at: the last fetch that brought a body counts, so a
    page fetched again adds no listing and a newer one replaces an older. Of equal times, or without times, the greatest
    body counts. The first embedded block that describes an event counts. Its texts are escaped twice, hence the extra decoding.
    """
    tagged = payloads.withColumn("_tags", markup.tokens(F.col("body")))
    cards = tagged.withColumn("_cards", markup.blocks(F.col("_tags"), _CARD))
    cards = cards.withColumn("broken", F.size("_cards") == 0).select(
        "source", "week_start", "page", "broken", F.posexplode_outer("_cards").alias("pos", "card")
    )
    cards = cards.withColumn("href", markup.unescape(markup.attribute(F.col("card"), _CARD_TITLE, "href")))
    cards = cards.withColumn("label", markup.unescape(markup.words(markup.element(F.col("card"), _CARD_TITLE))))
    found = F.transform(F.regexp_extract_all("body", F.lit(_SCRIPT), F.lit(1)), lambda s: F.from_json(s, _EVENT))
    event = F.get(F.filter(found, lambda e: e["@type"] == "Event"), F.lit(0))
    when = F.col("fetched_at") if "fetched_at" in details.columns else F.lit(None).cast("timestamp")
    last = F.max(F.when(F.col("body").isNotNull(), F.struct(when.alias("at"), F.col("body").alias("body"))))
    fetched = details.groupBy(F.col("url").alias("href")).agg(last.alias("last")).select("href", "last.body")
    described = fetched.select("href", event.alias("e"))
    raw = F.array("e.name", "e.location.name", "e.description")
    # Not salted: there is about one detail page for each card. Adaptive execution splits a page that many cards name.
    rows = cards.join(described, ["href"], "left").withColumn("_plain", F.transform(raw, markup.unescape))
    start = clock.local_part(F.col("e.startDate"))
    name, place, description = (F.get("_plain", F.lit(i)) for i in range(3))
    return parsed(
        rows,
        start.cast("date"),
        F.col("href") != "",
        {
            "title": text.first_filled(name, F.col("label")),
            "venue": F.concat_ws(", ", F.nullif(place, F.lit("")), F.nullif(F.col("e.location.address"), F.lit(""))),
            "time": clock.display_clock(start),
            "cost": F.lit(""),
            "url": F.col("href"),
            "description": description,
        },
    )
