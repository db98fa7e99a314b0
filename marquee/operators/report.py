"""Report tables: mention lines, pick cards, category cards, calendar rows, day pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import category, clock, markup, money, text
from marquee.operators.collection import failure_list
from marquee.operators.lookup import salted_lookup
from marquee.operators.ranking import display_cap

# Listing rows per page of a day document: keeps every array a bounded size.
PAGE_ROWS = 1_000


def display_time(time: Column, note: Column) -> Column:
    """The listed time, 'Various' when there is none, with a plus for several showtimes."""
    shown = text.unwrap_placeholder(time)
    plus = F.when(text.mentions(note, fixed.MULTIPLE_SHOWTIMES), "+").otherwise("")
    unknown = text.is_placeholder(time) | (shown == "")
    return F.when(unknown, fixed.VARIOUS_TIMES).otherwise(F.concat(shown, plus))


def mention_line(mentions: DataFrame) -> DataFrame:
    """One line per day: 'title at venue' joined by middle dots. A day has a few mentions."""
    bold = F.replace(
        markup.escape(F.col("title")), F.lit(fixed.SOLD_OUT_SUFFIX), F.lit("(<strong>SOLD OUT</strong>)")
    )
    part = F.concat(bold, F.lit(" at "), markup.escape(F.col("venue")))
    ordered = F.sort_array(F.collect_list(F.struct("pos", part.alias("part"))))
    return mentions.groupBy("week", "day").agg(
        F.array_join(F.transform(ordered, lambda p: p["part"]), " · ").alias("line")
    )


def with_music_links(picks: DataFrame, lookup: DataFrame) -> DataFrame:
    """Picks with the music link of their title; only music picks get one."""
    found = lookup.where(F.col("spotify_url").isNotNull()).select("title", "spotify_url", "matched_text")
    joined = salted_lookup(picks, found, ["title"], ["week", "day", "rank"])
    music = F.col("is_music")
    return joined.withColumn("spotify_url", F.when(music, F.col("spotify_url"))).withColumn(
        "matched_text", F.when(music, F.col("matched_text"))
    )


def pick_cards(picks: DataFrame, lookup: DataFrame) -> DataFrame:
    """One card per pick: link split into the text before, inside and after it, and 'time · cost'.

    The link wraps the matched part of a music pick, else the whole title.
    """
    rows = with_music_links(picks, lookup)
    at = F.instr(F.col("title"), F.col("matched_text"))
    music = F.coalesce(at > 0, F.lit(False))
    before = F.substr("title", F.lit(1), at - 1)
    after = F.substr(F.col("title"), at + F.char_length("matched_text"))
    shown = display_time(F.col("time"), F.lit(""))
    return rows.select(
        "week",
        "day",
        "rank",
        markup.escape(F.when(music, before).otherwise("")).alias("link_before"),
        markup.escape(F.when(music, F.col("matched_text")).otherwise(F.col("title"))).alias("link_text"),
        markup.escape(F.when(music, after).otherwise("")).alias("link_after"),
        F.when(music, F.col("spotify_url")).otherwise(F.col("url")).alias("link_url"),
        "why",
        "venue",
        F.concat_ws(
            " · ", shown, F.nullif(text.unwrap_placeholder(F.col("cost")), F.lit(""))
        ).alias("time_cost"),
    )


def category_cards(
    listing: DataFrame, picks: DataFrame, mentions: DataFrame, cap: int = fixed.CARDS_PER_CATEGORY
) -> DataFrame:
    """Displayed cards per day and category with link, the category's place and its true count.

    All three inputs are read more than once: hand over tables.
    """
    return display_cap(listing, picks, mentions, cap).select(
        "week",
        "day",
        "category",
        "category_ord",
        "card",
        "id",
        markup.escape(F.col("title")).alias("title"),
        F.col("url").alias("link_url"),
        F.col("is_pick").alias("starred"),
        "note",
        "venue",
        display_time(F.col("time"), F.col("note")).alias("time_display"),
        money.price_class(F.col("cost"), F.col("sold_out")).alias("price_class"),
        money.price_text(F.col("cost"), F.col("sold_out")).alias("price_text"),
        "true_count",
    )


def calendar_rows(picks: DataFrame) -> DataFrame:
    """Calendar entries of picks with a usable start time; the others are left out.

    The end is wall-clock arithmetic: start plus the category's length, then the zone's offset.
    """
    start = clock.wall_start(F.col("day"), F.col("time"))
    end = F.col("_start") + F.make_dt_interval(mins=category.minutes(F.col("category")))
    cost = F.when(
        text.filled(F.col("cost")) & ~text.is_placeholder(F.col("cost")), F.concat(F.lit("Cost: "), "cost")
    )
    return (
        picks.withColumn("_start", start)
        .where(F.col("_start").isNotNull())
        .select(
            "week",
            "day",
            F.col("title").alias("summary"),
            clock.iso_offset(F.col("_start")).alias("start"),
            clock.iso_offset(end).alias("end"),
            F.concat_ws("\n\n", "why", cost, F.nullif(F.col("url"), F.lit(""))).alias("description"),
            F.nullif(F.col("address"), F.lit("")).alias("location"),
        )
    )


def calendar_counts(picks: DataFrame) -> DataFrame:
    """Calendar entries made and picks skipped per week."""
    usable = clock.wall_start(F.col("day"), F.col("time")).isNotNull()
    return picks.groupBy("week").agg(
        F.count_if(usable).alias("created"), F.count_if(~usable).alias("skipped")
    )


def day_pages(picks: DataFrame, mentions: DataFrame, listing: DataFrame) -> DataFrame:
    """The nested selections document: one row per page of a day.

    Page 0 also holds the day's picks and mentions, which are few. The listing of a day has no upper
    size, so it is cut into pages of PAGE_ROWS by `listing_pos`; the pages in order are the whole day.
    """
    pick = F.struct(
        "rank", "title", "venue", "address", "time", "cost", "url", "category", "source",
        "is_music", "sold_out", "why",
    )
    event = F.struct(
        "listing_pos", "title", "venue", "time", "cost", "url", "category", "source", "sold_out", "note"
    )
    page = F.floor(F.col("listing_pos") / PAGE_ROWS).cast("int")
    events = listing.groupBy("week", "day", page.alias("page")).agg(
        F.sort_array(F.collect_list(event)).alias("events")
    )
    top = picks.groupBy("week", "day").agg(F.sort_array(F.collect_list(pick)).alias("top3"))
    also = mentions.groupBy("week", "day").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("pos", "title", "venue"))),
            lambda m: F.struct(m["title"].alias("title"), m["venue"].alias("venue")),
        ).alias("honorable_mentions")
    )
    head = top.join(also, ["week", "day"], "full").withColumn("page", F.lit(0))
    return events.join(head, ["week", "day", "page"], "full").withColumn(
        "day_name", F.date_format(F.try_to_date(F.col("day").cast("string"), "yyyy-MM-dd"), "EEEE")
    )


def week_heads(manifest: DataFrame, events: DataFrame, candidates: DataFrame) -> DataFrame:
    """Heads of the week documents: events before and after the collapse, and the sources that failed.

    A week has few sources, so its failures are an array in name order.
    """
    failed = failure_list(manifest).groupBy("week").agg(F.sort_array(F.collect_list("failure")).alias("collection_failures"))
    raw = events.groupBy("week").agg(F.count(F.lit(1)).alias("raw_event_count"))
    kept = candidates.groupBy("week").agg(F.count(F.lit(1)).alias("total_events_after_dedup"))
    heads = manifest.select("week").distinct().join(raw, ["week"], "left").join(kept, ["week"], "left").join(failed, ["week"], "left")
    return heads.na.fill(0, ["raw_event_count", "total_events_after_dedup"]).withColumn(
        "collection_failures", F.coalesce("collection_failures", F.array().cast("array<string>"))
    )


def week_index(listing: DataFrame) -> DataFrame:
    """Weeks with their label; the report index lists them newest first."""
    monday = F.col("week")
    return listing.select("week").distinct().select(
        "week", clock.range_label(monday, F.date_add(monday, 6)).alias("label")
    ).orderBy(F.col("week").desc())
