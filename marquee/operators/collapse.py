"""Exact-duplicate collapse and recurring-series folding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import text
from marquee.operators.numbering import number_by_range

KEY = ["week", "title", "venue", "date"]
SERIES = ["week", "title", "venue"]
CARRIED = ["source", "time", "cost", "url"]


def priority_rank(source: Column, priority: list[str]) -> Column:
    """0-based rank of a source; sources that are not listed share the last rank."""
    at = F.array_position(F.array(*[F.lit(s) for s in priority]), source)
    return F.when(at > 0, at - 1).otherwise(len(priority)).cast("int")


def completeness(*cols: Column) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + text.filled(c).cast("int")
    return total


def listed_day(rows: DataFrame) -> Column:
    """The day a row is listed under: `listed_date` where the rows have it, else `date`."""
    date = F.col("date").cast("string")
    return F.coalesce(F.col("listed_date").cast("string"), date) if "listed_date" in rows.columns else date


def collapse_duplicates(listings: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """One row per (week, title, venue, date).

    Kept is the best source, then the fullest row, then the first arrival (stem, pos). When only
    discarded copies say "sold out", the kept description gets a note. The row takes the arrival
    position of the first copy and the latest `listed_date` of the copies (without that column: its
    date). Descriptions leave whole.

    It is one grouped `min` over structs, so copies shrink before the shuffle: a group that holds a
    third of all rows reaches the reducers as one row per map task.
    """
    priority = fixed.SOURCE_PRIORITY if priority is None else priority
    body = text.text_or_empty(F.col("description"))
    rows = listings.select(
        *[text.text_or_empty(F.col(c)).alias(c) if c != "week" else F.col(c) for c in KEY],
        F.struct(
            priority_rank(F.col("source"), priority).alias("rank"),
            (-completeness(*[F.col(c) for c in ("time", "cost", "url", "description")])).alias("gaps"),
            "stem",
            "pos",
            *CARRIED,
            body.alias("body"),
            text.mentions(F.col("description"), fixed.SOLD_OUT_PHRASE).alias("sold_out"),
        ).alias("row"),
        listed_day(listings).alias("listed_date"),
    )
    best = rows.groupBy(*KEY).agg(
        F.min("row").alias("best"),
        F.max(F.col("row.sold_out")).alias("any_sold_out"),
        F.min(F.struct("row.stem", "row.pos")).alias("first"),
        F.max("listed_date").alias("listed_date"),
    )
    kept = F.col("best")
    noted = F.col("any_sold_out") & ~kept["sold_out"]
    noted_text = text.rstrip(F.concat(F.lit(fixed.SOLD_OUT_NOTE), kept["body"]))
    return best.select(
        *KEY,
        F.col("first.stem").alias("stem"),
        F.col("first.pos").alias("pos"),
        *[kept[c].alias(c) for c in CARRIED],
        F.when(noted, noted_text).otherwise(kept["body"]).alias("description"),
        "listed_date",
        noted.alias("sold_out_noted"),
    )


def fold_series(collapsed: DataFrame) -> DataFrame:
    """Fold a (title, venue) that runs on three or more dates of a week into its earliest row.

    The row gains `occurrences` and `recurrence_count`; rows of shorter runs pass through. Input must
    be collapsed: then a series has one row per date, so its window holds at most a week of rows.
    """
    by_date = Window.partitionBy(*SERIES).orderBy("date", "stem", "pos")
    # The same order for all three, so that one sort serves them.
    whole = by_date.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = collapsed.withColumns({
        "_dates": F.sort_array(F.collect_set("date").over(whole)),
        "_first": F.min(F.struct("stem", "pos")).over(whole),
        "_nth": F.row_number().over(by_date),
    })
    recurring = F.size("_dates") >= fixed.RECURRING_DATES
    return (
        rows.where(~recurring | (F.col("_nth") == 1))
        .withColumn("occurrences", F.when(recurring, F.col("_dates")))
        .withColumn("recurrence_count", F.when(recurring, F.size("_dates")))
        .withColumn("series_stem", F.col("_first.stem"))
        .withColumn("series_pos", F.col("_first.pos"))
        .drop("_dates", "_first", "_nth")
    )


def assign_ids(folded: DataFrame) -> DataFrame:
    """Number candidates c0000, c0001, ... per week: series by first arrival, then rows by arrival."""
    numbered = number_by_range(folded, ["week"], ["series_stem", "series_pos", "stem", "pos"], "ord")
    return numbered.withColumn("id", F.format_string("c%04d", F.col("ord")))
