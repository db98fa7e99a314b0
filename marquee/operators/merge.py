"""Joining judgement rows (picks, mentions, annotations) back onto candidates by id.

Judgement rows carry ids only; titles, venues, costs and links always come from the candidate.
Rows that do not resolve are left out here and reported by `violations`; the weekly plan refuses to
write while any exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import category, clock, money, text
from marquee.operators.collapse import listed_day
from marquee.operators.numbering import number_by_range

CANDIDATE = ["week", "id", "ord", "title", "venue", "date", "time", "cost", "url", "source", "listed_date"]


def latest_annotations(annotations: DataFrame) -> DataFrame:
    """One annotation per (week, day, id); the last one written wins."""
    row = F.struct("pos", "category", "sold_out", "note")
    return (
        annotations.groupBy("week", "day", "id")
        .agg(F.max(row).alias("a"))
        .select("week", "day", "id", "a.category", "a.sold_out", "a.note")
    )


def resolve(refs: DataFrame, candidates: DataFrame, annotations: DataFrame) -> DataFrame:
    """Judgement rows with their candidate `c` and annotation `a`, both NULL when there is none.

    Judgement rows are few. Candidates and annotations are cut down to the ids they name first: a
    semi join against a small side is a broadcast, so the large tables are scanned but not shuffled.
    """
    named = candidates.withColumn("listed_date", listed_day(candidates)).join(refs.select("week", "id").distinct(), ["week", "id"], "left_semi")
    found = named.select(
        "week", "id", F.struct(*[F.col(c) for c in CANDIDATE if c not in ("week", "id")]).alias("c")
    )
    judged = annotations.join(refs.select("week", "day", "id").distinct(), ["week", "day", "id"], "left_semi")
    noted = latest_annotations(judged).select(
        "week", "day", "id", F.struct("category", "sold_out", "note").alias("a")
    )
    return refs.join(found, ["week", "id"], "left").join(noted, ["week", "day", "id"], "left")


def reference_problem() -> Column:
    """First reason a resolved pick or mention cannot be placed, NULL when it can."""
    return (
        F.when(F.col("c").isNull(), "id matches no candidate")
        .when(~F.col("c.listed_date").eqNullSafe(F.col("day")), "belongs to another day")
        .when(F.col("a").isNull(), "not in the day's annotations")
    )


def missing_field() -> Column:
    """What a pick lacks, NULL when it has all it needs."""
    missing = F.lit(None).cast("string")
    for field in ("rank", "why", "category"):
        missing = F.when(F.col(field).isNull(), f"missing required field {field}").otherwise(missing)
    return missing


def pick_problem() -> Column:
    return F.coalesce(reference_problem(), missing_field())


def merge_picks(picks: DataFrame, candidates: DataFrame, annotations: DataFrame) -> DataFrame:
    """Picks with the candidate's columns. `time` is the pick's own when it states one."""
    return resolve(picks, candidates, annotations).where(pick_problem().isNull()).select(
        "week",
        "day",
        "rank",
        "id",
        F.col("c.title").alias("title"),
        F.col("c.venue").alias("venue"),
        F.nullif(F.col("address"), F.lit("")).alias("address"),
        F.coalesce(F.col("time"), F.col("c.time"), F.lit("")).alias("time"),
        money.listed_cost(F.col("c.cost")).alias("cost"),
        text.text_or_empty(F.col("c.url")).alias("url"),
        "category",
        F.col("c.source").alias("source"),
        F.coalesce("is_music", F.lit(False)).alias("is_music"),
        F.coalesce("sold_out", F.lit(False)).alias("sold_out"),
        "why",
    )


def merge_mentions(mentions: DataFrame, candidates: DataFrame, annotations: DataFrame) -> DataFrame:
    """Mentions with title and venue; a sold-out title says so once."""
    title = F.col("c.title")
    marked = F.concat(title, F.lit(" " + fixed.SOLD_OUT_SUFFIX))
    sold_out = F.coalesce(F.col("a.sold_out"), F.lit(False))
    return resolve(mentions, candidates, annotations).where(reference_problem().isNull()).select(
        "week",
        "day",
        "pos",
        "id",
        F.when(sold_out & ~title.endswith(fixed.SOLD_OUT_SUFFIX), marked).otherwise(title).alias("title"),
        F.col("c.venue").alias("venue"),
        F.col("a.category").alias("category"),
        F.col("c.source").alias("source"),
        money.listed_cost(F.col("c.cost")).alias("cost"),
        sold_out.alias("sold_out"),
    )


def annotated(candidates: DataFrame, annotations: DataFrame) -> DataFrame:
    """Candidates with the annotation of the day they were listed under."""
    return candidates.withColumn("listed_date", listed_day(candidates)).select(*CANDIDATE).join(latest_annotations(annotations), ["week", "id"])


def listing_rows(candidates: DataFrame, annotations: DataFrame) -> DataFrame:
    """Annotated candidates of each day with their sort keys, not yet numbered."""
    rows = annotated(candidates, annotations)
    placed = (F.col("listed_date") == F.col("day")) & category.is_canonical(F.col("category"))
    minute = clock.clock_minutes(F.col("time"))
    return rows.where(placed).select(
        "week",
        "day",
        "id",
        "ord",
        "title",
        "venue",
        F.coalesce("time", F.lit("")).alias("time"),
        money.listed_cost(F.col("cost")).alias("cost"),
        text.text_or_empty(F.col("url")).alias("url"),
        "category",
        "source",
        F.coalesce("sold_out", F.lit(False)).alias("sold_out"),
        F.nullif(F.col("note"), F.lit("")).alias("note"),
        category.display_order(F.col("category")).alias("category_ord"),
        minute.isNull().alias("untimed"),
        F.coalesce(minute, F.lit(0)).alias("minute"),
    )


def merge_events(candidates: DataFrame, annotations: DataFrame) -> DataFrame:
    """The day listing: category order, timed before untimed, by clock, then candidate order.

    `listing_pos` numbers each day from 0 without sorting a whole day in one task.
    """
    return number_by_range(
        listing_rows(candidates, annotations), ["week", "day"], ["category_ord", "untimed", "minute", "ord"], "listing_pos"
    )


def _issues(df: DataFrame, kind: str, problem: Column, severity: Column) -> DataFrame:
    return df.select(
        F.lit("merge").alias("check"),
        severity.alias("severity"),
        "week",
        "day",
        "id",
        F.concat(F.lit(f"{kind}: "), problem).alias("message"),
    ).where(F.col("message").isNotNull())


def violations(
    candidates: DataFrame, annotations: DataFrame, picks: DataFrame, mentions: DataFrame
) -> DataFrame:
    """One issue row per judgement row that cannot be merged.

    An annotation whose id matches no candidate is only a warning: nothing refers to it. Each table is read once: narrow
    rows of all four meet under (week, id), by one exchange, or none where the tables are bucketed by it. A candidate
    tells its day to the other rows of its id, an annotation its presence to those of its day. Rows without an id match
    nothing and are spread.
    """
    none = {"kind": "string", "listed_date": "string", "missing": "string", "pos": "long", "category": "string", "rest": "string"}

    def rows(df: DataFrame, kind: str, **told: Column) -> DataFrame:
        told = {"kind": F.lit(kind), **told}
        columns = (told.get(c, F.lit(None)).cast(t).alias(c) for c, t in none.items())
        day = F.lit(None) if kind == "candidate" else F.col("day")
        return df.select("week", day.cast("string").alias("day"), F.col("id").cast("string").alias("id"), *columns)

    rest = F.to_json(F.struct("sold_out", "note"))
    met = (
        rows(candidates, "candidate", listed_date=listed_day(candidates))
        .unionByName(rows(annotations, "annotation", pos=F.col("pos"), category=F.col("category"), rest=rest))
        .unionByName(rows(picks, "pick", missing=missing_field()))
        .unionByName(rows(mentions, "mention"))
        .withColumn("_alone", F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
    )
    key = ["week", "id", "_alone"]
    is_candidate, is_annotation = F.col("kind") == "candidate", F.col("kind") == "annotation"
    latest = Window.partitionBy(*key, "day", "kind").orderBy(
        F.col("pos").desc_nulls_last(), F.col("category").desc_nulls_last(), F.col("rest").desc_nulls_last()
    )
    seen = (
        met.withColumn("known", F.max(is_candidate).over(Window.partitionBy(*key)))
        .withColumn("c_date", F.max(F.when(is_candidate, F.col("listed_date"))).over(Window.partitionBy(*key)))
        .withColumn("noted", F.max(is_annotation).over(Window.partitionBy(*key, "day")))
        .withColumn("nth", F.row_number().over(latest))
        .where(~is_candidate & (~is_annotation | (F.col("nth") == 1)))
    )
    known = F.col("known") & F.col("id").isNotNull()
    reference = (
        F.when(~known, "id matches no candidate")
        .when(~F.col("c_date").eqNullSafe(F.col("day")), "belongs to another day")
        .when(~F.col("noted"), "not in the day's annotations")
    )
    dated = F.when(known, F.col("c_date"))
    annotation = (
        F.when(F.col("category").isNull(), "missing required field category")
        .when(~category.is_canonical(F.col("category")), "category is not one of the nine")
        .when(dated.isNull(), "id matches no candidate")
        .when(dated != F.col("day"), "belongs to another day")
    )
    problem = F.when(is_annotation, annotation).otherwise(F.coalesce(reference, "missing"))
    unknown = is_annotation & dated.isNull() & category.is_canonical(F.col("category"))
    return seen.select(
        F.lit("merge").alias("check"),
        F.when(unknown, "warn").otherwise("fail").alias("severity"),
        "week",
        "day",
        "id",
        F.concat("kind", F.lit(": "), problem).alias("message"),
    ).where(F.col("message").isNotNull())


def day_violations(days: DataFrame) -> DataFrame:
    """Days without a date or a day name."""
    problem = F.when(F.col("date").isNull(), "missing required field date").when(
        F.col("day_name").isNull(), "missing required field day_name"
    )
    rows = days.withColumn("day", F.col("date")).withColumn("id", F.lit(None).cast("string"))
    return _issues(rows, "day", problem, F.lit("fail"))
