"""The weekly run: collect, check, prepare, merge, check, report, log."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import text
from marquee.operators import category_model, collection, merge, picks_log, quality, ranking, report
from marquee.operators.collapse import listed_day
from marquee.operators.numbering import number_rows, position_bucket
from marquee.plans.candidates import shown, whole_candidates
from marquee.session import through_table
from marquee.sources import extract, week_files
from marquee.sources.week_files import reject, replace_weeks

# Category of a listing whose words vote for none.
UNVOTED = fixed.COMMUNITY


@dataclass(frozen=True)
class Selection:
    """Merged tables of one or many weeks."""

    picks: DataFrame
    mentions: DataFrame
    listing: DataFrame


@dataclass(frozen=True)
class Judgement:
    """What was decided about the candidates of one or many weeks."""

    days: DataFrame
    annotations: DataFrame
    picks: DataFrame
    mentions: DataFrame


@dataclass(frozen=True)
class Run:
    """Tables of a weekly run."""

    manifest: DataFrame
    candidates: DataFrame
    judgement: Judgement
    selection: Selection
    heads: DataFrame


def collect(payloads: dict[str, DataFrame], details: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Listings and per-source status of payloads keyed by their format, each written once."""
    parsed = [through_table(extract.parse(df, layout, details), "parsed") for layout, df in payloads.items()]
    listings = reduce(DataFrame.unionByName, [extract.listings(p) for p in parsed])
    return listings, reduce(DataFrame.unionByName, [extract.status(p) for p in parsed])


def manifest_of(status: DataFrame, collected_at: str, notes: DataFrame | None = None) -> DataFrame:
    """Manifest of extraction results; `notes` (week, source, note) come from the fetch log."""
    results = status.withColumnRenamed("week_start", "week").withColumn("collected_at", F.lit(collected_at))
    built = collection.build_manifest(results)
    if notes is None:
        return built.withColumn("note", F.lit(None).cast("string"))
    told = notes.groupBy("week", "source").agg(F.max("note").alias("note"))
    return built.join(told, ["week", "source"], "left")


def arrivals(listings: DataFrame, registry: DataFrame) -> DataFrame:
    """Extracted listings as candidates are built from them: the stem is the source's key, the source its
    display name, and `pos` numbers a source's week by page and place."""
    rows = listings.withColumnsRenamed({"week_start": "week", "source": "stem", "pos": "place"})
    rows = rows.withColumn("page", F.coalesce("page", F.lit(0))).withColumn("_bucket", position_bucket(F.col("place")))
    order = ["place", "title", "venue", "time", "url"]
    numbered = number_rows(rows, ["week", "stem"], ["page", "_bucket"], order, "pos").drop("_bucket", "place", "page")
    names = registry.select(F.col("source").alias("stem"), F.col("name").alias("source"))
    return numbered.join(names, ["stem"], "left")


def judge(
    candidates: DataFrame, categories: DataFrame, interests: DataFrame, aggregators: list[str], unvoted: str = UNVOTED,
    model: DataFrame | None = None,
) -> Judgement:
    """Category, score, picks and mentions of candidates with whole descriptions.

    Categories come from a model that was fitted on annotated listings (`category_model.fit`); without one they are
    voted for by `categories`, which holds term and category. `interests` holds term, interest and tier. Every candidate
    gets an annotation; `why` names the rule that placed a pick.
    """
    rows = candidates.withColumn("_text", F.concat_ws(" ", "title", "description")).withColumn(
        "_key", F.concat_ws("/", F.col("week").cast("string"), "id")
    )
    if model is None:
        votes = ranking.category_vote(rows, categories, "_key", "_text").select("_key", "category")
    else:
        votes = category_model.predict(rows.select("_key", "_text"), model, "_text").select("_key", "category")
    judged = through_table(
        rows.join(votes, ["_key"], "left")
        .withColumn("category", F.coalesce("category", F.lit(unvoted)))
        .withColumn("sold_out", text.mentions(F.col("description"), fixed.SOLD_OUT_PHRASE))
        .withColumn("day", listed_day(candidates))
        .drop("_key", "_text"),
        "judged",
    )
    scored = through_table(ranking.score_candidates(judged, interests, aggregators, fixed.PHRASE_WORDS), "scored")
    placed = ranking.daily_picks(scored).select("week", "id", "place", "kind", "tier", "overlap")
    chosen = through_table(judged.select("week", "day", "id", "category", "sold_out").join(placed, ["week", "id"]), "chosen")
    picks = chosen.where("kind = 'pick'").select(
        "week", "day", F.col("place").alias("rank"), "id", "category", "sold_out",
        F.format_string("interest tier %d, %d interests", "tier", "overlap").alias("why"),
        (F.col("category") == fixed.CATEGORIES[0][0]).alias("is_music"),
        F.lit(None).cast("string").alias("address"), F.lit(None).cast("string").alias("time"),
    )
    mentions = chosen.where("kind = 'mention'").select("week", "day", F.col("place").alias("pos"), "id")
    annotations = judged.select(
        "week", "day", "id", F.lit(0).alias("pos"), "category", "sold_out", F.lit(None).cast("string").alias("note")
    )
    days = collection.calendar(judged).select(
        "week", F.col("date").cast("string").alias("date"), F.date_format("date", "EEEE").alias("day_name")
    )
    return Judgement(days, annotations, picks, mentions)


def run(
    payloads: dict[str, DataFrame], registry: DataFrame, categories: DataFrame, interests: DataFrame, collected_at: str,
    aggregators: list[str] | None = None, details: DataFrame | None = None, notes: DataFrame | None = None,
    priority: list[str] | None = None, annotated: DataFrame | None = None,
) -> Run:
    """From raw payloads to the merged selection of their weeks.

    `annotated` holds listings of earlier weeks (title, description, category), from which categories are learned.
    """
    listings, status = collect(payloads, details)
    manifest = through_table(manifest_of(status, collected_at, notes), "manifest")
    events = collection.ok_events(manifest, through_table(arrivals(listings, registry), "arrivals"))
    whole = through_table(whole_candidates(events, priority), "candidates")
    model = None
    if annotated is not None:
        known = annotated.withColumn("_text", F.concat_ws(" ", "title", "description"))
        model = through_table(category_model.fit(known, "_text", "category"), "model")
    judgement = judge(whole, categories, interests, aggregators or [], model=model)
    candidates = shown(whole)
    selection = merge_selection(candidates, judgement.annotations, judgement.picks, judgement.mentions, judgement.days)
    return Run(manifest, candidates, judgement, selection, report.week_heads(manifest, events, whole))


def collection_issues(
    manifest: DataFrame, files: DataFrame, floors: DataFrame, total_floor: int = fixed.TOTAL_YIELD_FLOOR,
    prior: DataFrame | None = None,
) -> DataFrame:
    """All findings on a collection run. `files` holds week, source, n_events, collected_at."""
    runs = manifest.select("week", "run_started", "run_completed").distinct()
    found = [
        quality.provenance(files, runs),
        quality.yield_floor(manifest, floors, total_floor),
        quality.manifest_agreement(manifest, files),
    ]
    if prior is not None:
        found.append(quality.snapshot_regression(files, prior))
    return reduce(DataFrame.unionByName, found)


def stop_on_failures(issues: DataFrame) -> None:
    reject(issues.where(F.col("severity") == "fail"), "checks failed")


def merge_selection(
    candidates: DataFrame, annotations: DataFrame, picks: DataFrame, mentions: DataFrame, days: DataFrame | None = None
) -> Selection:
    """Merge judgement onto candidates; any row that does not resolve stops the run before a write.

    The merged tables are written once to the shared folder: every report table starts from them.
    """
    found = merge.violations(candidates, annotations, picks, mentions)
    if days is not None:
        found = found.unionByName(merge.day_violations(days))
    stop_on_failures(found)
    return Selection(
        through_table(merge.merge_picks(picks, candidates, annotations), "picks"),
        through_table(merge.merge_mentions(mentions, candidates, annotations), "mentions"),
        through_table(merge.merge_events(candidates, annotations), "listing"),
    )


def write_report(selection: Selection, lookup: DataFrame, path: str) -> None:
    """Report tables by week; re-running a week replaces it."""
    tables = {
        "pages": report.day_pages(selection.picks, selection.mentions, selection.listing),
        "mention_lines": report.mention_line(selection.mentions),
        "pick_cards": report.pick_cards(selection.picks, lookup),
        "category_cards": report.category_cards(selection.listing, selection.picks, selection.mentions),
        "calendar": report.calendar_rows(selection.picks),
    }
    for name, df in tables.items():
        replace_weeks(df, f"{path}/{name}")


def log_selection(selection: Selection, lookup: DataFrame, log: DataFrame, city: str = fixed.CITY) -> DataFrame:
    """The selection's rows that the log does not hold yet. Attendance is updated before this."""
    return picks_log.new_rows(picks_log.log_rows(selection.picks, selection.mentions, lookup, city), log)


def append_log(spark: SparkSession, selection: Selection, lookup: DataFrame, log_path: str, city: str = fixed.CITY) -> tuple[int, int]:
    """Append the selection's new rows to the log table; how many were written and how many it already held."""
    rows = through_table(picks_log.log_rows(selection.picks, selection.mentions, lookup, city), "log_rows")
    new = through_table(picks_log.new_rows_by_digest(rows, week_files.read_log_keys(spark, log_path)), "log_new")
    written = new.count()
    week_files.append_picks_log(new, log_path)
    return written, rows.count() - written


def record_attendance(spark: SparkSession, log_path: str, titles: DataFrame, week_of: str, city: str = fixed.CITY) -> None:
    """Set `attended` in one week of a log table partitioned by week_of; other weeks are not touched.

    The updated week is written aside first, because a table cannot be read and replaced at once.
    """
    week = spark.read.parquet(log_path).where(F.col("week_of").cast("string") == week_of)
    week = week.withColumn("week_of", F.col("week_of").cast("string"))
    updated = through_table(picks_log.update_attendance(week, titles, week_of, city), "attendance")
    updated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week_of").parquet(log_path)
