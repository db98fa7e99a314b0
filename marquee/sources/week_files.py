"""Week folders as tables: reading their JSON, CSV and JSON-lines documents, writing the results.

Spark skips files whose name starts with an underscore, so the documents are expected under plain
names (`manifest.json`, not `_manifest.json`).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import fixed, schemas
from marquee.functions import text
from marquee.operators import picks_log
from marquee.operators.collapse import listed_day
from marquee.operators.collection import day_split, out_of_window
from marquee.session import work_path

DERIVED = [name.lstrip("_") for name in fixed.DERIVED_FILES]


class MissingInput(FileNotFoundError):
    """A document the next step cannot do without is not there."""


class RowsRejected(ValueError):
    """Rows that must not be written; the message names the first of them."""


def _absent(exc: AnalysisException) -> bool:
    return exc.getCondition() == "PATH_NOT_FOUND"


def read_or_empty(spark: SparkSession, path: str, schema: str, **options: object) -> DataFrame:
    """A JSON document that may not exist yet: no file, no rows."""
    try:
        return spark.read.schema(schema).options(multiLine=True, **options).json(path)
    except AnalysisException as exc:
        if _absent(exc):
            return spark.createDataFrame([], schema)
        raise


def read_required(spark: SparkSession, path: str, schema: str, made_by: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as exc:
        if _absent(exc):
            raise MissingInput(f"{path} does not exist; run {made_by} first") from exc
        raise


# Collection ----------------------------------------------------------------------------------


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows; a path may name many weeks, e.g. weeks/*/manifest.json."""
    documents = read_required(spark, path, schemas.MANIFEST, "the collection")
    return documents.select(
        F.to_date("week").alias("week"), "run_started", "run_completed", F.explode("sources").alias("source", "s")
    ).select("week", "run_started", "run_completed", "source", "s.status", "s.events", "s.reason", "s.note")


def read_expected_yield(spark: SparkSession, path: str) -> DataFrame:
    documents = read_required(spark, path, schemas.EXPECTED_YIELD, "the yield baseline")
    return documents.select(
        F.col("_meta.total_floor").alias("total_floor"), F.explode("sources").alias("source", "s")
    ).select("source", F.coalesce("s.min_expected", F.lit(0)).alias("min_expected"), "total_floor")


def read_source_files(spark: SparkSession, path: str) -> DataFrame:
    """Source files of one or many week folders; the folder name is the week, the file stem the source.

    Derived documents that share the folder are left out; sub-folders are not entered.
    """
    files = spark.read.schema(schemas.SOURCE_FILE).option("multiLine", True).json(path)
    name = F.col("_metadata.file_name")
    folder = F.regexp_extract("_metadata.file_path", r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return files.where(~name.isin(DERIVED)).select(
        F.to_date(F.nullif(folder, F.lit(""))).alias("week"),
        F.regexp_replace(name, r"\.json$", "").alias("stem"),
        "source",
        "status",
        "reason",
        "collected_at",
        "events",
    )


def write_source_files(files: DataFrame, path: str) -> None:
    """Source files (week, stem and the columns of a file) as JSON folders by week and stem; whole weeks are replaced."""
    files.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week", "stem").json(path)


def read_written_source_files(spark: SparkSession, path: str) -> DataFrame:
    """What `write_source_files` wrote, as `read_source_files` gives hand-kept folders."""
    columns = ["week", "stem", "source", "status", "reason", "collected_at", "events"]
    return spark.read.schema(f"week DATE, stem STRING, {schemas.SOURCE_FILE}").json(path).select(*columns)


def source_counts(files: DataFrame) -> DataFrame:
    """Events per source file, as the checks compare them with the manifest."""
    return files.select(
        "week", F.col("stem").alias("source"), F.coalesce(F.size("events"), F.lit(0)).cast("long").alias("n_events"), "collected_at"
    )


def source_events(files: DataFrame) -> DataFrame:
    """Events of source files in file order; missing fields read as empty texts."""
    rows = files.select("week", "stem", "source", F.posexplode("events").alias("pos", "e"))
    fields = [text.text_or_empty(F.col(f"e.{c}")).alias(c) for c in schemas.EVENT_FIELDS]
    return rows.select("week", "stem", "source", F.col("pos").cast("long").alias("pos"), *fields)


def write_source_results(status: DataFrame, listings: DataFrame, path: str) -> None:
    """Extraction results per week: a status table and a listing table, whole weeks replaced."""
    replace_weeks(status.withColumnRenamed("week_start", "week"), f"{path}/status")
    replace_weeks(listings.withColumnRenamed("week_start", "week"), f"{path}/listings")


def manifest_documents(manifest: DataFrame) -> DataFrame:
    """One manifest document per week, sources in name order, with their notes. A week has as many entries as sources."""
    note = F.col("note") if "note" in manifest.columns else F.lit(None).cast("string")
    entry = F.struct("source", F.struct("status", "events", "reason", note.alias("note")).alias("entry"))
    return manifest.groupBy("week").agg(
        F.min("first_collected").alias("run_started"),
        F.max("last_collected").alias("run_completed"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("sources"),
    )


def expected_yield_document(floors: DataFrame, total_floor: int) -> DataFrame:
    """The yield baseline as one document; it has as many entries as there are sources."""
    entry = F.struct("source", F.struct(F.col("min_expected").cast("long").alias("min_expected"), F.lit(None).cast("string").alias("note")))
    return floors.agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("sources")).select(
        F.struct(F.lit(total_floor).cast("long").alias("total_floor")).alias("_meta"), "sources"
    )


# Selection -----------------------------------------------------------------------------------


def read_annotations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Judgement documents as (days, annotations, picks, mentions)."""
    documents = read_required(spark, path, schemas.ANNOTATIONS, "the selection")
    days = documents.select(F.to_date("week").alias("week"), F.explode("days").alias("d"))
    base = ["week", F.col("d.date").alias("day")]
    annotations = days.select(*base, F.posexplode("d.annotations").alias("pos", "a")).select("week", "day", "pos", "a.*")
    picks = days.select(*base, F.explode("d.top3").alias("p")).select("week", "day", "p.*")
    mentions = days.select(*base, F.posexplode("d.honorable_mentions").alias("pos", "m")).select("week", "day", "pos", "m.id")
    return days.select("week", "d.date", "d.day_name"), annotations, picks, mentions


def read_music_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Lookup results by title, titles without a hit included; no file yet means no rows."""
    try:
        documents = spark.read.text(path, wholetext=True)
    except AnalysisException as exc:
        if _absent(exc):
            return spark.createDataFrame([], "title STRING, spotify_url STRING, matched_text STRING")
        raise
    rows = documents.select(F.explode(F.from_json("value", schemas.MUSIC_LOOKUP)).alias("title", "hit"))
    return rows.select("title", "hit.spotify_url", "hit.matched_text")


def reject(rows: DataFrame, what: str) -> None:
    """Stop when there is any row; all go to a table that the message names beside the first five."""
    if rows.isEmpty():
        return
    path = work_path(rows.sparkSession, "refused")
    rows.write.parquet(path)
    first = rows.sparkSession.read.parquet(path).limit(5).collect()
    raise RowsRejected(f"{what}: " + "; ".join(str(r.asDict()) for r in first) + f"; all of them in {path}")


def write_day_split(candidates: DataFrame, path: str) -> None:
    """Candidates by week and day, with an index that holds all seven days of each week.

    A candidate outside its week would be lost to every reader of a day, so it stops the write.
    """
    reject(out_of_window(candidates).select("week", "id", "title", "date"), "candidates outside their week")
    replace_weeks(candidates.withColumn("day", listed_day(candidates)), f"{path}/candidates", "day")
    replace_weeks(day_split(candidates), f"{path}/days")


def replace_weeks(df: DataFrame, path: str, *deeper: str) -> None:
    """Replace the partitions present in `df`; other weeks stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week", *deeper).parquet(path)


# Logs ----------------------------------------------------------------------------------------


def read_picks_log(spark: SparkSession, path: str) -> DataFrame:
    """The log table, partitioned by `week_of`; a log that does not exist yet is empty."""
    try:
        return spark.read.schema(schemas.PICKS_LOG).parquet(path).select(*fixed.PICKS_LOG_COLUMNS)
    except AnalysisException as exc:
        if _absent(exc):
            return spark.createDataFrame([], schemas.PICKS_LOG)
        raise


def append_picks_log(rows: DataFrame, path: str) -> None:
    """Rows into the log, and the digests of their keys into its side table, both by week."""
    rows.select(*fixed.PICKS_LOG_COLUMNS).write.mode("append").partitionBy("week_of").parquet(path)
    keys = picks_log.with_digests(rows).select("week_of", "key_a", "key_b")
    keys.write.mode("append").partitionBy("week_of").parquet(_keys_path(path))


def _keys_path(path: str) -> str:
    return f"{path.rstrip('/')}-keys"


def read_log_keys(spark: SparkSession, path: str) -> DataFrame:
    """Key digests of a log: week_of, key_a, key_b.

    They come from the side table. A week whose side table has not as many rows as the log, as after a run that broke off
    between the two, is read from the log; the row counts come without reading a column.
    """
    log = read_picks_log(spark, path)
    columns = ["week_of", "key_a", "key_b"]
    try:
        keys = spark.read.schema("key_a LONG, key_b LONG, week_of STRING").parquet(_keys_path(path)).select(*columns)
    except AnalysisException as exc:
        if not _absent(exc):
            raise
        return picks_log.with_digests(log).select(*columns)
    counted = [df.groupBy("week_of").agg(F.count(F.lit(1)).alias(n)) for df, n in ((log, "in_log"), (keys, "in_keys"))]
    wrong = counted[0].join(counted[1], "week_of", "full").where(~F.col("in_log").eqNullSafe(F.col("in_keys")))
    weeks = [r["week_of"] for r in wrong.select("week_of").collect()]  # at most a row for each week of the log
    if not weeks:
        return keys
    again = picks_log.with_digests(log.where(F.col("week_of").isin(weeks))).select(*columns)
    return keys.where(~F.col("week_of").isin(weeks)).unionByName(again)


def import_picks_log(spark: SparkSession, path: str) -> DataFrame:
    """A log kept as CSV; an empty cell is an empty text."""
    return spark.read.schema(schemas.PICKS_LOG).options(header=True, escape='"').csv(path).na.fill("")


def export_picks_log(log: DataFrame, path: str) -> None:
    log.select(*fixed.PICKS_LOG_COLUMNS).write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)


def usage_lines(lines: DataFrame) -> DataFrame:
    """Usage readings of raw log lines (session, agent, line_no, value); other lines are skipped."""
    rows = lines.withColumn("j", F.from_json("value", schemas.USAGE_LINE)).where(
        (F.col("j.type") == "assistant") & F.col("j.message.id").isNotNull() & F.col("j.message.usage").isNotNull()
    )
    return rows.select("session", "agent", F.col("j.message.id").alias("message_id"), "line_no", "j.message.usage.*")


def read_usage_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines logs: <session>.jsonl and <session>/subagents/<agent>.jsonl.

    A line's number is its file split's start and its order inside the split, which is file order.
    """
    file = F.col("_metadata.file_path")
    sub = F.regexp_extract(file, r"([^/]+)/subagents/[^/]+\.jsonl$", 1)
    stem = F.regexp_extract(file, r"([^/]+)\.jsonl$", 1)
    lines = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter="*.jsonl").select(
        F.when(sub != "", sub).otherwise(stem).alias("session"),
        F.when(sub != "", stem).otherwise("").alias("agent"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("nth")).alias("line_no"),
        "value",
    )
    return usage_lines(lines)
