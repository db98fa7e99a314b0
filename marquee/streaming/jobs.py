"""Streams over the append-only inputs: usage log, picks log, payload files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators import collapse, usage
from marquee.operators.picks_log import new_rows
from marquee.sources import extract
from marquee.streaming import sink

MESSAGE = ["session", "agent", "message_id"]


def usage_stream(lines: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Usage readings into a table that keeps the last reading per message and batch.

    Later batches may hold later readings of a message; `usage_readings` settles them by line number.
    No state is kept between batches, so late readings never get lost.
    """

    def last(batch: DataFrame, batch_id: int) -> DataFrame:
        return batch.groupBy(*MESSAGE).agg(
            *[F.max_by(f, "line_no").alias(f) for f in usage.FIELDS], F.max("line_no").alias("line_no")
        )

    return sink.run(lines, path, checkpoint, last, every)


def usage_readings(table: DataFrame) -> DataFrame:
    """One reading per message from the streamed table."""
    return usage.latest_readings(table)


def drop_copies(lines: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Readings whose copies are identical, the first one kept; state lives as long as the delay."""
    return lines.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(MESSAGE)


def log_stream(rows: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Log rows appended unless an earlier batch holds their key; a repeated batch gives the same rows.

    The log is read only between the batch's first and last week, which Parquet's statistics prune:
    earlier batches hold earlier weeks.
    """

    def new(batch: DataFrame, batch_id: int) -> DataFrame:
        span = batch.agg(F.min("week_of").alias("first"), F.max("week_of").alias("last")).head()
        held = sink.read(batch.sparkSession, path, before=batch_id)
        return new_rows(batch, held.where(F.col("week_of").between(span["first"], span["last"])))

    return sink.run(rows, path, checkpoint, new, every)


def payload_stream(payloads: DataFrame, layout: str, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """New payload files parsed once each; the checkpoint remembers which files are done."""
    def listed(batch: DataFrame, batch_id: int) -> DataFrame:
        return extract.listings(extract.parse(batch, layout))

    return sink.run(payloads, path, checkpoint, listed, every)


def collapse_stream(
    listings: DataFrame, path: str, checkpoint: str, priority: list[str] | None = None, late: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Listings collapsed as they arrive, one row per (week, title, venue, date).

    What the copies of a key have told so far is the state of a streaming aggregation, so a batch reads its own rows and
    not the ones before, and a copy that comes late or again changes the key's row as it would have in one run. A batch
    writes the rows it changed; `collapsed` settles them. Without `late` the state keeps all weeks; with it (such as
    "21 days") a week's state goes when a week that much later has been seen, and its later copies are left out.
    """
    if late:
        listings = listings.withColumn("week", F.col("week").cast("timestamp")).withWatermark("week", late)
    kept = collapse.collapse_duplicates(listings, priority)
    return sink.run(kept, path, checkpoint, lambda batch, _: batch.withColumn("week", F.col("week").cast("date")), every, "update")


def collapsed(table: DataFrame) -> DataFrame:
    """The last row of each key from the streamed table."""
    rest = [c for c in table.columns if c not in ("batch", *collapse.KEY)]
    last = table.groupBy(*collapse.KEY).agg(F.max_by(F.struct(*rest), "batch").alias("row"))
    return last.select(*collapse.KEY, "row.*")
