"""From listings to numbered candidates: collapse, fold, number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import text
from marquee.operators.collapse import assign_ids, collapse_duplicates, fold_series
from marquee.operators.collection import ok_events

CANDIDATE_COLUMNS = [
    "week", "id", "ord", "title", "venue", "date", "time", "cost", "url", "description", "source",
    "occurrences", "recurrence_count", "listed_date",
]


def whole_candidates(listings: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """Listings of any number of weeks as numbered candidates, descriptions whole.

    Collapse comes first, so a sold-out note can ride on a series' earliest row. Numbering writes the folded rows once.
    """
    return assign_ids(fold_series(collapse_duplicates(listings, priority))).select(*CANDIDATE_COLUMNS)


def shown(candidates: DataFrame, limit: int = fixed.DESCRIPTION_CHARS) -> DataFrame:
    """Candidates as a selection reads them, descriptions capped. Scores come before this."""
    return candidates.withColumn("description", text.cap(F.col("description"), limit))


def build_candidates(listings: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """Numbered candidates with capped descriptions; the cap is the last step."""
    return shown(whole_candidates(listings, priority))


def candidates_of_run(manifest: DataFrame, events: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """Candidates of collected weeks: only sources the manifest calls ok take part."""
    return build_candidates(ok_events(manifest, events), priority)
