"""Matching mentions to listings by title, and titles to a name catalogue."""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from marquee import fixed
from marquee.functions import text
from marquee.operators.lookup import salted_lookup


@F.pandas_udf(DoubleType())
def title_ratio(wanted: pd.Series, listed: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; 0 where its cheap upper bounds already rule a match out."""
    out = []
    for a, b in zip(wanted, listed, strict=True):
        m = difflib.SequenceMatcher(None, a, b)
        possible = m.real_quick_ratio() >= fixed.FUZZY_RATIO and m.quick_ratio() >= fixed.FUZZY_RATIO
        out.append(m.ratio() if possible else 0.0)
    return pd.Series(out, dtype="float64")


def edit_ratio(a: Column, b: Column) -> Column:
    """One minus the edits between two titles as a share of the longer one."""
    return 1.0 - F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b), F.lit(1)).cast("double")


def _comparable(title: Column) -> Column:
    """A title in lower case without the sold-out suffix that a mention may carry."""
    return F.lower(text.rstrip(F.regexp_replace(title, re.escape(fixed.SOLD_OUT_SUFFIX) + r"\s*\z", "")))


def _long_enough(a: Column, b: Column) -> Column:
    """Titles whose lengths alone allow the required ratio by either measure."""
    shorter = F.least(F.char_length(a), F.char_length(b))
    return 2.0 * shorter >= fixed.FUZZY_RATIO * (F.char_length(a) + F.char_length(b))


def match_mentions(
    mentions: DataFrame,
    listing: DataFrame,
    day: list[str],
    carry: list[str],
    similarity: Callable[[Column, Column], Column] = edit_ratio,
    comparable: Callable[[Column], Column] = _comparable,
    salts: int | None = None,
) -> DataFrame:
    """Each mention with the listing row of its day: same title first, else the most similar title.

    Equal titles score equally and the first one listed wins, so a day's listing shrinks to its
    distinct titles before any comparison. Only mentions without an exact hit are compared, and a day
    has a few mentions, so the work grows with the listing, not with its square; a day's titles are
    spread over `salts` tasks. `title_ratio` is the other measure: it weighs common runs, in Python.
    """
    first = F.min(F.struct("pos", *carry)).alias("hit")
    titles = listing.groupBy(*day, "title").agg(first)
    exact = mentions.join(titles, [*day, "title"], "left")
    open_rows = exact.where(F.col("hit").isNull()).drop("hit")
    wanted, listed = comparable(F.col("title")), comparable(F.col("listed_title"))
    pairs = (
        salted_lookup(titles.withColumnRenamed("title", "listed_title"), open_rows, day, ["listed_title"], "inner", salts)
        .where(_long_enough(wanted, listed))
        .withColumn("score", similarity(wanted, listed))
        .where(F.col("score") >= fixed.FUZZY_RATIO)
    )
    keys = [c for c in mentions.columns]
    best = F.max(F.struct("score", (-F.col("hit.pos")).alias("earlier"), "hit")).alias("b")
    close = pairs.groupBy(*keys).agg(best).select(*keys, F.col("b.hit").alias("hit"), F.col("b.score").alias("score"))
    fuzzy = open_rows.join(close, keys, "left")
    whole = exact.where(F.col("hit").isNotNull()).withColumn("score", F.lit(1.0))
    return whole.unionByName(fuzzy).select(*keys, *[F.col(f"hit.{c}").alias(f"hit_{c}") for c in carry], "score")


def lookup_names(titles: DataFrame, catalogue: DataFrame) -> DataFrame:
    """For each distinct title the first headliner name the catalogue knows, and its url.

    `catalogue` holds name, url and rank; the best-ranked entry of a name wins. Titles and names are
    made distinct first; a name that many titles share is salted.
    """
    wanted = titles.select("title").distinct()
    names = wanted.select("title", F.posexplode(text.headliner_names(F.col("title"))).alias("nth", "name"))
    names = names.withColumn("key", F.lower("name"))
    known = (
        catalogue.groupBy(F.lower(text.strip(F.col("name"))).alias("key"))
        .agg(F.min(F.struct("rank", "url")).alias("k"))
        .select("key", F.col("k.url").alias("spotify_url"))
    )
    hits = salted_lookup(names, known, ["key"], ["title"], "inner")
    best = hits.groupBy("title").agg(F.min(F.struct("nth", "spotify_url", "name")).alias("b"))
    return wanted.join(best, ["title"], "left").select(
        "title", "b.spotify_url", F.col("b.name").alias("matched_text")
    )
