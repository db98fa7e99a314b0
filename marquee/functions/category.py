"""The nine canonical categories as literal lookups; no join needed for nine rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import fixed

LABELS = [label for label, _, _ in fixed.CATEGORIES]


def is_canonical(category: Column) -> Column:
    return F.coalesce(category.isin(LABELS), F.lit(False))


def display_order(category: Column) -> Column:
    """0-based display position; NULL for anything that is not canonical."""
    at = F.array_position(F.array(*[F.lit(x) for x in LABELS]), category)
    return F.nullif(at, F.lit(0)).cast("int") - 1


def slug(category: Column) -> Column:
    """Log slug of a category; other labels stay as they are."""
    out = category
    for label, short, _ in fixed.CATEGORIES:
        out = F.when(category == label, short).otherwise(out)
    return out


def minutes(category: Column) -> Column:
    out = F.lit(fixed.DEFAULT_EVENT_MINUTES)
    for label, _, length in fixed.CATEGORIES:
        out = F.when(category == label, length).otherwise(out)
    return out


def at(index: Column) -> Column:
    """Label at a 0-based position, NULL outside the nine."""
    return F.get(F.array(*[F.lit(x) for x in LABELS]), index)
