"""Cost text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import text


def is_free(cost: Column) -> Column:
    return F.lower(text.unwrap_placeholder(cost)).isin(fixed.FREE_WORDS)


def dollars(cost: Column) -> Column:
    """The first $ amount in a cost text. A thousands comma ends the number, so $1,000 reads as 1."""
    return F.nullif(F.regexp_extract(text.text_or_empty(cost), fixed.DOLLARS, 1), F.lit("")).try_cast("double")


def price_tier(cost: Column, sold_out: Column) -> Column:
    amount = dollars(text.unwrap_placeholder(cost))
    return (
        F.when(F.coalesce(sold_out, F.lit(False)), "paid")
        .when(text.is_placeholder(cost) | (text.unwrap_placeholder(cost) == ""), "")
        .when(is_free(cost), "free")
        .when(amount < fixed.LOW_PRICE_BELOW, "low")
        .when(amount.isNotNull(), "paid")
        .otherwise("free")
    )


def price_class(cost: Column, sold_out: Column) -> Column:
    return (
        F.when(F.coalesce(sold_out, F.lit(False)), "sold-out")
        .when(is_free(cost), "price-free")
        .otherwise("price-paid")
    )


def price_text(cost: Column, sold_out: Column) -> Column:
    return F.when(F.coalesce(sold_out, F.lit(False)), "SOLD OUT").otherwise(text.unwrap_placeholder(cost))


def listed_cost(cost: Column) -> Column:
    return F.coalesce(F.nullif(cost, F.lit("")), F.lit(fixed.COST_NOT_LISTED))


def looks_like_budget(cost: Column) -> Column:
    """A figure in thousands or millions is a budget, not a ticket price."""
    return F.rlike(text.text_or_empty(cost), F.lit(r"(?i)\$\s*\d+(?:\.\d+)?\s*(?:[mk]\b|million|thousand)"))
