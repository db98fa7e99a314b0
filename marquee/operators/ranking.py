"""Interest tags, category votes, daily picks and per-category caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee import fixed
from marquee.functions import category, money, phrases, text
from marquee.operators.collapse import listed_day
from marquee.operators.lookup import salted_lookup


# Tier of a candidate that touches no interest, and the mark of one without a link.
UNTOUCHED_TIER = 4
UNCONFIRMED = "*(confirm details)*"


def interest_lexicon(spark: SparkSession) -> DataFrame:
    rows = [(term, name, tier) for name, tier, terms in fixed.INTERESTS for term in terms]
    return spark.createDataFrame(rows, "term STRING, interest STRING, tier INT")


def tokens(body: Column) -> Column:
    """Lower-cased words of a text: runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text.text_or_empty(body)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def terms_of(body: Column, longest: int = 1) -> Column:
    """Distinct phrases of up to `longest` neighbouring words of a text, joined by one space."""

    def phrases(words: Column) -> Column:
        out = words
        run = words
        for n in range(1, longest):
            later = F.slice(words, n + 1, F.greatest(F.size(words) - n, F.lit(0)))
            run = F.zip_with(F.slice(run, 1, F.size(later)), later, lambda a, b: F.concat_ws(" ", a, b))
            out = F.concat(out, run)
        return F.array_distinct(out)

    return text.once(tokens(body), phrases)


def _found(words: DataFrame, terms: DataFrame, few: bool, key: str) -> DataFrame:
    """The words that a lexicon has: few terms are broadcast, so words meet them where they are, many are salted."""
    return words.join(F.broadcast(terms), "term") if few else salted_lookup(words, terms, ["term"], [key], "inner")


def interest_tags(
    docs: DataFrame, lexicon: DataFrame, key: str, body: str, longest: int = 1, most: int = phrases.MOST_TERMS
) -> DataFrame:
    """Interests whose words occur in a text, and how many of them; texts without any are left out.

    The distinct phrases of the texts meet a lexicon of at most `most` rows where they are, so only hits are shuffled. A
    larger one is joined by term, common terms salted.
    """
    words = docs.select(key, F.explode(terms_of(F.col(body), longest)).alias("term"))
    terms = lexicon.groupBy("term").agg(F.collect_set("interest").alias("interests"))
    hits = _found(words, terms, phrases.fits(lexicon, most), key)
    return (
        hits.select(key, F.explode("interests").alias("interest"))
        .groupBy(key)
        .agg(F.sort_array(F.collect_set("interest")).alias("interests"))
        .withColumn("overlap", F.size("interests"))
    )


def category_vote(docs: DataFrame, lexicon: DataFrame, key: str, body: str, most: int = phrases.MOST_TERMS) -> DataFrame:
    """The category with the most word hits in a text; the earlier category wins a tie.

    A lexicon of at most `most` rows is broadcast, so words meet it where they are and only the counts of a text's
    categories are shuffled. A larger one is joined by term, common terms salted.
    """
    words = docs.select(key, F.explode(tokens(F.col(body))).alias("term"))
    terms = lexicon.groupBy("term").agg(F.collect_set("category").alias("categories"))
    hits = _found(words, terms, phrases.fits(lexicon, most), key)
    votes = hits.select(key, F.explode("categories").alias("category")).groupBy(key, "category").agg(F.count(F.lit(1)).alias("votes"))
    best = F.max(F.struct("votes", (-category.display_order(F.col("category"))).alias("_o"), "category"))
    return votes.groupBy(key).agg(best.alias("b")).select(key, "b.category", "b.votes")


def is_elevated(venue: Column) -> Column:
    return F.split_part(text.text_or_empty(venue), F.lit(","), F.lit(1)).isin(fixed.ELEVATED_VENUES)


def interest_tiers(
    docs: DataFrame, lexicon: DataFrame, key: str, body: str, longest: int = 1, most: int = phrases.MOST_TERMS
) -> DataFrame:
    """Best interest tier of a text and how many interests it touches; texts that touch none are left out.

    Phrases meet the lexicon as in `interest_tags`.
    """
    words = docs.select(key, F.explode(terms_of(F.col(body), longest)).alias("term"))
    terms = lexicon.groupBy("term").agg(F.min("tier").alias("tier"), F.collect_set("interest").alias("interests"))
    hits = _found(words, terms, phrases.fits(lexicon, most), key)
    return hits.groupBy(key).agg(
        F.min("tier").alias("tier"), F.size(F.array_distinct(F.flatten(F.collect_set("interests")))).alias("overlap")
    )


def category_lexicon(spark: SparkSession) -> DataFrame:
    rows = [(term, name) for name, terms in fixed.CATEGORY_TERMS for term in terms]
    return spark.createDataFrame(rows, "term STRING, category STRING")


def score_candidates(candidates: DataFrame, lexicon: DataFrame, aggregators: list[str], longest: int = 1) -> DataFrame:
    """Candidates with the sort keys of `daily_picks`, one column per rule.

    Easy to miss is what no aggregator carries. A listing without a link stays and is marked as
    unconfirmed. Nothing is summed: the rules only order.
    """
    body = F.concat_ws(" ", "title", "description")
    rows = candidates.withColumn("_text", body).withColumn("_key", F.concat_ws("/", F.col("week").cast("string"), "id"))
    tiers = interest_tiers(rows, lexicon, "_key", "_text", longest)
    return rows.join(tiers, ["_key"], "left").select(
        "week",
        listed_day(candidates).alias("day"),
        "id",
        "ord",
        text.venue_key(F.lit(""), F.col("venue")).alias("venue_key"),
        F.coalesce("tier", F.lit(UNTOUCHED_TIER)).alias("tier"),
        (~F.col("source").isin(aggregators)).alias("easy_to_miss"),
        F.coalesce(F.col("category") == fixed.COMMUNITY, F.lit(False)).alias("community"),
        F.coalesce("overlap", F.lit(0)).alias("overlap"),
        money.is_free(F.col("cost")).alias("free"),
        F.col("recurrence_count").isNotNull().alias("recurring"),
        is_elevated(F.col("venue")).alias("elevated"),
        F.when(~text.filled(F.col("url")), UNCONFIRMED).alias("unconfirmed"),
    )


def precedence() -> list[Column]:
    """Interest tier, then easy to miss, community, overlap, free, one-off, elevated venue, arrival."""
    return [
        F.col("tier").asc_nulls_last(),
        F.col("easy_to_miss").desc(),
        F.col("community").desc(),
        F.col("overlap").desc(),
        F.col("free").desc(),
        F.col("recurring").asc(),
        F.col("elevated").desc(),
        F.col("ord").asc(),
    ]


def daily_picks(
    scored: DataFrame,
    venue_cap: int = fixed.VENUE_PICKS_PER_WEEK,
    picks: int = fixed.PICKS_PER_DAY,
    mentions: int = fixed.MENTIONS_PER_DAY,
) -> DataFrame:
    """Top rows per day after each venue was held to its weekly cap.

    Both windows keep only `row_number <= k`, so every map task drops all but k rows per group
    before the shuffle. A day whose venues are used up may get fewer rows. Rows without a venue share
    none: each is a group of its own.
    """
    blank = F.coalesce(F.trim("venue_key"), F.lit("")) == ""
    alone = [F.when(blank, F.col(c)) for c in ("day", "ord")]
    by_venue = Window.partitionBy("week", "venue_key", *alone).orderBy(*precedence())
    by_day = Window.partitionBy("week", "day").orderBy(*precedence())
    capped = (
        scored.withColumn("_nth", F.row_number().over(by_venue)).where(F.col("_nth") <= venue_cap).drop("_nth")
    )
    ranked = capped.withColumn("place", F.row_number().over(by_day)).where(F.col("place") <= picks + mentions)
    return ranked.withColumn("kind", F.when(F.col("place") <= picks, "pick").otherwise("mention"))


def flag_chosen(listing: DataFrame, picks: DataFrame, mentions: DataFrame) -> DataFrame:
    """Listing rows with `is_pick` (by title within the day) and `is_mention` (by id).

    Picks are few per day, so they are repeated over the salts of a title that many rows share.
    """
    titles = picks.select("week", "day", "title").distinct().withColumn("_pick", F.lit(True))
    ids = mentions.select("week", "day", "id").distinct().withColumn("_mention", F.lit(True))
    flagged = salted_lookup(listing, titles, ["week", "day", "title"], ["id"])
    return (
        flagged.join(ids, ["week", "day", "id"], "left")
        .withColumn("is_pick", F.coalesce("_pick", F.lit(False)))
        .withColumn("is_mention", F.coalesce("_mention", F.lit(False)))
        .drop("_pick", "_mention")
    )


def _card_order() -> Window:
    return Window.partitionBy("week", "day", "category").orderBy(
        F.col("is_pick").desc(), F.col("is_mention").desc(), "untimed", "minute", "ord"
    )


def display_cap(
    listing: DataFrame, picks: DataFrame, mentions: DataFrame, cap: int = fixed.CARDS_PER_CATEGORY
) -> DataFrame:
    """First `cap` rows per day and category with the true row count beside them.

    The count is its own aggregate on the plain listing: a second window function would stop the
    early top-k cut, and the flags are not needed to count.
    """
    counts = listing.groupBy("week", "day", "category").agg(F.count(F.lit(1)).alias("true_count"))
    ranked = flag_chosen(listing, picks, mentions).withColumn("card", F.row_number().over(_card_order()))
    return ranked.where(F.col("card") <= cap).join(counts, ["week", "day", "category"])


def annotation_cap(flagged: DataFrame, cap: int = fixed.CARDS_PER_CATEGORY) -> DataFrame:
    """Rows worth annotating: all picks and mentions, then the day's earliest up to `cap` per category."""
    chosen = F.col("is_pick") | F.col("is_mention")
    within = flagged.withColumn("_nth", F.row_number().over(_card_order())).where(F.col("_nth") <= cap)
    return flagged.where(chosen).unionByName(within.where(~chosen).drop("_nth"))
