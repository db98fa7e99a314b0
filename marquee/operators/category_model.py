"""Categories learned from annotated listings: complement naive Bayes over hashed words.

A word falls in one of BUCKETS by its digest, so the model has a fixed size whatever the vocabulary. Fitting is grouped
sums: occurrences of each bucket in the texts of each category. A category's weight for a bucket is how rare the bucket
is in the texts of all other categories, so a category with few listings is judged by as much text as any other. A text
is scored inside its row: the model comes as one row of arrays, and no row is made per word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import text
from marquee.operators.ranking import tokens

BUCKETS = 1 << 12
SMOOTHING = 1.0


def bucket(term: Column, buckets: int = BUCKETS) -> Column:
    """The first 32 bits of a word's digest, folded to the number of buckets."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 8), 16, 10).cast("long") % buckets


def fit(rows: DataFrame, body: str, category: str, by: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """One row (for each value of `by`): names, the categories in order, and weights, one array of bucket weights each.

    Rows without a category teach nothing, texts without a word teach only that the category is there. Words are
    counted where the rows are; what is shuffled is at most a count for each bucket and category of a task.
    """
    by = by or []
    known = rows.where(F.col(category).isNotNull()).select(*by, F.col(category).alias("category"), tokens(F.col(body)).alias("terms"))
    counts = known.select(*by, "category", F.explode("terms").alias("term")).groupBy(
        *by, "category", bucket(F.col("term"), buckets).alias("bucket")
    ).agg(F.count(F.lit(1)).alias("n"))
    # All that follows has at most a row for each category and bucket.
    held = counts.groupBy(*by, "category").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("held"))
    named = known.select(*by, "category").distinct().join(held, [*by, "category"], "left")
    dense = named.select(
        *by, "category",
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long")),
            lambda b: F.coalesce(F.try_element_at(F.coalesce("held", F.create_map().cast("map<bigint,bigint>")), b), F.lit(0)).cast("long"),
        ).alias("n"),
    )
    gathered = dense.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("category", "n"))).alias("all"))
    whole = F.aggregate(
        "all", F.array_repeat(F.lit(0).cast("long"), buckets), lambda acc, c: F.zip_with(acc, c["n"], lambda x, y: x + y)
    )
    gathered = gathered.select(*by, "all", F.explode(F.array(whole)).alias("whole"))

    def weights(one: Column) -> Column:
        others = F.zip_with(F.col("whole"), one["n"], lambda x, y: x - y)
        total = F.aggregate(others, F.lit(0).cast("long"), lambda acc, x: acc + x)
        return text.once(total, lambda t: F.transform(others, lambda n: -F.log((n + SMOOTHING) / (t + SMOOTHING * buckets))))

    return gathered.select(*by, F.col("all.category").alias("names"), F.transform("all", weights).alias("weights"))


def predict(rows: DataFrame, model: DataFrame, body: str, by: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """rows with the category of the greatest score (the first in name order on a tie) and that score.

    The score is the sum of the text's words' weights. A text without a word has the first category with score 0; without
    any category to choose from it has none. The model has one row for each value of `by`, which must be few.
    """
    placed = rows.withColumn("_buckets", F.transform(tokens(F.col(body)), lambda t: bucket(t, buckets).cast("int")))
    if by:
        scored = placed.join(F.broadcast(model), by, "left")
    else:
        scored = placed.join(F.broadcast(model.limit(1)), F.lit(True), "left")

    def score(name: Column, k: Column) -> Column:
        weight = F.get("weights", k)
        summed = F.aggregate("_buckets", F.lit(0.0), lambda acc, b: acc + F.get(weight, b))
        return F.struct(summed.alias("score"), (-k).alias("first"), name.alias("category"))

    best = F.array_max(F.transform("names", score)).alias("_best")
    return (
        scored.select(*rows.columns, F.explode(F.array(best)).alias("_best"))
        .select(*rows.columns, F.col("_best.category").alias("category"), F.col("_best.score").alias("score"))
    )
