"""Mixing sources to target weights.

Words are counted per source, the weights give each source a target, and target over size is its repetition rate: a
document is taken floor(rate) times, and once more if a hash of the seed, its id and its text falls below the rate's
fraction.

Null texts have size 0. A null source is a source of its own, the last. An empty table gives an empty result; a table
without words gives targets 0. Rows without id draw by their text. Rows that agree in id, text and source are numbered, and
each draws with its number, so a group of copies is taken as often as its rate says. Nothing but the rows enters the
hash, so reruns and retried tasks agree. A column of the input that is called `copy` gives way to the number of the copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm import rows

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target from (source, source_size), one row per source.

    A target stops at `most` times its source's size and the excess goes to the others by weight. In order of
    cap / weight a source is capped if its share of what the ones before it left reaches its cap, so one running sum
    replaces the repeated resharing. The windows run over the sources, not over documents.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"))
    listed = sources.select("source", "source_size", weight.cast("long").alias("weight")).withColumn(
        "cap", most * F.col("source_size")
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = listed.select(
        "*",
        F.sum("source_size").over(all_rows).alias("total"),
        F.sum("weight").over(all_rows).alias("weights"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    ).withColumn(
        "capped",
        F.col("cap") * (F.col("weights") - F.col("weight_before"))
        <= F.col("weight") * (F.col("total") - F.col("cap_before")),
    )
    left = summed.select(
        "*",
        (F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(all_rows)).alias("left_size"),
        (F.col("weights") - F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0)).over(all_rows)).alias("left_weight"),
    )
    share = (F.col("weight") * F.col("left_size")).cast("double") / F.col("left_weight").cast("double")
    return left.select(
        "source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target")
    )


def draw(doc_id: Column, digest: Column, number: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed, the id, the text's digest and the number among equal rows."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(":"), number.cast("string"))
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 13), 16, 10).cast("double") / float(2**52)


def _numbered(docs: DataFrame) -> DataFrame:
    """docs (id, digest, source, ...) with the number of each row among those that agree in the three, from 0.

    Only groups of several rows are numbered, each input partition's part of a group alone, from the count of the parts
    before it; which of the equal rows gets which number makes no difference.
    """
    key = F.struct(F.col("id"), F.col("digest"), F.col("source"))
    keyed = docs.withColumn("key", F.sha2(F.to_json(key).cast("binary"), 256))
    several = rows.cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    if several.isEmpty():
        return docs.withColumn("number", F.lit(0).cast("long"))
    single = keyed.join(several, "key", "left_anti").withColumn("number", F.lit(0).cast("long"))
    equal = rows.cut(keyed.withColumn("part", F.spark_partition_id()).join(several, "key", "left_semi"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = equal.groupBy("key", "part").agg(F.count(F.lit(1)).alias("held"))
    starts = starts.select("key", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("key", "part").orderBy("digest")
    counted = equal.withColumn("nth", F.row_number().over(within)).join(starts, ["key", "part"])
    counted = counted.withColumn("number", F.col("start") + F.col("nth") - 1)
    return single.select(*docs.columns, "number").union(counted.select(*docs.columns, "number"))


def plan(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: str = SEED,
    weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS,
) -> DataFrame:
    """row (the input row), size, source_size, target and copies of every document.

    The sources are few against the documents; Spark broadcasts their table below its threshold and otherwise
    joins by key, splitting a source that holds a large part of the rows.
    """
    size = rows.n_words(rows.whole(text))
    sources = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    listed = targets(sources, weights, most).withColumnRenamed("source", "listed")
    held = rows.whole(text)
    sized = docs.select(
        F.struct("*").alias("row"), F.col(source).alias("source"), F.col(doc_id).alias("id"), size.alias("size"),
        F.sha2(held.cast("binary"), 256).alias("digest"),
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = (draw(F.col("id"), F.col("digest"), F.col("number"), seed) < rate - F.floor(rate)).cast("long")
    return _numbered(sized).join(listed, F.col("source").eqNullSafe(F.col("listed")), "left").select(
        "row", "size", "source_size", "target", (F.floor(rate) + extra).alias("copies")
    )


def emit(planned: DataFrame) -> DataFrame:
    """Every document as often as it is taken, with the columns of the input and the number of the copy."""
    numbered = planned.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth"))
    held = [c for c in planned.schema["row"].dataType.names if c != "copy"]
    return numbered.select(*(F.col("row").getField(c).alias(c) for c in held), F.col("nth").alias("copy"))
