"""Connected components of a link table, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import rows


def _large(links: DataFrame) -> DataFrame:
    """Hang the greater neighbours of each node on its least neighbour."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    """Hang the smaller neighbours of each node, and the node, on the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(least, "u")
        .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        .select("e.u", "e.v")
        .where("u != v")
        .distinct()
    )


def _starred(links: DataFrame) -> bool:
    """Whether each node hangs on one other that itself hangs on none, so that every component is a star."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    met = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return met.agg(F.max(((F.col("hangs") > 1) | (F.col("hangs") + F.col("holds") > 1)).cast("int"))).head()[0] != 1


def label(links: DataFrame) -> DataFrame:
    """(node, least): each node that has a link to another, and the least node of its component. links: (u, v).

    Large-star and small-star steps alternate until all components are stars. A node with very many links meets its
    minimum by partial aggregation, and the join back to it is one that Spark splits. Every step is written to the
    shared folder.
    """
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = rows.cut(down.where("u != v").distinct())
    while not _starred(current):
        current = rows.cut(_small(_large(current)))
    return current.select(F.col("u").alias("node"), F.col("v").alias("least")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("least")).distinct()
    )


def extend(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels once more links are known: only the components that these join are labelled anew."""
    named = links.select("u", "v")
    for end in ("u", "v"):
        known = labels.select(F.col("node").alias(end), F.col("least").alias("_least"))
        named = named.join(known, end, "left").withColumn(end, F.coalesce("_least", end)).drop("_least")
    moved = label(named)
    if moved.isEmpty():
        return labels
    after = moved.select(F.col("node").alias("least"), F.col("least").alias("_least"))
    kept = labels.join(after, "least", "left").select("node", F.coalesce("_least", "least").alias("least"))
    return rows.cut(kept.union(moved.join(labels.select("node"), "node", "left_anti").select("node", "least")))
