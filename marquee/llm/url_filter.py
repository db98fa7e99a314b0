"""URL allow and block rules by host-suffix and path-prefix expressions.

Each URL expands into the (host suffix, path prefix) expressions that a rule of the table could have; the expressions
meet the rules on a short digest prefix, the full digests confirm a match, and the longest rule decides.

Nulls and URLs without "://" have an empty host and path and meet no rule. Repeated rows are judged alike and stay
repeated. An empty rule table leaves every URL to the default. Columns of the input are kept; names the result adds
(host, path, rule, verdict) replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", host, path).cast("binary"), 256)


def _expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The expressions of these (labels, path characters) that the URL has."""
    labels = F.split(host, r"\.")
    made = [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= length),
            F.struct(
                F.array_join(F.slice(labels, -n, n), ".").alias("rule_host"),
                F.substring(path, 1, length).alias("rule_path"),
            ),
        )
        for n, length in shapes
    ]
    return F.array_compact(F.array(*made)) if made else F.array()


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule (null if none fits) and verdict.

    rules: host, path, verdict, one row per (host, path); of rows with the same host and path one that blocks wins. A
    rule fits its host and all subdomains if the URL's path starts with its path; of those that fit the longest wins
    (characters of host and path, then of the host). The distinct rule shapes (label count, path length) come to the
    driver: as many as there are label counts times path lengths, not as many as there are rules.
    """
    rules = (
        rules.groupBy(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))
        .where("rule_host is not null and rule_path is not null")
    )
    shapes = [
        (row[0], row[1])
        for row in rules.select(F.size(F.split("rule_host", r"\.")), F.length("rule_path")).distinct().collect()
    ]
    listed = rules.select(
        F.substring(_digest(F.col("rule_host"), F.col("rule_path")), 1, PREFIX_HEX).alias("short"),
        _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("host_chars"),
        F.col("rule_verdict"),
    )
    split = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    targets = split.select("host", "path").distinct()
    if shapes:
        asked = (
            targets.select("host", "path", F.explode(_expressions(F.col("host"), F.col("path"), sorted(shapes))).alias("e"))
            .select("host", "path", _digest(F.col("e.rule_host"), F.col("e.rule_path")).alias("digest"))
            .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
        )
        best = (
            asked.join(listed, "short")
            .where(F.col("digest") == F.col("rule_digest"))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "rule_verdict")).alias("best"))
            .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("verdict"))
        )
    else:
        best = targets.limit(0).select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict"))
    return (
        split.drop("rule", "verdict")
        .join(best, ["host", "path"], "left")
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    )
