"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the counts of the vote patterns
estimates each rule's accuracy and the share of good documents, and the posterior of a document replaces the demand
that it pass every rule. There are at most 3 ** rules patterns, whatever the number of documents; their counts are all
that reaches the driver.

Null texts have no words and fail the base rule. Repeated rows get the same verdict and stay repeated. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import rows

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED = 50
ROUNDS = 50
PRIOR = 0.9
RIGHT_ON_GOOD, RIGHT_ON_BAD = 0.98, 0.4
HELD = 0.05
THRESHOLD = 0.5


def features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (all columns, or those to keep) and the counts of every document. One pass over the text, no shuffle: the three-word windows of a text are
    sorted inside its row, by 64-bit digest and position."""
    words = docs.select(F.struct(*(keep or ["*"])).alias("row"), rows.whole(text).alias("text")).withColumn(
        "words", F.regexp_extract_all("text", F.lit(rows.WORD), F.lit(0))
    )
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(rows.WORD)))
    n = F.size("words")
    counted = words.select(
        "row",
        "text",
        n.cast("long").alias("n_words"),
        F.length(F.translate("text", rows.SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.when(
            n >= 3,
            F.arrays_zip(
                F.slice("words", F.lit(1), n - 2).alias("a"),
                F.slice("words", F.lit(2), n - 2).alias("b"),
                F.slice("words", F.lit(3), n - 2).alias("c"),
            ),
        ).alias("windows"),
    )
    ordered = counted.withColumn(
        "ordered",
        F.sort_array(
            F.transform(
                F.col("windows"),
                lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i")),
            )
        ),
    ).drop("windows")
    last = F.size("ordered")
    neighbours = F.arrays_zip(
        F.col("ordered").alias("x"),
        F.concat(F.array(F.lit(None).cast("bigint")), F.slice("ordered", F.lit(1), last - 1)["h"]).alias("before"),
        F.concat(F.slice("ordered", F.lit(2), last - 1)["h"], F.array(F.lit(None).cast("bigint"))).alias("after"),
    )
    twice = F.filter(
        neighbours, lambda x: F.coalesce((x["x"]["h"] == x["before"]) | (x["x"]["h"] == x["after"]), F.lit(False))
    )
    found = ordered.withColumn("at", F.when(last > 1, F.sort_array(F.transform(twice, lambda x: x["x"]["i"])))).drop("ordered")
    ahead = F.size("at")
    gaps = F.zip_with(
        F.slice("at", F.lit(2), ahead - 1), F.slice("at", F.lit(1), ahead - 1), lambda b, a: F.least(b - a, F.lit(3))
    )
    covered = F.when(ahead > 1, F.aggregate(gaps, F.lit(3), lambda s, x: s + x)).otherwise(0)
    return found.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"\p{L}")).cast("long").alias("n_letters"),
        F.size(F.filter("lines", lambda x: F.regexp_like(x, F.lit(r"[.!?:][\"')]?\s*$")))).cast("long").alias("n_ended"),
        F.regexp_count("text", F.lit(r"!!|[|]")).cast("long").alias("n_marks"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def votes() -> dict[str, Column]:
    """1 good, -1 bad, 0 abstains; a document without words gets votes like any other."""

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(0).cast("int")

    n, lines, chars = F.col("n_words"), F.col("n_lines"), F.col("word_chars")
    return {
        "symbols": vote(50 * F.col("n_symbols") <= n, 10 * F.col("n_symbols") > n),
        "letters": vote(10 * F.col("n_letters") >= 9 * chars, 10 * F.col("n_letters") < 8 * chars),
        "marks": vote(100 * F.col("n_marks") <= n, 10 * F.col("n_marks") > n),
        "case": vote(10 * F.col("n_upper") <= F.col("n_letters"), 2 * F.col("n_upper") > F.col("n_letters")),
        "dup_lines": vote((F.col("n_dup_lines") == 0) & (lines > 1), 10 * F.col("n_dup_lines") > 4 * lines),
        "repeats": vote(10 * F.col("n_repeat_words") <= n, 10 * F.col("n_repeat_words") > 3 * n),
        "word_length": vote(chars.between(4 * n, 7 * n), ~chars.between(3 * n, 10 * n)),
        "endings": vote(10 * F.col("n_ended") >= 8 * lines, 2 * F.col("n_ended") < lines),
    }


class Model(NamedTuple):
    """prior: share of good documents; right_on_good, right_on_bad: of each rule, how often its vote is right on a
    document of that class."""

    prior: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]

    def weight(self, rule: int, vote: int) -> float:
        """What a vote adds to the log odds of good; an abstention adds nothing."""
        good, bad = self.right_on_good[rule], self.right_on_bad[rule]
        if vote == 0:
            return 0.0
        return math.log(good / (1 - bad)) if vote > 0 else math.log((1 - good) / bad)

    def start(self) -> float:
        return math.log(self.prior / (1 - self.prior))

    def posterior(self, pattern: tuple[int, ...]) -> float:
        odds = self.start() + sum(self.weight(r, vote) for r, vote in enumerate(pattern))
        return 1 / (1 + math.exp(-min(max(odds, -500), 500)))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> Model:
    """The model of these vote patterns (pattern, count).

    A rule that votes is right with an accuracy of its own on each class, independently of the others given the class,
    so a rule that is seldom wrong when it rejects outweighs several that accept nearly everything. The start values
    tell the classes apart, and each accuracy is held to its start value as by HELD of all documents: bad documents are
    of several kinds, and without that the commonest kind alone would become the bad class. The patterns are summed in
    sorted order, so reruns give the same bits.
    """
    patterns = sorted(patterns)
    n_rules, total = len(patterns[0][0]) if patterns else 0, sum(count for _, count in patterns)
    start = (RIGHT_ON_GOOD, RIGHT_ON_BAD)
    model = Model(PRIOR, (RIGHT_ON_GOOD,) * n_rules, (RIGHT_ON_BAD,) * n_rules)
    for _ in range(rounds if total else 0):
        good = 0.0
        right, cast = ([[0.0] * n_rules, [0.0] * n_rules] for _ in range(2))
        for pattern, count in patterns:
            p = model.posterior(pattern)
            good += count * p
            for r, vote in enumerate(pattern):
                if vote:
                    cast[0][r] += count * p
                    cast[1][r] += count * (1 - p)
                    right[vote < 0][r] += count * ((1 - p) if vote < 0 else p)
        accuracy = [
            tuple((right[k][r] + HELD * total * start[k]) / (cast[k][r] + HELD * total) for r in range(n_rules)) for k in (0, 1)
        ]
        model = Model(min(max(good / total, 0.01), 0.99), *accuracy)
    return model


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row, the counts, base_failed, posterior and kept of every document."""
    rules = votes()
    counted = rows.cut(features(docs, text, keep))
    return decide(counted, rules)


def decide(counted: DataFrame, rules: dict[str, Column]) -> DataFrame:
    names = list(rules)
    patterns = [
        (tuple(row[:-1]), row[-1])
        for row in counted.select(*(rules[n].alias(n) for n in names)).groupBy(*names).count().collect()
    ]
    model = estimate(patterns)
    odds = F.lit(model.start())
    for r, name in enumerate(names) if patterns else ():
        odds = odds + F.when(rules[name] > 0, model.weight(r, 1)).when(rules[name] < 0, model.weight(r, -1)).otherwise(0.0)
    return (
        counted.withColumn("base_failed", base_failed())
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= THRESHOLD))
    )
