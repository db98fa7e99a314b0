"""Secret scan over a trigram inverted index.

Every rule's pattern gives a Boolean trigram query. The index holds postings (trigram, text key) for the trigrams that
the rules ask for; the postings of a text meet by its key, which intersects the lists of a rule's trigrams, and only
texts that answer a rule's query are searched with its pattern. Rules without a mandatory trigram search every text.

Null texts are empty. Repeated rows share their key and their answers and stay repeated. An empty table gives an empty
result. Spans are in code points of the whole text, end exclusive.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import rows, trigrams


class Rule(NamedTuple):
    """A pattern valid in Python and Java; a match counts if its group (0: all) has `least` characters."""

    kind: str
    pattern: str
    group: int
    least: int


# Patterns and least lengths.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
BASE = (
    Rule("assign", ASSIGN, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("pem", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", 0, 27),
)
RULES = BASE + MORE


def postings(keyed: DataFrame, wanted: list[str]) -> DataFrame:
    """(trigram, key) of the wanted trigrams that the lower-cased text holds."""
    low = keyed.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted)))
    return low.select(F.explode(held).alias("trigram"), "key")


def _answers(held: Column, query: list[list[set[str]]]) -> Column:
    """Whether the trigrams held answer the query."""
    found = F.lit(True)
    for segment in query:
        any_of = F.lit(False)
        for needed in segment:
            any_of = any_of | (F.size(F.array_except(F.array(*map(F.lit, sorted(needed))), held)) == 0)
        found = found & any_of
    return found


def _lengths(text: Column, rule: Rule) -> Column:
    """(gap before, length, length of the group) of every match, from left to right."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    return F.transform(
        F.arrays_zip(gaps.alias("gap"), matches.alias("match"), groups.alias("group")),
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"),
            F.length(x["match"]).alias("chars"),
            F.coalesce(F.length(x["group"]), F.lit(0)).alias("group"),
        ),
    )


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """Array of (start, rank, end) of the matches that are long enough. The gaps and matches of a text in turn give the
    starts: one fold over the matches of the text."""
    empty = F.array().cast("array<struct<start:int,rank:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["chars"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        kept = F.when(x["group"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    found = F.aggregate(_lengths(text, rule), zero, step, lambda acc: acc["out"])
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), found).otherwise(empty)


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """row (the input row) and spans, an array of (start, rank of the rule, end) by start and rank."""
    queries = {rule.kind: trigrams.query(rule.pattern) for rule in rules}
    wanted = sorted({t for query in queries.values() for segment in query for needed in segment for t in needed})
    key = F.xxhash64(F.col(doc_id).cast("string"), rows.whole(text))
    keyed = docs.select(F.struct("*").alias("row"), rows.whole(text).alias("text"), key.alias("key"))
    # A text key groups at most as many postings as there are wanted trigrams, and the copies of one row.
    held = (
        postings(keyed, wanted).groupBy("key").agg(F.collect_set("trigram").alias("held"))
        if wanted
        else keyed.select("key", F.array().cast("array<string>").alias("held")).limit(0)
    )
    indexed = [rule for rule in rules if queries[rule.kind]]
    answered = held.select("key", *(_answers(F.col("held"), queries[r.kind]).alias(f"has_{r.kind}") for r in indexed))
    if indexed:
        answered = answered.where(F.greatest(*(F.col(f"has_{r.kind}") for r in indexed), F.lit(False)))
    found = []
    for rank, rule in enumerate(rules):
        spans = spans_of(F.col("text"), rule, rank)
        if queries[rule.kind]:
            none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
            spans = F.when(F.col(f"has_{rule.kind}"), spans).otherwise(none)
        found.append(spans)
    return keyed.join(answered, "key", "left").select("row", F.sort_array(F.concat(*found)).alias("spans"))


def written(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )
