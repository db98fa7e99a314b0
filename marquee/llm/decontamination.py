"""Benchmark decontamination with training suffix arrays.

Each shard of the documents (a slice of an Arrow batch) gets a suffix array over its words. Every test suffix is
searched in every shard by binary search, word by word, which narrows the interval of matching suffixes; what is left
after a window's words are all its occurrences. A longest verbatim match begins where a window occurs and the words
before it differ, and goes on as far as both sides agree; only such beginnings are listed, so words that repeat in an
item and in a document do not make a pair for every window and occurrence. Documents with a match are contaminated.

Suffixes whose first LEAD words begin no test suffix can't match and stay out of the array. The test items are searched in
parts of at most TEST_BYTES of text, one of which the driver and a task hold at a time; their number follows from the
measured size of the test table. One part needs no shuffle. With several, the documents are written once with a row
number, every part is a pass over them, and the matches it finds, with the number, are joined back.

Null or wordless texts have no words and match nothing. Items that share words match alike; equal item ids are listed
once, a null item id as an empty string. Repeated rows get the same answer. Empty tables give no matches. Columns of the
documents stay inside `row`, so they can have any name. A text of any length is searched whole, at some 50 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import flat, rows

WINDOW = 10
LEAD = 3
TEST_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
MATCH = "array<struct<item:string,item_at:int,at:int,words:int>>"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True


def words_of(texts: flat.Texts) -> flat.Words:
    return flat.Words(LOWER[texts.data], texts.at, IS_WORD)


class TestSuffixes:
    """Windows of the items: number and place of the item, where they start among the words' names, and their length."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        words = words_of(flat.Texts(pa.array([text or "" for _, text in items], pa.large_string())))
        sizes = np.diff(words.first)
        lengths = np.minimum(sizes, window)
        counts = np.where(sizes > 0, sizes - lengths + 1, 0)
        self.items = [item or "" for item, _ in items]
        self.names, self.first = words.names, words.first
        self.item = np.repeat(np.arange(len(items), dtype=np.int32), counts)
        self.at = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)
        self.length = lengths[self.item].astype(np.int32)
        self.start = (words.first[:-1][self.item] + self.at).astype(np.int64)
        self.depth = int(self.length.max(initial=0))
        self.lead = int(min(LEAD, self.length.min(initial=LEAD)))
        self.leads = np.unique(flat.Sums(words.names).span(self.start, self.start + self.lead))


def _bound(column: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search in column[low:high] of each row at once."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        value = column[np.where(open_, middle, 0)]
        right = open_ & ((value <= wanted) if after else (value < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)
    return low


class ShardArray:
    """Suffix array of a shard's words, sorted by the names of their first `depth` words inside their text."""

    def __init__(self, words: flat.Words, test: TestSuffixes):
        ends = np.repeat(words.first[1:], np.diff(words.first))
        place = np.flatnonzero(np.arange(len(words)) + test.lead <= ends)
        leads = flat.Sums(words.names).span(place, place + test.lead)
        found = np.searchsorted(test.leads, leads)
        place = place[(found < len(test.leads)) & (test.leads[np.minimum(found, max(0, len(test.leads) - 1))] == leads)] if len(test.leads) else place[:0]
        columns = place[:, None] + np.arange(test.depth)
        inside = columns < ends[place][:, None]
        names = np.where(inside, words.names[np.where(inside, columns, 0)] if len(words) else 0, 0).astype(np.uint64)
        order = np.lexsort(tuple(names[:, d] for d in range(test.depth - 1, -1, -1))) if len(place) and test.depth else np.arange(len(place))
        self.place, self.names = place[order], np.asfortranarray(names[order])

    def search(self, test: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur, and the interval of each one's suffixes."""
        live = np.arange(len(test.item))
        low, high = np.zeros(len(live), np.int64), np.full(len(live), len(self.place))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for depth in range(test.depth):
            wanted = test.names[test.start[live] + depth]
            column = self.names[:, depth]
            low, high = _bound(column, low, high, wanted, False), _bound(column, low, high, wanted, True)
            keep = low < high
            ended = keep & (test.length[live] == depth + 1)
            done.append((live[ended], low[ended], high[ended]))
            keep &= ~ended
            live, low, high = live[keep], low[keep], high[keep]
            if not len(live):
                break
        if not done:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def _beginnings(words: flat.Words, array: ShardArray, test: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """(window, word) where a window occurs and the word before it, if there is one on both sides, is another."""
    window, low, high = array.search(test)
    if not len(window):
        return window, window
    first_word = np.zeros(len(words) + 1, bool)
    first_word[words.first] = True
    before = np.where(test.at[window] > 0, test.names[np.maximum(test.start[window] - 1, 0)], np.uint64(0))
    # Windows of the same words have the same interval. Those that also follow the same word begin at the same places.
    order = np.lexsort((before, test.at[window] > 0, low, test.length[window]))
    window, low, high, before = window[order], low[order], high[order], before[order]
    starts = test.at[window] == 0
    new = np.ones(len(window), bool)
    new[1:] = (test.length[window][1:] != test.length[window][:-1]) | (low[1:] != low[:-1]) | (before[1:] != before[:-1]) | (starts[1:] != starts[:-1])
    group = np.flatnonzero(new)
    sizes = np.diff(np.r_[group, len(window)])
    times = (high - low)[group]
    # Every group of windows against every occurrence: the groups of an interval are as many as words that come before it.
    which = np.repeat(np.arange(len(group)), times)
    place = array.place[np.arange(times.sum()) + np.repeat(low[group] - (np.cumsum(times) - times), times)]
    same = ~starts[group][which] & ~first_word[place] & (words.names[np.maximum(place - 1, 0)] == before[group][which])
    which, place = which[~same], place[~same]
    n = sizes[which]
    member = np.arange(n.sum()) + np.repeat(group[which] - (np.cumsum(n) - n), n)
    return window[member], np.repeat(place, n)


def _agreeing(words: flat.Words, test: TestSuffixes, place: np.ndarray, start: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from both places on are equal, up to `most`: a binary search over the digests of spans."""
    left, right = flat.Sums(words.names), flat.Sums(test.names)
    low, high = np.zeros(len(place), np.int64), most.astype(np.int64)
    while (open_ := low < high).any():
        middle = (low + high + 1) // 2
        equal = left.span(place, place + middle) == right.span(start, start + middle)
        low, high = np.where(open_ & equal, middle, low), np.where(open_ & ~equal, middle - 1, high)
    return low


def _matches(words: flat.Words, test: TestSuffixes) -> pa.ListArray:
    """The longest verbatim matches of each text."""
    window, place = _beginnings(words, ShardArray(words, test), test)
    text = np.searchsorted(words.first, place, side="right") - 1
    start, item = test.start[window], test.item[window].astype(np.int64)
    most = np.minimum(words.first[text + 1] - place, test.first[item + 1] - start)
    length = _agreeing(words, test, place, start, most)
    order = np.lexsort((place, item, text))
    struct = pa.StructArray.from_arrays(
        [
            pa.array(test.items, pa.string()).take(pa.array(item[order])),
            pa.array(test.at[window][order].astype(np.int32)),
            pa.array((place - words.first[text])[order].astype(np.int32)),
            pa.array(length[order].astype(np.int32)),
        ],
        ["item", "item_at", "at", "words"],
    )
    ends = np.searchsorted(text[order], np.arange(len(words.first)))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), struct)


def _search(frame: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    """n_words and the matches with these items, beside the frame's columns; `text` must be one of them."""
    kept = [f.name for f in frame.schema]
    schema = T.StructType([*frame.schema, T.StructField("n_words", T.LongType()), T.StructField("matches", T._parse_datatype_string(MATCH))])
    test = frame.sparkSession.sparkContext.broadcast(TestSuffixes(items, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.parts(batch, "text", SHARD_BYTES):
                words = words_of(flat.Texts(part["text"]))
                yield pa.RecordBatch.from_arrays(
                    [*(part[n] for n in kept), pa.array(np.diff(words.first).astype(np.int64)), _matches(words, test.value)],
                    names=[*kept, "n_words", "matches"],
                )

    return frame.mapInArrow(run, schema)


def search(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, keep: list[str] | None = None,
) -> DataFrame:
    """row (all columns, or those to keep), text, n_words and matches of every document."""
    tests = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text"))
    n_parts = int((tests.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // TEST_BYTES) + 1
    listed = docs.select(F.struct(*(keep or ["*"])).alias("row"), F.col(text).cast("string").alias("text"))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n_parts))

    def held(k: int) -> list[tuple[str, str]]:
        """A part of the items, about TEST_BYTES at most."""
        return sorted((r["item"] or "", r["text"] or "") for r in tests.where(part == k).collect())

    if n_parts == 1:
        return _search(listed, held(0), window)
    numbered = rows.cut(listed.withColumn("number", F.monotonically_increasing_id()))
    texts = numbered.select("number", "text")
    found = [
        rows.cut(_search(texts, held(k), window).where(F.size("matches") > 0).select("number", "matches")) for k in range(n_parts)
    ]
    matched = reduce(DataFrame.union, found).groupBy("number").agg(F.flatten(F.collect_list("matches")).alias("matches"))
    joined = numbered.join(matched, "number", "left")
    # The words of an item, as the search takes them: A-Z in lower case makes no difference to their number.
    n_words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")
    return joined.select("row", "text", n_words.alias("n_words"), F.coalesce("matches", F.array().cast(MATCH)).alias("matches"))


def n_hit(matches: Column) -> Column:
    """Words inside any match: the matches by their start, each adding what lies beyond the ones before."""
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["at"].alias("at"), (m["at"] + m["words"]).alias("end"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        ordered,
        zero,
        lambda acc, m: F.struct(
            F.greatest(acc["end"], m["end"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), m["end"] - F.greatest(acc["end"], m["at"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def items_of(matches: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["item"])))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a match, with their columns."""
    found = search(docs, items).where(F.size("matches") == 0)
    return found.select("row.*")
