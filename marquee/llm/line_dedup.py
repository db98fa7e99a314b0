"""Line deduplication by pairwise alignment.

Overlapping documents are found through the hashes of shared runs: a run is neighbouring lines with at least BLOCK_WORDS
words, of which no line at one of its ends could be left out, named by its content and by how often it came before in its
document. Every run asks for the earliest document that holds it, and a document is paired with each document that comes
first in one of its runs. Any block that could be deleted holds such a run, so no line needs to be rare and none is too
common; pairs grow with the runs and not with the square of a run's holders.

The lines of a pair are aligned by patience diff. Blocks of neighbouring lines that align and have at least BLOCK_WORDS words
are deleted from the later document; of what is left, blocks that stand in another order are aligned too, each with the first
place in the earlier document that nothing is aligned with. So a document loses a passage as often as one earlier document
holds it, and further copies inside it stay. Equal texts count once as holders; all but the one with the least id lose
their lines.

A line is what stands between line feeds, without white space around it; lines without a word hold nothing, align with
nothing and stay. Null texts are empty. A null id comes after every id. Repeated rows (same id and text) stay alike. An
empty table gives an empty result. Columns of the documents stay inside `row`, so they can have any name. A text's lines
are read whole in one task, at some 30 bytes a line.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import flat, rows

BLOCK_WORDS = 10
KEY = ["id", "a", "b"]


def _increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing run of places, by patience sorting."""
    piles: list[int] = []
    tops: list[int] = []
    before: list[int] = []
    for k, place in enumerate(places):
        pile = bisect_left(tops, place)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(piles):
            piles.append(k)
            tops.append(place)
        else:
            piles[pile], tops[pile] = k, place
    found = []
    k = piles[-1] if piles else -1
    while k >= 0:
        found.append(k)
        k = before[k]
    return found[::-1]


def _numbered(lines: list[int]) -> list[tuple[int, int]]:
    """Each line with how often it came before."""
    seen: Counter[int] = Counter()
    found = []
    for x in lines:
        found.append((x, seen[x]))
        seen[x] += 1
    return found


def align(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Aligned places of two sequences: common beginnings and ends, then lines that are unique in both, in a common
    order, and the same again between them. Where no line is unique in both, the first occurrence meets the first, the
    second the second."""
    found: list[tuple[int, int]] = []
    waiting = [(0, len(left), 0, len(right))]
    while waiting:
        a, b, c, d = waiting.pop()
        while a < b and c < d and left[a] == right[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        in_left, in_right = Counter(left[a:b]), Counter(right[c:d])
        place = {x: k for k, x in enumerate(right[c:d], c) if in_right[x] == 1 and in_left.get(x) == 1}
        anchors = [(k, place[x]) for k, x in enumerate(left[a:b], a) if x in place]
        if not anchors:
            again = {x: k for k, x in enumerate(_numbered(right[c:d]), c)}
            anchors = [(k, again[x]) for k, x in enumerate(_numbered(left[a:b]), a) if x in again]
        if not anchors:
            continue
        chain = [anchors[k] for k in _increasing([y for _, y in anchors])]
        edges = [(a - 1, c - 1), *chain, (b, d)]
        found += chain
        waiting += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(found)


def _moved(left: list[int], right: list[int], sizes: list[int], used: set[int], gone: set[int]) -> list[int]:
    """Places of `right` outside `gone` in blocks that `left` holds outside `used`, in whatever order."""

    def run(lines: list[int], at: int, closed: set[int]) -> tuple[int, ...] | None:
        """The shortest run from a place on; the names say how many words its lines have."""
        words, end = 0, at
        while words < BLOCK_WORDS:
            if end == len(lines) or end in closed:
                return None
            words += size_of.get(lines[end], BLOCK_WORDS)
            end += 1
        return tuple(lines[at:end])

    size_of = dict(zip(right, sizes, strict=True))
    places: dict[tuple[int, ...], list[int]] = {}
    for x in reversed(range(len(left))):
        if left[x] in size_of and (key := run(left, x, used)):
            places.setdefault(key, []).append(x)
    found: list[int] = []
    y = 0
    while y < len(right):
        key = run(right, y, gone)
        listed = places.get(key, []) if key else []
        while listed and any(x in used for x in range(listed[-1], listed[-1] + len(key))):
            listed.pop()
        if not listed:
            y += 1
            continue
        x = listed[-1]
        while x < len(left) and y < len(right) and left[x] == right[y] and x not in used and y not in gone:
            used.add(x)
            found.append(y)
            x, y = x + 1, y + 1
    return found


def lost_places(left: list[int], right: list[int], sizes: list[int]) -> list[int]:
    """Places of the later text `right` that an earlier one makes it lose."""
    used: set[int] = set()
    gone: list[int] = []
    block: list[tuple[int, int]] = []
    for pair in [*align(left, right), (-9, -9)]:
        if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(sizes[y] for _, y in block) >= BLOCK_WORDS:
                used.update(x for x, _ in block)
                gone += [y for _, y in block]
            block = []
        block.append(pair)
    return gone + _moved(left, right, sizes, used, set(gone))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The names, by content and occurrence, of the runs of each text."""
    for batch in batches:
        at = np.r_[0, np.cumsum(batch["sizes"].value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
        sizes, names = (batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("sizes", "names"))
        text = np.repeat(np.arange(batch.num_rows), np.diff(at))
        words = np.r_[0, np.cumsum(sizes.astype(np.int64))]
        line = np.arange(len(sizes))
        # The shortest run from each line on, and the shortest one up to each line.
        after = np.searchsorted(words, words[:-1] + BLOCK_WORDS)
        before = np.searchsorted(words, words[1:] - BLOCK_WORDS, side="right") - 1
        on, up = after <= at[1:][text], before >= at[:-1][text]
        spans = np.unique(np.c_[np.r_[line[on], before[up]], np.r_[after[on], line[up] + 1]], axis=0)
        start, end = spans[:, 0], spans[:, 1]
        digests = flat.Sums(names.astype(np.int64).view(np.uint64)).span(start, end)
        order = np.lexsort((start, digests, text[start]))
        first = np.ones(len(order), bool)
        first[1:] = (digests[order][1:] != digests[order][:-1]) | (text[start][order][1:] != text[start][order][:-1])
        place = np.arange(len(order))
        times = np.zeros(len(order), np.uint64)
        times[order] = place - np.maximum.accumulate(np.where(first, place, 0))
        keys = flat.mix(digests + times * np.uint64(flat.BASE)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch["node"].take(pa.array(text[start])), pa.array(keys)], names=["node", "key"])


def _lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of the lines that the later text of each pair loses."""
    for batch in batches:
        nodes, numbers = [], []
        for k, (left, right, lines, sizes) in enumerate(
            zip(*(batch[c].to_pylist() for c in ("names_u", "names", "numbers", "sizes")), strict=True)
        ):
            found = lost_places(left, right, sizes)
            nodes += [k] * len(found)
            numbers += [lines[y] for y in found]
        picked = batch.select(KEY).take(pa.array(nodes, pa.int64()))
        yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(numbers, pa.int32())], names=[*KEY, "number"])


def _keyed(docs: DataFrame, text: str, doc_id: str, keep: list[str] | None) -> DataFrame:
    held = rows.whole(text)
    return docs.select(
        F.struct(*(keep or ["*"])).alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(flat.NO_ID)).alias("id"),
        F.xxhash64(held).alias("a"),
        F.xxhash64(F.lit(1), held).alias("b"),
        held.alias("text"),
    )


def lost_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, a, b, whole, lost): the documents that lose lines, with the digests of their text: all (a copy), or the
    numbers of the lines from 0, with those of lines without a word between them, which stay."""
    keyed = _keyed(docs, text, doc_id, [doc_id])
    line = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            F.xxhash64(F.lit(1), F.trim(x, F.lit(rows.SPACE))).alias("name"),
            F.regexp_count(x, F.lit(rows.WORD)).alias("size"),
            i.alias("number"),
        ),
    )
    lines = F.filter(line, lambda x: x["size"] > 0)
    profiles = rows.cut(keyed.select("id", "a", "b", lines.alias("lines")))
    # Written, so that Spark can split the joins of a text that very many rows hold.
    least = rows.cut(profiles.groupBy("a", "b").agg(F.min("id").alias("id")))
    chosen = profiles.join(least.select(*KEY), KEY, "left_semi").dropDuplicates(KEY)
    chosen = rows.cut(
        chosen.select(
            F.struct(*KEY).alias("node"), F.col("lines.name").alias("names"), F.col("lines.size").alias("sizes"),
            F.col("lines.number").alias("numbers"),
        )
    )
    runs = chosen.select("node", "names", "sizes").mapInArrow(
        _runs, "node struct<id: bigint, a: bigint, b: bigint>, key bigint"
    )
    # Written, so that Spark can split the join's side of a run that very many documents hold.
    origins = rows.cut(
        runs.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first != last").drop("last")
    )
    pairs = runs.join(origins, "key").where("node != first").select("first", "node").distinct()
    left = chosen.select(F.col("node").alias("first"), F.col("names").alias("names_u"))
    lost = (
        pairs.join(chosen, "node")
        .join(left, "first")
        .select("node.*", "names_u", "names", "sizes", "numbers")
        .mapInArrow(_lost, "id bigint, a bigint, b bigint, number int")
        .groupBy(*KEY)
        .agg(F.collect_set("number").alias("lost"))
    )
    copies = profiles.join(least.select("a", "b", F.col("id").alias("least")), ["a", "b"]).where("id != least").select(*KEY).distinct()
    return copies.select(*KEY, F.lit(True).alias("whole"), F.array().cast("array<int>").alias("lost")).union(
        lost.select(*KEY, F.lit(False), "lost")
    )


def remove(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """row (all columns, or those to keep), the kept text, n_lines and n_removed (lines with a word) of every document."""
    keyed = _keyed(docs, text, doc_id, keep)
    lost = lost_lines(docs, text, doc_id)
    schema = T.StructType([
        keyed.schema["row"], T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()),
        T.StructField("n_removed", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for held, whole, gone in zip(*(batch[c].to_pylist() for c in ("text", "whole", "lost")), strict=True):
                lines = held.split("\n")
                filled = [bool(x.strip(rows.SPACE)) for x in lines]
                removed = {k for k in gone or () if filled[k]}
                kept = [x for k, x in enumerate(lines) if k not in removed]
                out[0].append("" if whole else "\n".join(kept))
                out[1].append(sum(filled))
                out[2].append(sum(filled) if whole else len(removed))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())],
                names=["row", "kept", "n_lines", "n_removed"],
            )

    return keyed.join(lost, KEY, "left").select("row", "text", "whole", "lost").mapInArrow(run, schema)
