"""Suffix-array deduplication by the common-prefix interval tree.

Suffixes with the same first WINDOW bytes must meet in one enhanced suffix array. A window goes to the array of its
least seed (a string of SEED bytes, least by digest, the first of equal ones), so that windows with equal content meet,
and the windows in a row that share a seed travel together as one context. Blocks first ask which seeds another
document has; contexts of other seeds stay where they are. Of equal contexts a block sends the one with the least id;
the block itself removes those of later ids and carries over what the sent one loses to those of the same id.

Each array sorts the suffixes of its contexts by content, takes the common prefixes of neighbours and scans them with a
stack, which walks the intervals of the common-prefix tree. An interval whose occurrences are preceded by different
bytes (or by the edge of a context) can't be extended to the left: it is a maximal repeat, with all its occurrences. One
that can be extended is left to the longer repeat. Each occurrence in a document other than the one with the least id is
removed.

Null texts are empty. A null id comes after every id. Rows with the same id take nothing from each other. Texts shorter
than the window lose nothing. An empty table gives an empty result. Only id and text are read, so further columns can
have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm import blocks, flat

WINDOW = 50
SEED = 16
CONTEXTS = "block long, bucket long, ids binary, starts binary, counts binary, content binary"
SPANS = "block long, bucket long, starts binary, lengths binary"
REPEATS = "length long, id long, block long, start long, content binary"
RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept binary"


def seeds_of(texts: flat.Texts, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same least seed: first window, number of windows, digest of the seed, text."""
    n, width = len(texts.data), window - seed + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    places = np.arange(n - seed + 1)
    digests = flat.Sums(flat.BYTE_VALUE[texts.data]).span(places, places + seed)
    bits = np.uint64(n.bit_length())
    ranked = np.full(-(-(len(digests) + width) // width) * width, np.iinfo(np.uint64).max)
    ranked[: len(digests)] = (digests >> bits << bits) | places.astype(np.uint64)
    # Least of each `width` neighbours: the end of one stretch and the beginning of the next.
    stretches = ranked.reshape(-1, width)
    ahead = np.minimum.accumulate(stretches, axis=1).ravel()
    behind = np.minimum.accumulate(stretches[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - window + 1], ahead[width - 1 : width - 1 + n - window + 1])
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(texts.at))
    windows = np.flatnonzero(np.arange(n - window + 1) + window <= texts.at[1:][text[: n - window + 1]])
    place = place[windows]
    begins = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)]) if len(windows) else windows
    counts = np.diff(np.r_[begins, len(windows)])
    return windows[begins], counts, flat.mix(digests[place[begins]] ^ np.uint64(flat.BASE)), text[windows[begins]]


def _pieces(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """data[start:start + length] of all, laid end to end, and where each begins."""
    at = np.r_[0, np.cumsum(lengths)]
    places = np.arange(at[-1]) + np.repeat(starts - at[:-1], lengths)
    return data[places], at


def _of_several_ids(names: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each name belongs to more than one id."""
    order = np.argsort(names, kind="stable")
    starts = np.flatnonzero(np.r_[True, names[order][1:] != names[order][:-1]]) if len(names) else np.zeros(0, np.int64)
    found = np.zeros(len(names), bool)
    if len(names):
        several = np.minimum.reduceat(ids[order], starts) != np.maximum.reduceat(ids[order], starts)
        found[order] = np.repeat(several, np.diff(np.r_[starts, len(names)]))
    return found


def _alike(block: blocks.Block, starts: np.ndarray, counts: np.ndarray, text_of: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context of a block, the equal one with the least id (the first of them), and whether its own id is later."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    digests = flat.Sums(flat.BYTE_VALUE[block.texts.data]).span(starts, starts + counts + window - 1)
    ids = block.ids[text_of]
    order = np.lexsort((starts, ids, digests))
    first = np.flatnonzero(np.r_[True, digests[order][1:] != digests[order][:-1]])
    stands = np.empty(len(starts), np.int64)
    stands[order] = np.repeat(order[first], np.diff(np.r_[first, len(order)]))
    return stands, ids > ids[stands]


class SuffixArray:
    """Enhanced suffix array of the windows of contexts that several ids have and that can't be extended to the left."""

    def __init__(self, content: np.ndarray, at: np.ndarray, counts: np.ndarray, ids: np.ndarray, window: int):
        total = int(counts.sum())
        context = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        place = at[:-1][context] + offset
        names = flat.Sums(flat.BYTE_VALUE[content]).span(place, place + window)
        order = np.argsort(names)
        starts = np.flatnonzero(np.r_[True, names[order][1:] != names[order][:-1]]) if total else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[starts, total])
        if total:
            of = ids[context[order]]
            several = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
            before = np.where(offset[order] > 0, content[place[order] - 1].astype(np.int16), -1)
            low, high = np.minimum.reduceat(before, starts), np.maximum.reduceat(before, starts)
            held = several & ((low != high) | (low < 0))
            group = np.repeat(np.cumsum(held) - 1, sizes)[np.repeat(held, sizes)]
            chosen, before = order[np.repeat(held, sizes)], before[np.repeat(held, sizes)]
        else:
            group, chosen, before = np.zeros(0, np.int64), order, np.zeros(0, np.int16)
        place, context = place[chosen], context[chosen]
        left = at[1:][context] - place - window
        width = -(-int(left.max(initial=0)) // 8) * 8 + 8
        columns = np.arange(width)
        beyond = columns[None, :] < left[:, None]
        tails = np.where(beyond, content[np.minimum(place[:, None] + window + columns, max(0, len(content) - 1))], 0) if len(place) else np.zeros((0, width))
        tails = np.ascontiguousarray(tails.astype(np.uint8))
        keys = tails.view(">u8").astype(np.uint64)
        rank = np.lexsort((*(keys[:, k] for k in range(keys.shape[1] - 1, -1, -1)), group))
        self.context, self.offset = context[rank], (place - at[:-1][context])[rank]
        self.before, self.ids = before[rank], ids[context[rank]]
        self.common = np.zeros(len(rank) + 1, np.int64)
        if len(rank) > 1:
            tails, left, group = tails[rank], left[rank], group[rank]
            differ = tails[1:] != tails[:-1]
            same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            same = np.minimum(same, np.minimum(left[1:], left[:-1]))
            self.common[1:-1] = np.where(group[1:] == group[:-1], window + same, 0)

    def scan(self) -> tuple[list[tuple[int, int, int, int]], np.ndarray]:
        """The maximal repeats as (length, first, last + 1, least id) over the array, and for each suffix the length of
        the longest one that a smaller id has too (0: none)."""
        common, ids, before = self.common.tolist(), self.ids.tolist(), self.before.tolist()
        reach = np.zeros(len(ids), np.int64)
        found = []
        stack: list[list] = []  # length, first, least id, byte before (-1: differ), occurrences not yet removed
        for i in range(len(ids)):
            node = [0, i, ids[i], before[i], [i]]
            ahead = common[i + 1]
            while stack and stack[-1][0] > ahead:
                top = stack.pop()
                self._add(top, node)
                if top[3] < 0:
                    least = top[2]
                    found.append((top[0], top[1], i + 1, least))
                    later = [x for x in top[4] if ids[x] > least]
                    if later:
                        reach[later] = top[0]
                        top[4] = [x for x in top[4] if ids[x] == least]
                node = top
            if ahead:
                if stack and stack[-1][0] == ahead:
                    self._add(stack[-1], node)
                else:
                    stack.append([ahead, node[1], node[2], node[3], node[4]])
        return found, reach

    @staticmethod
    def _add(parent: list, child: list) -> None:
        parent[2] = min(parent[2], child[2])
        if parent[3] != child[3]:
            parent[3] = -1
        parent[4] += child[4]


class Shard:
    """The contexts of one bucket; of equal contexts only the one with the least id enters the suffix array."""

    def __init__(self, table: pa.Table, window: int):
        def read(column: str, kind: type) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_py(), kind) for x in table[column])])

        self.window = window
        counts = read("counts", np.uint8).astype(np.int64)
        self.ids, self.starts = read("ids", np.int64), read("starts", np.int64)
        self.row = np.repeat(np.arange(table.num_rows), [len(x.as_py()) for x in table["counts"]])
        content = read("content", np.uint8)
        at = np.r_[0, np.cumsum(counts + window - 1)]
        self.lengths = counts + window - 1
        digests = flat.Sums(flat.BYTE_VALUE[content]).span(at[:-1], at[1:])
        self.order = np.lexsort((self.ids, digests))
        first = np.r_[True, digests[self.order][1:] != digests[self.order][:-1]] if len(digests) else np.zeros(0, bool)
        self.same = np.cumsum(first) - 1  # by order: which distinct context
        chosen = self.order[first]
        self.least = self.ids[chosen]
        self.content, self.at = _pieces(content, at[:-1][chosen], self.lengths[chosen])
        self.array = SuffixArray(self.content, self.at, counts[chosen], self.least, window)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, start and length of all occurrences to remove."""
        later = self.ids[self.order] > self.least[self.same]
        whole = self.order[later]
        _, reach = self.array.scan()
        lost = np.flatnonzero(reach)
        # What the chosen context loses, equal contexts of the same id lose too.
        alike, which = self.order[~later], self.same[~later]
        bounds = np.searchsorted(which, np.arange(len(self.least) + 1))
        context = self.array.context[lost]
        times = bounds[context + 1] - bounds[context]
        member = alike[np.arange(times.sum()) + np.repeat(bounds[context] - (np.cumsum(times) - times), times)]
        return (
            np.r_[self.row[whole], self.row[member]],
            np.r_[self.starts[whole], self.starts[member] + np.repeat(self.array.offset[lost], times)],
            np.r_[self.lengths[whole], np.repeat(reach[lost], times)],
        )


def _contexts(docs: DataFrame, doc_id: str, text: str, window: int, seed: int) -> tuple[DataFrame, DataFrame]:
    split, n_buckets = blocks.split(docs, doc_id, text)

    def ask(table: pa.Table) -> pa.Table:
        block = blocks.Block(table)
        found, _ = blocks.short_names(seeds_of(block.texts, window, seed)[2], n_buckets)
        return blocks.question(block.number, found >> np.uint64(32), (found & np.uint64(0xFFFFFFFF)).astype(np.uint32))

    def send(table: pa.Table, replies: pa.Table) -> pa.Table:
        empty = pa.table({f.name: pa.array([], f.type) for f in _CONTEXTS})
        if not table.num_rows:
            return empty
        block = blocks.Block(table)
        starts, counts, keys, text_of = seeds_of(block.texts, window, seed)
        found, which = blocks.short_names(keys, n_buckets)
        shared = blocks.shared_bits(found, replies)[which] | _of_several_ids(which, block.ids[text_of])
        bucket = (found >> np.uint64(32))[which].astype(np.int64)
        stands, _ = _alike(block, starts, counts, text_of, window)
        chosen = np.flatnonzero(shared & (stands == np.arange(len(stands))))
        chosen = chosen[np.argsort(bucket[chosen], kind="stable")]
        numbers, firsts, ends = blocks.bucket_rows(bucket[chosen])
        out: dict[str, list] = {f.name: [] for f in _CONTEXTS}
        for number, a, b in zip(numbers.tolist(), firsts, ends, strict=True):
            some = chosen[a:b]
            content, _ = _pieces(block.texts.data, starts[some], counts[some] + window - 1)
            out["block"].append(block.number)
            out["bucket"].append(number)
            out["ids"].append(block.ids[text_of[some]].tobytes())
            out["starts"].append(starts[some].tobytes())
            out["counts"].append(counts[some].astype(np.uint8).tobytes())
            out["content"].append(content.tobytes())
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in _CONTEXTS})

    shared = blocks.in_several_blocks(split.groupBy("block").applyInArrow(ask, blocks.ASKED))
    return split, blocks.with_answers(split, shared, send, CONTEXTS)


def maximal_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row for each occurrence of each maximal repeat of an array: its length, the id and content, and where the
    occurrence starts in the bytes of its block. Equal contexts stand for the first of them."""
    _, contexts = _contexts(docs, doc_id, text, window, seed)

    def of(table: pa.Table) -> pa.Table:
        shard = Shard(table, window)
        array, numbers = shard.array, table["block"].to_pylist()
        chosen = shard.order[np.flatnonzero(np.r_[True, shard.same[1:] != shard.same[:-1]])]
        rows = [
            (length, int(array.ids[k]), numbers[shard.row[chosen[c]]], int(shard.starts[chosen[c]] + array.offset[k]),
             shard.content[shard.at[c] + array.offset[k] : shard.at[c] + array.offset[k] + length].tobytes())
            for length, a, b, _ in array.scan()[0] for k in range(a, b) for c in (array.context[k],)
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = ("length", "id", "block", "start", "content")
        return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)})

    return contexts.groupBy("bucket").applyInArrow(of, REPEATS)


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """id, n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes of every document."""
    split, contexts = _contexts(docs, doc_id, text, window, seed)

    def find(table: pa.Table) -> pa.Table:
        row, start, length = Shard(table, window).spans()
        order = np.lexsort((start, row))
        row, start, length = row[order], start[order], length[order]
        numbers, firsts, ends = blocks.bucket_rows(row)
        block, bucket = table["block"].to_pylist(), table["bucket"].to_pylist()
        return pa.table(
            {
                "block": pa.array([block[r] for r in numbers], pa.int64()),
                "bucket": pa.array([bucket[r] for r in numbers], pa.int64()),
                "starts": pa.array([start[a:b].tobytes() for a, b in zip(firsts, ends, strict=True)], pa.binary()),
                "lengths": pa.array([length[a:b].tobytes() for a, b in zip(firsts, ends, strict=True)], pa.binary()),
            }
        )

    def drop(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in _RESULT})
        block = blocks.Block(table)
        data, at = block.texts.data, block.texts.at
        starts, lengths = (
            np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in replies[c].to_pylist())]) for c in ("starts", "lengths")
        )
        # What the block did not send: contexts of later ids go, others lose what the equal one that was sent loses.
        begins, counts, _, text_of = seeds_of(block.texts, window, seed)
        stands, later = _alike(block, begins, counts, text_of, window)
        equal = np.flatnonzero((stands != np.arange(len(stands))) & ~later)
        equal = equal[np.argsort(stands[equal], kind="stable")]
        context = np.searchsorted(begins, starts, side="right") - 1
        bounds = [np.searchsorted(stands[equal], context, side=x) for x in ("left", "right")]
        times = bounds[1] - bounds[0]
        member = equal[np.arange(times.sum()) + np.repeat(bounds[0] - (np.cumsum(times) - times), times)]
        offset = np.repeat(starts - begins[context], times) if len(starts) else starts
        starts = np.r_[starts, begins[member] + offset, begins[later]]
        lengths = np.r_[lengths, np.repeat(lengths, times), counts[later] + window - 1]
        gone = flat.covered(len(data), starts, lengths)
        totals = np.r_[0, np.cumsum(gone)]
        begins, _ = flat.runs_of(gone, at)
        left = data[~gone].tobytes()
        kept_at = at - totals[at]
        return pa.table(
            {
                "id": block.table["id"],
                "n_bytes": pa.array(np.diff(at)),
                "n_removed": pa.array(np.diff(totals[at]).astype(np.int64)),
                "n_spans": pa.array(np.diff(np.searchsorted(begins, at)).astype(np.int64)),
                "kept": pa.array([left[a:b] for a, b in zip(kept_at[:-1], kept_at[1:], strict=True)], pa.binary()),
            }
        )

    spans = contexts.groupBy("bucket").applyInArrow(find, SPANS)
    return blocks.with_answers(split, spans, drop, RESULT)


_LONG, _BINARY = pa.int64(), pa.binary()
_CONTEXTS = [
    pa.field("block", _LONG), pa.field("bucket", _LONG), pa.field("ids", _BINARY), pa.field("starts", _BINARY),
    pa.field("counts", _BINARY), pa.field("content", _BINARY),
]
_RESULT = [
    pa.field("id", _LONG), pa.field("n_bytes", _LONG), pa.field("n_removed", _LONG), pa.field("n_spans", _LONG),
    pa.field("kept", _BINARY),
]
