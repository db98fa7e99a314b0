"""Substring deduplication by recompression.

Every document is a sequence of word names. A round names each maximal run of one symbol, then each pair of a left and a
right symbol, where a symbol's digest says on which side it stands. A name is the 64-bit digest of what it stands for,
so all tasks give the same run or pair the same name and a round needs no dictionary exchange. Equal substrings so get
the same symbols inside; only their outermost symbols can differ, and how far that reaches follows from the substring
alone. A window of WINDOW words is represented by the first symbol that is certain at the highest level that has one.

Rounds of Spark: (1) blocks ask which representatives other blocks have; (2) windows with a shared representative are
the candidates, and blocks ask which of them a smaller id has, by the digest of the whole window, which verifies the
candidates; (3) words that such a window covers are removed.

Null texts have no words. A null id comes after every id. Rows with the same id take nothing from each other, so
repeated rows stay alike. Documents shorter than the window lose nothing. An empty table gives an empty result. Only id
and text are read, so further columns can have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm import blocks, flat

WINDOW = 50
ROUNDS = 6
LONGEST = 16
RESULT = "id long, n_words long, n_removed long, kept string"


class Level:
    """Symbols of one level: `names`, and the word at which each starts; `border` words start a document."""

    def __init__(self, names: np.ndarray, start: np.ndarray, n_words: int, is_first: np.ndarray):
        self.names, self.start, self.n_words, self.is_first = names, start, n_words, is_first

    def lengths(self) -> np.ndarray:
        return np.diff(np.r_[self.start, self.n_words])

    def index_at(self) -> np.ndarray:
        """Symbol that starts at each word or, past the end, the number of symbols."""
        at = np.full(self.n_words + 1, len(self.start), np.int32)
        at[self.start] = np.arange(len(self.start), dtype=np.int32)
        return at


def _named(level: Level, keep: np.ndarray, names: np.ndarray) -> Level:
    return Level(names[keep], level.start[keep], level.n_words, level.is_first[keep])


def name_runs(level: Level, number: int) -> tuple[Level, np.ndarray]:
    """The level with each run of a symbol as one symbol; for each old symbol, its run."""
    n = len(level.names)
    begins = np.ones(n, bool)
    begins[1:] = (level.names[1:] != level.names[:-1]) | level.is_first[1:]
    first = np.flatnonzero(begins)
    counts = np.diff(np.r_[first, n]).astype(np.uint64)
    names = level.names.copy()
    salt = np.uint64((2 * number + 1) * 0x9E3779B97F4A7C15 % 2**64)
    names[first] = np.where(counts > 1, flat.mix(level.names[first] * np.uint64(3) + counts * salt), level.names[first])
    return _named(level, begins, names), np.cumsum(begins) - 1


def name_pairs(level: Level, number: int) -> tuple[Level, np.ndarray, np.ndarray]:
    """The level with each pair of a left and a right symbol as one symbol; for each old symbol, its new one and its side
    (0 left, 1 right, 2 neither: it is long and joins no more)."""
    salt = np.uint64((2 * number + 2) * 0x9E3779B97F4A7C15 % 2**64)
    side = (flat.mix(level.names ^ salt) & np.uint64(1)).astype(np.int8)
    side[level.lengths() > LONGEST] = 2
    joined = np.zeros(len(side), bool)
    joined[1:] = (side[:-1] == 0) & (side[1:] == 1) & ~level.is_first[1:]
    names = level.names.copy()
    second = np.flatnonzero(joined)
    names[second - 1] = flat.mix(level.names[second - 1] * np.uint64(5) + flat.mix(level.names[second] + salt))
    return _named(level, ~joined, names), np.cumsum(~joined) - 1, side


def representatives(words: flat.Words, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and the name of the symbol that represents each."""
    n = len(words)
    spans = np.diff(words.first)
    starts = np.flatnonzero(np.arange(n) + window <= np.repeat(words.first[1:], spans))
    is_first = np.zeros(n, bool)
    is_first[words.first[:-1][spans > 0]] = True
    level = Level(words.names, np.arange(n), n, is_first)
    low, high = starts.copy(), starts + window  # between them lie the symbols that the window alone decides
    names = level.names[starts] if n else level.names
    for number in range(rounds):
        # The first and the last run may reach beyond the window.
        index = level.index_at()
        after, run_of = name_runs(level, number)
        ends = np.r_[after.start, n]
        alive = low < high
        first_run = run_of[index[np.where(alive, low, 0)]]
        before_high = index[np.where(alive, high, n)] - 1
        last_run = run_of[before_high]
        low = np.where(alive, ends[first_run + 1], low)
        high = np.where(alive, ends[last_run], high)
        level = after
        # A right symbol at the start and a left one at the end may have joined a symbol beyond.
        index = level.index_at()
        after, _, side = name_pairs(level, number)
        alive = low < high
        begin, bound = level.start, np.r_[level.start, n]
        at_low = np.where(alive, index[np.where(alive, low, 0)], 0)
        at_high = np.where(alive, index[np.where(alive, high, n)] - 1, 0)
        low = np.where(alive & (side[at_low] == 1), bound[at_low + 1], low)
        high = np.where(alive & (side[at_high] == 0), begin[at_high], high)
        level = after
        alive = low < high
        index = level.index_at()
        salt = np.uint64((number + 1) * 0xD1342543DE82EF95 % 2**64)
        names = np.where(alive, flat.mix(level.names[index[np.where(alive, low, 0)] % max(1, len(level.names))] + salt), names)
    return starts, names


def _in_several_ids(names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names, which one each is, and the least id of each distinct name, with whether there is a greater one."""
    distinct, which = np.unique(names, return_inverse=True)
    least = np.full(len(distinct), flat.NO_ID)
    most = np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(least, which, ids)
    np.maximum.at(most, which, ids)
    return distinct, which, np.stack([least, most])


class Windows:
    def __init__(self, table: pa.Table):
        self.block = blocks.Block(table)
        self.words = flat.Words(self.block.texts.data, self.block.texts.at)
        self.id_of_word = np.repeat(self.block.ids, np.diff(self.words.first))


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """id, n_words, n_removed and the kept words, joined by one space, of every document."""
    split, n_buckets = blocks.split(docs, doc_id, text)

    def ask(table: pa.Table) -> pa.Table:
        w = Windows(table)
        _, names = representatives(w.words, window)
        found, _ = blocks.short_names(names, n_buckets)
        return blocks.question(w.block.number, found >> np.uint64(32), (found & np.uint64(0xFFFFFFFF)).astype(np.uint32))

    def ask_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blocks.question(0, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        w = Windows(table)
        starts, names = representatives(w.words, window)
        found, which = blocks.short_names(names, n_buckets)
        starts = starts[blocks.shared_bits(found, replies)[which]]
        digests = flat.Sums(w.words.names).span(starts, starts + window)
        order = np.lexsort((w.id_of_word[starts], digests, blocks.per_bucket(digests, n_buckets)[0]))
        digests, ids = digests[order], w.id_of_word[starts][order]
        once = np.r_[True, digests[1:] != digests[:-1]] if len(digests) else np.zeros(0, bool)
        return blocks.question(w.block.number, blocks.per_bucket(digests, n_buckets)[0][once], digests[once], ids[once])

    def drop(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"id": [], "n_words": [], "n_removed": [], "kept": []}).cast(_SCHEMA)
        w = Windows(table)
        n = len(w.words)
        starts = np.flatnonzero(np.arange(n) + window <= np.repeat(w.words.first[1:], np.diff(w.words.first)))
        digests = flat.Sums(w.words.names).span(starts, starts + window)
        earlier = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in replies["answer"].to_pylist())])
        # Inside the block, all but the least id of a window lose it too.
        distinct, which, ends = _in_several_ids(digests, w.id_of_word[starts])
        lost = np.isin(distinct, earlier)[which] | (w.id_of_word[starts] > ends[0][which])
        gone = flat.covered(n, starts[lost], window)
        data, kept = w.block.texts.data.tobytes(), []
        for a, b in zip(w.words.first[:-1], w.words.first[1:], strict=True):
            left = np.flatnonzero(~gone[a:b]) + a
            kept.append(b" ".join(data[s:e] for s, e in zip(w.words.start[left], w.words.end[left], strict=True)))
        totals = np.r_[0, np.cumsum(gone)]
        return pa.table(
            {
                "id": w.block.table["id"],
                "n_words": pa.array(np.diff(w.words.first).astype(np.int64)),
                "n_removed": pa.array((totals[w.words.first[1:]] - totals[w.words.first[:-1]]).astype(np.int64)),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    asked = split.groupBy("block").applyInArrow(ask, blocks.ASKED)
    shared = blocks.in_several_blocks(asked)
    candidates = blocks.with_answers(split, shared, ask_windows, blocks.ASKED)
    earlier = blocks.in_earlier_ids(candidates)
    return blocks.with_answers(split, earlier, drop, RESULT)


_SCHEMA = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
