"""Source divergence audit: how far the term use of the sources of a group lies apart.

Terms that enough documents of a group (a language) hold are found by iceberg prefix refinement. Documents are taken in
slices of about SLICE_BYTES; a slice keeps, for each of its terms, which of its documents hold it. In each round every slice
counts its documents for each byte prefix of the round's length, the counts of the slices are added, and prefixes below
the threshold are discarded; only terms under a prefix that is left are looked at in the next round, with LONGER times the
length. A term that ends within the length is complete and is kept if its own count reaches the threshold. So the long
tail of rare terms is never counted term by term. What slices exchange is one row for each slice and bucket of the
prefixes, packed; there are never more rows than prefixes alive in a slice.

Each source has a smoothed share p of every kept term of its group, in whole parts of 10**9. Sources are compared in tiles
of TILE by TILE sources over the terms of a bucket, so that a task holds a bounded matrix however many sources or terms
there are; sources that lack a term count with their least share.

Null text, group and source are read as ''. Repeated rows count each; a group without kept terms gives its pairs with value 0;
an empty table gives an empty result. Texts of any length are read whole, in windows cut between terms. Columns beside
the named ones are not read. Within a slice terms are told apart by 64-bit digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm import flat, rows

LEAST_DOCS = 10
TERMS_SHOWN = 10
SHARE = 1_000_000_000
FIRST_BYTES, LONGER = 4, 3
SLICE_BYTES = 16 << 20
WINDOW_BYTES = 4 << 20
BUCKET_BYTES = 48 << 20
TILE = 64
END = b"\0"

# Terms are runs of letters and of bytes beyond ASCII; only A-Z are lower-cased.
IS_TERM = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

SLICE = (
    "slice long, lang string, n_docs int, terms array<binary>, at binary, docs binary, "
    "sources array<string>, use_at binary, use_term binary, use_n binary"
)
ASKED = "slice long, lang string, bucket long, keys array<binary>, n binary"
ANSWERED = "slice long, lang string, keys array<binary>, n_open long"
USED = "slice long, lang string, bucket long, terms array<binary>, sources array<string>, use_at binary, use_term binary, use_n binary"
COUNTED = "lang string, source string, term string, bucket long, number int, n long, in_lang long"


def _small(x: np.ndarray) -> bytes:
    """Numbers as bytes, as narrow as they allow."""
    most = int(x.max()) if len(x) else 0
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max)).tobytes()


def _wide(x: bytes, count: int) -> np.ndarray:
    return np.frombuffer(x, f"<u{len(x) // count}" if count else np.uint8).astype(np.int64)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _windows(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about WINDOW_BYTES that end between terms or texts."""
    start, end = 0, len(data)
    while start < end:
        stop = min(start + WINDOW_BYTES, end)
        while stop < end and IS_TERM[data[stop - 1]] and IS_TERM[data[stop]]:
            border = int(at[np.searchsorted(at, stop)])
            outside = np.flatnonzero(~IS_TERM[data[stop : min(border, stop + WINDOW_BYTES)]])
            if border == stop:
                break
            stop = stop + int(outside[0]) if len(outside) else min(border, stop + WINDOW_BYTES)
            if stop == border:
                break
        yield start, stop
        start = stop


class Slice:
    """Terms of some documents, gathered batch by batch."""

    def __init__(self):
        self.size, self.n_docs = 0, 0
        self.names: list[np.ndarray] = []  # distinct terms of each window
        self.terms: list[np.ndarray] = []  # each word's place among these
        self.docs: list[np.ndarray] = []
        self.langs: list[str] = []
        self.sources: list[str] = []
        self.bytes_of: dict[int, bytes] = {}

    def add(self, batch: pa.Table) -> None:
        texts = flat.Texts(batch["text"])
        for start, stop in _windows(texts.data, texts.at):
            data = LOWER[texts.data[start:stop]]
            words = flat.Words(data, np.clip(texts.at, start, stop) - start, IS_TERM)
            if not len(words):
                continue
            blob = data.tobytes()
            names, first, which = np.unique(words.names, return_index=True, return_inverse=True)
            for name, a, b in zip(names.tolist(), words.start[first].tolist(), words.end[first].tolist(), strict=True):
                if name not in self.bytes_of:
                    self.bytes_of[name] = blob[a:b]
            self.names.append(names)
            self.terms.append(which.astype(np.int32))
            self.docs.append((words.text_of() + self.n_docs).astype(np.int32))
        self.size += int(texts.at[-1])
        self.n_docs += len(texts)
        self.langs += batch["lang"].to_pylist()
        self.sources += batch["source"].to_pylist()

    def rows(self, number: int) -> Iterator[pa.Table]:
        """One row for each language that has terms."""
        if not self.names:
            return
        names, which = np.unique(np.concatenate(self.names), return_inverse=True)
        listed = [self.bytes_of[x] for x in names.tolist()]
        order = sorted(range(len(listed)), key=listed.__getitem__)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        which = rank[which].astype(np.int32)
        starts = np.cumsum([0, *map(len, self.names)])
        term = np.concatenate([which[a + t] for a, t in zip(starts, self.terms, strict=False)])
        docs = np.concatenate(self.docs)
        self.terms.clear(), self.docs.clear(), self.bytes_of.clear()
        langs, lang_of = np.unique(np.array(self.langs, object), return_inverse=True)
        sources, source_of = np.unique(np.array(self.sources, object), return_inverse=True)
        for k, lang in enumerate(langs):
            mine = np.flatnonzero(lang_of == k)
            local = np.full(self.n_docs, -1, np.int64)
            local[mine] = np.arange(len(mine))
            chosen = local[docs] >= 0
            if not chosen.any():
                continue
            present = np.bincount(term[chosen], minlength=len(listed)) > 0
            held, place = np.flatnonzero(present), np.cumsum(present) - 1
            pairs = place[term[chosen]] * len(mine) + local[docs[chosen]]
            pairs.sort()
            first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
            n, pairs = np.diff(np.r_[first, len(pairs)]), pairs[first]
            pair_term, pair_doc = pairs // len(mine), pairs % len(mine)
            by = source_of[mine][pair_doc] * len(held) + pair_term
            into = np.argsort(by, kind="stable")
            starts = np.flatnonzero(np.r_[True, by[into][1:] != by[into][:-1]])
            used = by[into][starts]
            yield pa.table(
                {
                    "slice": pa.array([number], pa.int64()),
                    "lang": pa.array([lang], pa.string()),
                    "n_docs": pa.array([len(mine)], pa.int32()),
                    "terms": pa.array([[listed[order[x]] for x in held.tolist()]], pa.list_(pa.binary())),
                    "at": pa.array([_small(np.searchsorted(pair_term, np.arange(len(held) + 1)))], pa.binary()),
                    "docs": pa.array([_small(pair_doc)], pa.binary()),
                    "sources": pa.array([list(sources)], pa.list_(pa.string())),
                    "use_at": pa.array([_small(np.searchsorted(used, np.arange(len(sources) + 1) * len(held)))], pa.binary()),
                    "use_term": pa.array([_small(used % len(held))], pa.binary()),
                    "use_n": pa.array([_small(np.add.reduceat(n[into], starts))], pa.binary()),
                }
            )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held = TaskContext.get().partitionId() << 32, Slice()
    for batch in batches:
        for part in flat.parts(pa.Table.from_batches([batch]), "text", SLICE_BYTES):
            held.add(part)
            if held.size >= SLICE_BYTES:
                for made in held.rows(number):
                    yield from made.to_batches()
                number, held = number + 1, Slice()
    for made in held.rows(number):
        yield from made.to_batches()


def key_of(term: bytes, length: int) -> bytes:
    """The prefix of a length; a term that is shorter is complete and ends with END, which no term contains."""
    return term[:length] if len(term) >= length else term + END


def _buckets(keys: pa.Array, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order of the keys by bucket, and the buckets with the starts and ends of their keys in it."""
    bucket = (flat.Texts(keys).digests() >> np.uint64(8)) % np.uint64(n_buckets)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0]) if len(order) else np.zeros(0, np.int64)
    return order, bucket[order][starts].astype(np.int64), starts, np.r_[starts[1:], len(order)].astype(np.int64)


def _lists(values: pa.Array, starts: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """values[start:end] of each pair; the pairs follow each other."""
    return pa.ListArray.from_arrays(pa.array(np.r_[starts, ends[-1:]].astype(np.int32)) if len(starts) else pa.array([0], pa.int32()), values)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks().flatten()


def _asked(row: pa.Table, length: int, alive: set[bytes] | None, before: int, n_buckets: int) -> pa.Table:
    """Documents of a slice for each prefix of a length whose shorter prefix is alive, packed by bucket."""
    terms, n_docs = _flat(row["terms"]).to_pylist(), row["n_docs"][0].as_py()
    at = _wide(row["at"][0].as_py(), len(terms) + 1)
    docs = _wide(row["docs"][0].as_py(), int(at[-1]))
    chosen = [k for k, t in enumerate(terms) if alive is None or key_of(t, before) in alive]
    keys: list[bytes] = []
    number = np.empty(len(chosen), np.int64)
    for i, k in enumerate(chosen):
        key = key_of(terms[k], length)
        if not keys or keys[-1] != key:
            keys.append(key)
        number[i] = len(keys) - 1
    here = np.array(chosen, np.int64)
    sizes = (at[1:] - at[:-1])[here]
    n = np.bincount(number, sizes, len(keys)).astype(np.int64)
    # Only where several terms share a prefix can a document come more than once.
    several = np.bincount(number, minlength=len(keys))[number] > 1
    held = docs[_ranges(at[:-1][here[several]], sizes[several])]
    pairs = _distinct(np.repeat(number[several], sizes[several]) * n_docs + held)
    n[number[several]] = np.bincount(pairs // max(n_docs, 1), minlength=len(keys))[number[several]]
    listed = pa.array(keys, pa.binary())
    order, buckets, starts, ends = _buckets(listed, n_buckets)
    n = n[order]
    return pa.table(
        {
            "slice": pa.repeat(row["slice"][0], len(buckets)),
            "lang": pa.repeat(row["lang"][0], len(buckets)),
            "bucket": pa.array(buckets, pa.int64()),
            "keys": _lists(listed.take(pa.array(order)), starts, ends),
            "n": pa.array([_small(n[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary()),
        }
    )


def _answered(bucket: pa.Table, least: int) -> pa.Table:
    """The keys of each slice that enough documents of all slices hold."""
    sizes = bucket["keys"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    keys = _flat(bucket["keys"])
    n = np.concatenate([_wide(x.as_py(), k) for x, k in zip(bucket["n"], sizes.tolist(), strict=True)])
    coded = keys.dictionary_encode()
    which = coded.indices.to_numpy()
    alive = (np.bincount(which, n, len(coded.dictionary)) >= least)[which]
    is_open = alive & ~pc.ends_with(keys.cast(pa.large_binary()), END).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    counts = np.bincount(row[alive], minlength=len(sizes))
    ends = np.cumsum(counts)
    return pa.table(
        {
            "slice": bucket["slice"],
            "lang": bucket["lang"],
            "keys": _lists(keys.filter(pa.array(alive)), ends - counts, ends),
            "n_open": pa.array(np.bincount(row[is_open], minlength=len(sizes)).astype(np.int64)),
        }
    )


def _none(schema: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({c: pa.array([], kind) for c, kind in schema.items()})


ASKED_KINDS = {"slice": pa.int64(), "lang": pa.string(), "bucket": pa.int64(), "keys": pa.list_(pa.binary()), "n": pa.binary()}
USED_KINDS = {
    "slice": pa.int64(), "lang": pa.string(), "bucket": pa.int64(), "terms": pa.list_(pa.binary()),
    "sources": pa.list_(pa.string()), "use_at": pa.binary(), "use_term": pa.binary(), "use_n": pa.binary(),
}


def _refined(slices: DataFrame, least: int, n_buckets: int) -> list[DataFrame]:
    """What every round answers to the slices; the complete keys in it are the kept terms."""
    slices = slices.select("slice", "lang", "n_docs", "terms", "at", "docs")
    rounds: list[DataFrame] = []
    length = FIRST_BYTES
    while True:

        def first(batches: Iterator[pa.RecordBatch], length: int = length) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(len(batch)):
                    yield from _asked(pa.Table.from_batches([batch.slice(k, 1)]), length, None, 0, n_buckets).to_batches()

        def later(row: pa.Table, replies: pa.Table) -> pa.Table:
            alive = {k for k in _flat(replies["keys"]).to_pylist() if not k.endswith(END)} if len(replies) else set()
            if not len(row) or not alive:
                return _none(ASKED_KINDS)
            return _asked(row, length, alive, length // LONGER, n_buckets)

        def answer(bucket: pa.Table) -> pa.Table:
            return _answered(bucket, least)

        if not rounds:
            asked = slices.mapInArrow(first, ASKED)
        else:
            replies = rounds[-1].where("n_open > 0").groupBy("slice", "lang")
            asked = slices.groupBy("slice", "lang").cogroup(replies).applyInArrow(later, ASKED)
        rounds.append(rows.cut(asked.groupBy("lang", "bucket").applyInArrow(answer, ANSWERED)))
        if not rounds[-1].agg(F.sum("n_open")).head()[0]:
            return rounds
        length *= LONGER


def _used(row: pa.Table, replies: pa.Table, n_buckets: int) -> pa.Table:
    """Occurrences in a slice of each source's kept terms, packed by bucket of the terms."""
    if not len(row) or not len(replies):
        return _none(USED_KINDS)
    terms = _flat(row["terms"])
    kept = pa.array([k[:-1] for k in _flat(replies["keys"]).to_pylist() if k.endswith(END)], pa.binary())
    chosen = np.flatnonzero(pc.is_in(terms, kept).to_numpy(zero_copy_only=False))
    order, buckets, starts, ends = _buckets(terms.take(pa.array(chosen)), n_buckets)
    terms = terms.take(pa.array(chosen[order]))
    place = np.full(len(_flat(row["terms"])), -1, np.int64)
    place[chosen[order]] = np.arange(len(order))
    at = _wide(row["use_at"][0].as_py(), len(_flat(row["sources"])) + 1)
    n_uses, n_sources = int(at[-1]), len(at) - 1
    term = place[_wide(row["use_term"][0].as_py(), n_uses)]
    n = _wide(row["use_n"][0].as_py(), n_uses)
    source = np.repeat(np.arange(n_sources), np.diff(at))
    source, term, n = (x[term >= 0] for x in (source, term, n))
    into = np.argsort(np.searchsorted(ends, term, side="right"), kind="stable")  # by bucket, then by source
    source, term, n = source[into], term[into], n[into]
    cuts = np.searchsorted(np.searchsorted(ends, term, side="right"), np.arange(len(buckets) + 1))
    out: dict[str, list] = {"use_at": [], "use_term": [], "use_n": []}
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        out["use_at"].append(_small(np.searchsorted(source[a:b], np.arange(n_sources + 1))))
        out["use_term"].append(_small(term[a:b] - starts[k]))
        out["use_n"].append(_small(n[a:b]))
    return pa.table(
        {
            "slice": pa.repeat(row["slice"][0], len(buckets)),
            "lang": pa.repeat(row["lang"][0], len(buckets)),
            "bucket": pa.array(buckets, pa.int64()),
            "terms": _lists(terms, starts, ends),
            "sources": row["sources"].combine_chunks().take(pa.array([0] * len(buckets), pa.int64())),
            **{c: pa.array(values, pa.binary()) for c, values in out.items()},
        }
    )


def _summed(bucket: pa.Table) -> pa.Table:
    """The occurrences of each source's terms over all slices; terms are numbered inside the bucket."""
    coded_terms, coded_sources = _flat(bucket["terms"]).dictionary_encode(), _flat(bucket["sources"]).dictionary_encode()
    term_at, source_at, keys, counts = 0, 0, [], []
    n_terms = len(coded_terms.dictionary)
    term_of, source_of = coded_terms.indices.to_numpy(), coded_sources.indices.to_numpy()
    for k in range(len(bucket)):
        here_terms, here_sources = len(bucket["terms"][k]), len(bucket["sources"][k])
        at = _wide(bucket["use_at"][k].as_py(), here_sources + 1)
        source = np.repeat(source_of[source_at : source_at + here_sources], np.diff(at)).astype(np.int64)
        keys.append(source * n_terms + term_of[term_at + _wide(bucket["use_term"][k].as_py(), int(at[-1]))])
        counts.append(_wide(bucket["use_n"][k].as_py(), int(at[-1])))
        term_at, source_at = term_at + here_terms, source_at + here_sources
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    starts = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    total, key = np.add.reduceat(n[order], starts), key[order][starts]
    term = key % n_terms
    in_lang = np.zeros(n_terms, np.int64)
    np.add.at(in_lang, term, total)
    return pa.table(
        {
            "lang": pa.repeat(bucket["lang"][0], len(key)),
            "source": coded_sources.dictionary.take(pa.array(key // n_terms)),
            "term": coded_terms.dictionary.take(pa.array(term)).cast(pa.string()),
            "bucket": pa.repeat(bucket["bucket"][0], len(key)),
            "number": pa.array(term.astype(np.int32)),
            "n": pa.array(total),
            "in_lang": pa.array(in_lang[term]),
        }
    )


def kept_terms(
    docs: DataFrame, text: str = "text", group: str = "lang", source: str = "source", least: int = LEAST_DOCS
) -> DataFrame:
    """lang, source, term and its occurrences there (n) and in the language (in_lang), of the terms that `least` documents
    of the language hold. Terms have a bucket and a number in the bucket."""
    named = docs.select(*(rows.whole(c).alias(n) for c, n in ((group, "lang"), (source, "source"), (text, "text"))))
    size = named.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_buckets = size // BUCKET_BYTES + 1
    slices = rows.cut(named.mapInArrow(_slices, SLICE))
    kept, *more = _refined(slices, least, n_buckets)
    for answers in more:
        kept = kept.union(answers)

    def used(row: pa.Table, replies: pa.Table) -> pa.Table:
        return _used(row, replies, n_buckets)

    uses = slices.select("slice", "lang", "terms", "sources", "use_at", "use_term", "use_n").groupBy("slice", "lang")
    packed = uses.cogroup(kept.groupBy("slice", "lang")).applyInArrow(used, USED)
    return packed.groupBy("lang", "bucket").applyInArrow(_summed, COUNTED)


def share(n: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(SHARE * (n + 2) / (total + 2 * n_terms)), exactly."""
    top = F.lit(SHARE).cast("decimal(10,0)") * (n.cast("decimal(19,0)") + 2)
    return 1 + F.call_function("div", top.cast("decimal(38,0)"), (total + 2 * n_terms).cast("decimal(38,0)"))


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q))."""
    return F.when(p + q > 0, F.call_function("div", (p - q) * (p - q), p + q)).otherwise(0)


def _tile_sums(group: pa.Table) -> pa.Table:
    """For the pairs of two tiles: the sum over the terms of a bucket that occur in them, and how many terms these are."""
    places, number, p = (group[c].to_numpy() for c in ("place", "number", "p"))
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    members = number < 0
    order = np.argsort(places[members])
    listed, least = places[members][order], p[members][order]
    used, term = np.unique(number[~members], return_inverse=True)
    shares = np.repeat(least[:, None], len(used), axis=1)
    shares[np.searchsorted(listed, places[~members]), term] = p[~members]
    left, right = np.flatnonzero(listed // TILE == low), np.flatnonzero(listed // TILE == high)
    u, v, sums = [], [], []
    for a in left.tolist():
        others = right[right > a]
        off = shares[others] - shares[a]
        sums.append((off * off // np.maximum(shares[others] + shares[a], 1)).sum(axis=1))
        u.append(np.full(len(others), listed[a], np.int64))
        v.append(listed[others])
    columns = {"u": u, "v": v, "value": sums}
    n_pairs = sum(map(len, u))
    return pa.table(
        {
            "lang": pa.repeat(group["lang"][0], n_pairs),
            **{c: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for c, x in columns.items()},
            "n_terms": pa.array(np.full(n_pairs, len(used), np.int64)),
        }
    )


def _pairs(members: DataFrame, shares: DataFrame) -> DataFrame:
    """lang, source, item, value of every two sources of a language.

    members: lang, source, n_terms, p of an absent term. shares: lang, source, bucket, number, p. Terms that neither source
    has add the same value each, so only their number is needed.
    """
    within = Window.partitionBy("lang")
    listed = rows.cut(
        members.select(
            "*",
            (F.row_number().over(within.orderBy("source")) - 1).cast("long").alias("place"),
            F.floor((F.count(F.lit(1)).over(within) - 1) / TILE).cast("long").alias("last_tile"),
        )
    )
    own = F.floor(F.col("place") / TILE).cast("long")
    tiles = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_tile"))).alias("tile")
    both = ("lang", F.least(own, "tile").alias("low"), F.greatest(own, "tile").alias("high"), "bucket", "place", "number", "p")
    first = shares.select("lang", "bucket").distinct()
    zero = listed.join(first, "lang").select("lang", "bucket", "place", F.lit(-1).alias("number"), "p", tiles).select(*both)
    placed = shares.join(listed.select("lang", "source", "place", "last_tile"), ["lang", "source"])
    placed = placed.select("lang", "bucket", "place", "number", "p", tiles).select(*both)
    sums = zero.union(placed).groupBy("lang", "low", "high", "bucket").applyInArrow(
        _tile_sums, "lang string, u long, v long, value long, n_terms long"
    )
    summed = sums.groupBy("lang", "u", "v").agg(F.sum("value").alias("value"), F.sum("n_terms").alias("counted"))
    one, two = (
        listed.select("lang", F.col("place").alias(c), F.col("source").alias(f"s_{c}"), F.col("p").alias(f"p_{c}"), F.col("n_terms").alias(f"n_{c}"))
        for c in ("u", "v")
    )
    # A language without kept terms has no bucket; its pairs have the value 0.
    bare = one.where("n_u = 0").join(two, "lang").where("u < v").select("lang", "s_u", "s_v", F.lit(0).cast("long").alias("value"))
    value = F.col("value") + (F.col("n_u") - F.col("counted")) * apart(F.col("p_u"), F.col("p_v"))
    whole = summed.join(one, ["lang", "u"]).join(two, ["lang", "v"]).select("lang", "s_u", "s_v", value.alias("value")).union(bare)
    ways = F.array(*(F.struct(F.col(f"s_{a}").alias("source"), F.col(f"s_{b}").alias("item")) for a, b in ("uv", "vu")))
    return whole.select("lang", "value", F.explode(ways).alias("way")).select("lang", "way.source", "way.item", "value")


def audit(
    docs: DataFrame, text: str = "text", group: str = "lang", source: str = "source", least: int = LEAST_DOCS,
    shown: int = TERMS_SHOWN,
) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part `pair` has the divergence of every other source of the language, part `term` the `shown` terms that the source
    uses most beyond the language as a whole. Rank is by value, then by the item's bytes.
    """
    counts = rows.cut(kept_terms(docs, text, group, source, least))
    in_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    term = counts.groupBy("lang", "bucket", "number").agg(F.max("in_lang").alias("n"))
    langs = term.groupBy("lang").agg(F.sum("n").alias("in_all"), F.count(F.lit(1)).alias("n_terms"))
    groups = docs.select(rows.whole(group).alias("lang"), rows.whole(source).alias("source")).distinct()
    least_share = F.when(F.col("n_terms") > 0, share(F.lit(0), F.col("total"), F.col("n_terms"))).otherwise(0)
    members = rows.cut(
        groups.join(in_source, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "in_all", "n_terms"])
        .withColumn("p", least_share)
    )
    shares = counts.join(members.drop("p"), ["lang", "source"]).select(
        "lang", "source", "term", "bucket", "number",
        share(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"),
        share(F.col("in_lang"), F.col("in_all"), F.col("n_terms")).alias("q"),
    )
    terms = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))).alias("rank")

    def ranked(part: str, found: DataFrame) -> DataFrame:
        return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank)

    pairs = _pairs(members, shares.select("lang", "source", "bucket", "number", "p"))
    return ranked("pair", pairs).union(ranked("term", terms).where(F.col("rank") <= shown))
