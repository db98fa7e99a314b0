"""Lexical retrieval packing: training sequences filled with documents that are about the same things.

Documents become token ids with an end id. The ids serve as terms of a BM25 index: their document frequencies are counted
over all documents, one number for each entry of the vocabulary. Every document gets a signature, the terms that two
draws weighted by rarity select, so documents with much in common tend to have it in common too. Documents are sorted by
signature into ranges, and a range is taken in shards of about SHARD_TOKENS tokens, each with an inverted index. A shard
packs window by window: a seed queries the index, and the unused documents with the highest scores fill the window. The
document that reaches beyond the window's end is cut there, and its rest is the next seed; else the next seed is the next
unused document. What a shard leaves open goes on in the next shard of the range. So windows are full; the last tokens of
a range go into sequences whose lengths are powers of two, which need no padding either.

A null text is empty and has the end id alone. Repeated rows are packed one by one, and copies spread over as many ranges
as their tokens need. A document longer than a window takes windows of its own and joins a shard with its rest. An empty
table gives an empty result. Strings that spell a special token are ordinary text. Columns beside the named ones are not
read. The ranges are drawn from a sample when the result is computed: every result is one packing, and one that is to be
read twice should be written first.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import flat, rows

WINDOW = 4096
END_ID = 2
K1, B = 1.2, 0.75
SHARD_TOKENS = 1 << 19
RANGE_TOKENS = 4 << 20
SLICE_BYTES = 4 << 20
# A task's memory of encoded pieces starts anew beyond this number.
MEMORY = 1 << 19

# Between these classes of neighbouring bytes no token of the pre-tokenizer reaches over: blank, Latin letter, digit, other
# ASCII punctuation. The last class, apostrophes and everything else, is never cut from its neighbours.
BLANK, LETTER, DIGIT, MARK, STICKY = range(5)
KIND = np.full(256, STICKY, np.uint8)
KIND[[0x20, 0x09, 0x0A, 0x0D]] = BLANK
for _b in range(0x21, 0x7F):
    KIND[_b] = LETTER if chr(_b).isalpha() else DIGIT if chr(_b).isdigit() else STICKY if chr(_b) == "'" else MARK
APART = np.zeros((5, 5), bool)
APART[BLANK] = APART[:, BLANK] = True
for _a in (LETTER, DIGIT, MARK):
    for _c in (LETTER, DIGIT, MARK):
        APART[_a, _c] = _a != _c or _a == DIGIT
# U+00C0 to U+027F are letters, two bytes each, but for the signs of multiplication and division. The capital I with a dot
# has two code points in lower case, of which one is no letter.
FIRST_LEAD, LAST_LEAD = 0xC3, 0xC9
NO_LETTER = (0xC397, 0xC3B7, 0xC4B0)


def kinds(data: np.ndarray) -> np.ndarray:
    found = KIND[data]
    lead = np.flatnonzero((data >= FIRST_LEAD) & (data <= LAST_LEAD))
    lead = lead[lead + 1 < len(data)]
    pair = data[lead].astype(np.uint16) << 8 | data[lead + 1]
    lead = lead[~np.isin(pair, NO_LETTER)]
    found[lead] = found[lead + 1] = LETTER
    return found


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, but for those before a byte beyond ASCII, which may belong to an accent."""
    capital = (data >= 0x41) & (data <= 0x5A)
    capital[:-1] &= data[1:] < 0x80
    return data + 32 * capital.astype(np.uint8)


# How byte-level vocabularies write the bytes that are no printable character of Latin-1.
BYTES = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE))}


class Memory:
    """Rows of names, in two tables of slots; a name that finds both of its slots taken displaces the second's."""

    BITS = 20

    def __init__(self):
        self.names = np.zeros((2, 1 << self.BITS), np.uint64)
        self.rows = np.full((2, 1 << self.BITS), -1, np.int32)

    def _slot(self, names: np.ndarray, table: int) -> np.ndarray:
        return (names >> np.uint64(44 if table == 0 else 20)) & np.uint64((1 << self.BITS) - 1)

    def find(self, names: np.ndarray) -> np.ndarray:
        """The row of each name, -1 if it is not known."""
        slot = self._slot(names, 0)
        found = np.where(self.names[0][slot] == names, self.rows[0][slot], -1)
        missing = np.flatnonzero(found < 0)
        slot = self._slot(names[missing], 1)
        found[missing] = np.where(self.names[1][slot] == names[missing], self.rows[1][slot], -1)
        return found

    def put(self, names: np.ndarray, rows: np.ndarray) -> None:
        slot = self._slot(names, 0)
        free = self.rows[0][slot] < 0
        self.names[0][slot[free]], self.rows[0][slot[free]] = names[free], rows[free]
        left = self.names[0][slot] != names
        slot = self._slot(names[left], 1)
        self.names[1][slot], self.rows[1][slot] = names[left], rows[left]


class Encoder:
    """Token ids of texts, by pieces that can be encoded one by one; a piece that comes again is remembered."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = True
        self.tokenize = self.tokenizer.model.tokenize
        self._forget()

    def _forget(self) -> None:
        self.memory = Memory()
        self.at, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, names: np.ndarray, pieces: list[bytes], letters: list[bool]) -> None:
        """letters: which pieces are Latin letters only. Such a piece is one token of the pre-tokenizer, so the model
        gets it as the vocabulary writes its bytes."""
        tokenize = self.tokenize
        coded: list = [
            [t.id for t in tokenize(p.decode().lower() if p.isascii() else p.decode().lower().encode().decode("latin-1").translate(BYTES))]
            if plain
            else p.decode()
            for p, plain in zip(pieces, letters, strict=True)
        ]
        others = [k for k, plain in enumerate(letters) if not plain]
        for k, found in zip(others, self.tokenizer.encode_batch([coded[k] for k in others], add_special_tokens=False), strict=True):
            coded[k] = found.ids
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        self.memory.put(names, np.arange(len(self.sizes), len(self.sizes) + len(names), dtype=np.int32))
        self.at = np.r_[self.at, len(self.ids) + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.ids = np.r_[self.ids, np.fromiter((i for x in coded for i in x), np.uint32, int(sizes.sum()))]

    def encode(self, texts: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by END_ID, and where each text's begin."""
        data = lowered(texts.data)
        kind = kinds(data)
        cut = np.ones(len(kind) + 1, bool)
        if len(kind):
            cut[1:-1] = APART.ravel()[kind[:-1] * np.uint8(5) + kind[1:]]
        cut[texts.at] = True
        borders = np.flatnonzero(cut)
        start, end = borders[:-1], borders[1:]
        held = kind[start] != BLANK
        start, end = start[held], end[held]
        names = flat.Sums(flat.BYTE_VALUE[data]).span(start, end)
        if len(self.sizes) > MEMORY:
            self._forget()
        row = self.memory.find(names)
        new = np.flatnonzero(row < 0)
        if len(new):
            distinct, first, which = np.unique(names[new], return_index=True, return_inverse=True)
            row[new] = len(self.sizes) + which
            first = new[first]
            sticky = np.r_[0, np.cumsum(kind != LETTER)]
            letters = sticky[end[first]] == sticky[start[first]]
            whole = data.tobytes()
            pieces = [whole[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
            self._learn(distinct, pieces, letters.tolist())
        at, sizes = self.at[row], self.sizes[row]
        first_piece = np.searchsorted(start, texts.at)
        before = np.r_[0, np.cumsum(sizes)]
        begins = before[first_piece] + np.arange(len(texts) + 1)
        out = np.full(int(begins[-1]), END_ID, np.uint32)
        own = np.ones(len(out), bool)
        own[begins[1:] - 1] = False
        out[own] = self.ids[np.arange(before[-1]) + np.repeat(at - before[:-1], sizes)]
        return out, begins


def _tokens(docs: DataFrame, doc_id: str, text: str, tokenizer: str, kind: str) -> DataFrame:
    """id, ids (little-endian, as wide as the vocabulary needs) of every document."""
    held = docs.sparkSession.sparkContext.broadcast(tokenizer)
    named = docs.select(F.col(doc_id).alias("id"), rows.whole(text).alias("text"))
    schema = f"id {named.schema['id'].dataType.simpleString()}, ids binary"

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        for batch in batches:
            for part in flat.parts(pa.Table.from_batches([batch]), "text", SLICE_BYTES):
                ids, at = encoder.encode(flat.Texts(part["text"]))
                ids = ids.astype(kind)
                coded = pa.array([ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield from pa.table({"id": part["id"], "ids": coded}).to_batches()

    return named.mapInArrow(tokenised, schema)


def _unpacked(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    texts = flat.Texts(column)
    return texts.data.view(kind), texts.at // np.dtype(kind).itemsize


def _counts(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, document, occurrences), ordered by id and document; the ids come document by document."""
    order = np.argsort(ids, kind="stable")
    ids, doc = ids[order], doc[order]
    first = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (doc[1:] != doc[:-1])]) if len(ids) else order
    return ids[first], doc[first], np.diff(np.r_[first, len(ids)])


def _frequencies(tokens: DataFrame, n_terms: int, kind: str) -> tuple[np.ndarray, int, int]:
    """Documents of each id of the vocabulary, the number of documents and of tokens."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for part in flat.parts(pa.Table.from_batches([batch]), "ids", SLICE_BYTES):
                ids, at = _unpacked(part["ids"], kind)
                term, _, _ = _counts(ids, np.repeat(np.arange(len(part)), np.diff(at)))
                total += np.bincount(term, minlength=n_terms)
        term = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(term.astype(np.int64)), "n": pa.array(total[term])})

    found = tokens.select("ids").mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(n_terms, np.int64)
    for row in found:
        frequency[row["term"]] = row["n"]
    size = F.octet_length("ids") / np.dtype(kind).itemsize
    n_docs, n_tokens = tokens.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).head()
    return frequency, n_docs, n_tokens or 0


def _draws(idf: np.ndarray) -> list[np.ndarray]:
    """For each draw, the order in which terms are selected; a term's chance to come first grows with its idf."""
    found = []
    for seed in (1, 2):
        chance = (flat.mix(np.arange(1, len(idf) + 1, dtype=np.uint64) * np.uint64(flat.BASE) + np.uint64(seed)) >> np.uint64(11)) + np.uint64(1)
        with np.errstate(divide="ignore"):
            when = np.where(idf > 0, -np.log(chance / 2.0**53) / idf, np.inf)
        rank = np.empty(len(idf), np.int32)
        rank[np.lexsort((np.arange(len(idf)), when))] = np.arange(len(idf))
        found.append(rank)
    return found


class Shard:
    """Documents (at most a window each) with an inverted index whose postings hold BM25 weights."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, idf: np.ndarray, mean: float):
        sizes = np.diff(at)
        told = idf[ids] > 0
        term, self.doc, n = _counts(ids[told], np.repeat(np.arange(len(sizes)), sizes)[told])
        self.weight = idf[term] * n * (K1 + 1) / (n + K1 * (1 - B + B * sizes[self.doc] / mean))
        self.starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        self.ends = np.r_[self.starts[1:], len(term)]
        row = np.repeat(np.arange(len(self.starts)), self.ends - self.starts)
        by_doc = np.argsort(self.doc, kind="stable")
        self.row, self.first = row[by_doc], np.searchsorted(self.doc[by_doc], np.arange(len(sizes) + 1))
        self.unused = np.ones(len(sizes), bool)

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents, the highest score first."""
        lists = self.row[self.first[seed] : self.first[seed + 1]]
        starts, sizes = self.starts[lists], (self.ends - self.starts)[lists]
        places = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        scores = np.bincount(self.doc[places], self.weight[places], len(self.unused))
        left = np.flatnonzero(self.unused)
        return left[np.argsort(-scores[left], kind="stable")]


class Packer:
    """Fills windows; pieces are (document, start, length, sequence, offset)."""

    def __init__(self, number: int, window: int):
        self.window, self.sequence, self.fill = window, number, 0
        self.open: list[tuple[int, int, int]] = []
        self.pieces: list[tuple[int, int, int, int, int]] = []

    def put(self, doc: int, start: int, length: int) -> int:
        """Add as much of a document as the window takes; the number of tokens added."""
        taken = min(length, self.window - self.fill)
        self.open.append((doc, start, taken))
        self.fill += taken
        if self.fill == self.window:
            self._close(self.window)
        return taken

    def _close(self, length: int) -> None:
        """Make a sequence of the first tokens of the open window."""
        offset = 0
        while offset < length:
            doc, start, size = self.open.pop(0)
            taken = min(size, length - offset)
            self.pieces.append((doc, start, taken, self.sequence, offset))
            offset += taken
            if taken < size:
                self.open.insert(0, (doc, start + taken, size - taken))
        self.fill -= length
        self.sequence += 1

    def finish(self) -> None:
        """Sequences whose lengths are powers of two, for what the open window holds."""
        while self.fill:
            self._close(1 << (self.fill.bit_length() - 1))


def _packed(
    batches: Iterator[pa.RecordBatch], kind: str, idf: np.ndarray, mean: float, window: int, shard_tokens: int
) -> Iterator[pa.RecordBatch]:
    packer = Packer(TaskContext.get().partitionId() << 40, window)
    held: list[tuple[object, np.ndarray]] = []  # id and tokens of documents whose pieces are not all out
    rests: list[tuple[int, int]] = []  # document and start of what a shard is to pack
    waiting = 0

    def shard_packed() -> None:
        if not rests:
            return
        parts = [held[d][1][start:] for d, start in rests]
        at = np.r_[0, np.cumsum([len(x) for x in parts])]
        shard = Shard(np.concatenate(parts), at, idf, mean)
        following, cut = 0, None
        while True:
            if cut is None:
                while following < len(rests) and not shard.unused[following]:
                    following += 1
                if following == len(rests):
                    return
                seed, done = following, 0
                shard.unused[seed] = False
            else:
                seed, done = cut
            doc, start = rests[seed]
            cut, at_first = None, packer.sequence
            taken = packer.put(doc, start + done, len(parts[seed]) - done)
            if taken < len(parts[seed]) - done:
                cut = (seed, done + taken)
            if packer.sequence > at_first:
                continue
            for k in shard.neighbours(seed).tolist():
                shard.unused[k] = False
                doc, start = rests[k]
                taken = packer.put(doc, start, len(parts[k]))
                if packer.sequence > at_first:
                    cut = (k, taken) if taken < len(parts[k]) else None
                    break

    def out() -> Iterator[pa.RecordBatch]:
        """The finished pieces; documents with open ones are kept."""
        nonlocal held, rests
        names = ["doc", "start", "length", "sequence_id", "offset"]
        columns = dict(zip(names, zip(*packer.pieces, strict=True), strict=True)) if packer.pieces else {n: () for n in names}
        docs = columns["doc"]
        yield pa.record_batch(
            {
                "id": pa.array([held[d][0] for d in docs], kinds),
                "start": pa.array(columns["start"], pa.int64()),
                "length": pa.array(columns["length"], pa.int64()),
                "ids": pa.array([held[d][1][a : a + n].astype("<u4").tobytes() for d, a, n in zip(docs, columns["start"], columns["length"], strict=True)], pa.binary()),
                "doc_tokens": pa.array([len(held[d][1]) for d in docs], pa.int64()),
                "sequence_id": pa.array(columns["sequence_id"], pa.int64()),
                "offset": pa.array(columns["offset"], pa.int64()),
            }
        )
        staying = sorted({d for d, _, _ in packer.open})
        number = {d: k for k, d in enumerate(staying)}
        held = [held[d] for d in staying]
        packer.open = [(number[d], a, n) for d, a, n in packer.open]
        packer.pieces, rests = [], []

    kinds = None
    for batch in batches:
        kinds = batch.schema.field("id").type
        for part in flat.parts(pa.Table.from_batches([batch]), "ids", SLICE_BYTES):
            ids, at = _unpacked(part["ids"], kind)
            for k, doc_id in enumerate(part["id"].to_pylist()):
                tokens = ids[at[k] : at[k + 1]]
                held.append((doc_id, tokens))
                whole = len(tokens) // window * window
                for start in range(0, whole, window):  # windows of its own
                    packer.pieces.append((len(held) - 1, start, window, packer.sequence, 0))
                    packer.sequence += 1
                if whole < len(tokens):
                    rests.append((len(held) - 1, whole))
                waiting += len(tokens)
                if waiting >= shard_tokens:
                    shard_packed()
                    yield from out()
                    waiting = 0
    shard_packed()
    packer.finish()
    if held:
        yield from out()


def pack(
    docs: DataFrame, tokenizer: str | Path, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset of every piece.

    tokenizer is the path of a vocabulary file, which the driver reads; executors get its content, some megabytes.
    """
    from tokenizers import Tokenizer

    spec = Path(tokenizer).read_text(encoding="utf-8")
    n_terms = Tokenizer.from_str(spec).get_vocab_size()
    kind = "<u2" if n_terms <= 1 << 16 else "<u4"
    tokens = rows.cut(_tokens(docs, doc_id, text, spec, kind))
    frequency, n_docs, n_tokens = _frequencies(tokens, n_terms, kind)
    idf = np.maximum(np.log((n_docs - frequency + 0.5) / (frequency + 0.5)), 0)
    idf[END_ID] = 0
    mean = n_tokens / max(n_docs, 1)
    told = docs.sparkSession.sparkContext.broadcast((idf, _draws(idf)))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = [np.argsort(rank) for rank in told.value[1]]
        for batch in batches:
            for part in flat.parts(pa.Table.from_batches([batch]), "ids", SLICE_BYTES):
                ids, at = _unpacked(part["ids"], kind)
                for name, rank, term in zip(("first", "second"), told.value[1], order, strict=True):
                    part = part.append_column(name, pa.array(term[np.minimum.reduceat(rank[ids], at[:-1])].astype(np.int32)))
                yield from part.to_batches()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(batches, kind, told.value[0], mean, window, shard_tokens)

    id_type = tokens.schema["id"].dataType.simpleString()
    keys = ["first", "second", "row"]
    placed = (
        tokens.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(signed, f"id {id_type}, ids binary, row long, first int, second int")
        .repartitionByRange(n_tokens // RANGE_TOKENS + 1, *keys)
        .sortWithinPartitions(*keys)
    )
    return placed.select("id", "ids").mapInArrow(
        packed, f"id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
