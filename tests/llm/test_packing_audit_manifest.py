"""Packing, source divergence audit and Merkle manifest against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from marquee.llm import divergence, flat, merkle, packing, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, tree string, digest string, ids string, row long"
WORDS = [a + b + c for a in "bdfgk" for b in ("a", "e", "ié", "ou") for c in ("n", "lo", "ß", "mi")]
COMMON = ["the", "Über", "日本語", "longest" * 9, "ab", "abc", "abcd", "abcde"]
ODD = [
    None, "", " \n\t ", "one", "it's !!'s 5's don't 12,5 áb é KK İ …,x", "x" * 3000,
    "\x00\x0b\x85 y <|endoftext|> <|startoftext|>z", "!" * 700 + "'ll" * 200, "Q" * 20 + "q" * 40,
    "́̈ ,̸≮= ñ", "🙂🙂 ﬁ １２ ٣", "a" + "́" * 50,
]


def made_rows(n=160):
    rng = random.Random(11)
    found = []
    for k in range(n):
        words = rng.choices(COMMON, k=rng.randint(0, 12)) + rng.choices(WORDS, k=rng.randint(0, 120))
        rng.shuffle(words)
        source = ("a", "b", None, "c", "", "dé")[min(rng.randint(0, 9), 5)]
        found.append((k, " ".join(words), source, rng.choice(["en", "fr", "en", None]), rng.choice([k, None, 2**63 - 1])))
    found += [(1000 + k, t, "odd", "xx", 7) for k, t in enumerate(ODD)]
    found += [(2000, "alone", "a", "é", 1), (2001, None, None, None, None), (None, "no id", "a", "en", 3)]
    found += [found[3], found[3], (None, "no id", "a", "en", 3), (-5, found[7][1], "b", "fr", 2), (5, "other", "b", "en", 1)]
    return found


@pytest.fixture(scope="module")
def rows():
    return made_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, s, lang, n, "t", "d", "x", 0) for i, t, s, lang, n in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def db_of(rows):
    import pyarrow as pa

    db = duckdb.connect()
    names = ("doc_id", "text", "source", "lang", "n_chars")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
    db.register("documents", pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(zip(names, kinds, strict=True))}))
    return db


# Packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


def test_pieces_are_encoded_as_the_whole_text_is(tokenizer):
    import pyarrow as pa

    rng = random.Random(5)
    alphabet = list("ab Zé'’,.!<0 9\n\t\x0b\x1f̸́ ßİKs") + ["'s", "'ll", "🙂", " ", "ll"]
    texts = [t or "" for t in ODD] + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(1500)]
    encoder = packing.Encoder(open(VOCABULARY, encoding="utf-8").read())
    for part in (texts, texts[::-1], [], [""]):  # the second time from memory
        ids, at = encoder.encode(flat.Texts(pa.array(part, pa.string())))
        got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
        assert got == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in part]


def checked_packing(frame, rows, tokenizer, window):
    """The sequences, after a round trip of every document through its pieces."""
    got = frame.collect()
    by_sequence, pieces = defaultdict(list), Counter()
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["id"], r["start"], tuple(ids), r["doc_tokens"]] += 1
    wanted = Counter((i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for i, t, *_ in rows)
    starts = defaultdict(list)
    for (i, start, ids, size), n in pieces.items():
        starts[i, start, size].append([ids, n])

    def take(i, start, size, tokens):
        if start == size:
            return True
        for option in starts[i, start, size]:
            ids = option[0]
            if option[1] and tuple(tokens[start : start + len(ids)]) == ids:
                option[1] -= 1
                if take(i, start + len(ids), size, tokens):
                    return True
                option[1] += 1
        return False

    for (i, tokens), n in wanted.items():
        for _ in range(n):
            assert take(i, 0, len(tokens), tokens)
    assert not any(n for options in starts.values() for _, n in options)
    sizes = []
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        sizes.append(at)
        assert at == window or at < window and at & (at - 1) == 0
    return sizes


@pytest.mark.parametrize(("window", "shard", "whole"), [(4096, 1 << 19, 4 << 20), (64, 700, 2500), (64, 1, 4 << 20)])
def test_packing(docs, rows, tokenizer, monkeypatch, window, shard, whole):
    monkeypatch.setattr(packing, "RANGE_TOKENS", whole)
    sizes = checked_packing(packing.pack(docs, VOCABULARY, window=window, shard_tokens=shard), rows, tokenizer, window)
    assert sum(s == window for s in sizes) >= len(sizes) - 13 * (1 + sum(sizes) // whole)


def test_packing_without_rows_and_with_copies(spark, empty, tokenizer):
    assert packing.pack(empty, VOCABULARY).collect() == []
    copies = [(7, "the same words again and again " * 9)] * 40 + [(8, "word " * 40_000)]
    frame = spark.createDataFrame(copies, "doc_id long, text string")
    checked_packing(packing.pack(frame, VOCABULARY, window=256), copies, tokenizer, 256)


def test_packing_puts_related_documents_together(spark):
    rng = random.Random(3)
    fields = [[f"{a}{b}{c}{d}" for a in "bdfg" for b in "aeiou" for c in s for d in "aeiou"] for s in ("kl", "mn", "pr", "st")]
    texts = [(k, " ".join(rng.choices(fields[k % 4], k=40))) for k in range(400)]
    pieces = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), VOCABULARY, window=512).collect()
    by = defaultdict(Counter)
    for r in pieces:
        by[r["sequence_id"]][r["id"] % 4] += r["length"]
    assert sum(max(c.values()) for c in by.values()) > 0.9 * sum(sum(c.values()) for c in by.values())


def test_neighbours_are_ranked_by_bm25():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 30, 25)
    at = np.r_[0, np.cumsum(sizes)]
    ids = rng.integers(0, 40, at[-1]).astype(np.uint32)
    idf, mean = np.maximum(rng.normal(1, 1, 40), 0), 12.0
    shard = packing.Shard(ids, at, idf, mean)
    docs = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    for seed in range(25):
        shard.unused[seed] = False
        scores = {}
        for k, doc in enumerate(docs):
            n = Counter(doc)
            scores[k] = sum(
                idf[t] * n[t] * 2.2 / (n[t] + 1.2 * (0.25 + 0.75 * len(doc) / mean)) for t in sorted(set(docs[seed])) if n[t]
            )
        got = shard.neighbours(seed).tolist()
        assert sorted(got) == [k for k in range(25) if shard.unused[k]]
        assert all(scores[a] >= scores[b] - 1e-9 for a, b in zip(got, got[1:], strict=False))


# Source divergence


TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain_audit(rows, least):
    docs = [(lang or "", s or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for _, t, s, lang, _ in rows]
    held, counts = Counter(), Counter()
    for lang, source, terms in docs:
        held.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    kept = defaultdict(list)
    for (lang, t), n in held.items():
        if n >= least:
            kept[lang].append(t)
    out = []
    for lang in {d[0] for d in docs}:
        sources, terms = sorted({d[1] for d in docs if d[0] == lang}), kept[lang]
        use = {s: [counts[lang, s, t] for t in terms] for s in sources}
        use[None] = [sum(use[s][k] for s in sources) for k in range(len(terms))]
        share = {s: [1 + 10**9 * (c + 2) // (sum(n) + 2 * len(terms)) for c in n] for s, n in use.items()}

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        for s in sources:
            pairs = [(o, sum(map(apart, share[s], share[o]))) for o in sources if o != s]
            used = [(t, apart(p, q)) for t, n, p, q in zip(terms, use[s], share[s], share[None], strict=True) if n and p > q]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", used, 10)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(found[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [None, (300, 100, 2, 900, 1, 2)], ids=["one slice", "many slices"])
def test_divergence(docs, rows, monkeypatch, sizes):
    for name, value in zip(("SLICE_BYTES", "WINDOW_BYTES", "TILE", "BUCKET_BYTES", "FIRST_BYTES", "LONGER"), sizes or (), strict=False):
        monkeypatch.setattr(divergence, name, value)
    for least in (10, 2):
        assert sorted(map(tuple, divergence.audit(docs, least=least).collect())) == plain_audit(rows, least)


def test_divergence_equals_its_sql(docs, rows):
    got = sorted(map(tuple, divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()))
    assert got == sorted(db_of(rows).execute(queries.ORACLES["op12_source_divergence"]).fetchall())


def test_divergence_without_rows_or_terms(spark, empty):
    assert divergence.audit(empty).collect() == []
    rows = [(1, None, "a", "en", 1), (2, "12 34", "b", "en", 1), (3, "word", None, "en", 1), (4, "", "a", "fr", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    assert sorted(map(tuple, divergence.audit(frame).collect())) == plain_audit(rows, 10)


def test_windows_end_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "WINDOW_BYTES", 7)
    texts = [b"abc def", b"", b"x" * 40, b"yy", b"a b c d e f g", "é".encode() * 9]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]
    spans = list(divergence._windows(data, at))
    assert spans[0][0] == 0 and spans[-1][1] == len(data)
    for (_, a), (b, _) in zip(spans, spans[1:], strict=False):
        assert a == b and (a in at or not (divergence.IS_TERM[data[a - 1]] and divergence.IS_TERM[data[a]]))


def test_shares_are_exact_for_great_counts(spark):
    from pyspark.sql import functions as F

    n, total, terms = 3 * 10**12 + 7, 9 * 10**15 + 1, 10**6
    found = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms))).head()[0]
    assert found == 1 + 10**9 * (n + 2) // (total + 2 * terms)


# Merkle manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    def written(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, n):
        return h(*map(written, (r[0], r[2], r[3], n, r[1])))

    def tree(level):
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for path, k in zip(paths, at, strict=True):
                path.append((level[k ^ 1] if k ^ 1 < len(level) else "", k % 2 == 1))
            level, at = [h(*level[k : k + 2]) for k in range(0, len(level), 2)], [k // 2 for k in at]
        return level[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[g] = tree([leaf(r, r[4]) for r in groups[g]])
    root, tops = tree([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops, strict=True):
        for r, path in zip(groups[g], trees[g][1], strict=True):
            bad = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, r[4] + 1 if bad else r[4])
            for other, left in path + top:
                node = h(other, node) if left else h(node, other)
            out.append((r[0], leaf(r, r[4]), trees[g][0], root, h(*(d for d, _ in path + top)), node, node == root))
    return sorted(out, key=repr)


def manifest_of(spark, docs, tmp_path):
    docs.select("doc_id", "text", "source", "lang", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op13_merkle_manifest(spark, str(tmp_path))


@pytest.mark.parametrize("bits", [10, 2, 1])
def test_manifest(spark, docs, rows, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(merkle, "BITS", bits)
    monkeypatch.setattr(merkle, "BLOCK", 1 << bits)
    monkeypatch.setattr(merkle, "SORTED_ROWS", 30 if bits < 10 else 1 << 18)
    got = sorted(map(tuple, manifest_of(spark, docs, tmp_path).collect()), key=repr)
    assert got == plain_manifest(rows)
    assert any(not r[-1] for r in got)


def test_manifest_equals_its_sql(spark, docs, rows, tmp_path):
    got = sorted(map(tuple, manifest_of(spark, docs, tmp_path).collect()), key=repr)
    assert got == sorted(db_of(rows).execute(queries.ORACLES["op13_merkle_manifest"]).fetchall(), key=repr)


def test_manifest_of_few_rows(spark, empty, docs):
    assert merkle.manifest(empty).collect() == []
    one = merkle.manifest(docs.where("lang = 'é'")).head()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof"] == []


def test_a_changed_row_is_told(docs):
    from pyspark.sql import functions as F

    proven = merkle.manifest(docs, carry={"same": merkle.leaf(*map(F.col, merkle.COLUMNS)), "other": F.lit("0" * 64)})
    assert merkle.verify(proven, "same").where("not verified").isEmpty()
    assert merkle.verify(proven, "other").where("verified").isEmpty()
