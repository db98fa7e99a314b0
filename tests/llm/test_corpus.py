"""Corpus operators against plain versions, with the odd rows that tables hold."""

import hashlib
import random

import duckdb
import pytest

import corpus_pipeline
from marquee.llm import (
    blocks,
    components,
    decontamination,
    html_text,
    line_dedup,
    maximal_repeats,
    mixing,
    near_dup,
    quality,
    queries,
    secret_scan,
    substring_dedup,
    trigrams,
    url_filter,
)
from tests.llm import brute

VOCABULARY = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "s", "lo", "mi", "ré")]
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, size string, target string, row string"


def prose(rng, n):
    words = [rng.choice(VOCABULARY) for _ in range(n)]
    lines, k = [], 0
    while k < n:
        step = rng.randint(8, 25)
        lines.append(" ".join(words[k : k + step]).capitalize() + ".")
        k += step
    return "\n".join(lines)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    base = [prose(rng, n) for n in (60, 120, 300, 52, 80, 500, 2500)]
    texts = [*base, base[1], base[1], base[2]]
    for text in base[1:3] * 3:
        words = text.split(" ")
        for _ in range(3):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        texts.append(" ".join(words))
    passage = " ".join(rng.choice(VOCABULARY) for _ in range(70))
    texts += [f"{prose(rng, 60)} {passage} {prose(rng, 60)}" for _ in range(5)]
    texts += [None, "", " \n\t ", "one", "one two", "one two three four five", "ab " * 300, "x" * 400, "x" * 400 + "y"]
    texts += [" ".join(w + "###" for w in prose(rng, 90).split()), prose(rng, 90).upper().replace(" ", "!! ")]
    texts += ["\n".join([base[0].split("\n")[0]] * 12), "password = abcdefgh12345678 AKIA" + "ABCD1234" * 3 + " " + "0af" * 9]
    texts += [base[4] + "\n" + base[5], "é" * 60 + base[3], base[3] + "日本語 " * 40]
    found = [(k, t, ("a", "b", None, "c", "a")[k % 5]) for k, t in enumerate(texts)]
    return [*found, found[3], found[3], (None, base[5], "b"), (None, "free text without an id", None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, s, "en", len(t or ""), "s", "t", "r") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def same(frame, expected):
    assert result(frame) == sorted(expected, key=repr)


@pytest.fixture(params=[(1 << 20, 8 << 20), (2000, 3000)], ids=["one block", "many blocks"])
def block_sizes(request, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", request.param[0])
    monkeypatch.setattr(blocks, "BUCKET_BYTES", request.param[1])


def test_rows_without_an_id_are_dealt_over_the_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 3000)
    texts = [(doc_id, prose(random.Random(k % 30), 60)) for doc_id in (None, 7) for k in range(40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    sizes = [r["count"] for r in blocks.split(frame, "doc_id", "text")[0].groupBy("block").count().collect()]
    assert max(sizes) < len(texts) // 4
    same(substring_dedup.remove(frame), brute.without_windows(texts))
    same(maximal_repeats.remove(frame), [(i, n, g, s, bytearray(k)) for i, n, g, s, k in brute.without_bytes(texts)])


def test_substring_dedup(docs, rows, empty, block_sizes):
    same(substring_dedup.remove(docs), brute.without_windows([r[:2] for r in rows]))
    assert result(substring_dedup.remove(empty)) == []


def test_representatives_follow_the_content():
    rng = random.Random(3)
    inner = " ".join(rng.choice("ab cd ef gh".split()) for _ in range(90))
    import pyarrow as pa
    from marquee.llm import flat

    texts = flat.Texts(pa.array([f"{prose(rng, 40)} {inner} {prose(rng, 40)}" for _ in range(6)]))
    words = flat.Words(texts.data, texts.at)
    starts, names = substring_dedup.representatives(words)
    digests = flat.Sums(words.names).span(starts, starts + 50)
    by = {}
    for d, n in zip(digests.tolist(), names.tolist(), strict=True):
        assert by.setdefault(d, n) == n
    assert len(by) < len(digests)


def test_maximal_repeats(docs, rows, empty, block_sizes):
    same(maximal_repeats.remove(docs), [(i, n, g, s, bytearray(k)) for i, n, g, s, k in brute.without_bytes([r[:2] for r in rows])])
    assert result(maximal_repeats.remove(empty)) == []


def test_maximal_repeats_have_all_occurrences(spark):
    core = "the quick brown fox jumps over the lazy dog and then it sleeps until noon"
    frame = spark.createDataFrame([(k, f"{c * 30}{core}{c.upper() * 30}") for k, c in enumerate("abcd")], "doc_id long, text string")
    found = [r for r in maximal_repeats.maximal_repeats(frame).collect() if len(r["content"]) >= 50]
    ids = {}
    for r in found:
        ids.setdefault(bytes(r["content"]), set()).add(r["id"])
    assert all(core.encode().find(c) >= 0 for c in ids)
    assert all(v == {0, 1, 2, 3} for v in ids.values()) and ids


def test_equal_contexts_leave_a_block_once(spark, block_sizes):
    passage, run = " ".join(f"w{k}" for k in range(40)), "x" * 3000
    texts = [(k // 2, f"{k} {passage} {run if k in (4, 9) else k} {passage}") for k in range(40)] + [(None, passage), (None, passage), (3, f"{passage}{passage}")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    same(maximal_repeats.remove(frame), [(i, n, g, s, bytearray(k)) for i, n, g, s, k in brute.without_bytes(texts)])
    _, contexts = maximal_repeats._contexts(frame, "doc_id", "text", 50, 16)
    sent = []
    for r in contexts.collect():
        at = 0
        for count in r["counts"]:
            sent.append((r["block"], bytes(r["content"][at : at + count + 49])))
            at += count + 49
    assert sent and len(sent) == len(set(sent))


def test_quality(docs, rows, empty):
    judged = quality.judge(docs)
    expected = [(i, *brute.counts(t), k) for (i, t, _), k in zip(rows, brute.verdicts([r[:2] for r in rows]), strict=True)]
    same(judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept"), expected)
    assert set(judged.select("row.*").columns) == set(docs.columns)
    assert result(quality.judge(empty)) == []


def test_estimate_agrees_with_single_documents():
    rng = random.Random(6)
    votes = [tuple(rng.choice((-1, 0, 1, 1)) for _ in range(8)) for _ in range(400)]
    model = quality.estimate([(v, votes.count(v)) for v in set(votes)])
    for vote, good in zip(votes, brute.good_probabilities(votes), strict=True):
        assert model.posterior(vote) == pytest.approx(good, rel=1e-6, abs=1e-9)


def test_estimate_tells_the_classes_apart():
    patterns = [((1, 1, 1, 1), 900), ((-1, -1, 1, 1), 30), ((1, -1, -1, 1), 30), ((0, 1, 1, 1), 40)]
    model = quality.estimate(patterns)
    assert model.posterior((1, 1, 1, 1)) > 0.9 > 0.1 > model.posterior((-1, -1, 1, 1))
    assert quality.estimate([]).prior == quality.PRIOR
    assert model == quality.estimate(patterns[::-1])


def test_mixing(docs, rows, empty):
    planned = mixing.plan(docs)
    same(planned.select("row.doc_id", "copies"), [(r[0], c) for r, c in zip(rows, brute.copies(rows), strict=True)])
    assert sum(r["copies"] for r in planned.collect()) == mixing.emit(planned).count()
    assert mixing.emit(planned).columns == [*docs.columns, "copy"]
    assert result(mixing.emit(mixing.plan(empty))) == []


def test_mixing_without_ids_and_with_equal_rows(spark):
    texts = [(None, f"w{k} " * 10, "a") for k in range(900)] + [(None, "same " * 10, "b")] * 600 + [(k, "x " * 10, "c") for k in range(900)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(7)
    planned = mixing.plan(frame)
    same(planned.select("row.doc_id", "copies"), [(r[0], c) for r, c in zip(texts, brute.copies(texts), strict=True)])
    taken = planned.groupBy("row.source").agg({"target": "max"}).collect()
    words = {r["source"]: r["taken"] for r in planned.selectExpr("row.source", "size * copies AS taken").groupBy("source").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "taken").collect()}
    assert all(abs(words[r["source"]] - r["max(target)"]) < 0.05 * r["max(target)"] for r in taken)


def test_mixing_targets_reach_the_caps(spark):
    frame = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 0)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert found["a"] == 30 and found["c"] == 15 and found[None] == 0 and found["b"] == pytest.approx(970)


def test_secret_scan(docs, rows, empty):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in rows])
    kinds = [r.kind for r in secret_scan.RULES]
    found = secret_scan.scan(docs)
    expected = [(r[0], r[5]) for r in con.execute(queries.ORACLES["op5_secret_scan"]).fetchall()]
    same(found.select("row.doc_id", secret_scan.written(found["spans"], kinds)), expected)
    assert any(r[1].count("assign") and r[1].count("access") and r[1].count("hex") for r in expected)
    assert result(secret_scan.scan(empty)) == []


def test_secret_scan_counts_code_points_and_drops_short_matches(spark):
    text = "ééé TOKEN: password: abcdefghijklmnop 日 api_key='ABCDEFGHIJKL=' deadbeefdeadbeef"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = secret_scan.scan(frame)
    spans = found.select(secret_scan.written(found["spans"], [r.kind for r in secret_scan.RULES])).head()[0]
    assert spans == "assign:40:62,hex:64:80"


def test_trigram_queries():
    assert trigrams.query(r"AKIA[A-Z]+") == [[{"aki", "kia"}]]
    assert trigrams.query(r"(foo1|bars)x?") == [[{"bar", "ars"}, {"bar", "ars", "rsx"}, {"foo", "oo1"}, {"foo", "oo1", "o1x"}]]
    assert trigrams.query(r"[0-9a-f]{16,}") == [] and trigrams.query(r"ab|cdef") == []


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then sleeps"), (2, "Short item here"), (3, ""), (4, None), (None, "unnamed words go here"), (2, "Short item here")]


def test_decontamination(spark, docs, rows, empty):
    more = [(100, "x The QUICK brown-fox jumps over the lazy dog and then sleeps now", "a"), (101, "a short item here, short item here", "a"), (102, "unnamed words go here", None)]
    frame = docs.select("doc_id", "text", "source").union(spark.createDataFrame(more, "doc_id long, text string, source string"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontamination.search(frame, items)
    shown = found.select("row.doc_id", "n_words", decontamination.n_hit(found["matches"]), decontamination.items_of(found["matches"]))
    same(shown, [(i, *brute.hits(t, ITEMS)) for i, t, _ in [*rows, *more]])
    longest = {r["item"]: r["words"] for r in found.where("row.doc_id = 100").head()["matches"]}
    assert longest == {"1": 12}
    assert found.where("row.doc_id = 102").head()["matches"][0]["item"] == ""
    assert decontamination.clean(frame, items).count() == len(rows)
    assert result(decontamination.search(empty, items)) == []
    assert decontamination.search(frame, items.limit(0)).where("size(matches) > 0").count() == 0


def test_decontamination_in_parts(spark, docs, monkeypatch):
    items = spark.createDataFrame([(k, prose(random.Random(k), 30)) for k in range(12)] + [(90, "one two three four five")], "item_id long, text string")
    whole = result(decontamination.search(docs, items).select("row.doc_id", "n_words", "matches"))
    monkeypatch.setattr(decontamination, "TEST_BYTES", 400)
    assert result(decontamination.search(docs, items).select("row.doc_id", "n_words", "matches")) == whole


def plain_matches(words, items, window=10):
    """Longest verbatim matches of one text, by all places of both sides."""
    found = []
    for name, other in items:
        need = min(window, len(other))
        for i in range(len(other)):
            for p in range(len(words)):
                if i and p and other[i - 1] == words[p - 1]:
                    continue
                n = 0
                while i + n < len(other) and p + n < len(words) and other[i + n] == words[p + n]:
                    n += 1
                if need and n >= need:
                    found.append((name, i, p, n))
    return sorted(found)


def test_longest_verbatim_matches_against_all_places(spark, monkeypatch):
    rng = random.Random(8)
    words = ["a", "b", "c"]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([3, 12, 30, 60])))) for k in range(12)] + [(90, "a " * 40), (91, "")]
    texts = [(k, " ".join(rng.choices(words, k=rng.randint(0, 120)))) for k in range(40)] + [(50, "a " * 70), (51, items[3][1])]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    expected = {i: plain_matches(t.split(), [(str(k), x.split()) for k, x in items]) for i, t in texts}
    for size in (1 << 20, 300):
        monkeypatch.setattr(decontamination, "TEST_BYTES", size)
        found = decontamination.search(frame, tests)
        got = {r["row"]["doc_id"]: sorted(map(tuple, r["matches"])) for r in found.collect()}
        assert got == expected
        assert {r["row"]["doc_id"]: r["n_words"] for r in found.collect()} == {i: len(t.split()) for i, t in texts}


def test_words_that_repeat_make_no_pairs_of_windows():
    import time

    import pyarrow as pa
    from marquee.llm import flat

    test = decontamination.TestSuffixes([("1", "same " * 2000)], 10)
    words = decontamination.words_of(flat.Texts(pa.array(["same " * 20_000])))
    begun = time.process_time()
    found = decontamination._matches(words, test)
    assert time.process_time() - begun < 2
    assert len(found[0]) == 20_000 - 9 + 2000 - 9 - 1


def test_line_dedup(docs, rows, empty):
    found = line_dedup.remove(docs)
    same(found.select("row.doc_id", "kept", "n_lines", "n_removed"), [(r[0], *x) for r, x in zip(rows, brute.without_lines([r[:2] for r in rows]), strict=True)])
    assert any(0 < r["n_removed"] < r["n_lines"] for r in found.collect())
    assert result(line_dedup.remove(empty)) == []


def test_a_line_of_many_texts_goes_from_all_later_ones(spark):
    line = " ".join(f"licence{k}" for k in range(20))
    frame = spark.createDataFrame([(k, f"own start {k}\n{line}\n\nown end {k}") for k in range(60)], "doc_id long, text string")
    found = {r["doc_id"]: r["kept"] for r in line_dedup.remove(frame.repartition(5)).select("row.doc_id", "kept").collect()}
    assert found.pop(0) == f"own start 0\n{line}\n\nown end 0"
    assert found == {k: f"own start {k}\n\nown end {k}" for k in range(1, 60)}


def test_blocks_whose_lines_were_first_seen_in_other_company(spark):
    one, two = (" ".join(f"{x}{k}" for k in range(6)) for x in "pq")
    poem = "\n".join(f"verse{k}" for k in range(30))
    texts = [f"a\n{one}\nb", f"c\n{two}\nd", f"e\n{one}\n{two}\nf", f"g\n{one}\n{two}\nh", f"i i\n{poem}", f"{poem}\nj j"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["kept"] for r in line_dedup.remove(frame).select("row.doc_id", "kept").collect()}
    assert found == dict(enumerate(texts)) | {3: "g\nh", 5: "j j"}


def kept_of(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    return {r["doc_id"]: r["kept"] for r in line_dedup.remove(frame).select("row.doc_id", "kept").collect()}


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(23)
    licence = " ".join(f"licence{k}" for k in range(20))
    short = [" ".join(f"s{k}x{j}" for j in range(1 + k % 6)) for k in range(24)]
    texts = [f"only{k} {short[k]}\n{short[k]}\nthen {k}" for k in range(24)]
    for k in range(36):
        at, size = rng.randrange(18), rng.randint(2, 6)
        texts.append("\n".join([f"head {k}", *short[at : at + size], "", f"middle {k}", licence, f"tail {k}"]))
    texts += [f"{licence}\nnumber {k}" for k in range(20)]
    expected = {k: kept for k, (kept, _, _) in enumerate(brute.without_lines(list(enumerate(texts))))}
    assert sum(licence in t for t in expected.values()) == 1
    assert kept_of(spark, texts) == expected


def test_passages_that_come_again_or_in_another_order(spark):
    one, two, three = (" ".join(f"{x}{k}" for k in range(12)) for x in "pqr")
    texts = [
        f"u\n{one}\n{two}\nv", f"w\n{one}\n{two}\nz\n{one}\n{two}\nq", f"{two}\nnew\n{one}\nend", f"a1\n{three}\nb1",
        f"{three}\nx\na1\n{three}\nb1", f"{three}\ny\n{three}\nyy\n{three}",
    ]
    found = kept_of(spark, texts)
    assert found == {k: kept for k, (kept, _, _) in enumerate(brute.without_lines(list(enumerate(texts))))}
    assert found[1] == f"w\nz\n{one}\n{two}\nq" and found[2] == "new\nend"
    assert found[4] == f"{three}\nx\na1\nb1" or found[4] == f"x\na1\n{three}\nb1" or found[4].count(three) == 1


def test_a_line_of_a_thousand_texts(spark):
    line = " ".join(f"w{k}" for k in range(15))
    texts = [f"{k} begins\n{line}\n{k} ends" for k in range(1000)]
    assert kept_of(spark, texts) == {0: texts[0]} | {k: f"{k} begins\n{k} ends" for k in range(1, 1000)}


def test_long_texts_of_lines(spark):
    lines = [f"line {k} of a very long text with more than ten words in all" for k in range(6000)]
    texts = ["\n".join(lines), "\n".join(reversed(lines)), "\n".join(lines[1000:] + ["new"] + lines[:1000]), "same words again and again here now\n" * 4000]
    assert kept_of(spark, texts) == {0: texts[0], 1: "", 2: "new", 3: texts[3]}


def test_alignment_without_unique_lines():
    assert line_dedup.align([1, 2, 3, 4], [5, 2, 3, 6, 2, 3, 7]) == [(1, 1), (2, 2)]
    assert line_dedup.align([8, 2, 2, 9], [7, 2, 2, 2, 6]) == [(1, 1), (2, 2)]


def test_patience_alignment():
    assert line_dedup.align([1, 2, 3, 4], [1, 9, 3, 4]) == [(0, 0), (2, 2), (3, 3)]
    assert line_dedup.align([5, 1, 2, 6], [7, 2, 8, 1, 9]) in ([(2, 1)], [(1, 3)])
    assert line_dedup.align([], [1]) == [] and line_dedup.align([1, 1, 2], [1, 2, 2]) == [(0, 0), (2, 2)]


def test_near_duplicates(docs, rows, empty):
    classes = brute.near_classes([r[:2] for r in rows])
    expected = [(r[0], None if c == brute.LAST else c) for r, c in zip(rows, classes, strict=True)]
    same(near_dup.classes(docs).select("id", "class_id"), expected)
    assert (None, None) in expected
    assert near_dup.keep_one(docs).count() == len({c for _, c in expected if c is not None}) + 1
    assert near_dup.keep_one(docs).columns == docs.columns
    assert result(near_dup.classes(empty)) == [] and result(near_dup.keep_one(empty)) == []


def test_many_near_copies_in_chains(spark):
    rng = random.Random(11)
    words = [rng.choice(VOCABULARY) + str(k) for k in range(200)]
    texts = []
    for k in range(60):
        words = list(words)
        for _ in range(2):
            words[rng.randrange(200)] = f"new{k}{rng.random()}"
        texts.append((k, " ".join(words)))
    texts += [(100 + k, " ".join(f"w{k}x{j}" for j in range(40))) for k in range(20)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    same(near_dup.classes(frame).select("id", "class_id"), list(zip([i for i, _ in texts], brute.near_classes(texts), strict=True)))


def test_sketches_estimate_the_weighted_similarity():
    import numpy as np

    n = 4000
    names = np.random.default_rng(5).integers(0, 2**63, n, dtype=np.uint64)
    left, right = np.arange(n) % 7 + 1, np.arange(n) % 5 + 1
    truth = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    found = near_dup.sketch(np.repeat([0, 1], n), np.r_[names, names], np.r_[left, right], 2, 4096)
    assert abs((found[0] == found[1]).mean() - truth) < 0.04


def test_components(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 200), (200, 150), (300, 300), (5, 9)]
    found = {r["node"]: r["least"] for r in components.label(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {k: 0 for k in range(31)} | {100: 100, 200: 100, 150: 100}
    assert components.label(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_grow_by_further_links(spark):
    """Labels with links added later are those of all links at once; nothing moves without a link between components."""
    kind = "u long, v long"
    first, later = [(1, 2), (2, 3), (10, 11), (20, 21), (21, 22)], [(22, 11), (30, 31), (3, 3), (40, 10), (2, 1)]
    labels = components.label(spark.createDataFrame(first, kind))
    assert components.extend(labels, spark.createDataFrame([(1, 3), (3, 2)], kind)) is labels
    grown = sorted(map(tuple, components.extend(labels, spark.createDataFrame(later, kind)).collect()))
    assert grown == sorted(map(tuple, components.label(spark.createDataFrame(first + later, kind)).collect()))
    assert dict(grown) == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 20: 10, 21: 10, 22: 10, 40: 10, 30: 30, 31: 30}


def test_components_that_are_stars_take_no_step(spark, monkeypatch):
    monkeypatch.setattr(components, "_small", None)
    links = [(1, n) for n in range(2, 60)] + [(101, 100), (102, 100)]
    found = components.label(spark.createDataFrame(links, "u long, v long"))
    assert {r["node"]: r["least"] for r in found.collect()} == {n: 1 for n in range(1, 60)} | {n: 100 for n in (100, 101, 102)}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a></ul></nav>
<div id="side_bar" class='sidebar'>Side, with, many, commas, in, it</div><div class="cookieNotice"><p>We use cookies, yes.</p></div>
<article><header><h1>Head &amp; more</h1></header><p>First, with <b>bold</b> and
 spaces &eacute;.<p>Second <a href="x">link</a>.<br>same block</p><form><p>Fill in</p></form><div class="advert">Buy</div>
<script>var x = "</p>";</script><!-- <p>hidden</p> --><section class="comments"><p>Nice, really, good.</p></section></article>
<footer>&copy; us</footer></body></html>"""


def test_html_pages(spark):
    assert html_text.main_text(PAGE) == "Head & more\nFirst, with bold and spaces é.\nSecond link. same block"
    div = PAGE.replace("article", "div").replace("<header>", "").replace("</header>", "")
    assert html_text.main_text(div).split("\n")[1:] == html_text.main_text(PAGE).split("\n")[1:]
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>a</nav>") == ""
    assert html_text.main_text("a < b & c <p>d<script>x") == "a < b & c\nd"
    assert len(html_text.main_text("<article>" + "<p>word, word</p>" * 20000 + "</article>").split("\n")) == 20000
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    frame = spark.createDataFrame([(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, None)], "page_id long, url string, html string, text string")
    found = html_text.extract(frame)
    assert sorted(r["n_chars"] for r in found.collect()) == [0, 66, 66] and found.columns == ["page_id", "url", "text", "n_chars"]
    assert html_text.extract(frame.limit(0)).count() == 0


def test_short_siblings_of_the_text_stay():
    body = "".join(f"<p>Paragraph {k}, with commas, and enough words to be the main text of this page, as it is.</p>" for k in range(8))
    page = f"<body><p><a href=/>Home</a></p><h1>Title</h1><p>By someone</p><div>{body}</div><p>A short end.</p><div><p>And so on.</p></div><p><a href=/n>Next.</a></p><h2>More</h2></body>"
    found = html_text.main_text(page).split("\n")
    assert found[0] == "Title" and found[-2:] == ["A short end.", "And so on."] and len(found) == 11


URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=/es/", "http://b.com/fr/#top", "http://b.com/de", "http://b.com/de/",
        "no scheme", None, "", "http://org/", "http://example.org", "ftp://x.net/a", "http://notexample.org/es/", "http://u:p@c.com:80/de/"]


def test_url_filter(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    frame = spark.createDataFrame([(k, u, "x") for k, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, rule string")
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", list(enumerate([*URLS, URLS[0]])))
    same(url_filter.judge(frame, rules).select("page_id", "host", "path", "rule", "verdict"), con.execute(queries.ORACLES["op8_url_filters"]).fetchall())
    none = url_filter.judge(frame, rules.limit(0), default="block").collect()
    assert len(none) == len(URLS) + 1 and all(r["rule"] is None and r["verdict"] == "block" for r in none)
    assert url_filter.judge(frame.limit(0), rules).count() == 0


def test_pipeline_against_the_plain_versions(spark, rows, tmp_path):
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(full, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [r for r, k in zip(full, brute.verdicts([r[:2] for r in full]), strict=True) if k]
    lined = []
    for r, (text, _, _) in zip(kept, brute.without_lines([r[:2] for r in kept]), strict=True):
        if brute.WORD.search(text):
            lined.append((r[0], text, r[2], r[3], len(text)))
    classes = brute.near_classes([r[:2] for r in lined])
    chosen = {}
    for r, c in zip(lined, classes, strict=True):
        if brute.rank(r[0]) == c:
            chosen[c] = r
    clean = [r for r in chosen.values() if not brute.hits(r[1], ITEMS)[1]]
    n = brute.copies([(r[0], r[1], r[3]) for r in clean])
    expected = [(*r, k) for r, c in zip(clean, n, strict=True) for k in range(1, c + 1)]
    same(corpus_pipeline.run(spark, str(tmp_path)), expected)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.ORACLES and n != "op10_suffix_array_dedup"])
def test_queries_match_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    found = queries.QUERIES[name](spark, folder)
    expected = con.execute(queries.ORACLES[name])
    places = [[d[0] for d in expected.description].index(c) for c in found.columns]
    same(found, [tuple(r[p] for p in places) for r in expected.fetchall()])


def test_digest_columns(spark):
    found = queries.QUERIES["op2_substring_dedup"](spark, "/root/testdata/sf0.001").where("n_words = n_removed").collect()
    assert all(r["kept_sha256"] == hashlib.sha256(b"").hexdigest() for r in found)
