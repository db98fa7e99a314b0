"""Near-duplicate classes by BagMinHash.

A text is the bag of its five-word shingles, weighted by how often each occurs. Every shingle runs Poisson processes over
the levels of its weight: level 0 covers the weights up to 1, level j those from 2 ** (j - 1) to 2 ** j, with a rate that
is the level's width, so that two bags share a point exactly where both weights reach it. A point falls in one of
REGISTERS registers, which keeps the earliest; a process stops when it is later than every register of its text. Two
registers agree with the probability of the weighted Jaccard similarity of the bags.

Registers in bands make buckets. Texts of a bucket are compared with its first text, and the overlap of both bags verifies
the link. Texts of a bucket that are then of different classes are compared too, unless their bags rule a link out: what
a text shares with others is at most the weight of its shingles that another open text has, which with both sizes bounds
the similarity from above. So no link between texts of a bucket is lost, though a bucket with many unlinked texts doesn't
meet them all with all. With SIMILARITY 0.8, 32 bands of 4 registers miss a pair with a probability of 5e-8.

Nulls are empty texts. Equal texts, empty ones too, are one class. A text of one to four words is one shingle. A null id
comes after every id. Repeated rows are of one class. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import components, flat, rows

SHINGLE = 5
SIMILARITY = 0.8
BANDS, PER_BAND = 32, 4
REGISTERS = BANDS * PER_BAND
SLICE_BYTES = 4 << 20
SIZE_STEP = 1.1
COUNTERS = 128


def _salt(k: int) -> np.uint64:
    return np.uint64((2 * k + 1) * flat.BASE % 2**64)


def bags(texts: flat.Texts, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle name, count) of the distinct shingles, ordered by text and name."""
    words = flat.Words(texts.data, texts.at)
    sizes = np.diff(words.first)
    counts = np.where(sizes > 0, np.maximum(sizes - shingle + 1, 1), 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    start = words.first[:-1][text] + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    names = flat.Sums(words.names).span(start, np.minimum(start + shingle, words.first[1:][text]))
    order = np.lexsort((names, text))
    text, names = text[order], names[order]
    first = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]) | (text[1:] != text[:-1])]) if len(names) else order
    return text[first], names[first], np.diff(np.r_[first, len(names)])


def _uniform(seed: np.ndarray) -> np.ndarray:
    return ((seed >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def sketch(text: np.ndarray, names: np.ndarray, weights: np.ndarray, n_texts: int, registers: int = REGISTERS) -> np.ndarray:
    """Earliest point of each register of each text (infinite for an empty bag)."""
    levels = [(text, flat.mix(names ^ _salt(0)), np.zeros(len(text)), np.ones(len(text)), weights)]
    level = 1
    while True:
        low = 2.0 ** (level - 1)
        reached = weights > low
        if not reached.any():
            break
        levels.append((text[reached], flat.mix(names[reached] ^ _salt(level)), np.full(reached.sum(), low), np.full(reached.sum(), low), weights[reached]))
        level += 1
    text, seed, low, width, weights = (np.concatenate(x) for x in zip(*levels, strict=True))
    found = np.full((n_texts, registers), np.inf)
    time = np.zeros(len(text))
    step = 0
    while len(text):
        step += 1
        draw = flat.mix(seed + _salt(3 * step))
        time = time - np.log(_uniform(draw)) / (width * registers)
        place = flat.mix(seed + _salt(3 * step + 1))
        weight = low + width * _uniform(flat.mix(seed + _salt(3 * step + 2)))
        hit = weight < weights
        np.minimum.at(found, (text[hit], (place[hit] % np.uint64(registers)).astype(np.int64)), time[hit])
        running = np.unique(text)
        latest = np.zeros(n_texts)
        latest[running] = found[running].max(axis=1)
        on = time <= latest[text]
        text, seed, low, width, weights, time = text[on], seed[on], low[on], width[on], weights[on], time[on]
    return found


def bands_of(registers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit name for each band of registers."""
    values = np.ascontiguousarray(registers).view(np.uint64).reshape(len(registers), bands, -1)
    names = np.full(values.shape[:2], 0, np.uint64)
    for k in range(values.shape[2]):
        names = flat.mix(names * np.uint64(3) + values[:, :, k] + _salt(k))
    return flat.mix(names + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(flat.BASE))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.int64())
    for batch in batches:
        for part in flat.parts(batch, "text", SLICE_BYTES):
            texts = flat.Texts(part["text"])
            text, names, counts = bags(texts)
            bands = bands_of(sketch(text, names, counts, len(texts))).view(np.int64)
            filled = np.isin(np.arange(len(texts)), text)
            lists = pa.array([b if f else [] for b, f in zip(bands, filled, strict=True)], kind)
            yield pa.RecordBatch.from_arrays([*(part[k] for k in KEY), lists], names=[*KEY, "bands"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in flat.parts(batch, "text", SLICE_BYTES):
            text, names, counts = bags(flat.Texts(part["text"]))
            yield pa.RecordBatch.from_arrays(
                [part["node"].take(pa.array(text)), pa.array(names.view(np.int64)), pa.array(counts.astype(np.int64))],
                names=["node", "name", "weight"],
            )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight of the shingles that fall to each of COUNTERS; no counters for a text that overflows them."""
    for batch in batches:
        for part in flat.parts(batch, "text", SLICE_BYTES):
            text, names, counts = bags(flat.Texts(part["text"]))
            place = text * COUNTERS + (flat.mix(names) % np.uint64(COUNTERS)).astype(np.int64)
            sums = np.bincount(place, counts, part.num_rows * COUNTERS).reshape(-1, COUNTERS)
            lists = [[] if x.max() > 32767 else x for x in sums.astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [part["node"], pa.array([np.asarray(x, np.int16) for x in lists], pa.list_(pa.int16()))],
                names=["node", "counters"],
            )


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose bags overlap by SIMILARITY: the counts in common against all counts."""
    for batch in batches:
        for part in flat.parts(batch, "text_u", SLICE_BYTES // 2):
            sides = [bags(flat.Texts(part[c])) for c in ("text_u", "text_v")]
            pair, names, counts = (np.concatenate(x) for x in zip(*sides, strict=True))
            order = np.lexsort((names, pair))
            pair, names, counts = pair[order], names[order], counts[order]
            both = np.flatnonzero((pair[1:] == pair[:-1]) & (names[1:] == names[:-1]))
            n = part.num_rows
            common = np.bincount(pair[both], np.minimum(counts[both], counts[both + 1]), n)
            total = np.bincount(pair, counts, n) - common
            yield part.select(["u", "v"]).filter(pa.array((total > 0) & (common >= SIMILARITY * total - 1e-9)))


# missing is 1 for a null id, whose place in the order is behind every other.
KEY = ["id", "missing", "a", "b"]


def _keyed(docs: DataFrame, text: str, doc_id: str, *more: Column) -> DataFrame:
    """id, the text and its two digests."""
    held = rows.whole(text)
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(flat.NO_ID)).alias("id"),
        F.col(doc_id).isNull().cast("int").alias("missing"),
        F.xxhash64(held).alias("a"),
        F.xxhash64(F.lit(1), held).alias("b"),
        held.alias("text"),
        *more,
    )


def _verified(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) that overlap enough. A text that very many pairs name is joined to them by a join that Spark
    splits."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    named = asked.join(right, "v").join(left, "u")
    return named.select("u", "v", "text_u", "text_v").mapInArrow(_overlaps, "u bigint, v bigint")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, a, b, class_id, class_size): one row per document, with the digests of its text and the least id of its
    class, null where no document of the class has an id."""
    found = _classes(docs, text, doc_id)
    given = F.when(F.col("missing") == 0, F.col("id"))
    return found.select(
        given.alias("id"), "a", "b", F.when(F.col("first.missing") == 0, F.col("first.id")).alias("class_id"), "class_size"
    )


def _classes(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The key of every document, with the least key and the size of its class."""
    keyed = _keyed(docs, text, doc_id)
    members = rows.cut(keyed.mapInArrow(_sketched, "id bigint, missing int, a bigint, b bigint, bands array<bigint>"))
    # Equal texts count once, by the least id. The numbers are written before they are used, so they stay.
    least = members.groupBy("a", "b").agg(F.min(F.struct("id", "missing")).alias("least"))
    nodes = rows.cut(least.select("least.*", "a", "b").select(*KEY, F.monotonically_increasing_id().alias("node")))
    buckets = members.join(nodes, KEY).select(F.explode("bands").alias("bucket"), "node")
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first != last")
    held = rows.cut(buckets.join(shared.select("bucket", "first"), "bucket").select("bucket", "node", "first"))
    wanted = nodes.join(held.select("node").distinct(), "node").select(*KEY, "node")
    texts = rows.cut(keyed.join(wanted, KEY).select("node", "text").dropDuplicates(["node"]))
    asked = held.where("node != first").select(F.col("first").alias("u"), F.col("node").alias("v")).distinct()
    labels = rows.cut(components.label(_verified(asked, texts)))
    held = _bounded(held.select("bucket", "node").distinct(), texts, labels)
    for pairs in (_central, _open):
        labels = components.extend(labels, rows.cut(_verified(pairs(_named(held, labels)), texts)))
    return _labelled(members.select(*KEY), nodes, labels)


def _named(held: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts of buckets with several classes, with their class."""
    label = F.coalesce("label", "node").alias("label")
    known = held.join(labels.select("node", F.col("least").alias("label")), "node", "left").select(*held.columns, label)
    several = known.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("bucket")
    return rows.cut(known.join(several, "bucket"))


def _bounded(held: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, size, both, counters, buckets) of the buckets with several classes.

    `both` bounds the size of a text and one that it may be linked to: two texts overlap enough only if what they share
    reaches SIMILARITY / (1 + SIMILARITY) of both sizes together, and a text shares at most the weight of its shingles
    that another open text has. `counters` bound what two texts share more closely, and `buckets` are all that a text has.
    """
    known = _named(held, labels)
    opened = rows.cut(texts.join(known.select("node").distinct(), "node"))
    shingles = opened.mapInArrow(_shingled, "node bigint, name bigint, weight bigint")
    alone = (
        shingles.groupBy("name")
        .agg(F.count("*").alias("n"), F.min("node").alias("node"), F.sum("weight").alias("weight"))
        .where("n = 1")
        .groupBy("node")
        .agg(F.sum("weight").alias("alone"))
    )
    words = F.regexp_count("text", F.lit(rows.WORD))
    sized = opened.select("node", F.greatest(words - (SHINGLE - 1), F.lit(1)).cast("long").alias("size"))
    most = F.col("size") - F.coalesce("alone", F.lit(0))
    both = ((1 + SIMILARITY) / SIMILARITY * most + 1e-6).alias("both")
    counted = opened.mapInArrow(_counted, "node bigint, counters array<smallint>")
    listed = known.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))  # at most one of each band
    profile = sized.join(alone, "node", "left").select("node", "size", both).join(counted, "node").join(listed, "node")
    return rows.cut(known.select("bucket", "node").join(rows.cut(profile), "node"))


def _central(known: DataFrame) -> DataFrame:
    """Pairs of a bucket's text that shares the largest part of itself and the texts of other classes."""
    rank = F.struct((F.col("both") / F.col("size")).alias("share"), "node", "label", "size", "both")
    first = known.groupBy("bucket").agg(F.max(rank).alias("first"))
    met = known.join(first, "bucket").where(
        "first.label != label and size + first.size <= both and size + first.size <= first.both"
    )
    return met.select(F.least("first.node", "node").alias("u"), F.greatest("first.node", "node").alias("v")).distinct()


def _open(known: DataFrame) -> DataFrame:
    """All pairs of a bucket's texts that are of different classes and may be linked: the smaller text looks for larger
    ones in the steps of size that its bound leaves. A pair comes from the least bucket that both texts have, and only if
    the lesser of their counters adds up to enough."""
    step = lambda size: F.floor(F.log(size) / F.log(F.lit(SIZE_STEP)))
    widest = F.least(F.col("both") - F.col("size"), F.col("size") / SIMILARITY + 1e-6)
    small = (
        known.select(
            "bucket", F.col("node").alias("s"), F.col("label").alias("label_s"), F.col("size").alias("size_s"),
            widest.alias("widest"), F.col("counters").alias("counters_s"), F.col("buckets").alias("buckets_s"),
        )
        .where("widest >= size_s")
        .withColumn("step", F.explode(F.sequence(step(F.col("size_s")), step(F.col("widest")))))
    )
    large = known.select("bucket", "node", "label", "size", "both", "counters", "buckets", step(F.col("size")).alias("step"))
    shared = "aggregate(zip_with(counters_s, counters, (x, y) -> int(least(x, y))), 0, (n, x) -> n + x)"
    met = small.join(large, ["bucket", "step"]).where(
        f"""s != node and label_s != label and size between size_s and widest and size_s + size <= both
        and array_min(array_intersect(buckets_s, buckets)) = bucket
        and (size(counters_s) = 0 or size(counters) = 0
             or {(1 + SIMILARITY) / SIMILARITY} * {shared} + 1e-6 >= size_s + size)""".replace("size(", "cardinality(")
    )
    return met.select(F.least("s", "node").alias("u"), F.greatest("s", "node").alias("v")).distinct()


def _labelled(members: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The least id of a class is the least of its texts' ids."""
    named = nodes.join(labels.select("node", F.col("least").alias("label")), "node", "left").select(*KEY, F.coalesce("label", "node").alias("label"))
    found = named.groupBy("label").agg(F.min(F.struct(*KEY)).alias("first"))
    joined = members.join(named.select("a", "b", "label"), ["a", "b"])
    sizes = joined.groupBy("label").agg(F.count("*").alias("class_size"))
    return joined.join(sizes.join(found, "label"), "label").select(*KEY, "class_size", "first")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each class, the one with the least id, with its columns."""
    found = _classes(docs, text, doc_id)
    kept = found.where(" and ".join(f"{c} = first.{c}" for c in KEY)).select(*KEY).distinct()
    keyed = _keyed(docs, text, doc_id, F.struct("*").alias("row")).select("row", *KEY)
    return keyed.join(kept, KEY, "left_semi").dropDuplicates(KEY).select("row.*")
