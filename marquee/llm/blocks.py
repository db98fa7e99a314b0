"""Documents in blocks of bounded size, and questions that all blocks answer together.

A block is the documents whose id and text hash to the same number, about BLOCK_BYTES of text whatever ids are null or
repeated. A block asks about its distinct keys: they go out as one sorted array per (block, bucket), where the bucket is
a part of the key space, and the answer comes back to the block. A key that a third of all documents hold reaches its
bucket once per block, and there are never more rows than keys. The number of blocks and buckets follows from the size
of the input.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import flat

BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
ASKED = "block long, bucket long, keys binary, ids binary"
ANSWERED = "block long, bucket long, answer binary"


def split(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """(block, id, text) and the number of buckets. Null ids come after every id; null texts are empty."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).head()[0] or 0
    n_blocks, n_buckets = size // BLOCK_BYTES + 1, size // BUCKET_BYTES + 1
    key = F.pmod(F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string")), F.lit(n_blocks))
    return docs.select(
        key.alias("block"), F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")
    ), n_buckets


class Block:
    """The documents of one block, ordered by id and content, so that every pass numbers them alike."""

    def __init__(self, table: pa.Table):
        ids = table["id"].fill_null(flat.NO_ID).combine_chunks().to_numpy(zero_copy_only=False)
        texts = flat.Texts(table["text"])
        order = np.lexsort((texts.digests(), ids))
        self.number = table["block"][0].as_py()
        self.table = table.take(pa.array(order))
        self.ids = ids[order]
        self.texts = flat.Texts(self.table["text"])


def per_bucket(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each key, and its name inside the bucket (32 bits)."""
    return (keys >> np.uint64(32)) % np.uint64(n_buckets), keys & np.uint64(0xFFFFFFFF)


def short_names(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (bucket << 32 | name) in order, and which of them each key is."""
    bucket, name = per_bucket(keys, n_buckets)
    return np.unique((bucket << np.uint64(32)) | name, return_inverse=True)


def bucket_rows(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, starts and ends of the runs of equal buckets in an ordered array."""
    if not len(buckets):
        return buckets, np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    return buckets[starts], starts, np.r_[starts[1:], len(buckets)].astype(np.int64)


def question(block: int, buckets: np.ndarray, keys: np.ndarray, ids: np.ndarray | None = None) -> pa.Table:
    """One row for each bucket of keys that are ordered by bucket."""
    numbers, starts, ends = bucket_rows(buckets)
    return pa.table(
        {
            "block": pa.array([block] * len(numbers), pa.int64()),
            "bucket": pa.array(numbers.astype(np.int64)),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            "ids": pa.array([ids[a:b].tobytes() if ids is not None else None for a, b in zip(starts, ends, strict=True)], pa.binary()),
        }
    )


def _gathered(table: pa.Table, column: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    values = [np.frombuffer(x.as_py(), kind) for x in table[column]]
    return np.concatenate(values), np.repeat(np.arange(len(values)), [len(v) for v in values])


def _in_several(table: pa.Table) -> pa.Table:
    """Bits: which keys another block has too."""
    keys, row = _gathered(table, "keys", np.uint32)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    answers = [np.packbits(x).tobytes() for x in np.split(found, cuts[1:])]
    return pa.table({"block": table["block"], "bucket": table["bucket"], "answer": pa.array(answers, pa.binary())})


def _earlier(table: pa.Table) -> pa.Table:
    """The keys of each block that a smaller id of another block has."""
    keys, row = _gathered(table, "keys", np.uint64)
    ids, _ = _gathered(table, "ids", np.int64)
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
    least = np.repeat(np.minimum.reduceat(ids[order], starts), np.diff(np.r_[starts, len(keys)]))
    found = np.zeros(len(keys), bool)
    found[order] = least < ids[order]
    cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    answers = [k[f].tobytes() for k, f in zip(np.split(keys, cuts[1:]), np.split(found, cuts[1:]), strict=True)]
    return pa.table({"block": table["block"], "bucket": table["bucket"], "answer": pa.array(answers, pa.binary())})


def in_several_blocks(asked: DataFrame) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(_in_several, ANSWERED)


def in_earlier_ids(asked: DataFrame) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(_earlier, ANSWERED)


def shared_bits(names: np.ndarray, replies: pa.Table) -> np.ndarray:
    """The bits of in_several_blocks() for distinct short names in order."""
    found = np.zeros(len(names), bool)
    numbers, starts, ends = bucket_rows(names >> np.uint64(32))
    spans = {int(n): (a, b) for n, a, b in zip(numbers, starts, ends, strict=True)}
    for bucket, answer in zip(replies["bucket"].to_pylist(), replies["answer"].to_pylist(), strict=True):
        a, b = spans[bucket]
        found[a:b] = np.unpackbits(np.frombuffer(answer, np.uint8), count=b - a).astype(bool)
    return found


def with_answers(split_docs: DataFrame, replies: DataFrame, act: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """act(documents, answers) of every block that has documents."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        return act(left, right)

    return split_docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(both, schema)
