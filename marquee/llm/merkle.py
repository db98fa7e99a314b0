"""Merkle manifest of a dataset by time-forward processing.

Rows are leaves. The leaves of a group, in the order of their ids, form a binary tree whose root is the group's subroot;
the subroots, in the order of the groups, form one more tree whose root stands for the dataset. Nodes are labelled by
(level, index), so a parent's label is always greater than its children's. A priority queue ordered by label delivers
child digests forward to parents; a second sweep over the labels in reverse delivers to each child what proves its parent.

The queue is external: a task holds only the messages inside one block of BLOCK leaves that stand next to each other. The
message of a block's root goes to a table, which Spark sorts by label for the next round, and the proof suffix of the root
comes back the same way. A round takes BITS levels, so 10**12 leaves take four. Neither a group nor the dataset is ever in
one task, and no level is sorted in one: positions are row numbers inside range partitions plus the counts before them.

Null values are written as `-`, other values as byte count, colon and value. A null group is a group, the first. Null ids
come before every id. Rows with equal ids stand in the order of their digests; equal rows are leaves of their own. A group
of one leaf has that leaf as subroot and nothing to prove; an empty table gives an empty result. Columns beside the named
ones are not read; a column that is to be handed through comes in under a name of the caller's choice.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.llm import rows

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 10
BLOCK = 1 << BITS
# Narrow rows that a range partition holds when leaves are numbered.
SORTED_ROWS = 1 << 18
PROOF = "array<struct<digest:string,left:boolean>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def written(value: Column) -> Column:
    """Byte count, colon and value; `-` for null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(F.concat(*map(written, values)))


def fold(leaf_digest: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        proof,
        leaf_digest,
        lambda node, other: digest(
            F.when(other["left"], F.concat(other["digest"], node)).otherwise(F.concat(node, other["digest"]))
        ),
    )


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes (tree, digest, ...) with their position in the tree and the size of the tree.

    Row number and partition come from the id that Spark gives the rows of the sorted partitions; what lies before a
    partition's part of a tree is a sum over the partitions.
    """
    n_parts = nodes.count() // SORTED_ROWS + 1
    keys = ["tree", *order, "digest", "tie"]
    placed = rows.cut(
        nodes.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .drop("tie")
        .withColumn("at", F.monotonically_increasing_id())
    )
    placed = placed.select(
        *nodes.columns, F.expr("shiftright(at, 33)").alias("part"), F.expr("at & 8589934591").alias("row_at")
    )
    held = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("held"), F.min("row_at").alias("since"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "tree", "part",
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("since")).alias("start"),
        F.sum("held").over(tree).alias("size"),
    )
    return placed.join(starts, ["tree", "part"]).select(
        *nodes.columns, (F.col("start") + F.col("row_at")).alias("position"), "size"
    )


class Sweep:
    """The nodes above the leaves of one block, up to its root or to the root of the tree."""

    def __init__(self, positions: list[int], digests: list[str], size: int):
        self.levels = min(BITS, max(0, (size - 1).bit_length()))
        self.children: list[tuple[int, list[tuple[int, str]]]] = []
        first = min(positions) & ~(BLOCK - 1)
        self.leaves = [p - first for p in positions]
        queue = [(index, index, value) for index, value in zip(self.leaves, digests, strict=True)]
        heapq.heapify(queue)
        while queue:
            label = queue[0][0]
            got = []
            while queue and queue[0][0] == label:
                _, child, value = heapq.heappop(queue)
                got.append((child, value))
            level, index = label >> BITS, label & (BLOCK - 1)
            node = sha256("".join(v for _, v in got).encode()).hexdigest() if level else got[0][1]
            if level:
                self.children.append((label, got))
            if level < self.levels:
                heapq.heappush(queue, ((level + 1 << BITS) + (index >> 1), label, node))
            else:
                self.root, self.root_label = node, label

    def proofs(self, suffix: list[tuple[str, bool]]) -> list[list[tuple[str, bool]]]:
        """Siblings of each leaf from its level to the last of the suffix, in the order of the given leaves."""
        queue = [(-self.root_label, suffix)]
        inner = dict(self.children)
        found: dict[int, list[tuple[str, bool]]] = {}
        while queue:
            label, path = heapq.heappop(queue)
            if not -label >> BITS:
                found[-label] = path
                continue
            got = inner[-label]
            for k, (child, _) in enumerate(got):
                other = (got[1 - k][1], k == 1) if len(got) == 2 else ("", False)
                heapq.heappush(queue, (-child, [other, *path]))
        return [found[x] for x in self.leaves]


def _forward(block: pa.Table) -> pa.Table:
    """The root of a block as a node of the next round."""
    positions, size = block["position"].to_pylist(), block["size"][0].as_py()
    sweep = Sweep(positions, block["digest"].to_pylist(), size)
    return pa.table(
        {
            "tree": block["tree"][:1],
            "position": pa.array([positions[0] >> BITS], pa.int64()),
            "size": pa.array([-(-size // BLOCK)], pa.int64()),
            "digest": pa.array([sweep.root], pa.string()),
        }
    )


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The tables of nodes (tree, position, size, digest) that the rounds begin with; the last one has the roots."""
    found = [nodes]
    most = nodes.agg(F.max("size")).head()[0] or 1
    while len(found) == 1 or most > 1:
        blocks = found[-1].select("tree", "position", "size", "digest").groupBy("tree", F.expr(f"shiftright(position, {BITS})"))
        found.append(rows.cut(blocks.applyInArrow(_forward, "tree string, position long, size long, digest string")))
        most = -(-most // BLOCK)
    return found


def _delivered(rounds: list[DataFrame], suffixes: DataFrame) -> DataFrame:
    """The first round's nodes with the proof of each and what else the suffixes (tree, position, proof, ...) say."""
    more = [f for f in suffixes.schema.fields if f.name not in ("tree", "position", "proof")]
    names = [f.name for f in more]

    def backward(block: pa.Table, above: pa.Table) -> pa.Table:
        sweep = Sweep(block["position"].to_pylist(), block["digest"].to_pylist(), block["size"][0].as_py())
        proofs = sweep.proofs([(x["digest"], x["left"]) for x in above["proof"][0].as_py()])
        ends = [0]
        for path in proofs:
            ends.append(ends[-1] + len(path))
        siblings = {
            "digest": pa.array([value for path in proofs for value, _ in path], pa.string()),
            "left": pa.array([left for path in proofs for _, left in path], pa.bool_()),
        }
        for name in names:
            block = block.append_column(name, pa.repeat(above[name][0], len(block)))
        flat = pa.StructArray.from_arrays(siblings.values(), list(siblings))
        return block.append_column("proof", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))

    for number, nodes in reversed(list(enumerate(rounds[:-1]))):
        schema = StructType([*nodes.schema.fields, *more, suffixes.schema["proof"]])
        blocks = nodes.groupBy("tree", F.expr(f"shiftright(position, {BITS})"))
        suffixes = blocks.cogroup(suffixes.groupBy("tree", "position")).applyInArrow(backward, schema)
        if number:
            suffixes = rows.cut(suffixes.select("tree", "position", *names, "proof"))
    return suffixes


def manifest(
    docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", columns: tuple[str, ...] = COLUMNS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """id, group, leaf, position (in its group), subroot, root, proof and the carried columns of every row.

    The proof lists the sibling of each node on the way from the leaf to the root, with the side it stands on; a node
    without sibling has an empty digest there, as its parent is the digest of it alone.
    """
    carry = carry or {}
    name = F.col(group).cast("string")
    leaves = docs.select(
        F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name)).alias("tree"),
        leaf(*(F.col(c) for c in columns)).alias("digest"),
        F.col(doc_id).alias("id"),
        F.struct(F.lit(True).alias("held"), *(value.alias(c) for c, value in carry.items())).alias("carried"),
    )
    trees = _rounds(rows.cut(_numbered(rows.cut(leaves), ["id"])))
    forest = _rounds(
        rows.cut(_numbered(trees[-1].select(F.lit("").alias("tree"), "digest", F.col("tree").alias("id")), ["id"]))
    )
    top = forest[-1].select("tree", "position", F.col("digest").alias("root"), F.array().cast(PROOF).alias("proof"))
    subroots = _delivered(forest, top).select(
        F.col("id").alias("tree"), F.lit(0).cast("long").alias("position"), F.col("digest").alias("subroot"), "root", "proof"
    )
    return _delivered(trees, rows.cut(subroots)).select(
        "id",
        F.when(F.col("tree") != "", F.expr("substr(tree, 2)")).alias("group"),
        F.col("digest").alias("leaf"), "position", "subroot", "root", "proof",
        *(F.col("carried").getField(c).alias(c) for c in carry),
    )


def verify(proven: DataFrame, presented: str) -> DataFrame:
    """folded_root, the root that the presented leaf digest leads to, and verified, whether it is the manifest's."""
    folded = proven.withColumn("folded_root", fold(F.col(presented), F.col("proof")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
