"""Merkle manifest of a dataset with a witness for every row.

A leaf is the digest of a row's fields. The leaves of a tree (the rows of one value of a column)
stand in order; while several nodes remain, every two neighbours become their digest, and a last one
alone becomes the digest of itself. The roots of the trees are the leaves of one more tree, whose root
stands for the dataset.

Witnesses grow as leaves are appended. A task appends the leaves of one aligned block after another
to a row of open subtrees: two of equal height join at once, and both extend the witnesses of
their leaves by the other's node. What is still open at the end of a block is lifted to the height of
the block. The roots of the blocks are then appended in the same way, block by block, and so on; what
a block's root gets as witness extends those of all its leaves. No task holds more than a block, and
only digests are moved, never texts.

Defined cases: a null field is ``-``, so it differs from every text, the empty one included; rows
whose ``tree`` is null form a tree of their own, the first; rows without ``order`` come first; ties
go by leaf, and repeated rows have equal leaves with a place each; a text of any length is hashed where
it is read; no rows give no rows. Columns that are not named are ignored; what is to be
kept travels inside one struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from perkline.llm.ordering import numbered
from perkline.llm.shipping import ship_library
from perkline.llm.storage import stored

HEIGHT = 10
BLOCK = 1 << HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEFT, RIGHT, NONE = "<", ">", ""


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of fields, each as UTF-8 byte count, colon and value, or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def proof_digest(witness: Column) -> Column:
    """Digest of a witness's sibling nodes, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(witness, lambda w: F.substr(w, F.lit(2))), ""), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that follows from a leaf and its witness."""

    def step(node: Column, sibling: Column) -> Column:
        other = F.substr(sibling, F.lit(2))
        joined = F.when(sibling.startswith(LEFT), F.concat(other, node)).otherwise(F.concat(node, other))
        return F.sha2(joined, 256)

    return F.aggregate(witness, leaf, step)


class OpenSubtrees:
    """Nodes appended so far: complete subtrees of falling height, and each leaf's witness up to its subtree."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, int]] = []  # height, node, first leaf
        self.witnesses: list[list[str]] = []

    def append(self, node: str) -> None:
        self.open.append((0, node, len(self.witnesses)))
        self.witnesses.append([])
        self._join()

    def _join(self) -> None:
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            height, right, middle = self.open.pop()
            _, left, first = self.open.pop()
            for witness in self.witnesses[first:middle]:
                witness.append(RIGHT + right)
            for witness in self.witnesses[middle:]:
                witness.append(LEFT + left)
            self.open.append((height + 1, _digest(left + right), first))

    def close(self, height: int) -> str:
        """Lifts what is open to one node of the given height."""
        while self.open[-1][0] < height:
            lowest, node, first = self.open.pop()
            for witness in self.witnesses[first:]:
                witness.append(NONE)
            self.open.append((lowest + 1, _digest(node), first))
            self._join()
        return self.open[0][1]


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _append_block(rows: pa.Table) -> pa.Table:
    """Adds witness and block_root to the rows of one block, in their order."""
    subtrees = OpenSubtrees()
    for node in rows["node"].to_pylist():
        subtrees.append(node)
    size = rows["group_size"][0].as_py()
    root = subtrees.close(HEIGHT if size > BLOCK else (size - 1).bit_length())
    out = rows.append_column("witness", pa.array(subtrees.witnesses, pa.list_(pa.string())))
    return out.append_column("block_root", pa.array([root] * len(rows), pa.string()))


def _append_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows come sorted by tree and position; a block may go on in the next batch."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        keys = list(zip(rows["tree"].to_pylist(), rows["block"].to_pylist()))
        ends = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        for first, end in zip([0, *ends], ends):
            yield from _append_block(rows.slice(first, end - first)).to_batches()
        rest = rows.slice(ends[-1] if ends else 0)
    if rest is not None and len(rest):
        yield from _append_block(rest).to_batches()


def _appended(nodes: DataFrame) -> DataFrame:
    """Adds block, witness (inside the block) and block_root to nodes with tree, position, group_size and node."""
    blocks = nodes.withColumn("block", F.shiftright("position", HEIGHT))
    added = [StructField("witness", ArrayType(StringType())), StructField("block_root", StringType())]
    schema = StructType([*blocks.schema.fields, *added])
    sorted_blocks = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    return stored(sorted_blocks.mapInArrow(_append_blocks, schema), "witnesses")


def _block_roots(appended: DataFrame) -> DataFrame:
    return appended.where(F.col("position").bitwiseAND(BLOCK - 1) == 0).select(
        "tree",
        F.col("block").alias("position"),
        F.shiftright(F.col("group_size") + (BLOCK - 1), HEIGHT).alias("group_size"),
        F.col("block_root").alias("node"),
    )


def _largest(nodes: DataFrame) -> int:
    return nodes.agg(F.max("group_size")).first()[0] or 0


def _grown(nodes: DataFrame, largest: int) -> DataFrame:
    """tree, position, witness and root of its whole tree, for each of the nodes."""
    if largest <= 1:
        none = F.array().cast("array<string>")
        return nodes.select("tree", "position", none.alias("witness"), F.col("node").alias("root"))
    appended = _appended(nodes)
    above = _grown(_block_roots(appended), -(-largest // BLOCK))
    above = above.select("tree", F.col("position").alias("block"), F.col("witness").alias("above"), "root")
    return appended.join(above, ["tree", "block"]).select(
        "tree", "position", F.concat("witness", "above").alias("witness"), "root"
    )


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    tree: str = "lang",
    order: str = "doc_id",
    keep: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per document: ``leaf``, ``position`` in its tree, ``witness``, ``subroot``, ``root`` and ``kept``.

    ``kept`` is a struct of ``keep`` (by default the tree and order columns). A witness is a list
    from the leaf to the root: the sibling's node after ``<`` or ``>``, the side on which it
    stands, or an empty text where a node is alone.
    """
    ship_library(docs.sparkSession)
    keep = keep or {name: F.col(name) for name in (tree, order)}
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col(tree).cast("string")), F.lit("0")).alias("tree"),
        F.col(order).alias("order"),
        leaf_digest([F.col(f) for f in fields]).alias("node"),
        F.struct(*[c.alias(name) for name, c in keep.items()]).alias("kept"),
        F.monotonically_increasing_id().alias("tie"),
    )
    leaves = stored(leaves, "leaves")
    appended = _appended(numbered(leaves, "tree", ["order", "node", "tie"]).drop("order", "tie"))

    blocks = _block_roots(appended)
    trees = stored(_grown(blocks, _largest(blocks)), "blocks")
    subroots = trees.where("position = 0").select(
        F.lit("all").alias("tree"), F.col("tree").alias("member"), F.col("root").alias("node")
    )
    ordered = stored(numbered(subroots, "tree", ["member"]), "subroots")
    top = _grown(ordered, _largest(ordered)).select("position", F.col("witness").alias("top"), "root")
    top = ordered.join(top, "position").select(F.col("member").alias("tree"), "top", "root")
    above = trees.withColumnRenamed("root", "subroot").join(top, "tree").select(
        "tree", F.col("position").alias("block"), F.concat("witness", "top").alias("above"), "subroot", "root"
    )
    return appended.join(above, ["tree", "block"]).select(
        "kept",
        F.col("node").alias("leaf"),
        "position",
        F.concat("witness", "above").alias("witness"),
        "subroot",
        "root",
    )
