"""Merkle dataset manifest (operator 11): per-source trees, proofs, and versions by path copying.

Every row is a leaf: the digest of its fields.  Per source the leaves ascend by doc_id, and runs of
``ARITY`` consecutive nodes become their parent until one node remains, the source's subroot; the
subroots, ordered by source, likewise give the root.

1. Leaves are hashed where the texts lie; only digests travel on.
2. Positions come from range-partitioned slices and the slices' counts, so a source that holds a
   third of all rows is spread over as many tasks as any other rows.
3. A tree is cut into aligned blocks of ``ARITY ** LEVELS`` nodes.  A block's root is a node of the
   next, smaller round, until every source has one node.  Rounds are written tables.
4. Downwards, a block's row of siblings above it meets the block's nodes, and each node gets its
   own path.  At the documents, a block is a persistent tree: an altered row makes a version that
   copies its ancestors inside the block and shares all other nodes; the version's block root goes
   on along the siblings above, which all versions of the block share.

No task holds more than one block and one path at a time, whatever the number of rows of a source.

Defined results: a null field counts as ``-``; null ids come first in their source and are never
altered by the query; rows of equal id are ordered by leaf, and equal leaves are interchangeable;
an empty text is ``0:``; texts of any length are hashed whole in one pass; a null source is a
source of its own, before all others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import staged, struct_type

ARITY = 16
#: Levels of a tree that one aligned block spans.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = T.ArrayType(struct_type(left=T.BinaryType(), right=T.BinaryType()))
NODES = struct_type(tree=T.StringType(), idx=T.LongType(), total=T.LongType(), digest=T.BinaryType())
PATHS = struct_type(tree=T.StringType(), idx=T.LongType(), path=PATH, subroot=T.BinaryType())
PROVED = struct_type(
    doc_id=T.LongType(), leaf=T.StringType(), subroot=T.StringType(), proof_sha256=T.StringType(), folded_root=T.StringType(), proof=PATH,
)


def digest(*hex_digests: bytes) -> bytes:
    """sha256 of digests spelled in hex, spelled in hex."""
    return hashlib.sha256(b"".join(hex_digests)).hexdigest().encode()


def fold(node: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root above ``node``, from its siblings to the left and right, level by level."""
    for left, right in path:
        node = digest(left, node, right)
    return node


class PersistentTree:
    """The nodes of one aligned block.  Nodes are appended and never changed; a version is its root's number."""

    def __init__(self, leaves: list[bytes], levels: int | None):
        """``levels``: how many the block spans; None where it is a whole tree, which ends at one node."""
        self.digest = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        self.height = 0
        row = list(range(len(leaves)))
        while len(row) > 1 if levels is None else self.height < levels:
            row = [self._add(tuple(row[at : at + ARITY])) for at in range(0, len(row), ARITY)]
            self.height += 1
        (self.root,) = row

    def _add(self, children: tuple[int, ...]) -> int:
        self.digest.append(digest(*(self.digest[c] for c in children)))
        self.children.append(children)
        return len(self.digest) - 1

    def _spine(self, index: int, version: int) -> list[tuple[int, int]]:
        """(node, place of its child on the way) from the version's root to the leaf's parent."""
        spine, node = [], version
        for height in range(self.height - 1, -1, -1):
            place = index // ARITY**height % ARITY
            spine.append((node, place))
            node = self.children[node][place]
        return spine

    def replaced(self, index: int, leaf: bytes, version: int | None = None) -> int:
        """A version of ``version`` with another leaf: a new leaf and new ancestors, all else shared."""
        spine = self._spine(index, self.root if version is None else version)
        self.digest.append(leaf)
        self.children.append(())
        node = len(self.digest) - 1
        for parent, place in reversed(spine):
            old = self.children[parent]
            node = self._add((*old[:place], node, *old[place + 1 :]))
        return node

    def path(self, index: int, version: int | None = None) -> list[tuple[bytes, bytes]]:
        """Digests left and right of the way to a leaf, from its run upwards."""
        found = []
        for node, place in reversed(self._spine(index, self.root if version is None else version)):
            run = [self.digest[c] for c in self.children[node]]
            found.append((b"".join(run[:place]), b"".join(run[place + 1 :])))
        return found


# ---- leaves and positions ----------------------------------------------------


def spelled(field: Column) -> Column:
    """A field as it is hashed: its byte count and value, or ``-``."""
    text = field.cast("string")
    return F.when(field.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(spelled, fields)).cast("binary"), 256))


def leaf_rows(docs: DataFrame, tampered: Column | None = None, altered: dict[str, Column] | None = None) -> DataFrame:
    """tree (the source, so that null comes first), doc_id, leaf and, where ``tampered``, the leaf of the altered row."""
    changed = F.lit(None).cast("binary")
    if tampered is not None:
        changed = F.when(tampered, leaf_digest([(altered or {}).get(f, F.col(f)) for f in FIELDS]))
    source = F.col("source").cast("string")
    tree = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest([F.col(f) for f in FIELDS]).alias("leaf"), changed.alias("changed"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds idx, the place of a row in its tree from 0, and total, the rows of the tree; ``rows`` is a written table.

    Rows are dealt to slices by ranges of (tree, order, a number of their own), so that neither a
    large tree nor many equal rows meet in one task.
    """
    spark = rows.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "own"]
    dealt = rows.withColumn("own", F.monotonically_increasing_id()).repartitionByRange(slices, *keys).sortWithinPartitions(*keys)
    placed = staged(dealt.drop("own").withColumn("slice", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    counts = placed.groupBy("tree", "slice").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("tree", "slice", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("total"))
    return placed.join(starts, ["tree", "slice"]).select(*rows.columns, (F.col("at") + F.col("shift")).alias("idx"), "total")


# ---- blocks --------------------------------------------------------------------


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The tables of one (tree, block) each, from batches sorted by them."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        if not rows.num_rows:
            continue
        tree, block = rows["tree"].combine_chunks(), np.asarray(rows["block"])
        begins = np.flatnonzero(np.asarray(pc.not_equal(tree[1:], tree[:-1])) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *begins.tolist()], begins.tolist()):
            yield rows.slice(a, b - a)
        held = rows.slice(int(begins[-1]) if len(begins) else 0)
    if held is not None and held.num_rows:
        yield held


def hexed(digests: pa.ChunkedArray) -> list[bytes | None]:
    return [d if d is None else d.hex().encode() for d in digests.to_pylist()]


def block_tree(rows: pa.Table, levels: int) -> PersistentTree:
    whole = rows["total"][0].as_py() <= ARITY**levels
    return PersistentTree(hexed(rows["digest"]), None if whole else levels)


def in_blocks(nodes: DataFrame, levels: int, uppers: DataFrame | None = None) -> DataFrame:
    """Nodes with their block and place in it, block by block; the block's path, if any, comes first."""
    size = ARITY**levels
    rows = nodes.withColumn("block", F.floor(F.col("idx") / size)).withColumn("place", F.col("idx") % size).drop("idx")
    if uppers is not None:
        rows = rows.unionByName(uppers.withColumn("place", F.lit(-1).cast("bigint")).withColumnRenamed("idx", "block"), allowMissingColumns=True)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """The next round: a node for each block of ``nodes`` (tree, idx, total, digest)."""
    size = ARITY**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches):
            tree = block_tree(rows, levels)
            total = -(-rows["total"][0].as_py() // size)
            found = [[rows["tree"][0].as_py()], [rows["block"][0].as_py()], [total], [bytes.fromhex(tree.digest[tree.root].decode())]]
            yield pa.RecordBatch.from_arrays([pa.array(f, t) for f, t in zip(found, (pa.string(), pa.int64(), pa.int64(), pa.binary()))], names=NODES.names)

    return in_blocks(nodes, levels).mapInArrow(run, NODES)


def rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` and the rounds above them, the last with one node a tree."""
    out = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        out.append(staged(block_roots(out[-1], levels)))
        most = -(-most // ARITY**levels)
    return out


def raw_path(path: list[tuple[bytes, bytes]]) -> list[dict[str, bytes]]:
    return [{"left": bytes.fromhex(a.decode()), "right": bytes.fromhex(b.decode())} for a, b in path]


def with_path(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[bytes, bytes]], bytes | None]]:
    """Blocks without their first row, the path that it holds, and the subroot."""
    for rows in blocks(batches):
        above = [(level["left"].hex().encode(), level["right"].hex().encode()) for level in rows["path"][0].as_py()]
        yield rows.slice(1), above, rows["subroot"][0].as_py()


def paths(nodes: DataFrame, uppers: DataFrame, levels: int) -> DataFrame:
    """tree, idx and the whole path of every node, given those of the blocks' roots (``uppers``)."""
    size = ARITY**levels
    schema = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("path", pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))), ("subroot", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, above, subroot in with_path(batches):
            tree = block_tree(rows, levels)
            first = rows["block"][0].as_py() * size
            yield pa.RecordBatch.from_pylist(
                [{"tree": rows["tree"][0].as_py(), "idx": first + i, "path": raw_path(tree.path(i) + above), "subroot": subroot} for i in range(rows.num_rows)], schema
            )

    return in_blocks(nodes, levels, uppers).mapInArrow(run, PATHS)


def proved(leaves: DataFrame, uppers: DataFrame, levels: int, proofs: bool) -> DataFrame:
    """PROVED for every document, its versions made block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, above, subroot in with_path(batches):
            tree = block_tree(rows, levels)
            upper_text = b"".join(a + b for a, b in above)
            root = fold(tree.digest[tree.root], above).decode()
            proof, folded, shown = [], [], []
            for i, changed in enumerate(hexed(rows["changed"])):
                own = tree.path(i)
                proof.append(digest(*(x for level in own for x in level), upper_text).decode())
                folded.append(root if changed is None else fold(tree.digest[tree.replaced(i, changed)], above).decode())
                shown.append(raw_path(own + above) if proofs else None)
            kind = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
            leaf = [d.decode() for d in tree.digest[: rows.num_rows]]
            values = [rows["doc_id"].combine_chunks(), pa.array(leaf, pa.string()), pa.array([subroot.hex()] * len(leaf)), pa.array(proof), pa.array(folded), pa.array(shown, kind)]
            yield pa.RecordBatch.from_arrays(values, names=PROVED.names)

    return in_blocks(leaves.withColumnRenamed("leaf", "digest"), levels, uppers).mapInArrow(run, PROVED)


def manifest(docs: DataFrame, tampered: Column | None = None, altered: dict[str, Column] | None = None, proofs: bool = False, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    ``tampered``: rows whose root is recomputed with the columns ``altered``; their siblings are the
    original ones.  ``proofs``: also return the siblings, as a list of levels with the digests to
    the left and to the right.
    """
    leaves = staged(numbered(staged(leaf_rows(docs, tampered, altered)), ["doc_id", "leaf"]))
    by_source = rounds(leaves.select("tree", "idx", "total", F.col("leaf").alias("digest")), levels)

    # the subroots are the leaves of one tree above all sources
    tops = by_source[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    tops = staged(numbered(staged(tops), ["source"]))
    overall = rounds(tops.select("tree", "idx", "total", "digest"), levels)
    top = overall[-1].select("digest").first()
    above = overall[-1].select("tree", "idx", F.lit(None).cast(PATH).alias("path"), F.col("digest").alias("subroot")).withColumn("path", F.array().cast(PATH))
    for nodes in reversed(overall[:-1]):
        above = staged(paths(nodes, above, levels))
    found = tops.select("idx", "source", "digest").join(above.select("idx", "path"), "idx")
    uppers = found.select(F.col("source").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "path", F.col("digest").alias("subroot"))
    for nodes in reversed(by_source[1:-1]):
        uppers = staged(paths(nodes, uppers, levels))

    root = F.lit(bytes(top[0]).hex() if top else None).cast("string")
    out = proved(leaves, uppers, levels, proofs).withColumn("root", root).withColumn("verified", F.col("folded_root") == root)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["proof"] if proofs else []))
