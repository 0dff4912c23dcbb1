"""Embedding near-dedup (operator 7): cross-polytope hashing after fast Hadamard rotations.

Unit vectors are turned by three rounds of random signs and a fast Hadamard transform; the nearest
corner of the cross-polytope (the coordinate of greatest size, with its sign) is the hash.  A table
joins ``k`` such hashes into a bucket key, k growing with the logarithm of the number of vectors.
Each vector also enters the buckets of its next-best corners (multiprobe).  Members of a bucket are
compared by cosine in double precision, so no pair below the threshold is ever linked; a pair that
meets in no bucket of any table is missed.

Equal vectors are one class with a count.  Large buckets are cut into blocks, and block meets block
in tasks of their own.  A bucket returns, per vector, the number of links that it is the first to
find (both vectors carry all their keys), and a spanning forest of the links: never all pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different length link with nothing; repeated ids get a row each and count as
different vectors, rows with a null id are returned as they are and join in; of
equally near corners the first one is the hash; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import bounded_batches, staged, struct_type
from headway.llm.components import components
from headway.llm.jaccard import forest

TABLES = 8
PROBES = 3
#: Of a pair at cosine 0.95, measured for 64 dimensions: found in one table of FOUR hashes, and how
#: that falls with each hash more.  Longer keys get as many tables as keep the recall of RECALL.
FOUND_AT_FOUR, FOUND_FALL = 0.44, 0.65
RECALL = 0.99
#: Buckets of a table per vector, at least.
ROOM = 8
ROTATIONS = 3
#: Members of a bucket that are compared in one task at most.
BLOCK = 1024

NODES = struct_type(vec_id=T.LongType(), node=T.LongType(), vector=T.ArrayType(T.DoubleType()))
CODES = struct_type(node=T.LongType(), copies=T.LongType(), vector=T.ArrayType(T.DoubleType()), codes=T.ArrayType(T.LongType()))
FOUND = struct_type(a=T.LongType(), b=T.LongType(), links=T.LongType())


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def tables_for(hashes: int) -> int:
    """Tables that find a share of RECALL of the pairs at cosine 0.95, TABLES at least."""
    alone = FOUND_AT_FOUR * FOUND_FALL ** max(0, hashes - 4)
    return max(TABLES, math.ceil(math.log(1 - RECALL) / math.log(1 - alone)))


def bucket_keys(x: np.ndarray, hashes: int) -> np.ndarray:
    """Keys of the rows (unit vectors of one length): tables * probes each, in table order."""
    tables = tables_for(hashes)
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    rows = np.arange(len(x))
    out = np.empty((len(x), tables * PROBES), np.int64)
    for table in range(tables):
        signs = np.random.default_rng([7, table, x.shape[1]]).choice([-1.0, 1.0], (hashes, ROTATIONS, width))
        corner, second, loss = [], [], []
        for f in range(hashes):
            turned = padded
            for r in range(ROTATIONS):
                turned = hadamard(turned * signs[f, r])
            size = np.abs(turned)
            best = size.argmax(axis=1)
            top = size[rows, best].copy()
            size[rows, best] = -1
            next_ = size.argmax(axis=1)
            corner.append(2 * best + (turned[rows, best] < 0))
            second.append(2 * next_ + (turned[rows, next_] < 0))
            loss.append(top - size[rows, next_])
        corner_, second_ = np.stack(corner, axis=1), np.stack(second, axis=1)
        cheapest = np.argsort(np.stack(loss, axis=1), axis=1, kind="stable")
        for probe in range(PROBES):
            code = corner_.copy()
            if 0 < probe <= hashes:
                flip = cheapest[:, probe - 1]
                code[rows, flip] = second_[rows, flip]
            key = np.full(len(x), table * 1_000_003 + x.shape[1], np.uint64)
            for f in range(hashes):
                key = (key ^ code[:, f].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            out[:, table * PROBES + probe] = key.view(np.int64)
    return out


def usable(vector: np.ndarray | None) -> bool:
    """Whether a vector (components as doubles, nulls as nan) has a direction."""
    return vector is not None and len(vector) > 0 and bool(np.isfinite(vector).all()) and bool(np.any(vector))


def nodes(vectors: DataFrame) -> DataFrame:
    """vec_id, node (the id of the vector's value; null where it has no direction) and the vector."""
    bounded_batches(vectors.sparkSession)
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            offsets, values = np.asarray(lists.offsets), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            each = [values[a:b] if ok else None for a, b, ok in zip(offsets, offsets[1:], lists.is_valid().to_pylist())]
            node = [int.from_bytes(hashlib.blake2b((v + 0.0).tobytes(), digest_size=8).digest(), "little", signed=True) if usable(v) else None for v in each]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(node, pa.int64()), lists], names=NODES.names)

    return given.mapInArrow(run, NODES)


def coded(classes: DataFrame, hashes: int) -> DataFrame:
    """Add the bucket keys to classes (node, copies, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                each = [np.array(v) for v in part.column("vector").to_pylist()]
                codes = np.empty((len(each), tables_for(hashes) * PROBES), np.int64)
                for length in {len(v) for v in each}:
                    own = [i for i, v in enumerate(each) if len(v) == length]
                    x = np.stack([each[i] for i in own])
                    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
                    codes[own] = bucket_keys(x / np.linalg.norm(x, axis=1, keepdims=True), hashes)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("node", "copies", "vector")), pa.array(codes.tolist(), pa.list_(pa.int64()))], names=CODES.names)

    return classes.select("node", "copies", "vector").mapInArrow(run, CODES)


def first_meeting(codes: np.ndarray, key: int) -> np.ndarray:
    """Matrix of the pairs that share no bucket of smaller key than ``key``."""
    new = np.ones((len(codes), len(codes)), bool)
    width = codes.shape[1]
    for table in range(0, width, PROBES):
        for p in range(table, table + PROBES):
            for q in range(table, table + PROBES):
                same = codes[:, p][:, None] == codes[:, q][None, :]
                new &= ~(same & (codes[:, p] < key)[:, None])
    return new


def bucket_links(x: np.ndarray, copies: np.ndarray, codes: np.ndarray, own: np.ndarray, key: int, across: bool, least: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links that a bucket is the first to find, counted per member, and a spanning forest of all its links."""
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    if across:
        linked &= own[:, None] != own[None, :]
    if not linked.any():
        return np.zeros(len(x), np.int64), []
    return (linked & first_meeting(codes, key)) @ copies, forest(linked)


def found_links(entries: DataFrame, least: float) -> DataFrame:
    """Rows (a, null, links) with the number of links a bucket adds to a, and (a, b, 0) of its forest."""
    spread = entries.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def group_rows(rows: list[dict]) -> list[tuple[int, int | None, int]]:
        out: list[tuple[int, int | None, int]] = []
        for length in {len(r["vector"]) for r in rows}:
            same = [r for r in rows if len(r["vector"]) == length]
            if len(same) < 2:
                continue
            x = np.array([r["vector"] for r in same])
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            node = [r["node"] for r in same]
            copies, own = np.array([r["copies"] for r in same]), np.array([r["own"] for r in same])
            links, edges = bucket_links(x, copies, np.array([r["codes"] for r in same]), own, same[0]["key"], same[0]["i"] != same[0]["j"], least)
            out += [(node[i], None, int(n)) for i, n in enumerate(links.tolist()) if n]
            out += [(node[i], node[j], 0) for i, j in edges]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []

        def record(out: list[tuple[int, int | None, int]]) -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=FOUND.names)

        for batch in batches:
            out: list[tuple[int, int | None, int]] = []
            for at in range(0, batch.num_rows, 4096):
                for row in batch.slice(at, 4096).to_pylist():
                    if rows and (row["key"], row["i"], row["j"]) != (rows[0]["key"], rows[0]["i"], rows[0]["j"]):
                        out += group_rows(rows) if len(rows) > 1 else []
                        rows = []
                    rows.append(row)
            yield record(out)
        if len(rows) > 1:
            yield record(group_rows(rows))

    return spread.mapInArrow(run, FOUND)


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): n_links, component_id and kept."""
    rows = staged(nodes(vectors))
    classes = staged(
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.min("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("vec_id"))
    )
    shape = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("length")).first()
    corners = 2 << max(1, ((shape["length"] or 2) - 1).bit_length())
    hashes = max(1, math.ceil(math.log(ROOM * max(2, shape["n"]), corners)))
    codes = staged(coded(classes, hashes))
    keys = codes.select("node", F.explode(F.array_distinct("codes")).alias("key"))
    sizes = staged(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.when(blocks > 1, F.pmod(F.hash("node"), blocks)).otherwise(0)
    placed = (
        keys.join(sizes, "key")
        .select("key", "node", blocks.alias("blocks"), own.alias("own"))
        .select("key", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("key", "node", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    found = staged(found_links(placed.join(codes, "node"), least))
    links = staged(found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")))
    groups = staged(components(found.where("b is not null").select("a", "b").distinct()))
    named = classes.join(links, "node", "left").join(groups, "node", "left")
    named = named.select("node", "vec_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "node").alias("group"))
    smallest = named.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    by_node = staged(named.join(smallest, "group").select("node", "n_links", "component_id"))
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "node").join(by_node, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
