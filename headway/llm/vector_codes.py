"""Vector code compression (operator 13): product quantisation, assigned over a trie of distinct parts.

Vectors become integers, are cut into ``PARTS`` equal parts, and each part position has a codebook
of at most ``ENTRIES`` entries, refined in ``ROUNDS`` rounds.

* Distinct parts.  Equal parts are counted first (a partial aggregate, so a vector that a third of
  all rows repeat is one row) and written in lexicographic order, range by range.
* Trie.  The sorted parts of a task are the leaves of a trie by dimension.  It is walked depth
  first; a node holds the squared distances of its prefix to all entries, which all parts below it
  share.  Subtrees of at most ``LEAVES`` parts are finished level by level, all their nodes at once.
  A leaf takes the nearest entry, and its part is added to that entry's sum by its weight.
* Rounds.  A task returns a sum and a count per entry, so the driver gets ``PARTS x ENTRIES`` rows
  of one part's length whatever the number of vectors, and sends the new codebooks to all tasks.

Integers are ``floor(1024 x)``.  Their order is kept by their big-endian bytes, so parts travel,
group and sort as bytes.

Defined results: rows whose vector is null or holds null, NaN or infinite components are dropped;
codebooks start with the smallest ids (ties by vector, null ids last), fewer than ``ENTRIES`` where
there are fewer rows; ties go to the lower entry; repeated rows get a row each; null labels count
as one label; an empty table gives no rows; empty vectors have code 0 and error 0; extra columns are
ignored.  Vectors of different lengths, of a length that ``PARTS`` doesn't divide, or with components
of 8,192 and more are an error, as the distances would not be defined or not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import staged, struct_type

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Parts of a subtree of the trie that are finished level by level.
LEAVES = 2048
#: Components are below this as integers, so that squared distances fit.
LIMIT = 1 << 23

KEPT = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.StringType()), *(T.StructField(f"p{i}", T.BinaryType()) for i in range(PARTS))])
SUMS = struct_type(position=T.IntegerType(), entry=T.IntegerType(), n=T.LongType(), total=T.ArrayType(T.LongType()))
CODED = struct_type(vec_id=T.LongType(), label=T.StringType(), code=T.StringType(), error=T.LongType())

Codebooks = list[np.ndarray]


def to_bytes(parts: np.ndarray) -> list[bytes]:
    """Rows of integers as bytes of the same order."""
    raw = (parts + (1 << 31)).astype(">u4").tobytes()
    width = 4 * parts.shape[1]
    return [raw[at : at + width] for at in range(0, len(raw), width)] if width else [b""] * len(parts)


def from_bytes(parts: list[bytes]) -> np.ndarray:
    flat = np.frombuffer(b"".join(parts), ">u4").astype(np.int64) - (1 << 31)
    return flat.reshape(len(parts), -1) if len(flat) else np.zeros((len(parts), 0), np.int64)


def integer_parts(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(places of the vectors that are kept, their integer components as a matrix)."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0))
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    begins = np.concatenate([[0], np.cumsum(lengths)])
    faults = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    kept = np.flatnonzero(np.asarray(vectors.is_valid()) & (faults[begins[1:]] == faults[begins[:-1]]))
    width = int(lengths[kept[0]]) if len(kept) else 0
    if (lengths[kept] != width).any() or width % PARTS:
        raise ValueError(f"vectors must be of one length that {PARTS} divides")
    whole = np.floor(values[begins[kept][:, None] + np.arange(width)] * SCALE)
    if (np.abs(whole) >= LIMIT).any():
        raise ValueError(f"components must be below {LIMIT // SCALE}")
    return kept, whole.astype(np.int64)


def kept_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, label and the parts, as bytes, of the vectors that are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, whole = integer_parts(batch.column("vector"))
            at = pa.array(kept)
            parts = [pa.array(to_bytes(p), pa.binary()) for p in np.split(whole, PARTS, axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(at), batch.column("label").take(at), *parts], names=KEPT.names)

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col(vector).alias("vector")).mapInArrow(run, KEPT)


class PartTrie:
    """Lexicographic trie over distinct parts: rows of a sorted matrix, a prefix for every node."""

    def __init__(self, parts: np.ndarray, leaves: int = LEAVES):
        self.parts, self.leaves = parts, leaves
        self.steps = 0  # nodes whose distances were computed

    def nearest(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every leaf, the lowest on ties, and its squared distance."""
        size, width = self.parts.shape
        entry, distance = np.zeros(size, np.int64), np.zeros(size, np.int64)
        todo = [(0, size, 0, np.zeros(len(codebook), np.int64))] if size else []
        while todo:  # (first leaf, end, depth, distances of the shared prefix), the lexicographically first on top
            first, end, depth, shared = todo.pop()
            if end - first <= self.leaves or depth == width:
                found = self._subtree(first, end, depth, shared, codebook)
                entry[first:end] = found.argmin(axis=1)
                distance[first:end] = found.min(axis=1)
                continue
            column = self.parts[first:end, depth]
            begins = first + np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            for a, b in reversed(list(zip(begins.tolist(), [*begins[1:].tolist(), end]))):
                self.steps += 1
                todo.append((a, b, depth + 1, shared + (self.parts[a, depth] - codebook[:, depth]) ** 2))
        return entry, distance

    def _subtree(self, first: int, end: int, depth: int, shared: np.ndarray, codebook: np.ndarray) -> np.ndarray:
        """Distances of the leaves below one node, each inner node's once."""
        parts = self.parts[first:end]
        held, node = shared[None, :], np.zeros(len(parts), np.int64)
        new = np.zeros(len(parts), bool)
        new[:1] = True
        for d in range(depth, parts.shape[1]):
            new[1:] |= parts[1:, d] != parts[:-1, d]
            begins = np.flatnonzero(new)
            step = parts[begins, d][:, None] - codebook[None, :, d]
            held = held[node[begins]] + step * step
            node = np.cumsum(new) - 1
            self.steps += len(begins)
        return held[node]


def weighted_sums(parts: np.ndarray, weight: np.ndarray, entry: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(count, sum) of the parts of each entry."""
    total = np.zeros((entries, parts.shape[1] + 1), np.int64)
    order = np.argsort(entry, kind="stable")
    own = entry[order]
    begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[: len(own)])
    if len(begins):
        counted = np.concatenate([np.ones((len(parts), 1), np.int64), parts], axis=1) * weight[:, None]
        total[own[begins]] = np.add.reduceat(counted[order], begins, axis=0)
    return total[:, 0], total[:, 1:]


def distinct_parts(kept: DataFrame) -> DataFrame:
    """position, part and weight (how many vectors have it), in lexicographic ranges."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("position"), F.col(f"p{i}").alias("part")) for i in range(PARTS)))).alias("x")
    counted = kept.select(each).groupBy(F.col("x.position").alias("position"), F.col("x.part").alias("part")).agg(F.count(F.lit(1)).alias("weight"))
    return counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part")


def first_codebooks(kept: DataFrame) -> Codebooks:
    parts = [f"p{i}" for i in range(PARTS)]
    rows = kept.select("vec_id", *parts).orderBy(F.asc_nulls_last("vec_id"), *parts).limit(ENTRIES).toArrow()
    return [from_bytes(rows[p].to_pylist()) for p in parts]


def refined(parts: DataFrame, codebooks: Codebooks) -> Codebooks:
    """Codebooks after one round over the distinct parts."""
    shared = parts.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            position, weight = np.asarray(batch.column("position")), np.asarray(batch.column("weight"))
            for at in np.unique(position).tolist():
                own = np.flatnonzero(position == at)
                raw = batch.column("part").take(pa.array(own))
                own = own[np.asarray(pc.sort_indices(raw))]  # a task may read several ranges
                leaves = from_bytes(batch.column("part").take(pa.array(own)).to_pylist())
                entry, _ = PartTrie(leaves).nearest(books[at])
                n, total = weighted_sums(leaves, weight[own], entry, len(books[at]))
                counts[at] += n
                totals[at] += total
        found = [(at, e) for at, n in enumerate(counts) for e in np.flatnonzero(n).tolist()]
        values = [pa.array([at for at, _ in found], pa.int32()), pa.array([e for _, e in found], pa.int32()), pa.array([int(counts[at][e]) for at, e in found], pa.int64())]
        yield pa.RecordBatch.from_arrays([*values, pa.array([totals[at][e].tolist() for at, e in found], pa.list_(pa.int64()))], names=SUMS.names)

    sums = parts.mapInArrow(run, SUMS)
    keys = ["position", "entry"]
    counted = F.array_insert(F.col("total"), 1, F.col("n"))  # the count goes first, so empty parts have a row as well
    by_dimension = sums.select(*keys, F.posexplode(counted).alias("dimension", "value")).groupBy(*keys, "dimension").agg(F.sum("value").alias("value"))
    rows = by_dimension.toArrow()
    out = []
    for at, book in enumerate(codebooks):
        own = np.flatnonzero(np.asarray(rows["position"]) == at)
        table = np.zeros((len(book), book.shape[1] + 1), np.int64)
        table[np.asarray(rows["entry"])[own], np.asarray(rows["dimension"])[own]] = np.asarray(rows["value"])[own]
        used = table[:, :1] > 0
        out.append(np.where(used, table[:, 1:] // np.maximum(table[:, :1], 1), book))
    return out


def coded(kept: DataFrame, codebooks: Codebooks) -> DataFrame:
    """vec_id, label, code and error of every kept vector; each batch is a trie of its own."""
    shared = kept.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, error = [], np.zeros(batch.num_rows, np.int64)
            for at, book in enumerate(shared.value):
                spelled = batch.column(f"p{at}").dictionary_encode()
                order = np.asarray(pc.sort_indices(spelled.dictionary)).astype(np.int64)
                entry, distance = PartTrie(from_bytes(spelled.dictionary.take(pa.array(order)).to_pylist())).nearest(book)
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                own = place[np.asarray(spelled.indices)]
                codes.append(entry[own])
                error += distance[own]
            code = ["".join(f"{c:02x}" for c in row) for row in np.stack(codes, axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)], names=CODED.names)

    return kept.mapInArrow(run, CODED)


def codebooks_digest(codebooks: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code and error of every kept row of ``rows``, the final codebooks)."""
    kept = staged(kept_vectors(rows, vector))
    widths = kept.agg(F.min(F.length("p0")), F.max(F.length("p0"))).first()
    if widths[0] != widths[1]:  # each task has seen one length, but not the same
        raise ValueError(f"vectors must be of one length that {PARTS} divides")
    codebooks = first_codebooks(kept)
    if len(codebooks[0]):
        parts = staged(distinct_parts(kept))
        for _ in range(ROUNDS):
            codebooks = refined(parts, codebooks)
    return coded(kept, codebooks), codebooks


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds label_error, the error summed over equal labels; nulls are one label."""
    codes = staged(codes)
    sums = codes.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("own"))).drop("own")
