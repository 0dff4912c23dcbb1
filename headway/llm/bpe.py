"""Byte-level BPE encoding and decoding (operator 4) by ranks, in padded numpy matrices.

A text is split by the tokenizer's pattern; a piece that is a token itself is its id, any other is
merged from its bytes.  Pieces not met before by the process are merged together: bucketed by
length and padded into a matrix of ids, one piece per row.  Each round looks up the rank of every
adjacent pair in a hash table, finds each row's leftmost minimum, merges it there, and moves the
rest of the row one place left; rows without a known pair leave the matrix.  That is exactly the
order in which one piece at a time would be merged.  Pieces over ``LONGEST_ROW`` bytes, for which
moving whole rows would cost their square, are merged with a heap instead.

Decoding concatenates the bytes of the ids, so it gives back the text's bytes whatever they are.

Defined results: a null text is empty and has no ids; repeated rows are encoded each,
whatever their id, a null one too; texts of any length are encoded whole; of equal ranks the leftmost
pair is merged; extra columns are ignored; an empty table gives no rows.  Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import bounded_batches, id_text, struct_type
from headway.llm.tokens import ChunkTable

#: Longest piece that is merged in a matrix, in bytes; rows of a matrix; cells of a matrix.
LONGEST_ROW = 256
MATRIX_CELLS = 1 << 20

IDS = struct_type(doc_id=T.LongType(), ids=T.ArrayType(T.IntegerType()))
DECODED = struct_type(doc_id=T.LongType(), ids=T.ArrayType(T.IntegerType()), decoded=T.BinaryType())

NONE = np.int64(1) << 40
_HASH = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing table from (left id, right id) to the merged id, which is also its rank."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.shift = np.uint64(64 - (4 * len(pairs) + 1).bit_length())
        size = 1 << (64 - int(self.shift))
        self.key = np.full(size, -1, np.int64)
        self.value = np.full(size, NONE, np.int64)
        self.mask = size - 1
        keys = np.array([(a << 20) | b for a, b in pairs], np.int64)
        todo, slot = np.arange(len(keys)), self.slot(keys)
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        self.probes = 0
        while len(todo):
            free = self.key[slot] < 0
            self.key[slot[free]] = keys[todo[free]]  # of several, the last one written stays
            placed = self.key[slot] == keys[todo]
            self.value[slot[placed]] = values[todo[placed]]
            todo, slot = todo[~placed], (slot[~placed] + 1) & self.mask
            self.probes += 1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _HASH) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where the pair merges to no token or a side is padding."""
        keys = (left << 20) | right
        keys[(left < 0) | (right < 0)] = -2
        slot = self.slot(keys)
        rank = np.where(self.key[slot] == keys, self.value[slot], NONE)
        open_ = np.flatnonzero((self.key[slot] >= 0) & (self.key[slot] != keys) & (keys >= 0))
        at = slot[open_]
        for _ in range(self.probes):
            if not len(open_):
                break
            at = (at + 1) & self.mask
            held = self.key[at]
            hit = held == keys[open_]
            rank[open_[hit]] = self.value[at[hit]]
            go = ~hit & (held >= 0)
            open_, at = open_[go], at[go]
        return rank


class RankModel(ChunkTable):
    """The ranks of a byte-level vocabulary: token bytes <-> id."""

    max_chunks = 500_000

    def __init__(self, ranks_file: bytes, pattern: str):
        pairs = (line.split() for line in ranks_file.splitlines() if line)
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        # every way to put a token together from two tokens, as merging looks at their joint bytes
        joined = {
            (self.rank[token[:cut]], self.rank[token[cut:]]): rank
            for token, rank in self.rank.items()
            for cut in range(1, len(token))
            if token[:cut] in self.rank and token[cut:] in self.rank
        }
        self.pairs = PairTable(joined)
        self.joined = joined
        self.split = regex.compile(pattern).findall
        super().__init__(keep_space=True, lower=False, dtype=np.uint16 if len(self.token) <= 1 << 16 else np.int32)

    def merge_matrix(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of pieces of similar length: all rows merge once a round."""
        width = max(map(len, pieces))
        rows = np.full((len(pieces), width + 1), -1, np.int64)
        for row, piece in zip(rows, pieces):
            row[: len(piece)] = self.byte[np.frombuffer(piece, np.uint8)]
        out: list[tuple[int, ...]] = [()] * len(pieces)
        live = np.arange(len(pieces))
        length = np.array([len(p) for p in pieces])
        rank = self.pairs.look_up(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), -1)
        while len(live):
            at = rank.argmin(axis=1)  # the leftmost of the least
            least = rank[np.arange(len(live)), at]
            done = least == NONE
            if done.any():
                for i in np.flatnonzero(done):
                    out[live[i]] = tuple(rows[i, : length[i]].tolist())
                go = ~done
                width = int(length[go].max()) if go.any() else 0
                rows, rank = rows[go, : width + 1], rank[go, :width]
                live, length, at, least = live[go], length[go], at[go], least[go]
                if not len(live):
                    break
            row = np.arange(len(live))
            column = np.arange(rows.shape[1])
            moved = np.minimum(column + (column > at[:, None]), rows.shape[1] - 1)
            rows = np.take_along_axis(rows, moved, axis=1)
            rows[row, at] = least
            length = length - 1
            rows[row, length] = -1
            pair_column = np.arange(rank.shape[1])
            rank = np.take_along_axis(rank, np.minimum(pair_column + (pair_column > at[:, None]), rank.shape[1] - 1), axis=1)
            before = np.maximum(at - 1, 0)
            rank[row, length - 1] = NONE
            fresh = self.pairs.look_up(rows[row, at], rows[row, at + 1])
            rank[row, at] = fresh
            left = self.pairs.look_up(rows[row, before], rows[row, before + 1])
            rank[row, before] = np.where(at > 0, left, fresh)
        return out

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one long piece: a heap of pairs over a linked list, leftmost first among equals."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := self.joined.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if x >= 0 and y < n and (r := self.joined.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return tuple(i for i in ids if i >= 0)

    def merged(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of each piece; those that need merging are bucketed by length."""
        found: dict[str, tuple[int, ...]] = {}
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            if raw in self.rank:
                found[piece] = (self.rank[raw],)
            elif len(raw) > LONGEST_ROW:
                found[piece] = self.merge_long(raw)
            else:
                buckets.setdefault((len(raw) + 3) // 4, []).append((piece, raw))
        for quarter, bucket in buckets.items():
            step = max(1, MATRIX_CELLS // (4 * quarter + 1))
            for at in range(0, len(bucket), step):
                part = bucket[at : at + step]
                found.update(zip((p for p, _ in part), self.merge_matrix([raw for _, raw in part])))
        return found

    def ids_of(self, chunks: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(chunks), 50_000):
            split = [self.split(c) for c in chunks[at : at + 50_000]]
            known = self.merged({p for pieces in split for p in pieces})
            for pieces in split:
                yield [i for p in pieces for i in known[p]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


_MODELS: dict[int, RankModel] = {}


def rank_model(ranks_file: bytes, pattern: str) -> RankModel:
    """The process's model; Spark's reused workers keep its tables between tasks."""
    key = hash((ranks_file, pattern))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = RankModel(ranks_file, pattern)
    return _MODELS[key]


def _shared(spark: SparkSession, ranks_path: str):
    """The vocabulary, read on the driver: under a MB, whatever the size of the data."""
    with open(ranks_path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _ids_column(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(offsets.astype(np.int32), ids.astype(np.int32))


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids of every whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    ranks = _shared(spark, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = rank_model(ranks.value, pattern)
        for batch in batches:
            ids = _ids_column(*model.encode(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=IDS.names)

    return id_text(docs).mapInArrow(run, IDS)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the bytes that the ids stand for."""
    spark = encoded.sparkSession
    bounded_batches(spark)
    ranks = _shared(spark, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = rank_model(ranks.value, pattern)
        for batch in batches:
            decoded = [None if ids is None else model.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(decoded, pa.binary())], names=DECODED.names)

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids and, from the ids, the decoded bytes: encode and decode in one pass over the data."""
    spark = docs.sparkSession
    bounded_batches(spark)
    ranks = _shared(spark, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = rank_model(ranks.value, pattern)
        for batch in batches:
            ids, offsets = model.encode(batch.column("text").to_pylist())
            decoded = [model.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _ids_column(ids, offsets), pa.array(decoded, pa.binary())], names=DECODED.names)

    return id_text(docs).mapInArrow(run, DECODED)


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space) and decoded_sha256."""
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelled.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
