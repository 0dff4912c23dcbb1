"""Packing (operator 10): best-fit decreasing into fixed token windows.

Documents are encoded whole and end with an end id.  An overlong document is first cut into full
windows; what remains of it, and every shorter document, is one piece.  Pieces are dealt at random
(by a hash of their row, so equal and missing ids are spread like any others) into groups of
bounded size, and each group is packed on its own: the longest piece first, each into the open window with the least room that still holds it.
A segment tree over the remaining room (a node tells whether any open window has a room in its
range) finds that window in a number of steps that depends on the window size only.

Groups have about ``GROUP_PIECES`` pieces whatever the size of the data, so no task and no hot
source grows with the input, and only the few last windows of a group stay underfilled.

Defined results: a null text is empty and yields one piece with the end id alone; a very long text
yields full windows and one rest; repeated rows and rows of equal or null id yield their pieces
each, null ids stay null; pieces of equal length go in the order of id and start; extra columns are
ignored; an empty table yields no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm import tokens as tok
from headway.llm.common import bounded_batches, id_text, staged, struct_type

WINDOW = 4096
#: Pieces that are packed together.
GROUP_PIECES = 16_384

PIECES = struct_type(doc_id=T.LongType(), start=T.LongType(), length=T.LongType(), ids=T.ArrayType(T.IntegerType()), ids_crc32=T.LongType(), doc_tokens=T.LongType())


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, added_tokens: bool = False, with_ids: bool = True) -> DataFrame:
    """Encode every whole text and cut it into pieces of at most ``window`` ids.

    Columns: doc_id, start (ids of the document before the piece), length, ids, ids_crc32 (their
    checksum as little-endian unsigned 32-bit integers), doc_tokens (all ids of the document).
    ``added_tokens``: whether the string of an added token in a text stands for that token, as in the
    library's tokenizer as loaded.  ``with_ids``: without it there is no column ids.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(tok.model_text(tokenizer_path))
    schema = T.StructType([f for f in PIECES if with_ids or f.name != "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tok.encoder(model.value, keep_space=False, added_tokens=added_tokens)
        for batch in batches:
            ids, offsets = tok.append_id(*encoder.encode(batch.column("text").to_pylist()), end_id)
            n = np.diff(offsets)
            pieces = -(-n // window)
            doc = np.repeat(np.arange(len(n)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            begin = offsets[doc] + start
            end = np.minimum(begin + window, offsets[doc + 1])
            raw = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist())]
            lists = [pa.ListArray.from_arrays(np.append(begin, end[-1:]).astype(np.int32), ids)] if with_ids else []
            doc_id = batch.column("doc_id").take(pa.array(doc))  # nulls stay nulls
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(start), pa.array(end - begin), *lists, pa.array(crc, pa.int64()), pa.array(n[doc])], names=schema.names)

    return id_text(docs).mapInArrow(cut, schema)


class RoomTree:
    """Segment tree over the room left in open windows; finds the tightest that is large enough."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, room: int) -> int:
        """An open window with exactly this much room."""
        self._add(room, -1)
        return self.windows[room].pop()

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, need: int) -> int:
        """The least room of an open window that is at least ``need``; -1 if there is none."""
        node, count = need + self.leaves, self.count
        if count[node]:
            return need
        while node > 1:
            if node % 2 == 0 and count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; ``lengths`` are in falling order."""
    tree = RoomTree(window)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i, need in enumerate(lengths.tolist()):
        room = tree.tightest(need)
        if room < 0:
            room, seq, opened = window, opened, opened + 1
        else:
            seq = tree.take(room)
        sequence[i], offset[i] = seq, window - room
        if room > need:
            tree.put(room - need, seq)
    return sequence, offset


def pack(pieces: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Place pieces (doc_id, start, length, further columns) into sequences.

    Adds sequence_id (unique over the whole result) and offset (gapless from 0 in a sequence).
    """
    pieces = staged(pieces)
    total = pieces.count()
    groups = max(1, -(-total // group_pieces))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.drop_columns(["pack_group"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        sequence, offset = best_fit_decreasing(group["length"].to_numpy(), window)
        first = key[0].as_py() << 32
        return group.append_column("sequence_id", pa.array(first + sequence)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The windows themselves: sequence_id, ids and the documents with their places, in order.

    ``packed`` carries the ids column of the pieces.  A sequence has at most one window of ids.
    """
    part = F.struct("offset", "length", "doc_id", "start", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return grouped.select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["start"], p["offset"], p["length"])).alias("parts"),
    )
