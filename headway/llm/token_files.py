"""Token-ID output (operator 2): Parquet list columns made for selective reads.

Documents are ordered by id over all files (a range partitioning, sorted inside each file).  Ids
are a list column, dictionary encoded (pages of bit-packed codes) or delta encoded; row groups and
pages are small enough that a reader skips most of a file: the writer keeps the column and offset
indexes of every page, so a filter on doc_id reads only the pages that can match, and a reader of
doc_id and n_tokens never touches the ids.

Defined results: a null text is empty and holds the end id alone; texts of any length are
encoded whole; repeated rows are written as often as they occur; null ids come first; rows of one id
have no order in the files, and ``start`` counts them by number of ids and checksum; extra columns are ignored; an empty table leaves no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm import tokens as tok
from headway.llm.common import bounded_batches, id_text, staged, struct_type
from headway.session import checkpoint_dir

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
#: Rows in a page at most: a selective read decodes so many documents around the wanted one.
PAGE_ROWS = 256

RECORDS = struct_type(doc_id=T.LongType(), n_tokens=T.LongType(), ids=T.ArrayType(T.IntegerType()))
SUMS = struct_type(doc_id=T.LongType(), n_tokens=T.LongType(), ids_crc32=T.LongType(), file=T.StringType())


def encode(docs: DataFrame, tokenizer_path: str, end_id: int, added_tokens: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids of every whole text, the end id appended; keeps the partitioning."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(tok.model_text(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tok.encoder(model.value, keep_space=True, added_tokens=added_tokens)
        for batch in batches:
            ids, offsets = tok.append_id(*encoder.encode(batch.column("text").to_pylist()), end_id)
            lists = pa.ListArray.from_arrays(offsets.astype(np.int32), ids)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), lists], names=RECORDS.names)

    return id_text(docs).mapInArrow(run, RECORDS)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, encoding: str = "dictionary", added_tokens: bool = False) -> None:
    """Encode and write; over all files, ids stand in ascending doc_id order.

    ``added_tokens``: whether the string of an added token in a text stands for that token, as in the
    library's tokenizer as loaded.  ``encoding``: "dictionary", or "delta" (delta binary packed, smaller for near-sorted ids).
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    ordered = id_text(docs).repartitionByRange("doc_id")
    (
        encode(ordered, tokenizer_path, end_id, added_tokens)
        .sortWithinPartitions("doc_id")
        .write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.size", str(PAGE_BYTES))
        .option("parquet.page.row.count.limit", str(PAGE_ROWS))
        .option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The records, or only those with first <= doc_id <= last; select columns to read fewer bytes."""
    df = spark.read.schema(RECORDS).parquet(path)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    if last is not None:
        df = df.where(F.col("doc_id") <= last)
    return df


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record, computed from the files.

    start counts the ids of all documents before: a file's own running sum plus the sums of the
    files before it.  The latter needs one row per file, the former stays inside a file.
    """
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = np.asarray(lists.offsets).tolist()
            raw = memoryview(np.asarray(lists.values).astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(crc, pa.int64()), batch.column("file")], names=SUMS.names)

    records = read_token_files(spark, path).select("*", F.col("_metadata.file_name").alias("file"))
    sums = staged(records.mapInArrow(run, SUMS))
    per_file = sums.groupBy("file").agg(F.min("doc_id").alias("first_id"), F.sum("n_tokens").alias("file_tokens"))
    order = Window.orderBy("first_id", "file")
    before = per_file.select("file", (F.sum("file_tokens").over(order) - F.col("file_tokens")).alias("file_start"))
    inside = Window.partitionBy("file").orderBy("doc_id", "n_tokens", "ids_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sums.withColumn("file_sum", F.sum("n_tokens").over(inside))
        .join(before, "file")
        .select("doc_id", (F.col("file_start") + F.col("file_sum") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, added_tokens: bool = False) -> DataFrame:
    """Write the token files (by default into the shared checkpoint folder) and sum them up from disk."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer_path, end_id, added_tokens=added_tokens)
    return checksums(spark, path)
