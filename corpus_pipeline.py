"""Training-data pipeline: language filter, near-duplicate removal, secret redaction, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and
read again as the next stage's ``docs``.  All stages but the last return the columns of
``documents``; the last returns the packed pieces.

A classifier and an exact Jaccard join over all documents take part, which SQL can't state, so
there is no ORACLE_SQL; tests/llm/test_pipeline.py holds the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm import jaccard, language, packing, secrets
from headway.llm.common import read_table, staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts, texts without a letter and rejected ones go."""
    model = language.train(docs)
    return language.identified(docs, model).where(~F.col("found.rejected")).select("row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): its smallest id.

    Of repeated rows with one id, one stays.  Rows without an id can't be told apart and stay.
    """
    found = jaccard.similar_components(docs, words=5, percent=80)
    kept = staged(found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct())
    rows = docs.select("doc_id", F.struct("*").alias("row"))
    order = [F.col("row")[f.name] for f in docs.schema if isinstance(f.dataType, T.AtomicType)]  # of columns that have an order
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    one = rows.join(kept, "doc_id", "left_semi").select("row", first.alias("place")).where("place = 1")
    return one.unionByName(rows.where(F.col("doc_id").isNull()).select("row", F.lit(1).alias("place"))).select("row.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in 4,096-token sequences."""
    pieces = packing.tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, added_tokens=True, with_ids=False)
    return packing.pack(pieces)


STAGES = [("language_id", language_id), ("jaccard_join", jaccard_join), ("secret_scans", secret_scans), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
