"""Registered queries of this package: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, chat, embeddings, fingerprints, jaccard, language, lm, merkle, packing, secrets, token_counts, token_files, vector_codes
from headway.llm import sql as digest_sql
from headway.llm.common import crc_fold, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secrets.BASE),
        F.sha2(secrets.spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_files.token_table(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, added_tokens=True)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(read_table(spark, sf_dir, "documents"), words=3, percent=90)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.round_trip(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(read_table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(read_table(spark, sf_dir, "conversations"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"), least=0.95)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_fold("doc_id") == 0
    model = language.train(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lm.score(docs, crc_fold("doc_id") == 1, public_tokenizers.path("word_bpe_49k.json"), end_id=49407)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    pieces = packing.tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, added_tokens=True, with_ids=False)
    return packing.pack(pieces)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return merkle.manifest(docs, crc_fold("doc_id") == 0, {"text": F.translate("text", upper, upper.lower())})


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    out = vector_codes.with_label_error(codes)
    return out.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.codebooks_digest(codebooks)).alias("codebooks_sha256"))


QUERIES: dict[str, Query] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_token_files": op2_token_files,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_fingerprints": op5_fingerprints,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_language_id": op8_language_id,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_packing": op10_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_counts": op12_token_counts,
    "op13_vector_codes": op13_vector_codes,
}

#: Whole conversations as lists of turns; one goes if its list begins a longer one's.  Independent of
#: the operator's hashes; conversations are compared only where their first turns are equal.
OP6_SQL = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role, text) AS said
  FROM turns GROUP BY conv_id
),
same AS (SELECT said, min(conv_id) AS conv_id, count(*) AS copies FROM whole GROUP BY said),
kept AS (
  SELECT a.conv_id, len(a.said) AS n_turns, a.copies FROM same a
  WHERE NOT EXISTS (
    SELECT 1 FROM same b
    WHERE b.said[1] = a.said[1] AND len(b.said) > len(a.said) AND list_slice(b.said, 1, len(a.said)) = a.said
  )
),
shown AS (
  SELECT t.conv_id, t.turn, t.role, k.n_turns, k.copies,
         '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) AS rendered
  FROM turns t JOIN kept k USING (conv_id)
)
SELECT conv_id, turn, role, n_turns, copies,
       CAST(coalesce(sum(length(rendered)) OVER (
         PARTITION BY conv_id ORDER BY turn, role, rendered ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
       rendered
FROM shown
"""

#: Every document's tokens and distinct shingles are out of reach for op3's exact join in SQL at
#: scale, and classifiers and library tokenizers can't be stated in it: those queries have none.
ORACLE: dict[str, str] = {
    "op6_chat_formatting": OP6_SQL,
    "op11_merkle_manifest": digest_sql.merkle_manifest(),
    "op13_vector_codes": digest_sql.vector_codes(),
}
