"""Token counts (operator 12): pieces per distinct pre-token, joined to per-document frequencies.

How many tokens a byte-level tokenizer makes of a text is the sum over its pre-tokens (the matches
of the tokenizer's pattern) of their numbers of pieces.  So no ids are made:

1. Every task lists its most frequent pre-tokens; the most frequent of all lists, ``TOP`` at most
   and of bounded length, are counted once and sent to all tasks.  This choice moves work, no result.
2. A document's pre-tokens are reduced to frequencies.  Those of the table are summed up on the
   spot; the others, which are rare by this choice, are kept as (row, pre-token, frequency).
3. Each distinct one of these is counted once, joined back to the frequencies and summed by row.

The string of an added token in a text (``<|endoftext|>``) is that one token, as in the library as
loaded; the text is cut there first.

Defined results: a null text is empty and has no token; texts are counted whole whatever their
length; repeated rows, rows of equal or null id and equal texts get a row each; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import bounded_batches, id_text, staged, struct_type
from headway.llm.tokens import model_text

#: Pre-tokens of the table that all tasks have, their greatest length, and how many a task proposes.
TOP = 1 << 18
TOP_CHARS = 32
PROPOSED = 1 << 17
#: Distinct pre-tokens that a task holds before it passes its list on and begins another.
HELD = 800_000

FREQUENT = struct_type(piece=T.StringType(), n=T.LongType())
PARTS = struct_type(piece=T.StringType(), parts=T.LongType())
KNOWN = struct_type(row=T.LongType(), doc_id=T.LongType(), n_bytes=T.LongType(), n_tokens=T.LongType(), rest=T.ArrayType(T.StringType()), rest_n=T.ArrayType(T.LongType()))

#: In texts of printable ASCII, line feeds and Latin letters the tokenizer's pattern is this one.
_NOT_SIMPLE = re.compile(r"[^\x20-\x7e\nÀ-ÿ]")
_LETTER = r"A-Za-zÀ-ÖØ-öø-ÿ"
_SIMPLE = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[0-9]+| ?[^ \n0-9{_LETTER}]+|[ \n]+(?![^ \n])|[ \n]+")


class PreTokens:
    """Pre-tokens of a byte-level tokenizer and their pieces."""

    def __init__(self, model_json: str):
        from tokenizers import Tokenizer, pre_tokenizers

        model = json.loads(model_json)
        kind = model["pre_tokenizer"] or {}
        if kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex") or model["normalizer"]:
            raise ValueError("only byte-level tokenizers without a normalizer and a prefix space are counted by pre-tokens")
        tokenizer = Tokenizer.from_str(model_json)
        self.library, self.model = tokenizer.pre_tokenizer, tokenizer.model
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        added = sorted((a["content"] for a in model["added_tokens"]), key=len, reverse=True)
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in model["added_tokens"]):
            raise ValueError("added tokens that take in or look at their neighbours are not handled")
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def split(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a whole text and the number of added tokens in it."""
        if self.added and self.added.search(text):
            between = self.added.split(text)
            return [p for part in between for p in self._plain(part)], len(between) - 1
        return self._plain(text), 0

    def _plain(self, text: str) -> list[str]:
        if _NOT_SIMPLE.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return _SIMPLE.findall(text)

    def parts(self, piece: str) -> int:
        """How many tokens a pre-token is."""
        return len(self.model.tokenize(self.letters(piece)[0][0])) if piece else 0


def frequent(docs: DataFrame, model_json: Broadcast, top: int = TOP, proposed: int = PROPOSED) -> list[str]:
    """At most ``top`` pre-tokens that are frequent in the lists of all tasks, each of ``TOP_CHARS`` characters at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held = PreTokens(model_json.value), Counter()

        def most() -> pa.RecordBatch:
            found = [(p, n) for p, n in held.most_common(proposed) if len(p) <= TOP_CHARS]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=FREQUENT.names)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(words.split(text)[0])
                if len(held) > HELD:
                    yield most()
                    held.clear()
        yield most()

    counts = staged(docs.select("text").mapInArrow(run, FREQUENT).groupBy("piece").agg(F.sum("n").alias("n")))
    # the least count with at most ``top`` pre-tokens above it, from a table of a row per magnitude
    magnitude = F.floor(F.log2(F.col("n")) * 16)
    sizes = sorted(((r["magnitude"], r["pieces"]) for r in counts.groupBy(magnitude.alias("magnitude")).agg(F.count(F.lit(1)).alias("pieces")).collect()), reverse=True)
    least, total = None, 0
    for at, pieces in sizes:
        if total + pieces > top:
            break
        least, total = at, total + pieces
    if least is None:
        return []
    return counts.where(magnitude >= least).select("piece").toArrow()["piece"].to_pylist()


def piece_parts(pieces: DataFrame, model_json: Broadcast) -> DataFrame:
    """piece and parts, the number of its tokens, of distinct pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = PreTokens(model_json.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(map(words.parts, batch.column("piece").to_pylist()), pa.int64())], names=PARTS.names)

    return pieces.mapInArrow(run, PARTS)


def document_frequencies(docs: DataFrame, model_json: Broadcast, known: Broadcast) -> DataFrame:
    """Per row of ``docs``: its tokens by the table ``known``, and the frequencies of its other pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = PreTokens(model_json.value), known.value
        for batch in batches:
            totals, rest, rest_n = [], [], []
            for text in batch.column("text").to_pylist():
                pieces, total = words.split(text)
                others, others_n = [], []
                for piece, n in Counter(pieces).items():
                    parts = table.get(piece)
                    if parts is None:
                        others.append(piece)
                        others_n.append(n)
                    else:
                        total += n * parts
                totals.append(total)
                rest.append(others)
                rest_n.append(others_n)
            values = [batch.column("row"), batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64()), pa.array(rest, pa.list_(pa.string())), pa.array(rest_n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(values, names=KNOWN.names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(run, KNOWN)


def count_tokens(docs: DataFrame, tokenizer_path: str, top: int = TOP) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model_json = spark.sparkContext.broadcast(model_text(tokenizer_path))
    docs = id_text(docs)
    words = PreTokens(model_json.value)
    known = spark.sparkContext.broadcast({piece: words.parts(piece) for piece in frequent(docs, model_json, top)})
    rows = staged(document_frequencies(docs, model_json, known))
    rest = rows.select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("x")).select("row", F.col("x.rest").alias("piece"), F.col("x.rest_n").alias("n"))
    parts = staged(piece_parts(rest.select("piece").distinct(), model_json))
    joined = rest.join(parts, "piece").select("row", (F.col("n") * F.col("parts")).alias("n_tokens"))
    every = rows.select("row", "doc_id", "n_bytes", "n_tokens").unionByName(joined, allowMissingColumns=True)
    summed = every.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
    return summed.drop("row")
