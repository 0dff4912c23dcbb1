"""op2, op4, op10: tokenisation against the libraries, files, packing."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from headway.llm import bpe, packing, queries, token_files, tokens

BYTE, WORD, RANKS = (P.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"))

ODD = [
    "", " ", "  ", " a", "a ", "a\t b", "a \t b", "a\n\n b", "x  y", "don't  stop\n's It'S", "<|endoftext|> a <|endoftext|>", "é ̈a",
    "ΑΣ ΑΣ", "A" * 3000, "ab" * 400, " \n", "\x1c \x1c", "a\x85 b", "a \nb", "2² ² x²", "日本語" * 50, "İİ. ×÷",
    "under_score a.b,c;d!e?f", "1234 5 67a8", "!!!" * 40, "ﬁẛ̣", "it's 'twas we'll'd",
]
DOCS = "doc_id long, text string, ids string, n int, start string, length string, file string, row string"


def odd_texts() -> list[str]:
    rng = random.Random(3)
    alphabet = " \n\ta'sé.1 \x1c中́<|ZÀ_-!"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]


def documents(spark, texts):
    rows = [(i, t, "x", 1, "y", "z", "f", "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.mark.parametrize("path,keep_space", [(BYTE, True), (WORD, False)])
def test_cached_encoder_equals_library(path, keep_space, monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_CHARS", 500)
    monkeypatch.setattr(tokens.ChunkTable, "max_chunks", 50)  # the table is begun anew in between
    encoder = tokens.CachedEncoder(tokens.model_text(path), keep_space)
    texts = odd_texts()
    ids, offsets = encoder.encode(texts)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == encoder.tok.encode(text, add_special_tokens=False).ids, text


ADDED = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "<|startoftext|> x", "<|EndOfText|> y", " <|endoftext|>\n\nfar  <|endoftext|> ", "x\t <|endoftext|> z"]


@pytest.mark.parametrize("path,keep_space", [(BYTE, True), (WORD, False)])
def test_added_tokens_equal_untouched_library(path, keep_space):
    library = Tokenizer.from_file(path)
    encoder = tokens.CachedEncoder(tokens.model_text(path), keep_space, added_tokens=True)
    texts = [*odd_texts(), *ADDED]
    ids, offsets = encoder.encode(texts)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_queries_encode_as_untouched_library(spark, tmp_dir):
    texts = [*ADDED, "plain"]
    folder = f"{tmp_dir}/added"
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    byte, word = ([Tokenizer.from_file(p).encode(t, add_special_tokens=False).ids for t in texts] for p in (BYTE, WORD))
    files = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in queries.op2_token_files(spark, folder).collect()}
    assert files == {i: (len(w) + 1, zlib.crc32(np.array([*w, 0], "<u4").tobytes())) for i, w in enumerate(byte)}
    for rows in (queries.op10_packing(spark, folder), corpus_pipeline.packed(spark, documents(spark, texts), folder)):
        got = {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in rows.collect()}
        assert got == {i: (len(w) + 1, zlib.crc32(np.array([*w, 2], "<u4").tobytes())) for i, w in enumerate(word)}


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, tmp_dir, encoding):
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    texts = [*odd_texts(), None]
    want = [library.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    path = f"{tmp_dir}/tokens"
    token_files.write_token_files(documents(spark, texts), path, BYTE, end_id=0, encoding=encoding)
    got = {r["doc_id"]: r["ids"] for r in token_files.read_token_files(spark, path).collect()}
    assert got == dict(enumerate(want))
    some = token_files.read_token_files(spark, path, first=5, last=9)
    assert sorted(r["doc_id"] for r in some.select("doc_id", "n_tokens").collect()) == [5, 6, 7, 8, 9]
    assert "doc_id" in some._jdf.queryExecution().toString()
    starts = np.cumsum([0, *map(len, want)])
    for r in token_files.checksums(spark, path).collect():
        i = r["doc_id"]
        assert (r["start"], r["n_tokens"]) == (starts[i], len(want[i]))
        assert r["ids_crc32"] == zlib.crc32(np.array(want[i], "<u4").tobytes())


def test_token_files_odd_tables(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (2, None)], "doc_id long, text string")
    rows = sorted(token_files.token_table(frame, BYTE, 0).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 2]
    assert [r["start"] for r in rows] == [0, 2, 5, 8]
    assert token_files.token_table(frame.limit(0), BYTE, 0).count() == 0
    with pytest.raises(ValueError):
        token_files.write_token_files(frame, "unused", BYTE, 0, encoding="plain")


def test_bpe_equals_tiktoken_and_decodes(spark):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    texts = [*odd_texts(), *("".join(rng.choice("abcdeéxthing") for _ in range(rng.randint(1, 300))) for _ in range(200)), None]
    out = bpe.decode(bpe.encode(documents(spark, texts), RANKS, P.PATTERN), RANKS, P.PATTERN).cache()
    assert sorted(bpe.round_trip(documents(spark, texts), RANKS, P.PATTERN).collect()) == sorted(out.collect())
    digests = {r["doc_id"]: r for r in bpe.digests(out).collect()}
    for r in out.collect():
        text = texts[r["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert r["ids"] == ids, text
        assert bytes(r["decoded"]) == text.encode()
        d = digests[r["doc_id"]]
        assert d["n_tokens"] == len(ids)
        assert d["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode(documents(spark, ["a"]).limit(0), RANKS, P.PATTERN).count() == 0


def test_long_pieces_merge_alike():
    with open(RANKS, "rb") as f:
        model = bpe.RankModel(f.read(), P.PATTERN)
    rng = random.Random(5)
    for _ in range(60):
        piece = bytes(rng.choice(b"abcdeaa ") for _ in range(rng.randint(2, 80)))
        assert model.merge_long(piece) == model.merge_matrix([piece])[0]


def test_best_fit_decreasing_takes_the_tightest_window():
    sequence, offset = packing.best_fit_decreasing(np.array([7, 6, 3, 3, 1]), 10)
    assert sequence.tolist() == [0, 1, 0, 1, 1]
    assert offset.tolist() == [0, 0, 7, 6, 9]


def test_room_tree_against_search():
    rng, tree, open_ = random.Random(6), packing.RoomTree(50), []
    for i in range(400):
        need = rng.randint(1, 50)
        fits = [room for room, _ in open_ if room >= need]
        assert tree.tightest(need) == min(fits, default=-1)
        if fits and rng.random() < 0.5:
            window = tree.take(min(fits))
            open_.remove((min(fits), window))
        else:
            open_.append((need, i))
            tree.put(need, i)


def test_packing(spark):
    library = Tokenizer.from_file(WORD)
    library.encode_special_tokens = True
    texts = [*odd_texts(), "word and more " * 3000, None, "same", "same"]
    want = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    window = 64
    pieces = packing.tokenize_pieces(documents(spark, texts), WORD, end_id=2, window=window)
    packed = packing.pack(pieces, window=window, group_pieces=200).cache()
    seen, filled = {}, {}
    for r in packed.collect():
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids"] == ids and r["doc_tokens"] == len(want[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen.setdefault(r["doc_id"], []).extend(range(r["start"], r["start"] + r["length"]))
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sorted(seen[i]) == list(range(len(w))) for i, w in enumerate(want))
    for places in filled.values():
        ends = np.cumsum([0, *(n for _, n in sorted(places))])
        assert [o for o, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= window
    total = sum(map(len, want))
    assert len(filled) * window < 1.05 * total
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == total
    assert packing.pack(pieces.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (4, "c"), (4, "c")], "doc_id long, text string")
    rows = packing.pack(packing.tokenize_pieces(odd, WORD, end_id=2)).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 3), (4, 2), (4, 2)]
    assert packed.select(F.min("offset")).first()[0] == 0


def test_packing_spreads_rows_without_an_id(spark):
    pieces = spark.range(12_000).selectExpr("cast(null as long) AS doc_id", "cast(0 as long) AS start", "cast(1 + id % 300 as long) AS length")
    packed = packing.pack(pieces, group_pieces=1_000)
    groups = packed.selectExpr("sequence_id >> 32 AS g").groupBy("g").count().collect()
    assert len(groups) == 12 and max(r["count"] for r in groups) < 1_400
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] <= packing.WINDOW for r in filled) and sum(r["n"] for r in filled) == pieces.agg(F.sum("length")).first()[0]
