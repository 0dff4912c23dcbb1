"""op11, op12, op13: trees, counts and codes against plain forms."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from headway.llm import merkle, queries, token_counts, vector_codes
from headway.llm.common import crc_fold
from tests.llm.test_tokens import ADDED, odd_texts

BYTE = P.path("byte_bpe_50k.json")

# ---- op11 --------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx int, digest string, place int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    fields = (None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text))
    return H("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][at : at + 16]) for at in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    """(left, right) per level."""
    out = []
    for row in levels[:-1]:
        run = at - at % 16
        out.append(("".join(row[run:at]), "".join(row[at + 1 : run + 16])))
        at //= 16
    return out


def plain_manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars) -> result rows, one whole tree at a time."""
    leaves = {}
    for doc_id, text, lang, source, n_chars in rows:
        lowered = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf = plain_leaf(doc_id, source, lang, n_chars, text)
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        node = plain_leaf(doc_id, source, lang, n_chars, lowered) if tampered else leaf
        leaves.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, node))
    order = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(leaves[s])]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, (_, _, leaf, doc_id, node) in enumerate(sorted(leaves[s])):
            path = siblings(trees[s], i) + siblings(top, at)
            for a, b in path:
                node = H(a, node, b)
            proof = H("".join(a + b for a, b in path))
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def tampered_manifest(docs, **options):
    lowered = {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    return merkle.manifest(docs, crc_fold("doc_id") == 0, lowered, **options)


def odd_documents():
    rng = random.Random(5)
    rows = [(i, rng.choice(["Ab É", "low", "", None, "X" * rng.randint(0, 40)]), rng.choice(["en", None]), rng.choice(["a", "B", "é", "", None, *["hot"] * 4]), i % 7 or None) for i in range(700)]
    rows += [(None, "A", "en", "hot", 1), (None, "A", "en", "hot", 1), (5, "Same", None, "hot", 2), (5, "Same", None, "hot", 2), (5, "Other", None, "hot", 2)]
    rows += [(10_000 + i, "One" + "Y" * 300_000 * (i == 0), "en", f"only{i}", 3) for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_equals_whole_trees(spark, levels):
    rows = odd_documents()
    docs = spark.createDataFrame([(*r, "t", 0, "d", 1) for r in rows], DOCS).repartition(5)
    found = tampered_manifest(docs, levels=levels).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted(map(tuple, found.collect()), key=str) == plain_manifest(rows)


def test_manifest_of_no_and_one_row(spark):
    empty = spark.createDataFrame([], DOCS)
    assert tampered_manifest(empty).collect() == []
    one = [(0, "Text", "en", None, 4)]
    docs = spark.createDataFrame([(*one[0], "t", 0, "d", 1)], DOCS)
    assert [tuple(r) for r in tampered_manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()] == plain_manifest(one)


def test_manifest_returns_proofs_that_fold(spark):
    docs = spark.createDataFrame([(*r, "t", 0, "d", 1) for r in odd_documents()], DOCS)
    for row in merkle.manifest(docs, proofs=True, levels=1).collect():
        path = [(level["left"].hex().encode(), level["right"].hex().encode()) for level in row["proof"]]
        assert merkle.fold(row["leaf"].encode(), path).decode() == row["root"] and row["verified"]
        assert merkle.digest(*(x for level in path for x in level)).decode() == row["proof_sha256"]


def test_versions_copy_ancestors_only():
    leaves = [merkle.digest(str(i).encode()) for i in range(600)]
    tree = merkle.PersistentTree(leaves, levels=3)
    before, digests = len(tree.digest), list(tree.digest)
    first = tree.replaced(37, merkle.digest(b"x"))
    assert len(tree.digest) == before + 1 + 3  # the leaf and its ancestors
    second = tree.replaced(500, merkle.digest(b"y"), first)
    assert tree.digest[:before] == digests  # the original is as it was
    changed = list(leaves)
    changed[37] = merkle.digest(b"x")
    assert tree.digest[first] == merkle.PersistentTree(changed, 3).digest[-1]
    changed[500] = merkle.digest(b"y")
    assert tree.digest[second] == merkle.PersistentTree(changed, 3).digest[-1]
    shared = set(tree.children[tree.root]) & set(tree.children[second])
    assert len(shared) == len(tree.children[tree.root]) - 2  # two runs of the block differ


def test_positions_spread_a_hot_tree(spark):
    rows = spark.range(4_000).selectExpr("'=hot' AS tree", "cast(7 AS long) AS doc_id", "cast('same' AS binary) AS leaf")
    placed = merkle.numbered(rows, ["doc_id", "leaf"])
    assert sorted(r["idx"] for r in placed.select("idx").collect()) == list(range(4_000))
    slices = merkle.staged(rows).select("*", F.monotonically_increasing_id().alias("own")).repartitionByRange(8, "tree", "doc_id", "leaf", "own")
    assert slices.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2_000


# ---- op12 --------------------------------------------------------------------


@pytest.mark.parametrize("top", [0, 40, 1 << 18])
def test_counts_equal_untouched_library(spark, top):
    library = Tokenizer.from_file(BYTE)
    texts = [*odd_texts(), *ADDED, "Word " * 20_000, None, "a-b " * 50 + "x" * 5_000]
    docs = spark.createDataFrame([(i if i % 9 else None, t, "r", 1, "p", 2) for i, t in enumerate(texts)], "doc_id long, text string, row string, n int, piece string, n_tokens int").repartition(3)
    found = sorted(map(tuple, token_counts.count_tokens(docs, BYTE, top).select("doc_id", "n_bytes", "n_tokens").collect()), key=str)
    wanted = [(i if i % 9 else None, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    assert found == sorted(wanted, key=str)


def test_split_equals_library():
    words = token_counts.PreTokens(open(BYTE, encoding="utf-8").read())
    for text in odd_texts():
        assert words._plain(text) == [text[a:b] for _, (a, b) in words.library.pre_tokenize_str(text)], text


def test_counts_of_no_rows_and_other_models(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(empty, BYTE).collect() == []
    with pytest.raises(ValueError):
        token_counts.PreTokens(open(P.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_token_counts_query(spark):
    found = queries.op12_token_counts(spark, "/root/testdata/sf0.001")
    library = Tokenizer.from_file(BYTE)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = found.collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == {
        i: (len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 1024) for i, t in texts.items()
    }
    assert len(rows) == len(texts)


# ---- op13 --------------------------------------------------------------------

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()), T.StructField("part", T.StringType()),
])


def plain_codes(rows):
    """(vec_id, code, error, label_error) and the codebooks, one vector at a time, in Python integers."""
    kept = [(i, [int(np.floor(1024 * x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // 4 if kept else 0
    parts = [[v[p * w : (p + 1) * w] for _, v, _ in kept] for p in range(4)]
    books = [own[:256] for own in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), at) for at, entry in enumerate(book))

    for _ in range(4):
        for p in range(4):
            own = {}
            for x in parts[p]:
                own.setdefault(nearest(x, books[p])[1], []).append(x)
            books[p] = [[sum(c) // len(own[at]) for c in zip(*own[at])] if at in own else entry for at, entry in enumerate(books[p])]
    found = [[nearest(x, books[p]) for x in parts[p]] for p in range(4)]
    errors = [sum(found[p][i][0] for p in range(4)) for i in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    out = [(i, "".join(f"{found[p][at][1]:02x}" for p in range(4)), errors[at], by_label[label]) for at, (i, _, label) in enumerate(kept)]
    return out, books


def odd_vectors(n=420, width=8):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=width), 1)], int(i % 3) if i % 4 else None) for i in range(n)]
    rows += [(5, rows[5][1], 1), (5, rows[6][1], 1), (None, rows[7][1], None)] + [(1_000 + i, rows[3][1], 0) for i in range(150)]
    rows += [(2_000, None, 1), (2_001, [None] * width, 1), (2_002, [float("nan"), *[0.0] * (width - 1)], 1), (2_003, [float("inf"), *[0.0] * (width - 1)], 1), (2_004, [-0.0001] * width, 1)]
    return rows


def test_codes_equal_plain_form(spark):
    rows = odd_vectors()
    frame = spark.createDataFrame([(*r, "p") for r in rows], VECTORS).repartition(5)
    codes, books = vector_codes.compress(frame)
    found = vector_codes.with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()
    wanted, plain_books = plain_codes(rows)
    assert [b.tolist() for b in books] == plain_books
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_trie_equals_all_distances_and_shares_prefixes():
    rng = np.random.default_rng(1)
    parts = np.unique(rng.integers(-3, 4, size=(4_000, 6)), axis=0)
    book = rng.integers(-3, 4, size=(50, 6))
    distance = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    for leaves in (1, 40, 10_000):
        trie = vector_codes.PartTrie(parts, leaves)
        entry, found = trie.nearest(book)
        assert (entry == distance.argmin(axis=1)).all() and (found == distance.min(axis=1)).all()
        assert trie.steps < parts.size / 1.5  # prefixes are shared


def test_parts_keep_their_order_as_bytes():
    parts = np.array([[-5, 3], [-5, 4], [0, -9], [7, 0]], np.int64)
    raw = vector_codes.to_bytes(parts)
    assert raw == sorted(raw) and (vector_codes.from_bytes(raw) == parts).all()


def test_codes_of_no_rows_and_unequal_lengths(spark):
    for rows in ([], [(1, None, 1, "p")]):
        codes, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
        assert vector_codes.with_label_error(codes).collect() == [] and all(len(b) == 0 for b in books)
    codes, _ = vector_codes.compress(spark.createDataFrame([(1, [], 1, "p"), (2, [], 1, "p")], VECTORS))
    assert [tuple(r) for r in codes.select("code", "error").collect()] == [("00000000", 0)] * 2
    with pytest.raises(Exception, match="one length"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 4, 1, "p"), (2, [1.0] * 8, 1, "p")], VECTORS))
