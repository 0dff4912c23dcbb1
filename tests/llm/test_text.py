"""op5, op6, op9: fingerprints, chat snapshots and LM scores against brute force."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from headway.llm import attention, chat, fingerprints, lm, queries

SF = "/root/testdata/sf0.001"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_rows(spark, texts, ids=None):
    rows = list(zip(ids or range(len(texts)), texts, ["x"] * len(texts), [1] * len(texts)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp_words string, k int").repartition(3)
    return fingerprints.compare(frame).collect()


def test_fingerprints(spark):
    rng = random.Random(1)
    prose = [" ".join(rng.choice(["ab", "cde", "éf", "g", "hijk", "lm"]) + str(rng.randrange(300)) for _ in range(n)) for n in (400, 300, 500, 3, 40)]
    texts = [*prose, None, "", prose[0], "one", " ".join(["same word"] * 300), "x" * 2000]
    rows = {r["doc_id"]: r for r in fingerprint_rows(spark, texts)}
    whole = [t or "" for t in texts]
    for i, t in enumerate(whole):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + whole[(i + 1) % len(whole)][:cut]
        assert rows[i]["n_chars"] == len(t)
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i]["near_edited"] <= 1
    assert rows[0]["fingerprint"] == rows[7]["fingerprint"] and rows[5]["fingerprint"] == rows[6]["fingerprint"]
    assert rows[5]["near_next"] == 1.0 and rows[0]["near_next"] < 0.1 < rows[0]["near_edited"]
    assert len({r["fingerprint"] for r in rows.values()}) == len(texts) - 2


def test_fingerprint_is_sensitive_to_order(spark):
    words = [f"w{i}" for i in range(400)]
    blocks = [words[i : i + 8] for i in range(0, 400, 8)]
    random.Random(3).shuffle(blocks)
    moved = " ".join(w for b in blocks for w in b)
    near = " ".join(words[:390] + ["z"] * 10)
    frame = spark.createDataFrame([(" ".join(words), moved, near)], "a string, b string, c string")
    for name in "abc":
        frame = fingerprints.with_fingerprint(frame, name, f"f{name}")
    row = frame.select(fingerprints.likeness("fa", "fb").alias("moved"), fingerprints.likeness("fa", "fc").alias("near")).first()
    assert row["near"] > 0.8 > 0.7 > row["moved"]


@pytest.mark.parametrize("n", [16, 32, 64, 128])
def test_fingerprint_of_short_texts_is_sensitive_to_order(spark, n):
    """Halves swapped: most pairs of k-mers keep their members, but half of them change their order."""
    whole = [[f"t{t}w{i}" for i in range(n)] for t in range(12)]
    frame = spark.createDataFrame([(" ".join(w), " ".join(w[n // 2 :] + w[: n // 2]), " ".join([*w[:-1], "z"])) for w in whole], "a string, b string, c string")
    for name in "abc":
        frame = fingerprints.with_fingerprint(frame, name, f"f{name}")
    rows = frame.select(fingerprints.likeness("fa", "fb").alias("swapped"), fingerprints.likeness("fa", "fc").alias("near")).collect()
    swapped, near = (sum(r[c] for r in rows) / len(rows) for c in ("swapped", "near"))
    assert swapped < 0.6 and near > swapped + 0.1


def test_fingerprint_odd_tables(spark):
    rows = fingerprint_rows(spark, ["a b c d e f g h", "a b c d e f g h", None, "q"], [1, 1, None, 5])
    assert len(rows) == 4 and rows[0].asDict().keys() >= {"near_next", "near_edited"}
    assert len({tuple(r) for r in rows if r["doc_id"] == 1}) == 1
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprints.compare(frame).count() == 0


def brute_maximal(rows):
    said = collections.defaultdict(set)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].add((-(1 << 62) if turn is None else turn, role or "unknown", text or ""))
    whole = {c: tuple(sorted(s)) for c, s in said.items()}
    prefix = lambda a, b: len(a) < len(b) and b[: len(a)] == a and b[len(a)][0] > a[-1][0]
    longest = {c: w for c, w in whole.items() if not any(prefix(w, o) for o in whole.values())}
    first = {}
    for c in sorted(longest):
        first.setdefault(longest[c], c)
    return {c: w for w, c in first.items()}


def test_chat_snapshots(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 2)
    rng = random.Random(5)
    rows = [(None, 0, "user", "lost"), (900, None, None, None), (901, None, None, None), (901, 3, "user", "x")]
    for conv in range(60):
        base = rng.randrange(12)
        for turn in range(rng.randint(1, 7)):
            text = f"t{base}-{turn}" if turn < 4 else f"t{base}-{turn}-{rng.randrange(2)}"
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text))
    rows += rows[10:20]
    rows += [(950, 0, "user", "tie"), (950, 0, "system", "tie"), (951, 0, "user", "tie"), (952, -5, "user", "neg"), (952, 700, "user", "far")]
    frame = spark.createDataFrame([(*r, "b", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, start int")
    want = brute_maximal(rows)
    rendered = chat.render(frame).cache()
    assert {r["conv_id"] for r in rendered.collect()} == set(want)
    spelled = {c: "".join(f"<|{role}|>\n{text}<|end|>\n" for _, role, text in w) for c, w in want.items()}
    assert {r["conv_id"]: r["text"] for r in chat.assemble(rendered).collect()} == spelled
    for r in rendered.collect():
        assert spelled[r["conv_id"]][r["start"] :].startswith(r["rendered"])
        assert r["n_turns"] == len(want[r["conv_id"]])
    assert chat.render(frame.limit(0)).count() == 0


@pytest.fixture(scope="module")
def scored(spark):
    return queries.op9_lm_scoring(spark, SF).toPandas().sort_values("doc_id")


def test_base_scores(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id")
    tokens = [(t or "").encode().translate(LOWER).split() + [None] for t in docs["text"]]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in docs["doc_id"]]
    count = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(count.values()), len(count)
    base = [sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t) for t in tokens]
    assert np.allclose(scored["base_score"], base)
    assert scored["held_out"].tolist() == held
    assert scored["n_tokens"].tolist() == [len(t) for t in tokens]
    assert scored["n_known"].tolist() == [sum(count[w] > 0 for w in t) for t in tokens]
    assert (scored["train_tokens"] == n).all()


def test_rare_words_are_joined(spark, scored, monkeypatch):
    monkeypatch.setattr(lm, "TOP_WORDS", 5)
    monkeypatch.setattr(lm, "HELD_WORDS", 100)
    again = queries.op9_lm_scoring(spark, SF).toPandas().sort_values("doc_id")
    assert np.allclose(again["base_score"], scored["base_score"])
    assert (again["n_known"] == scored["n_known"]).all()


def test_model_learns(scored):
    held = scored[scored["held_out"]]
    subwords = held["score"].sum() / held["n_tokens"].sum()
    assert (scored["score"] < 0).all() and subwords > -6  # an untrained model is below -15


def test_training_covers_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_IDS", 500)
    end, path = 49407, P.path("word_bpe_49k.json")
    encoder = lm.tok.CachedEncoder(lm.tok.model_text(path), keep_space=False)
    texts = ["", "one", *(" ".join(f"Word{i * j % 97}" for i in range(n)) for j, n in enumerate((47, 48, 49, 400, 3000), 1))]
    model = lm.Model(attention.initial(lm.CLASSES), np.arange(end + 1) % lm.CLASSES, np.zeros((1, 1)), np.zeros(1))
    model.classes[end] = lm.END
    got = np.concatenate([t[t >= 0] for _, t in lm.training_groups(lm.WordTable(encoder, model.classes), texts)])
    want = [i for t in texts for i in [*encoder.tok.encode(t.lower(), add_special_tokens=False).ids, end]]
    assert got.tolist() == model.classes[want].tolist()
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    shared = spark.sparkContext.broadcast(lm.tok.model_text(path))
    cut = spark.createDataFrame([(" ".join(t.split()[:48]),) for t in texts], "text string").coalesce(1)
    whole, part = (lm.averaged(model, f, shared) for f in (frame, cut))
    assert not np.allclose(whole["out"], part["out"])


def test_lm_odd_rows(spark):
    texts = [(1, "a b c"), (1, "a b c"), (None, "a b"), (3, None), (4, ""), (5, "word " * 20000), (6, "x" * 100_000)]
    frame = spark.createDataFrame([(i, t, 1, "r", "w") for i, t in texts], "doc_id long, text string, n int, row string, rest string")
    held = zlib_fold_one()
    rows = lm.score(frame, held, P.path("word_bpe_49k.json"), 49407).collect()
    assert len(rows) == len(texts) and all(np.isfinite(r["score"]) and np.isfinite(r["base_score"]) for r in rows)
    assert len({tuple(r) for r in rows if r["doc_id"] == 1}) == 1
    assert lm.score(frame.limit(0), held, P.path("word_bpe_49k.json"), 49407).count() == 0


def zlib_fold_one():
    from headway.llm.common import crc_fold

    return crc_fold("doc_id") == 1


def plain_scores(p, x):
    """log probabilities of all classes at each scored position, query by query, in double."""
    p = {k: v.astype(np.float64) for k, v in p.items()}
    out = np.zeros((len(x), attention.STEP, len(p["bias"])))
    for w, row in enumerate(x):
        for step in range(attention.STEP):
            at = attention.CONTEXT + step
            keys = [k for k in range(at + 1) if row[k] >= 0]
            if row[at] < 0:
                continue
            query = p["embedding"][row[at]] @ p["query"]
            s = np.array([query @ (p["embedding"][row[k]] @ p["key"]) / 4 + p["near"][at - k] for k in keys])
            weights = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
            seen = weights @ (p["embedding"][row[keys]] @ p["value"]) @ p["mix"]
            z = np.tanh(p["embedding"][row[at]] + seen) @ p["out"] + p["bias"]
            out[w, step] = z - z.max() - np.log(np.exp(z - z.max()).sum())
    return out


def test_attention_gradients(monkeypatch):
    monkeypatch.setattr(attention, "BATCH", 2)  # blocks of a step's windows add up
    rng = np.random.default_rng(0)
    p = attention.initial(8)
    p["near"] += rng.standard_normal(attention.LENGTH).astype(np.float32) / 3
    x = rng.integers(0, 8, (3, attention.LENGTH))
    t = rng.integers(0, 8, (3, attention.STEP))
    x[0, :10], t[1, 12:] = -1, -1
    g = attention.gradients(p, x, t)

    def loss(q):
        return -np.take_along_axis(plain_scores(q, x), np.maximum(t, 0)[..., None], 2)[..., 0][t >= 0].mean()

    for name, value in p.items():
        at = tuple(rng.integers(0, s) for s in value.shape)
        up, down = ({k: v.astype(np.float64) for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert g[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=2e-6)


def test_each_token_is_scored_once_and_causally():
    rng = np.random.default_rng(1)
    p = attention.initial(8)
    n = [1, 16, 17, 33, 70]
    offsets = np.cumsum([0, *n])
    tokens = rng.integers(0, 8, offsets[-1])
    inputs, targets, text = attention.windows(tokens, offsets, 0, -1)
    assert np.bincount(text, (targets >= 0).sum(axis=1)).tolist() == n
    got = attention.log_probabilities(p, inputs, targets)
    full = plain_scores(p, inputs)
    steep = {k: v * 40 if k == "out" else v for k, v in p.items()}  # scores that could overflow are shifted
    far = np.take_along_axis(plain_scores(steep, inputs), np.maximum(targets, 0)[..., None].astype(int), 2)[..., 0]
    assert np.allclose(attention.log_probabilities(steep, inputs, targets), np.where(targets >= 0, far, 0), rtol=1e-4, atol=1e-3)
    want = np.where(targets >= 0, np.take_along_axis(full, np.maximum(targets, 0)[..., None].astype(int), 2)[..., 0], 0)
    assert np.allclose(got, want, atol=1e-4)
    changed = tokens.copy()
    changed[offsets[4] + 40 :] = (changed[offsets[4] + 40 :] + 1) % 8
    after = attention.log_probabilities(p, *attention.windows(changed, offsets, 0, -1)[:2])
    mine = np.flatnonzero(text == 4)
    assert np.allclose(after[mine].ravel()[:40], got[mine].ravel()[:40], atol=1e-6)


def test_classes_come_from_all_training_texts(spark):
    """Neighbours are counted over every word of every text, not over some windows of some."""
    path, end = P.path("word_bpe_49k.json"), 49407
    encoder = lm.tok.CachedEncoder(lm.tok.model_text(path), keep_space=False)
    texts = ["", None, "the cat", " ".join(["the cat sat"] * 60 + ["on the mat"]), *(f"a word{i % 7} the end" for i in range(1_100))]
    ids = [encoder.tok.encode(t.lower(), add_special_tokens=False).ids for t in texts if t]
    counts = np.bincount([i for own in ids for i in own], minlength=end + 1)
    frequent = lm.frequent_tokens(counts, end)
    row = {int(t): k for k, t in enumerate(frequent)}
    marks = min(lm.MARKS, len(frequent))
    want = np.zeros((len(frequent), 2 * marks))
    for own in ids:
        for a, b in zip(own, own[1:]):
            want[row[b], row[a]] += 1
            want[row[a], marks + row[b]] += 1
    frame = spark.createDataFrame([(t or "",) for t in texts], "text string").repartition(3)
    got = lm.neighbours(frame, spark.sparkContext.broadcast(lm.tok.model_text(path)), frequent, end)
    assert got.sum() > 0 and np.array_equal(got, want)


def test_ids_written_once_serve_classes_and_training(spark):
    """Neighbours, counts and training need no text: they read ids that one pass has written."""
    path, end = P.path("word_bpe_49k.json"), 49407
    encoder = lm.tok.CachedEncoder(lm.tok.model_text(path), keep_space=False)
    texts = ["", "one", "it's 25% don't Über-x42 你好 end ed", *(f"a word{i % 7} the end" for i in range(300))]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    shared = spark.sparkContext.broadcast(lm.tok.model_text(path))
    ids = lm.token_ids(frame, shared, end).cache()
    want = [encoder.tok.encode(" ".join(lm.words(t)), add_special_tokens=False).ids + [end] for t in texts]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in ids.collect()] == want
    ends = lm.piece_ends(encoder, end + 1)
    counts = lm.token_counts(ids, end, ends)[0]
    assert counts.tolist() == np.bincount([i for own in want for i in own[:-1]], minlength=end + 1).tolist()
    frequent = lm.frequent_tokens(counts, end)
    assert np.array_equal(lm.neighbours(ids, shared, frequent, end), lm.neighbours(frame, shared, frequent, end))
    model = lm.Model(attention.initial(lm.CLASSES), np.arange(end + 1) % lm.CLASSES, np.zeros((1, 1)), np.zeros(1))
    model.classes[end] = lm.END
    a, b = (lm.averaged(model, f, shared) for f in (ids, frame))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_words_are_cut_in_one_go():
    encoder = lm.tok.CachedEncoder(lm.tok.model_text(P.path("word_bpe_49k.json")), keep_space=False)
    simple = ["it's", "end.", "(a,b)", "x42y", "über-all", "Öl", "o'neil's", "--", "a", "a", "25%", "don't,", "'"]
    for given in (simple, [*simple, "你好", "a b"], [], ["", "a"]):
        ids, offsets = encoder.encode_words(given)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [encoder.tok.encode(w, add_special_tokens=False).ids for w in given]
