"""op3 and op7: joins against brute force over all pairs."""

import random

import numpy as np
import pytest

from headway.llm import embeddings, jaccard, shingles
from headway.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(text, k):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()


def groups(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def brute_components(texts, k, percent):
    sets = [shingle_set(t, k) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return groups(len(sets), links), sets


def near_copies(rng, count, length, changes, vocabulary=400):
    first = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
    out = [" ".join(first)]
    for _ in range(count):
        words = list(first)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(length)] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "One", "one", "ONE two", "one two", "one two three", "One  Two\nthree", "x" * 5000]
    texts += near_copies(rng, 60, 150, 4) + near_copies(rng, 30, 40, 2) + near_copies(rng, 25, 700, 30) + near_copies(rng, 20, 12, 1) + near_copies(rng, 40, 230, 6)
    passage = " ".join(f"p{i}" for i in range(50))
    texts += [f"{passage} " + " ".join(f"q{rng.randrange(9999)}" for _ in range(rng.randint(2, 60))) for _ in range(60)]
    texts += [texts[12]] * 5
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("words,percent,tuning", [(3, 90, {}), (5, 80, {}), (3, 90, {"rare": 1, "pair_factor": 20, "block": 7}), (2, 60, {"rare": 0, "pair_factor": 1, "block": 5})])
def test_components_equal_brute_force(spark, words, percent, tuning):
    tuning = jaccard.Tuning(**tuning)
    texts = corpus(words)
    frame = spark.createDataFrame([(i, t, 1, "x", 2, "y", 3) for i, t in enumerate(texts)], "doc_id long, text string, node int, key string, n int, label string, component_id int")
    found = {r["doc_id"]: r for r in jaccard.similar_components(frame, words, percent, tuning).collect()}
    want, sets = brute_components(texts, words, percent)
    assert [found[i]["component_id"] for i in range(len(texts))] == want
    assert [found[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]


@pytest.mark.parametrize("factor", [1, 4, 30])
def test_index_keys_meet_for_every_similar_pair(factor):
    """Sets at the threshold share an index key, whatever the classes of their elements."""
    rng = random.Random(8)
    for _ in range(300):
        percent = rng.choice([60, 80, 90])
        size = rng.randint(1, 400)
        shared = [rng.getrandbits(63) for _ in range(size)]
        extra = [[rng.getrandbits(63) for _ in range(rng.randint(0, max(1, size // 8)))] for _ in range(2)]
        a, b = ({*shared, *e} for e in extra)
        if 100 * len(a & b) < percent * len(a | b):
            continue
        frequency = {e: rng.choice([2, 5, 50, 500]) if e in a and e in b else rng.choice([1, 1, 3, 60]) for e in a | b}
        keys = []
        for s in (a, b):
            least = sorted(s)[: jaccard.extended_size(len(s), percent)]
            common = [e for e in least if frequency[e] > 1]
            keys.append(set(jaccard.index_keys(len(s), np.array(common, np.uint64), np.array([frequency[e] for e in common]), percent, jaccard.Tuning(pair_factor=factor)).tolist()))
        in_common_prefix = sum(1 for e in a & b if frequency[e] > 1)
        assert in_common_prefix == 0 or keys[0] & keys[1]


def test_failed_edges_are_resolved_by_the_second_pass(spark):
    """With a signature of few bits most forest edges fail; the components stay exact."""
    rng = random.Random(9)
    texts = near_copies(rng, 80, 120, 9) + near_copies(rng, 30, 60, 6)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.similar_components(frame, 3, 90, jaccard.Tuning(bits=64)).collect()}
    assert [found[i] for i in range(len(texts))] == brute_components(texts, 3, 90)[0]


def test_odd_rows(spark):
    same = "a b c d e"
    frame = spark.createDataFrame([(7, same), (7, same), (None, same), (9, same), (3, None), (None, None), (None, "q r s t")], "doc_id long, text string")
    rows = [tuple(r) for r in jaccard.similar_components(frame, 3, 90).collect()]
    assert sorted(rows, key=str) == sorted([(7, 3, 7), (7, 3, 7), (None, 3, 7), (9, 3, 7), (3, 0, 3), (None, 0, None), (None, 2, None)], key=str)
    assert jaccard.similar_components(frame.limit(0), 3, 90).count() == 0


def test_word_hashes_equal_for_equal_words(monkeypatch):
    monkeypatch.setattr(shingles, "SLICE_BYTES", 64)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["Aé", "aé", "b", "ccc", "", "\t", "x" * 50]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    for k in (1, 3, 5):
        got = [frozenset(s.tolist()) for s in shingles.shingle_sets(texts, k)]
        want = [shingle_set(t, k) for t in texts]
        assert [len(s) for s in got] == [len(s) for s in want]
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(60) for j in range(i))
        assert all(len(got[i] & got[j]) == len(want[i] & want[j]) for i in range(60) for j in range(i))


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 9), (9, 7), (1, 1), (200, 300), (300, 200)]
    frame = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    found = {r["node"]: r["component_id"] for r in components(frame).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 5: 5, 9: 5, 7: 5, 1: 1, 200: 200, 300: 200}
    assert components(frame.limit(0)).count() == 0


def vectors(seed, length=64):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(length) for _ in range(150)]
    for cos in (0.999, 0.97, 0.955):
        for _ in range(25):
            v = out[rng.integers(60)]
            v = v / np.linalg.norm(v)
            other = rng.standard_normal(length)
            other -= other @ v * v
            out.append(cos * v + np.sqrt(1 - cos**2) * other / np.linalg.norm(other))
    out += [out[3], out[3] * 2.0, out[200], -out[5]]
    return [v.astype(np.float32).tolist() for v in out]


@pytest.mark.parametrize("length,block", [(64, 1024), (64, 4), (20, 1024)])
def test_embedding_links_equal_brute_force(spark, monkeypatch, length, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = vectors(1, length)
    n = len(rows)
    odd = [None, [], [0.0] * length, [float("nan")] * length, [None, *rows[0][1:]], rows[0] + [0.0], [float("inf")] * length]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in enumerate([*rows, *odd])], "vec_id long, embedding array<float>, node int, codes string")
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    want = groups(n, np.argwhere(linked).tolist())
    got = [found[i]["n_links"] for i in range(n)]
    assert all(g <= w for g, w in zip(got, linked.sum(axis=1)))
    assert sum(got) >= 0.97 * linked.sum()
    if sum(got) == linked.sum():
        assert [found[i]["component_id"] for i in range(n)] == want
    assert [(found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) for i in range(n, n + len(odd))] == [(0, i, True) for i in range(n, n + len(odd))]


def test_embedding_repeated_ids_and_empty(spark):
    frame = spark.createDataFrame([(4, [1.0, 0.0]), (4, [1.0, 0.0]), (2, [2.0, 0.1]), (None, [1.0, 0.0])], "vec_id long, embedding array<double>")
    rows = sorted((tuple(r) for r in embeddings.near_duplicates(frame).collect()), key=str)
    assert rows == sorted([(4, 3, 2, False), (4, 3, 2, False), (2, 3, 2, True), (None, 3, 2, None)], key=str)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_hadamard_keeps_length():
    x = np.random.default_rng(0).standard_normal((5, 32))
    assert np.allclose(np.linalg.norm(embeddings.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(embeddings.hadamard(embeddings.hadamard(x)), x)


def test_rows_without_an_id_bridge_others(spark):
    """1 ~ bridge ~ 3, where all copies of the bridge have no id: one component, as with an id."""
    words = [f"w{i}" for i in range(200)]
    head, tail = [f"p{i}" for i in range(9)], [f"x{i}" for i in range(9)]
    first, bridge, third = " ".join(words), " ".join([*words[:191], *tail]), " ".join([*head, *words[9:191], *tail])
    sets = [shingle_set(t, 3) for t in (first, bridge, third)]
    similar = lambda a, b: 100 * len(a & b) >= 90 * len(a | b)
    assert similar(sets[0], sets[1]) and similar(sets[1], sets[2]) and not similar(sets[0], sets[2])
    lonely = " ".join(f"n{i}" for i in range(60))
    rows = [(1, first), (3, third), *[(None, bridge)] * 40, (8, "else where"), (None, lonely), (None, lonely + " more")]
    found = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 90).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found if r["component_id"] is not None) == [(0, 1)] * 40 + [(1, 1), (3, 1), (8, 8)]
    assert sum(r["component_id"] is None for r in found) == 2 and len(found) == len(rows)


@pytest.mark.parametrize("hashes", range(2, 8))
def test_recall_does_not_fall_with_longer_keys(hashes):
    """Pairs at the threshold meet in a table whatever the number of hashes, which grows with the data."""
    rng = np.random.default_rng(hashes)
    x = rng.standard_normal((1_500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal(x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = (embeddings.bucket_keys(v, hashes).reshape(len(v), -1, embeddings.PROBES) for v in (x, y))
    met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() >= 0.95
