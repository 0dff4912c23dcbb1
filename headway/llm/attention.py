"""A small causal self-attention model over token classes, in numpy: forward, gradients, training.

One layer: class embeddings, attention with a bias by distance over the last ``CONTEXT`` to
``CONTEXT + STEP`` positions, a residual sum, tanh, and a softmax over the next class.  A token's
probability is that of its class times its share of the class.

A text is scored in overlapping windows: each scores ``STEP`` tokens, every token in exactly one
window, and sees ``CONTEXT`` positions before them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTH = 16
CONTEXT = 16
STEP = 16
LENGTH = CONTEXT + STEP
#: Windows that go through the model at a time.
BATCH = 128

Params = dict[str, np.ndarray]

#: Distance from query (a scored position) to key; keys after the query are masked.
_DISTANCE = np.arange(CONTEXT, LENGTH)[:, None] - np.arange(LENGTH)[None, :]
_CAUSAL = _DISTANCE >= 0


def initial(classes: int, seed: int = 11) -> Params:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return {
        "embedding": (0.5 * rng.standard_normal((classes, WIDTH))).astype(np.float32),
        "query": draw(WIDTH, WIDTH),
        "key": draw(WIDTH, WIDTH),
        "value": draw(WIDTH, WIDTH),
        "mix": draw(WIDTH, WIDTH),
        "near": np.zeros(LENGTH, np.float32),
        "out": draw(WIDTH, classes),
        "bias": np.zeros(classes, np.float32),
    }


def flat(params: Params) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params.values()])


def unflat(values: np.ndarray, like: Params) -> Params:
    parts = np.split(values.astype(np.float32), np.cumsum([p.size for p in like.values()])[:-1])
    return {name: part.reshape(p.shape) for (name, p), part in zip(like.items(), parts)}


def windows(tokens: np.ndarray, offsets: np.ndarray, begin: int, nothing: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts: inputs (n, LENGTH), targets (n, STEP), and the text of each window.

    ``tokens``: classes of all texts, each text closed by its end; ``begin`` is the input before a
    text's first token.  Positions outside the text hold ``nothing``.
    """
    n = np.diff(offsets)
    count = -(-n // STEP)
    text = np.repeat(np.arange(len(n)), count)
    # texts lie one after another, each behind CONTEXT empty positions and its begin, up to a whole step
    room = np.where(n > 0, CONTEXT + count * STEP, 0)
    base = np.cumsum(room) - room
    before = np.full(room.sum() + LENGTH, nothing, np.int16)
    after = before.copy()
    place = np.repeat(base + CONTEXT - offsets[:-1], n) + np.arange(len(tokens))
    after[place] = tokens
    before[place + 1] = tokens  # an end falls on the empty position behind its text, or is cleared below
    before[(base + CONTEXT + n)[n > 0]] = nothing
    before[(base + CONTEXT)[n > 0]] = begin
    start = base[text] + (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * STEP
    view = np.lib.stride_tricks.sliding_window_view
    return view(before, LENGTH)[start], view(after, STEP)[start + CONTEXT], text


@dataclass
class Tables:
    """What depends on one class, or on a pair of classes: the last row or column is for no class."""

    query: np.ndarray
    key: np.ndarray
    #: exponentials of all scores of query and key
    weight: np.ndarray
    #: exponentials of the bias by distance, 0 where a key is after its query
    near: np.ndarray
    #: values after the mix
    value: np.ndarray
    embedding: np.ndarray

    @classmethod
    def of(cls, p: Params) -> Tables:
        e, nothing = p["embedding"], np.zeros((1, WIDTH), np.float32)
        query, key = e @ p["query"] / np.float32(np.sqrt(WIDTH)), e @ p["key"]
        weight = np.zeros((len(e) + 1, len(e) + 1), np.float32)
        weight[:-1, :-1] = np.exp(np.clip(query @ key.T, -40, 40))
        near = np.where(_CAUSAL, np.exp(np.clip(p["near"], -40, 40))[np.maximum(_DISTANCE, 0)], 0).astype(np.float32)
        return cls(query, key, weight.ravel(), near, np.vstack([e @ p["value"] @ p["mix"], nothing]), np.vstack([e, nothing]))


class Space:
    """Arrays that are written again for each block of windows; fresh ones cost more than the arithmetic."""

    def __init__(self) -> None:
        self.arrays: dict[str, np.ndarray] = {}

    def __call__(self, name: str, n: int, *shape: int, dtype: type = np.float32) -> np.ndarray:
        """An array (n, *shape) of any content, n at most ``BATCH`` times the positions of a window."""
        held = self.arrays.get(name)
        if held is None or len(held) < n:
            held = self.arrays[name] = np.empty((n, *shape), dtype)
        return held[:n]


_ONES = np.ones(1024, np.float32)


def _attend(t: Tables, inputs: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes, pairs of classes, values, attention weights (n, STEP, LENGTH) and the sums that they give.

    A position outside the text weighs nothing; a query outside has no weights and scores no target.
    """
    n, nothing = len(inputs), len(t.embedding) - 1
    x = space("x", n, LENGTH, dtype=np.intp)
    np.copyto(x, inputs)
    x[x < 0] = nothing
    pairs = space("pairs", n, STEP, LENGTH, dtype=np.intp)
    np.add((x[:, CONTEXT:] * (nothing + 1))[:, :, None], x[:, None, :], out=pairs)
    a = t.weight.take(pairs, mode="clip", out=space("a", n, STEP, LENGTH))
    a *= t.near
    total = a @ _ONES[:LENGTH]
    np.maximum(total, np.float32(1e-30), out=total)
    np.divide(1, total, out=total)
    a *= total[..., None]
    v = t.value.take(x, axis=0, mode="clip", out=space("v", n, LENGTH, WIDTH))
    return x, pairs, v, a, np.matmul(a, v, out=space("c", n, STEP, WIDTH))


def _hidden(t: Tables, x: np.ndarray, c: np.ndarray, space: Space) -> np.ndarray:
    y = t.embedding.take(x[:, CONTEXT:], axis=0, mode="clip", out=space("y", len(x), STEP, WIDTH))
    y += c
    return np.tanh(y, out=y).reshape(-1, WIDTH)


def _scores(p: Params, y: np.ndarray, space: Space) -> np.ndarray:
    """Scores of the next class, less their greatest where they could overflow (|y| is at most 1)."""
    z = np.matmul(y, p["out"], out=space("z", len(y), p["out"].shape[1]))
    z += p["bias"]
    if (np.abs(p["out"]).sum(axis=0) + np.abs(p["bias"])).max() > 60:
        z -= z.max(axis=1, keepdims=True)
    return z


def log_probabilities(p: Params, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target class, 0 where there is none; like ``targets``."""
    tables, space = Tables.of(p), Space()
    out = np.zeros(targets.shape, np.float64)
    for at in range(0, len(inputs), BATCH):
        x, _, _, _, c = _attend(tables, inputs[at : at + BATCH], space)
        t = targets[at : at + BATCH].ravel()
        z = _scores(p, _hidden(tables, x, c, space), space)
        got = z[np.arange(len(t)), np.maximum(t, 0)]
        got -= np.log(np.exp(z, out=z) @ _ONES[: z.shape[1]])
        out[at : at + BATCH] = np.where(t >= 0, got, 0).reshape(-1, targets.shape[1])
    return out


def _by_class(classes: np.ndarray, rows: np.ndarray, out: np.ndarray, space: Space) -> None:
    """Add the rows of each class to its row of ``out``."""
    order = np.argsort(classes.astype(np.uint16), kind="stable")
    count = np.bincount(classes, minlength=len(out))
    found = np.flatnonzero(count)
    ordered = rows.take(order, axis=0, mode="clip", out=space("ordered", len(rows), rows.shape[1]))
    out[found] += np.add.reduceat(ordered, (np.cumsum(count) - count)[found], axis=0)


def gradients(p: Params, inputs: np.ndarray, targets: np.ndarray, space: Space | None = None) -> Params:
    """Gradients of the mean negative log probability, gathered by class and pair of classes."""
    tables, space = Tables.of(p), space or Space()
    e, classes = p["embedding"], len(p["embedding"])
    share = np.float32(1 / max(1, (targets >= 0).sum()))
    out, bias, near = np.zeros_like(p["out"]), np.zeros_like(p["bias"]), np.zeros((STEP, LENGTH), np.float32)
    by_pair, dv, dy = np.zeros((classes + 1) ** 2), np.zeros((classes + 1, WIDTH), np.float32), np.zeros((classes + 1, WIDTH), np.float32)
    for at in range(0, len(inputs), BATCH):
        x, pairs, v, a, c = _attend(tables, inputs[at : at + BATCH], space)
        n, t = len(x), targets[at : at + BATCH].ravel()
        y = _hidden(tables, x, c, space)
        dz = _scores(p, y, space)
        np.exp(dz, out=dz)
        own = (t >= 0) * share
        dz *= (own / (dz @ _ONES[:classes]))[:, None]
        dz[np.arange(len(t)), np.maximum(t, 0)] -= own
        out += y.T @ dz
        bias += _ONES[:1].repeat(len(dz)) @ dz
        flat_dc = np.matmul(dz, p["out"].T, out=space("dc", len(dz), WIDTH))
        y *= y
        np.subtract(1, y, out=y)
        flat_dc *= y
        dc = flat_dc.reshape(n, STEP, WIDTH)
        ds = np.matmul(dc, v.transpose(0, 2, 1), out=space("ds", n, STEP, LENGTH))
        c *= dc
        ds -= (c.reshape(-1, WIDTH) @ _ONES[:WIDTH]).reshape(n, STEP, 1)  # the mean over the keys, by their weights
        weights = np.multiply(ds, a, out=space("weights", n, STEP, LENGTH, dtype=np.float64))
        near += weights.sum(axis=0)
        by_pair += np.bincount(pairs.ravel(), weights.ravel(), minlength=len(by_pair))
        back = np.matmul(a.transpose(0, 2, 1), dc, out=space("back", n, LENGTH, WIDTH))
        _by_class(x.ravel(), back.reshape(-1, WIDTH), dv, space)
        _by_class(x[:, CONTEXT:].ravel(), flat_dc, dy, space)
    by_pair, dv, dy = by_pair.reshape(classes + 1, -1)[:-1, :-1], dv[:-1], dy[:-1]
    dq, dk = by_pair @ tables.key / np.sqrt(WIDTH), by_pair.T @ tables.query  # query holds the scale already
    g = {
        "embedding": dy + dq @ p["query"].T + dk @ p["key"].T + dv @ (p["value"] @ p["mix"]).T,
        "query": e.T @ dq,
        "key": e.T @ dk,
        "value": e.T @ dv @ p["mix"].T,
        "mix": (e @ p["value"]).T @ dv,
        "near": np.bincount(_DISTANCE[_CAUSAL], near[_CAUSAL], minlength=LENGTH),
        "out": out,
        "bias": bias,
    }
    return {name: g[name].astype(np.float32) for name in p}


@dataclass
class Trainer:
    """Adam over shuffled batches of windows."""

    params: Params
    rate: float = 0.01

    def __post_init__(self) -> None:
        self.mean = np.zeros(len(flat(self.params)), np.float32)
        self.square = np.zeros_like(self.mean)
        self.steps = 0
        self.space = Space()

    def step(self, inputs: np.ndarray, targets: np.ndarray) -> None:
        self.steps += 1
        g = flat(gradients(self.params, inputs, targets, self.space))
        self.mean = 0.9 * self.mean + 0.1 * g
        self.square = 0.99 * self.square + 0.01 * g * g
        m, s = self.mean / (1 - 0.9**self.steps), self.square / (1 - 0.99**self.steps)
        self.params = unflat(flat(self.params) - self.rate * m / (np.sqrt(s) + 1e-8), self.params)

    def train(self, inputs: np.ndarray, targets: np.ndarray, rounds: int, seed: int = 5, batch: int = 64) -> None:
        rng = np.random.default_rng(seed)
        for _ in range(rounds):
            order = rng.permutation(len(inputs))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                self.step(inputs[some], targets[some])
