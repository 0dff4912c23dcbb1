"""Word shingles of whole texts as sorted sets of 64-bit hashes, computed for a batch at a time."""

from __future__ import annotations

import hashlib

import numpy as np

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes of text that are hashed at a time.
SLICE_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs stay equal, others are spread evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, offsets of the texts in them); A-Z count as a-z.

    A word's hash is a polynomial of its bytes, taken from running sums over the whole buffer.
    """
    raw = [t.encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    begin, end = edge[::2], edge[1::2]
    power = np.full(len(data), _BASE)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power)])
    back = np.full(len(data), _INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    words = mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))
    text_end = np.cumsum([len(r) + 1 for r in raw])
    return words, np.concatenate([[0], np.searchsorted(begin, text_end)])


def _combined(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    out = mix(words[:n] + np.uint64(k))
    for j in range(1, k):
        out = mix(out * _BASE + words[j : j + n])
    return out


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct k-word shingles; with fewer words, of the whole sequence."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
            size += len(texts[end])
            end += 1
        words, offsets = word_hashes(texts[at:end])
        every = _combined(words, k) if len(words) >= k else words[:0]
        for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
            if b - a >= k:
                out.append(np.unique(every[a : b - k + 1]))
            else:
                out.append(_combined(words[a:b], b - a) if b > a else words[:0])
        at = end
    return out


def set_id(hashes: np.ndarray) -> int:
    """A signed 64-bit id of a whole set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)
