"""Fast whole-text encoding with the tokenizers library: each distinct chunk is encoded once.

A byte-level or word-level BPE splits a text before merging, and where runs of spaces and line
feeds are cut as its pattern cuts them, the ids of a text are the ids of its chunks in order.
Chunks recur (words do), so each process keeps a bounded table chunk -> ids and calls the library
for new chunks only, many of them joined by a separator whose id nothing else yields.  The one
case in which such a cut would be wrong is other white space next to a space or line feed, as that
run belongs together; such a text is handed to the library in one piece.

Where ``added_tokens`` is set, the string of an added token in a text stands for that token, as in
a tokenizer that is used as loaded; a text that holds one is handed over in one piece as well.
Otherwise such a string is ordinary text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np

#: The table is begun anew when it holds so many chunks, or so many characters and ids.
MAX_CHUNKS = 800_000
MAX_HELD = 32_000_000
#: Characters of text that are cut into chunks at a time.
SLICE_CHARS = 1_000_000

#: With a leading space: the cuts of the byte-level pattern at spaces and line feeds.
_WITH_SPACE = re.compile(r" ?[^ \n]+|\n(?=[^ \n])|[ \n]+(?=[ \n][^ \n])|[ \n]+$")
_WITHOUT_SPACE = re.compile(r"[^ \n]+")
#: Texts of printable ASCII and Latin letters only may also be cut behind a run of letters and
#: digits, unless an apostrophe follows: no piece of the patterns goes on there.
_NOT_SIMPLE = re.compile(r"[^\x20-\x7e\n\u00c0-\u00ff]")
_LETTERS = r"\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_SIMPLE_WITH_SPACE = re.compile(rf" ?[0-9A-Za-z{_LETTERS}]++(?!')|" + _WITH_SPACE.pattern)
_SIMPLE_WITHOUT_SPACE = re.compile(rf"[0-9A-Za-z{_LETTERS}]++(?!')|" + _WITHOUT_SPACE.pattern)
#: The same cuts of words that are joined by line feeds; a line feed is a chunk by itself.
_SIMPLE_WORDS = re.compile(_SIMPLE_WITHOUT_SPACE.pattern + r"|\n")
_ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_OTHER_SPACE = re.compile(r"[^\S \n]")
_UNSAFE = re.compile(r"[^\S \n][ \n]|[ \n][^\S \n]")
#: A superscript two is a piece of its own under patterns that cut off each numeral.
_NUMERAL = "\u00b2"

#: Chunks that a separator can stand next to: no white space at their edges, no separator inside.
_PLAIN_SPACED = re.compile(r" ?\S(?:[^\n]*\S)?")
_PLAIN = re.compile(rf"[^\s{_NUMERAL}](?:[^\n{_NUMERAL}]*[^\s{_NUMERAL}])?")

_ENCODERS: dict[tuple[int, bool, bool], CachedEncoder] = {}


#: Chunks that every pattern leaves in one piece: Latin letters, in lower case where case is dropped.
_WORD = re.compile(f" ?[A-Za-z{_LETTERS}]+")
_LOWER_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_alphabet() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest for 256, 257, ..."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(rest)}


_ALPHABET = _byte_alphabet()


def _byte_level(chunk: str) -> str:
    """A chunk of _WORD in that alphabet; of its ASCII characters only the space is not shown as itself."""
    if chunk.isascii():
        return "\u0120" + chunk[1:] if chunk[0] == " " else chunk
    return chunk.encode().decode("latin-1").translate(_ALPHABET)


class Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _lowered(text: str) -> str:
    return text.encode().translate(_ASCII_LOWER).decode()


class ChunkTable:
    """Ids of whole texts, chunk by chunk; subclasses know the ids of a chunk.

    The table is begun anew when it holds more than ``max_chunks`` or ``MAX_HELD``.
    """

    max_chunks = MAX_CHUNKS
    #: Finds strings whose texts may not be cut.
    apart: re.Pattern[str] | None = None

    def __init__(self, keep_space: bool, lower: bool, dtype: type):
        self.simple, self.chunk = (_SIMPLE_WITH_SPACE, _WITH_SPACE) if keep_space else (_SIMPLE_WITHOUT_SPACE, _WITHOUT_SPACE)
        self.lower, self.dtype = lower, dtype
        self._clear()

    def ids_of(self, chunks: list[str]) -> Iterator[list[int]]:
        """The ids of each chunk, which may be any text."""
        raise NotImplementedError

    def whole(self, text: str) -> list[int]:
        """The ids of a text that may not be cut."""
        return next(iter(self.ids_of([text])))

    def _clear(self) -> None:
        self.table = Numbers()
        self.pool = np.empty(1 << 16, self.dtype)
        self.start = np.zeros((1 << 14) + 1, np.int64)
        self.chars = 0

    def _learn(self, new: list[str]) -> None:
        """Find the ids of unseen chunks; they have the next numbers of the table, in this order."""
        done = len(self.table) - len(new)
        lens, flat = [], []
        for ids in self.ids_of(new):
            lens.append(len(ids))
            flat += ids
        used, total = int(self.start[done]), len(flat)
        while used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while done + len(new) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.pool[used : used + total] = flat
        self.start[done + 1 : done + 1 + len(new)] = used + np.cumsum(lens)
        self.chars += sum(map(len, new))

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each text, for texts that may be cut."""
        if len(self.table) > self.max_chunks or self.chars + self.start[len(self.table)] > MAX_HELD:
            self._clear()
        known = len(self.table)
        codes: list[int] = []
        ends = [0]
        for t in texts:
            if _NOT_SIMPLE.search(t):
                chunks = self.chunk.findall(t)
            else:
                chunks = self.simple.findall(_lowered(t) if self.lower else t)
            codes += map(self.table.__getitem__, chunks)
            ends.append(len(codes))
        if len(self.table) > known:
            self._learn(list(islice(self.table, known, None)))
        return self._gather(np.array(codes, np.int64), ends)

    def _gather(self, code: np.ndarray, ends: np.ndarray | list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the chunks of that number, and how many lie between two ``ends``."""
        begin, lens = self.start[code], self.start[code + 1] - self.start[code]
        before = np.concatenate([[0], np.cumsum(lens)])
        ids = self.pool[np.repeat(begin - before[:-1], lens) + np.arange(before[-1])]
        return ids, np.diff(before[ends])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, for words without a space or line feed: where the model drops spaces, simple ones are cut in one go."""
        joined = "\n".join([*words, ""])
        if self.simple is not _SIMPLE_WITHOUT_SPACE or self.apart is not None or _NOT_SIMPLE.search(joined) or not all(words):
            return self.encode(words)
        if len(self.table) > self.max_chunks or self.chars + self.start[len(self.table)] > MAX_HELD:
            self._clear()
        known = len(self.table)
        line = self.table["\n"]
        code = np.array(list(map(self.table.__getitem__, _SIMPLE_WORDS.findall(_lowered(joined) if self.lower else joined))), np.int64)
        if len(self.table) > known:
            self._learn(list(islice(self.table, known, None)))
        lines = np.flatnonzero(code == line)
        ids, lens = self._gather(code[code != line], np.concatenate([[0], lines - np.arange(len(lines))]))
        return ids, np.concatenate([[0], np.cumsum(lens)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of the texts in them)."""
        ids, lens, at = [], [], 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= SLICE_CHARS):
                chars += len(texts[end])
                end += 1
            part = texts[at:end]
            whole = [bool(_OTHER_SPACE.search(t)) and bool(_UNSAFE.search(t)) or self.apart is not None and bool(self.apart.search(t)) for t in part]
            got, n = self._cut([t for t, w in zip(part, whole) if not w])
            if any(whole):
                cut = iter(np.split(got, np.cumsum(n)[:-1]))
                each = [np.array(self.whole(t), self.dtype) if w else next(cut) for t, w in zip(part, whole)]
                got, n = np.concatenate(each), np.array([len(e) for e in each], np.int64)
            ids.append(got)
            lens.append(n)
            at = end
        if not ids:
            return np.empty(0, self.dtype), np.zeros(1, np.int64)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(lens))])


class CachedEncoder(ChunkTable):
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    With ``added_tokens`` those of the tokenizer as loaded, else with ``encode_special_tokens`` set.
    """

    def __init__(self, model_json: str, keep_space: bool, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(model_json)
        self.tok.encode_special_tokens = True  # their strings are ordinary text, also where lower case makes one
        if added := json.loads(model_json).get("added_tokens", []) if added_tokens else []:
            anyhow = re.IGNORECASE if any(a["normalized"] for a in added) else 0
            self.apart = re.compile("|".join(re.escape(a["content"]) for a in added), anyhow)
            self.loaded = Tokenizer.from_str(model_json)
        upper, lower = self.tok.encode_batch(["AZ", "az"], add_special_tokens=False)
        # where the model tells no cases apart, neither does the table
        super().__init__(keep_space, upper.ids == lower.ids, np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.int32)
        self.mark = "\n" if keep_space else f" {_NUMERAL} "
        (self.mark_id,) = self.tok.encode(self.mark, add_special_tokens=False).ids
        self.word = (_WORD if keep_space else _LOWER_WORD).fullmatch
        self.plain = (_PLAIN_SPACED if keep_space else _PLAIN).fullmatch

    def whole(self, text: str) -> list[int]:
        if self.apart and self.apart.search(text):
            return self.loaded.encode(text, add_special_tokens=False).ids
        return super().whole(text)

    def ids_of(self, chunks: list[str]) -> Iterator[list[int]]:
        word = self.tok.model.tokenize
        others = iter(self._library_ids([c for c in chunks if not self.word(c)]))
        for c in chunks:
            # one piece, for which the library's model can be asked directly
            yield [t.id for t in word(_byte_level(c))] if self.word(c) else next(others)

    def _library_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks of any kind; most go through the library joined by the separator."""
        plain = [c for c in chunks if self.plain(c)]
        found: dict[str, list[int]] = {}
        for at in range(0, len(plain), 2_000):
            part = plain[at : at + 2_000]
            (got,) = self.tok.encode_batch_fast([self.mark + self.mark.join(part)], add_special_tokens=False)
            ids = np.array(got.ids)
            begins = np.flatnonzero(ids == self.mark_id)
            assert len(begins) == len(part), "the separator is not a piece of its own under this model"
            ends = np.append(begins[1:], len(ids)).tolist()
            found.update((c, got.ids[a + 1 : b]) for c, a, b in zip(part, begins.tolist(), ends))
        return [found[c] if c in found else self.tok.encode(c, add_special_tokens=False).ids for c in chunks]


def encoder(model_json: str, keep_space: bool, added_tokens: bool = False) -> CachedEncoder:
    """The process's encoder for this model; Spark's reused workers keep its table between tasks."""
    key = (hash(model_json), keep_space, added_tokens)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = CachedEncoder(model_json, keep_space, added_tokens)
    return _ENCODERS[key]


def model_text(path: str) -> str:
    """The tokenizer's file, read on the driver; a few MB, whatever the size of the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def append_id(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Put ``end_id`` behind the ids of each text."""
    n = len(offsets) - 1
    moved = offsets + np.arange(n + 1)
    out = np.empty(len(ids) + n, np.int32)
    ends = moved[1:] - 1
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = ids
    out[ends] = end_id
    return out, moved
