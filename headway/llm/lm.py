"""LM scoring (operator 9): a causal self-attention model on subword ids, beside a word unigram base.

What is learned, and from what:

* Word counts over all training documents (grouped on Spark).  They give the base score.
* Subword ids of all texts, each closed by its end id: one pass encodes them and writes them as a
  column, and all that is learned or scored by ids reads that.
* How often each subword id follows each class inside words, in all training documents.
* Token classes, from the neighbours of the ``FREQUENT`` most frequent tokens in all training documents,
  counted by tasks and summed up on Spark; a table of fixed size comes back.
* The attention model: it trains on every token of every training document and the end, in the
  windows in which a text is scored; each partition trains on its windows from the common start
  (drawn at random, with each class at its share of all training tokens), and the parameters are
  averaged by the number of windows, as a grouped sum over parameter numbers.

A text is scored whole: its subword ids and the end id, in overlapping windows, each token once;
log10 of the attention model's probability for its class, times the token's share in that class
after the class before it (or at a word's start).  Both scores are over the
lower-case words of the text, white space aside.

The base needs the count of every word of a document.  The ``TOP_WORDS`` most frequent words (of
bounded length) are sent to all tasks, a table of fixed size; the others are joined, one row per
document and distinct word.

Defined results: a null text is empty (one token, the end); texts of any length train and are
scored whole, in as many windows as they need; words of equal count are ranked by their text;
repeated rows are scored each; a null
id belongs to no training document and isn't held out (null); without training documents words have
count 0 and the model is untrained; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm import attention
from headway.llm import tokens as tok
from headway.llm.common import bounded_batches, staged, struct_type

CLASSES = 64
#: Tokens that are put into classes by their neighbours, and how many of them count as neighbours.
FREQUENT, MARKS = 4096, 256
#: Pairs of neighbours that a task holds before it adds them up.
HELD_PAIRS = 1 << 22
#: Subword ids of whole texts that are shuffled together in training, at least.
GROUP_IDS = 1 << 18
#: Adam's rate, and the windows of one step.
RATE, BATCH_WINDOWS = 0.01, 128
TOP_WORDS = 1 << 17
TOP_WORD_CHARS = 32
#: Distinct words that a process remembers before it begins anew.
TABLE_WORDS = 900_000
#: Word parts that the encoder remembers beside that; each word asks it once.
ENCODER_CHUNKS = 100_000
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 400_000
#: Weight of a token's overall share in its class against its counts after a context.
SMOOTHING = 20.0

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END, BEGIN, REST = 0, 0, CLASSES - 1

COUNTS = struct_type(word=T.StringType(), n=T.LongType())
IDS = struct_type(ids=T.BinaryType())
TOKENS = struct_type(token=T.IntegerType(), n=T.LongType())
WEIGHTS = struct_type(parameter=T.IntegerType(), total=T.DoubleType(), weight=T.LongType())
_BASE = dict(doc_id=T.LongType(), held_out=T.BooleanType(), n_tokens=T.LongType(), n_known=T.LongType(), base=T.DoubleType())
ENCODED = struct_type(**_BASE, ids=T.BinaryType(), rest=T.ArrayType(T.StringType()), rest_n=T.ArrayType(T.LongType()))
SCORED = struct_type(**_BASE, row=T.LongType(), score=T.DoubleType())


def words(text: str) -> list[str]:
    """Words of a text between ASCII white space, A-Z as a-z."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").translate(_LOWER).split()]


def word_counts(texts: DataFrame) -> DataFrame:
    """word and n over all rows of ``texts`` (text); summed up per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            spelled = [w.decode("utf-8", "surrogatepass") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(spelled, pa.string()), pa.array(list(held.values()), pa.int64())], names=COUNTS.names)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(text.encode("utf-8", "surrogatepass").translate(_LOWER).split())
                if len(held) > HELD_WORDS:
                    yield rows()
                    held.clear()
        yield rows()

    return texts.select("text").mapInArrow(run, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


def _binary(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])


def token_ids(texts: DataFrame, model_json: Broadcast, end_id: int) -> DataFrame:
    """Subword ids of each text, closed by its end (ids); a frame that has them stays as it is."""
    if "ids" in texts.columns:
        return texts.select("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(tok.encoder(model_json.value, keep_space=False), np.arange(end_id + 1), end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids = table.tokens(*table.look_up(batch.column("text").slice(at, 256).to_pylist()))
                yield pa.RecordBatch.from_arrays([_binary(*ids)], names=IDS.names)

    return texts.select("text").mapInArrow(run, IDS)


def token_counts(encoded: DataFrame, end_id: int, ends: np.ndarray, classes: np.ndarray | None = None) -> np.ndarray:
    """How often each subword id occurs in the texts (ids), as (1, ids); ends don't count.

    With ``classes``, how often it follows each class inside a piece, or starts one: (CLASSES + 1, ids).
    At most a row per number reaches the driver, whatever the size of the data.
    """
    contexts = 1 if classes is None else CLASSES + 1
    size = end_id + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, table = np.zeros(contexts * size, np.int64), IdTable(np.arange(size))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, offsets = table.look_up(batch.column("ids").slice(at, 256).to_pylist())
                places = ids.astype(np.int64)
                if classes is not None:
                    places += size * contexts_of(ids, offsets, classes, ends)
                np.add.at(total, places[ids != end_id], 1)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=TOKENS.names)

    rows = encoded.select("ids").mapInArrow(run, TOKENS).groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(contexts * size)
    out[np.asarray(rows["token"])] = np.asarray(rows["n"])
    return out.reshape(contexts, size)


def piece_ends(encoder: tok.CachedEncoder, size: int) -> np.ndarray:
    """Whether each id ends a piece of the tokenizer."""
    return np.array([(encoder.tok.id_to_token(i) or "").endswith("</w>") for i in range(size)])


def contexts_of(ids: np.ndarray, offsets: np.ndarray, classes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per id the class of the one before it in its piece; CLASSES where a piece starts."""
    before = np.roll(ids, 1)
    out = np.where(ends[before], CLASSES, classes[before])
    out[offsets[:-1][offsets[:-1] < len(ids)]] = CLASSES
    return out


def frequent_tokens(counts: np.ndarray, end_id: int) -> np.ndarray:
    frequent = np.argsort(-counts[:end_id], kind="stable")[:FREQUENT]
    return frequent[counts[frequent] > 0]


def neighbours(texts: DataFrame, model_json: Broadcast, frequent: np.ndarray, end_id: int) -> np.ndarray:
    """How often each frequent token has each of the first ``MARKS`` of them before it, then after it, in all ``texts``.

    At most a row per number reaches the driver, whatever the size of the data.
    """
    marks = min(MARKS, len(frequent))
    size = len(frequent) * 2 * marks
    if not size:
        return np.zeros((0, 0))
    rank = np.zeros(end_id + 1, np.int64)  # from 1; 0: another token or an end
    rank[frequent] = np.arange(1, len(frequent) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = IdTable(rank)
        total, held, n = np.zeros(size, np.int64), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                tokens, _ = table.tokens(*table.look_up(batch.column("ids").slice(at, 256).to_pylist()))
                left, right = tokens[:-1], tokens[1:]  # an end between two texts
                before, after = (left > 0) & (left <= marks) & (right > 0), (right > 0) & (right <= marks) & (left > 0)
                held += [(right[before] - 1) * 2 * marks + left[before] - 1, (left[after] - 1) * 2 * marks + marks + right[after] - 1]
                n += len(tokens)
                if n > HELD_PAIRS:
                    total += np.bincount(np.concatenate(held), minlength=size)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=TOKENS.names)

    rows = token_ids(texts, model_json, end_id).mapInArrow(run, TOKENS).groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[np.asarray(rows["token"])] = np.asarray(rows["n"])
    return out.reshape(len(frequent), 2 * marks)


def token_classes(counts: np.ndarray, frequent: np.ndarray, near: np.ndarray, end_id: int) -> np.ndarray:
    """Class of each id: tokens of like neighbours together; the end alone, unseen and rare ones in the last."""
    classes = np.full(end_id + 1, REST)
    x = np.sqrt(near)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    groups = min(CLASSES - 2, len(x))
    if groups:
        centres = x[:groups].copy()  # the most frequent tokens lead
        weight = np.sqrt(counts[frequent])[:, None]
        for _ in range(15):
            own = (x @ centres.T).argmax(axis=1)
            for j in range(groups):
                if (own == j).any():
                    centres[j] = (x[own == j] * weight[own == j]).sum(axis=0)
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        own = (x @ centres.T).argmax(axis=1)
        classes[frequent] = np.where(near.sum(axis=1) > 0, own + 1, REST)
    classes[end_id] = END
    return classes


@dataclass
class Model:
    params: attention.Params
    classes: np.ndarray
    #: log10 share of each id in its class, by the context before it
    share: np.ndarray
    ends: np.ndarray

    def log_shares(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 of the shares of each text's tokens in their classes, added up; an end is all of its class."""
        each = self.share[contexts_of(ids, offsets, self.classes, self.ends), ids].astype(np.float64)
        return _sums(each, offsets)

    def score(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each text, given by its ids and its end."""
        inputs, targets, text = attention.windows(self.classes[ids], offsets, BEGIN, -1)
        by_window = attention.log_probabilities(self.params, inputs, targets).sum(axis=1) / math.log(10)
        return np.bincount(text, by_window, minlength=len(offsets) - 1) + self.log_shares(ids, offsets)


class IdTable:
    """The classes (or other small numbers) of the tokens of texts that are given by their ids and ends."""

    def __init__(self, classes: np.ndarray):
        self.classes = classes

    def look_up(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offsets of the texts in them."""
        return np.frombuffer(b"".join(raw), "<u4"), np.cumsum([0, *(len(r) // 4 for r in raw)])

    def tokens(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.classes[ids], offsets


class WordTable:
    """The classes (or other numbers) of each word's tokens; a word is encoded once.  ``end`` closes a text."""

    def __init__(self, encoder: tok.CachedEncoder, classes: np.ndarray, end: int = END):
        self.encoder, self.class_of, self.end = encoder, classes.astype(np.min_scalar_type(classes.max(initial=0))), end
        encoder.max_chunks = ENCODER_CHUNKS
        self.clear()

    def clear(self) -> None:
        self.numbers = tok.Numbers()
        self.words: list[bytes] = []
        self.classes = np.empty(0, self.class_of.dtype)
        self.start = np.zeros(1, np.int64)

    def look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts, and the offsets of the texts in them."""
        if len(self.numbers) > TABLE_WORDS:
            self.clear()
        known, found, ends = len(self.numbers), [], [0]
        for text in texts:
            found += map(self.numbers.__getitem__, text.encode("utf-8", "surrogatepass").translate(_LOWER).split())
            ends.append(len(found))
        new = list(islice(self.numbers, known, None))
        if new:
            self.add(new, *self.encoder.encode_words([w.decode("utf-8", "surrogatepass") for w in new]))
        return np.array(found, np.int64), np.array(ends)

    def add(self, new: list[bytes], ids: np.ndarray, offsets: np.ndarray) -> None:
        self.words += new
        self.classes = np.concatenate([self.classes, self.class_of[ids]])
        self.start = np.concatenate([self.start, self.start[-1] + offsets[1:]])

    def tokens(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of the tokens of all texts, each text closed by its end, and the offsets of the texts."""
        begin, lens = self.start[words], self.start[words + 1] - self.start[words]
        before = np.concatenate([[0], np.cumsum(lens)])
        flat = self.classes[np.repeat(begin - before[:-1], lens) + np.arange(before[-1])]
        closed = before[offsets] + np.arange(len(offsets))
        out = np.full(closed[-1], self.end, np.int64)
        inside = np.ones(closed[-1], bool)
        inside[closed[1:] - 1] = False
        out[inside] = flat
        return out, closed


class CountTable(WordTable):
    """The ids of each word, and its count if it is a top word."""

    def __init__(self, encoder: tok.CachedEncoder, end_id: int, top: dict[bytes, int]):
        self.top = top
        super().__init__(encoder, np.arange(end_id + 1), end_id)

    def clear(self) -> None:
        super().clear()
        self.count = np.empty(0, np.int64)

    def add(self, new: list[bytes], ids: np.ndarray, offsets: np.ndarray) -> None:
        super().add(new, ids, offsets)
        self.count = np.concatenate([self.count, np.array([self.top.get(w, -1) for w in new], np.int64)])


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the slices that ``offsets`` bound."""
    return np.bincount(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)), values, minlength=len(offsets) - 1)


def shares(counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """log10 share of each id in its class after each context, drawn towards its share overall."""
    overall = counts.sum(axis=0) + 0.5
    overall /= np.bincount(classes, overall, minlength=CLASSES)[classes]
    out = np.empty(counts.shape, np.float32)
    for context, own in enumerate(counts):
        in_class = np.bincount(classes, own, minlength=CLASSES)
        out[context] = np.log10((own + SMOOTHING * overall) / (in_class[classes] + SMOOTHING))
    return out


def untrained(classes: np.ndarray, counts: np.ndarray, documents: int) -> Model:
    """An attention model before its training: each class at its share of all training tokens; the shares of ids are still to be set."""
    params = attention.initial(CLASSES)
    of_class = np.bincount(classes, counts, minlength=CLASSES)
    of_class[END] += documents
    if documents:
        params["bias"] = np.log((of_class + 0.5) / (of_class + 0.5).sum()).astype(np.float32)
    return Model(params, classes, np.zeros((1, 1)), np.zeros(1))


def training_groups(table: WordTable | IdTable, texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Inputs and targets of all windows of whole texts, some texts at a time; each token is a target once."""
    tokens, offsets = table.tokens(*table.look_up(texts))
    first = 0
    for last in range(1, len(texts) + 1):
        if last == len(texts) or offsets[last] - offsets[first] >= GROUP_IDS:
            inputs, targets, _ = attention.windows(tokens[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], BEGIN, -1)
            yield inputs, targets
            first = last


def averaged(model: Model, texts: DataFrame, model_json: Broadcast) -> attention.Params:
    """Train on all windows of all ``texts``, each partition from ``model``, and average by their number.

    The sum over partitions is grouped by parameter number; a model's worth of rows comes back.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = IdTable(model.classes)
        trainer = attention.Trainer(model.params, rate=RATE)
        seen = 0
        for batch in batches:
            for inputs, targets in training_groups(table, batch.column("ids").to_pylist()):
                trainer.train(inputs, targets, 1, batch=BATCH_WINDOWS)
                seen += len(inputs)
        if seen:
            values = attention.flat(trainer.params).astype(np.float64) * seen
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values), pa.array(np.full(len(values), seen))], names=WEIGHTS.names)

    mean = F.sum("total") / F.sum("weight")
    rows = token_ids(texts, model_json, len(model.classes) - 1).mapInArrow(run, WEIGHTS).groupBy("parameter").agg(mean.alias("value")).collect()
    if not rows:
        return model.params
    values = attention.flat(model.params).astype(np.float64)
    for row in rows:
        values[row["parameter"]] = row["value"]
    return attention.unflat(values, model.params)


def train(encoded: DataFrame, documents: int, model_json: Broadcast, end_id: int) -> Model:
    """The model learned from the texts ``encoded`` (ids), ``documents`` rows."""
    ends = piece_ends(tok.encoder(model_json.value, keep_space=False), end_id + 1)
    every = token_counts(encoded, end_id, ends)[0]
    frequent = frequent_tokens(every, end_id)
    classes = token_classes(every, frequent, neighbours(encoded, model_json, frequent, end_id), end_id)
    model = untrained(classes, every, documents)
    model.params = averaged(model, encoded, model_json)
    model.share, model.ends = shares(token_counts(encoded, end_id, ends, classes), classes), ends
    return model


def score(docs: DataFrame, held_out: F.Column, tokenizer_path: str, end_id: int) -> DataFrame:
    """Scores of every row of ``docs``, learned from those for which ``held_out`` is false.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = staged(word_counts(training))
    documents = training.count()
    size = counts.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    train_tokens = size["n"] + documents  # with an end for each document
    distinct = size["v"] + (documents > 0)
    total = train_tokens + 0.5 * (distinct + 1)
    short = counts.where(F.char_length("word") <= TOP_WORD_CHARS)
    top_rows = short.orderBy(F.desc("n"), "word").limit(TOP_WORDS).collect()
    top = spark.sparkContext.broadcast({r["word"].encode("utf-8", "surrogatepass"): r["n"] for r in top_rows})
    model_json = spark.sparkContext.broadcast(tok.model_text(tokenizer_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = CountTable(tok.encoder(model_json.value, keep_space=False), end_id, top.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found, offsets = table.look_up(part.column("text").to_pylist())
                c = table.count[found]
                seen = c >= 0
                known = _sums(seen.astype(np.float64), offsets).astype(np.int64) + (documents > 0)
                base = _sums(np.where(seen, np.log10((np.maximum(c, 0) + 0.5) / total), 0), offsets) + math.log10((documents + 0.5) / total)
                # the other words, once for each text with how often they occur there
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[~seen]
                pair, n = np.unique((text << 40) | found[~seen], return_counts=True)
                ends = np.searchsorted(pair, np.arange(len(offsets)) << 40)
                rest = pa.array([table.words[w].decode("utf-8", "surrogatepass") for w in (pair & ((1 << 40) - 1)).tolist()], pa.string())
                lists = [pa.ListArray.from_arrays(ends.astype(np.int32), v) for v in (rest, pa.array(n.astype(np.int64)))]
                columns = [pa.array(np.diff(offsets) + 1), pa.array(known), pa.array(base), _binary(*table.tokens(found, offsets))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), *columns, *lists], names=ENCODED.names)

    encoded = staged(rows.select("doc_id", "held_out", "text").mapInArrow(encode, ENCODED).withColumn("row", F.monotonically_increasing_id()))
    shared = spark.sparkContext.broadcast(train(encoded.where(~F.col("held_out")), documents, model_json, end_id))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = IdTable(model.classes)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = model.score(*table.look_up(part.column("ids").to_pylist()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in SCORED.names[:-1]), pa.array(scores)], names=SCORED.names)

    scored = staged(encoded.select(*SCORED.names[:-1], "ids").mapInArrow(run, SCORED))
    others = encoded.select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("w")).select("row", F.col("w.rest").alias("word"), F.col("w.rest_n").alias("k"))
    c = F.coalesce("n", F.lit(0))
    joined = others.join(counts, "word", "left").groupBy("row")
    added = joined.agg(F.sum(F.col("k") * F.log10((c + 0.5) / F.lit(total))).alias("added"), F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("added_known"))
    return scored.join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("added_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("added", F.lit(0.0))).alias("base_score"),
        "score",
    )
