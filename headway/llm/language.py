"""Language ID (operator 8): nearest centroid over TF-IDF vectors of character n-grams.

A text's vector holds the hashed 1- to 3-grams of its lower-case letters (every run of other
characters counts as one blank, as marks, digits and layout tell nothing of the language),
sublinear counts times inverse document frequency, scaled to length one.  Each language is stood for by a few
centroids (spherical k-means over its sample), so that a language with several styles is not
averaged into one.  The prediction is the language of the centroid with the greatest cosine, and
the score is that cosine.  A text is rejected when its cosine lies far below the median that texts
of its size (its number of different n-grams) reach which the centroids have not seen: each half of the sample is compared with
centroids of the other half.

The classifier is fitted on the driver on a bounded sample of labelled rows: for each of the
``MAX_LANGS`` most frequent languages ``SAMPLE_PER_LANG`` distinct rows, those with the least hash of
id and text, of each the first ``SAMPLE_CHARS`` characters.  Prediction reads every whole text.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected;
rows with a null lang are never learned from; without any labelled row every text is ``und``, and
so is every row's language on such a table; texts of any length are read whole; equally near
centroids give the first language in order; repeated rows and rows of equal or null id are
predicted each and count once in the sample; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import bounded_batches, struct_type

DIMENSIONS = 1 << 14
MAX_N = 3
#: Labelled rows per language that the classifier is fitted on, and centroids per language.
SAMPLE_PER_LANG = 400
MAX_LANGS = 64
SAMPLE_CHARS = 100_000
CENTROIDS = 4
#: Letters and blanks of the cut sample texts from which the rejection thresholds are taken, and the
#: least numbers of different n-grams of the bins that they fall into.  A long text that repeats a
#: few words tells no more than a short one, so it is measured by its different n-grams.
LENGTHS = (4, 8, 16, 32, 64, 128, 256, 512, 1024, 4096)
SIZES = (8, 16, 32, 64, 128, 256, 512, 1024, 2048)
#: A text is rejected below this share of the median cosine that unseen sample texts of its size reach
#: (interpolated between the bins); texts of less than the first size are kept.
REJECT_SHARE = 0.43
#: Sample texts of a length that a median is taken from, at least.
FILLED = 8

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHERS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

FOUND = struct_type(lang_pred=T.StringType(), score=T.DoubleType(), rejected=T.BooleanType())


def letters(text: str) -> str:
    """The lower-case letters of a whole text, words between single blanks."""
    return _OTHERS.sub(" ", text.lower())


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-gram, how often) of a whole text as letters() gives it."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    total = np.zeros(DIMENSIONS, np.int64)
    gram = np.zeros(len(points), np.uint64)
    for n in range(1, MAX_N + 1):
        if len(points) < n:
            break
        gram = gram[: len(points) - n + 1] * _MULTIPLIERS[0] + points[n - 1 :] + np.uint64(n)
        mixed = gram * _MULTIPLIERS[n % 3]
        total += np.bincount((mixed >> np.uint64(50)).astype(np.int64), minlength=DIMENSIONS)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class Classifier:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    usual: np.ndarray

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, n = counts(text)
        value = (1 + np.log(n)) * self.idf[at]
        length = np.sqrt((value * value).sum())
        return at, value / length if length else value

    def cosines(self, text: str) -> tuple[np.ndarray, int]:
        """The cosine of each centroid with a text, and how many different n-grams the text has."""
        at, value = self.vector(text)
        return value @ self.centroids[at], len(at)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected) of one text."""
        if not text or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        text = letters(text)
        cos, size = self.cosines(text)
        best = int(cos.argmax())
        score = float(min(1.0, max(0.0, cos[best])))
        usual = np.interp(np.log2(size), np.log2(SIZES) + 0.5, self.usual) if size >= SIZES[0] else 0.0
        return self.langs[self.owner[best]], score, bool(score < REJECT_SHARE * usual)


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the starting centres are picked farthest first, so no chance is involved."""
    centres = [x.mean(axis=0)]
    nearest = x @ (centres[0] / max(np.linalg.norm(centres[0]), 1e-12))
    for _ in range(min(k, len(x)) - 1):
        centres.append(x[int(nearest.argmin())])
        nearest = np.maximum(nearest, x @ centres[-1])
    c = np.stack(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _fitted(rows: list[tuple[str, str]]) -> Classifier:
    """Centroids of (lang, letters) rows in order; nothing is rejected yet."""
    langs = sorted({lang for lang, _ in rows})
    frequency = np.zeros(DIMENSIONS)
    for _, text in rows:
        frequency[counts(text)[0]] += 1
    idf = np.log((1 + len(rows)) / (1 + frequency)) + 1
    model = Classifier(langs, idf, np.zeros((DIMENSIONS, 0)), np.zeros(0, int), np.zeros(len(SIZES)))
    centroids, owner = [], []
    for j, lang in enumerate(langs):
        x = np.zeros((sum(own == lang for own, _ in rows), DIMENSIONS))
        for row, text in zip(x, [text for own, text in rows if own == lang]):
            at, value = model.vector(text)
            row[at] = value
        c = _clusters(x, CENTROIDS)
        centroids.append(c)
        owner += [j] * len(c)
    if langs:
        model.centroids, model.owner = np.ascontiguousarray(np.concatenate(centroids).T), np.array(owner)
    return model


def usual_cosines(models: list[Classifier], unseen: list[list[tuple[str, str]]]) -> np.ndarray:
    """Per size, the median of the greatest cosines of texts, whole and cut, that a model has not seen.

    A bin that too few of them fall into takes over the value of the filled one below it.
    """
    cut = [(model, text[:n]) for model, rows in zip(models, unseen) if model.langs for _, text in rows for n in LENGTHS if len(text) >= n]
    reached = [(size, cosines.max()) for cosines, size in (model.cosines(text) for model, text in cut if _LETTER.search(text))]
    sizes, cosines = (np.array(x) for x in zip(*reached)) if reached else (np.zeros(0), np.zeros(0))
    bins = np.searchsorted(SIZES, sizes, side="right") - 1
    usual = np.zeros(len(SIZES))
    for b in range(len(SIZES)):
        own = cosines[bins == b]
        usual[b] = np.median(own) if len(own) >= FILLED else usual[b - 1] if b else 0.0
    return usual


def fit(rows: list[tuple[str, str]]) -> Classifier:
    """Fit on (text, lang) rows; their number is bounded by the caller."""
    rows = sorted((lang, letters(text)) for text, lang in rows if text and _LETTER.search(text))
    model = _fitted(rows)
    halves = [rows[::2], rows[1::2]]  # each language is in both, but for its last row
    model.usual = usual_cosines([_fitted(halves[1]), _fitted(halves[0])], halves)
    return model


def training_sample(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, max_langs: int = MAX_LANGS) -> DataFrame:
    """At most ``per_lang`` distinct labelled rows of each of ``max_langs`` languages: text and lang.

    Rows are ranked by a hash of id and text.  Only hashes are sorted, and the rank is cut before the
    shuffle as well (Spark's window group limit), so a language that holds most rows doesn't collect
    in a task; of equal rows one is fetched.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("rank_hash", F.xxhash64("doc_id", "text"))
    langs = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).select("lang")
    order = Window.partitionBy("lang").orderBy("rank_hash")
    ranked = labelled.select("lang", "rank_hash").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
    chosen = ranked.join(langs, "lang", "left_semi").select("lang", "rank_hash")  # bounded: per_lang * max_langs
    fetched = labelled.join(F.broadcast(chosen), ["lang", "rank_hash"], "left_semi")
    return fetched.groupBy("lang", "rank_hash").agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text")).select("text", "lang")


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Classifier:
    """Fit the classifier on a bounded sample of ``docs`` (doc_id, text, lang)."""
    clean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return fit([(r["text"], r["lang"]) for r in training_sample(clean, per_lang).collect()])


def identified(docs: DataFrame, model: Classifier) -> DataFrame:
    """row (all columns of ``docs``) and found (the prediction) of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != "text"]
    carried = docs.select("text", F.struct(*others).alias("row") if others else F.lit(None).cast("int").alias("row"))
    schema = T.StructType([T.StructField("found", FOUND), carried.schema["text"], carried.schema["row"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            langs, scores, rejected = zip(*map(model.predict, batch.column("text").to_pylist())) if batch.num_rows else ((), (), ())
            values = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(values, FOUND.names), batch.column("text"), batch.column("row")], names=schema.names)

    out = carried.mapInArrow(run, schema)
    whole = F.struct(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
    return out.select(whole.alias("row"), "found")


def identify(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every whole text."""
    return identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("row.doc_id", "found.*")
