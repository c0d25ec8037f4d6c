"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of 1 to 3 letters, lower-cased and with everything but letters read as
a space, are hashed to ``DIMS`` places. Document frequencies come from all
documents that may teach. The model is fitted by follow-the-regularised-leader with
L1 and L2 penalties on about ``PER_LANGUAGE`` rows of each language, chosen by a
hash of their ids (all rows of a rarer language). The temperature that calibrates the
scores is fitted on all these rows, each scored by a model of the other ``FOLDS`` - 1
parts of them, against targets smoothed by one wrong answer more than there are, so
that it is finite even if no answer is wrong. Every text is judged whole.

A text that is NULL or has no letter is ``und`` with score 0, as is every text
if there is no labelled row. Of equally likely languages the first by name
wins. Repeated rows get equal results; an empty table gives an empty result;
other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.texts import column
from salespipe.llm.vectors import summed

DIMS = 1 << 14
SIZES = (1, 2, 3)
PER_LANGUAGE = 800
EPOCHS = 4
FOLDS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
LOG_TEMPERATURES = (np.log(0.02), np.log(20.0))
UNKNOWN = "und"

_LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])


def _letters(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = points < len(_LETTER)
    letter = ~known
    letter[known] = _LETTER[points[known]]
    if not known.all():
        letter[~known] = [chr(p).isalpha() for p in points[~known]]
    return np.where(letter, points, np.uint32(0x20))


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The places of a text's n-grams and their numbers; empty for a text without a letter."""
    points = _letters(text or "")
    if not (points != 0x20).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.concatenate(([0x20], points, [0x20])).astype(np.uint32)
    counts = np.zeros(DIMS, np.int64)
    hashed = np.zeros(len(points), np.uint32)
    for size in range(1, max(SIZES) + 1):
        hashed = hashed[: len(points) - size + 1] * np.uint32(0x01000193) + points[size - 1 :] * np.uint32(0x9E3779B1)
        if size in SIZES:
            counts += np.bincount((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(18), minlength=DIMS)
    places = np.flatnonzero(counts)
    return places, counts[places]


def weighted(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[places]
    return values / max(np.sqrt((values * values).sum()), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    total = np.zeros(DIMS + 1, np.int64)
    for batch in batches:
        for text in column(batch, "text"):
            places, _ = grams(text.as_py())
            total[places] += 1
            total[DIMS] += 1
    return total


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [grams(t.as_py()) for t in column(batch, "text")]
        yield pa.RecordBatch.from_pydict({
            "doc_id": column(batch, "doc_id"), "lang": column(batch, "lang"),
            "places": pa.array([p.astype(np.int32).tobytes() for p, _ in found], pa.binary()),
            "counts": pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary()),
        })


class Model:
    """Weights of each language at each place, its offset, and the temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray) -> None:
        self.langs, self.idf, self.temperature = langs, idf, 1.0
        self.z = np.zeros((DIMS + 1, len(langs)))
        self.n = np.zeros((DIMS + 1, len(langs)))
        self.w = self.z

    def _weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, places: np.ndarray, values: np.ndarray, lang: int) -> None:
        at, x = np.append(places, DIMS), np.append(values, 1.0)
        w = self._weights(at)
        p = _softmax(x @ w)
        p[lang] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g

    def finish(self) -> None:
        self.w = self._weights(slice(None))
        self.z = self.n = None

    def logits(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(places, counts, self.idf) @ self.w[places] + self.w[DIMS]

    def predict(self, text: str | None) -> tuple[str, float]:
        places, counts = grams(text)
        if not len(places) or not self.langs:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(places, counts) / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least loss against smoothed targets, by golden section on its logarithm."""
    n, langs = logits.shape
    if n == 0 or langs < 2:
        return 1.0
    target = np.full((n, langs), 1 / (n + 2) / (langs - 1))
    target[np.arange(n), truth] = (n + 1) / (n + 2)

    def loss(t: float) -> float:
        scaled = logits / np.exp(t)
        top = scaled.max(axis=1, keepdims=True)
        every = np.log(np.exp(scaled - top).sum(axis=1, keepdims=True)) + top - scaled
        return float((target * every).sum(axis=1).mean())

    low, high, ratio = *LOG_TEMPERATURES, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _taught(langs: list[str], idf: np.ndarray, data: list[tuple]) -> Model:
    model = Model(langs, idf)
    for _ in range(EPOCHS):
        for places, counts, lang in data:
            model.learn(places, weighted(places, counts, idf), lang)
    model.finish()
    return model


def fit(spark: SparkSession, docs: DataFrame, train: Column) -> Model:
    """A model of the rows where ``train`` holds, of which those with a ``lang`` are learned; no other row has a part in it."""
    texts = docs.where(train).select(F.col("text").cast("string").alias("text"))
    frequency = summed(spark, texts, _frequencies, DIMS + 1)
    idf = np.log((1 + frequency[DIMS]) / (1 + frequency[:DIMS])) + 1
    labelled = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", "cast(lang as string) lang")
    numbers = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(numbers)
    if not langs:
        return _taught(langs, idf, [])
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, PER_LANGUAGE / numbers[lang]))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / (1 << 30)
    sample = labelled.where(place < share[F.col("lang")])
    rows = sample.mapInArrow(_features, "doc_id long, lang string, places binary, counts binary").collect()
    rows = sorted(rows, key=lambda r: (hash_of(r.doc_id), bytes(r.places)))
    data = [(np.frombuffer(bytes(r.places), np.int32), np.frombuffer(bytes(r.counts), np.int32), langs.index(r.lang)) for r in rows]
    data = [d for d in data if len(d[0])]
    model = _taught(langs, idf, data)
    if len(data) >= 10 * FOLDS:
        logits, truth = [], []
        for fold in range(FOLDS):
            others = _taught(langs, idf, [d for i, d in enumerate(data) if i % FOLDS != fold])
            logits += [others.logits(places, counts) for places, counts, _ in data[fold::FOLDS]]
            truth += [lang for _, _, lang in data[fold::FOLDS]]
        model.temperature = _temperature(np.array(logits), np.array(truth))
    return model


def hash_of(n: int | None) -> int:
    """A fixed order of ids that has nothing to do with their size."""
    return ((n or 0) * 0x9E3779B97F4A7C15 + 1) % (1 << 64) >> 20


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in column(batch, "text")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(batch, "doc_id"), "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64()),
            })

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")
