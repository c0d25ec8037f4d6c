"""Toxicity by the nearest labelled examples.

Texts are compared by exact TF-IDF cosine over a vocabulary of words and
beginnings of words, chosen by chi-squared from the labelled examples; document
frequencies come from all documents. The examples lie in inverted lists cut
into blocks; the largest weight of each term in a block bounds every
similarity in it, so that blocks that cannot reach the best found so far are
skipped without changing the result. Votes weighted by distance, calibrated on
the examples themselves (each judged by the others), give the score; the
nearest examples are its evidence.

At most about ``PER_CLASS`` examples of each label are kept, chosen by a hash
of their ids; the vocabulary holds every term that tells their labels apart better than
chance would among so many terms, however rare. A text with no term of it, as
NULL and empty texts are, gets the calibrated score of the examples without one. Without labelled rows, or with
one label only, every score is 0 or that label. An id labelled twice counts as
toxic if any label says so. Repeated rows get equal results, ties between
examples go to the smaller id; an empty table gives an empty result. Input
columns are kept; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.llm.texts import Slice, column, mix, plain, slices
from salespipe.llm.vectors import summed

PER_CLASS = 2000
LEAST_DOCS = 3  # the approximation by chi-squared means nothing for fewer examples
PREFIXES = (4, 5, 6)
NEIGHBOURS = 15
BLOCK = 64
EVIDENCE = 5
SMOOTH = 1.0

RESULT = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    T.StructField("evidence", T.ArrayType(T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType()),
        T.StructField("similarity", T.DoubleType())]))),
])
_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("similarity", pa.float64())]))

_LETTERS = np.zeros(256, bool)
_LETTERS[0x80:] = True
_LETTERS[ord("a") : ord("z") + 1] = True


def _terms(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word and beginning of a word, from lower-cased texts."""
    starts, ends, docs = part.runs(_LETTERS[part.data])
    found = [(part.hashes(starts, ends), docs)]
    for k in PREFIXES:
        longer = ends - starts > k
        found.append((mix(part.hashes(starts[longer], starts[longer] + k) + np.uint64(k)), docs[longer]))
    return np.concatenate([h for h, _ in found]), np.concatenate([d for _, d in found])


class Vocabulary:
    """Chosen terms, by hash, in ascending order."""

    def __init__(self, terms: np.ndarray) -> None:
        self.terms = np.sort(terms)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.terms & np.uint64(0xFFFF)] = True

    def counts(self, part: Slice) -> np.ndarray:
        """How often each document of a slice has each term."""
        out = np.zeros((part.n, len(self.terms)))
        if len(self.terms):
            hashed, docs = _terms(part)
            near = self.maybe[hashed & np.uint64(0xFFFF)]
            hashed, docs = hashed[near], docs[near]
            at = np.minimum(np.searchsorted(self.terms, hashed), len(self.terms) - 1)
            hit = self.terms[at] == hashed
            np.add.at(out, (docs[hit], at[hit]), 1)
        return out


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(plain(texts))


def _tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf
    norm = np.sqrt((values * values).sum(axis=1, keepdims=True))
    return np.divide(values, norm, out=np.zeros_like(values), where=norm > 0)


class BlockMaxIndex:
    """Examples in blocks: per block its terms, their postings as columns, and each term's largest weight."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        # Like examples lie together, so that a block has few terms and sharp bounds.
        order = np.lexsort((ids, labels, vectors.argmax(axis=1) if vectors.size else ids))
        self.ids, self.labels = ids[order], labels[order]
        vectors = vectors[order]
        self.blocks = []
        for start in range(0, len(ids), BLOCK):
            own = vectors[start : start + BLOCK]
            terms = np.flatnonzero(own.any(axis=0))
            self.blocks.append((start, terms, own[:, terms].T.copy()))
        self.bounds = np.zeros((vectors.shape[1], len(self.blocks)))
        for b, (_, terms, postings) in enumerate(self.blocks):
            self.bounds[terms, b] = postings.max(axis=1)

    def nearest(self, queries: np.ndarray, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the k nearest examples (-1: none) and their cosines. ``without``: an id each query must not find."""
        n = len(queries)
        best, rows = np.full((n, k), -1.0), np.full((n, k), -1)
        if not n or not self.blocks:
            return rows, best
        bound = queries @ self.bounds
        seen = np.zeros(bound.shape, bool)
        first = bound.argmax(axis=1)
        seen[np.arange(n), first] = True
        for b in np.unique(first):
            self._visit(b, np.flatnonzero(first == b), queries, best, rows, without)
        for b in np.argsort(-bound.max(axis=0), kind="stable"):
            need = np.flatnonzero(~seen[:, b] & (bound[:, b] > 0) & (bound[:, b] >= best[:, -1] - 1e-9))
            if len(need):
                self._visit(b, need, queries, best, rows, without)
        return rows, best

    def _visit(self, b, need, queries, best, rows, without) -> None:
        start, terms, postings = self.blocks[b]
        score = np.round(queries[need][:, terms] @ postings, 12)
        at = np.broadcast_to(np.arange(start, start + postings.shape[1]), score.shape)
        score = np.where(score > 0, score, -1.0)
        if without is not None:
            score = np.where(self.ids[at] == without[need][:, None], -1.0, score)
        all_scores = np.concatenate((best[need], score), axis=1)
        all_rows = np.concatenate((rows[need], np.where(score > 0, at, -1)), axis=1)
        ids = np.where(all_rows >= 0, self.ids[all_rows], np.iinfo(np.int64).max)
        order = np.lexsort((ids, -all_scores), axis=1)[:, : best.shape[1]]
        best[need] = np.take_along_axis(all_scores, order, 1)
        rows[need] = np.take_along_axis(all_rows, order, 1)


class Model:
    def __init__(self, vocabulary: Vocabulary, idf: np.ndarray) -> None:
        self.vocabulary, self.idf = vocabulary, idf
        self.index: BlockMaxIndex | None = None
        self.blank, self.prior, self.slope, self.offset = 0.0, 0.0, 1.0, 0.0
        self.constant: float | None = None

    def votes(self, vectors: np.ndarray, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, cosine = self.index.nearest(vectors, NEIGHBOURS, without)
        if not self.index.blocks:
            return np.full(len(vectors), self.blank), rows, cosine
        weight = np.where(rows >= 0, 1 / (1.05 - np.clip(cosine, 0, 1)), 0.0)
        toxic = np.where(rows >= 0, self.index.labels[rows], 0)
        vote = ((weight * toxic).sum(axis=1) + SMOOTH * self.prior) / (weight.sum(axis=1) + SMOOTH)
        return np.where(vectors.any(axis=1), vote, self.blank), rows, cosine

    def score(self, vote: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _logit(vote) + self.offset)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _calibrate(model: Model, vote: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
    """Slope and offset of least weighted logistic loss, lightly held to 1 and 0, by Newton's steps."""
    x = np.stack((_logit(vote), np.ones(len(vote))), axis=1)
    at, home = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + 1.0 * (at - home)
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(bend, slope)
        at = at - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    model.slope, model.offset = max(float(at[0]), 0.05), float(at[1])


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(_lowered(column(batch, "text"))):
            hashed, docs = _terms(part)
            order = np.argsort(docs, kind="stable")
            hashed, cuts = hashed[order], np.searchsorted(docs[order], np.arange(part.n + 1))
            found = [np.unique(hashed[a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(batch, "doc_id").slice(part.first, part.n),
                "toxic": column(batch, "toxic").slice(part.first, part.n),
                "terms": pa.array([t.tobytes() for t, _ in found], pa.binary()),
                "counts": pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary()),
            })


def _choose(terms: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The terms that tell the labels apart better than chance, by chi-squared."""
    every, at = np.unique(np.concatenate(terms), return_inverse=True)
    owner = np.repeat(labels, [len(t) for t in terms])
    toxic, both = np.bincount(at, owner, len(every)), np.bincount(at, minlength=len(every)).astype(float)
    n, n1 = len(labels), labels.sum()
    n0 = n - n1
    cross = toxic * (n0 - (both - toxic)) - (both - toxic) * (n1 - toxic)
    chi2 = n * cross**2 / np.maximum(both * (n - both) * n1 * n0, 1e-9)
    # Of n terms without meaning the largest is near 2 log(n); beyond 4 log(n) one comes once in about n such tables.
    chance = 4 * np.log(max(2, (both >= LEAST_DOCS).sum()))
    return every[(chi2 >= chance) & (both >= LEAST_DOCS)]


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, train: Column) -> Model:
    """A model of the labels (doc_id, toxic) of the rows of ``labels`` where ``train`` holds."""
    known = labels.where(train & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    numbers = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {c: min(1.0, PER_CLASS / max(1, numbers.get(c, 0))) for c in (0, 1)}
    place = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / (1 << 30)
    chosen = known.where(F.col("toxic").isin(0, 1) & (place < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])))
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").where("text is not null")
    # At most about twice PER_CLASS ids of eight bytes: small whatever the input.
    examples = texts.join(F.broadcast(chosen), "doc_id")
    rows = examples.mapInArrow(_example_terms, "doc_id long, toxic int, terms binary, counts binary").collect()
    # Copies of a text say the same thing: the smallest id stands for them.
    rows = {(r.terms, r.counts, r.toxic): r for r in sorted(rows, key=lambda r: -r.doc_id)}
    rows = sorted(rows.values(), key=lambda r: r.doc_id)
    truth = np.array([r.toxic for r in rows], np.int64)
    terms = [np.frombuffer(bytes(r.terms), np.uint64) for r in rows]
    if not len(truth) or truth.min() == truth.max():
        model = Model(Vocabulary(np.zeros(0, np.uint64)), np.zeros(0))
        model.constant = float(truth[0]) if len(truth) else 0.0
        return model
    vocabulary = Vocabulary(_choose(terms, truth))
    size = len(vocabulary.terms)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for part in slices(_lowered(column(batch, "text"))):
                total[:size] += (vocabulary.counts(part) > 0).sum(axis=0)
                total[size] += part.n
        return total

    df = summed(spark, docs.select(F.col("text").cast("string").alias("text")), frequencies, size + 1)
    model = Model(vocabulary, np.log((1 + df[size]) / (1 + df[:size])) + 1)
    counts = np.zeros((len(rows), size))
    for i, r in enumerate(rows):
        if size:
            at = np.minimum(np.searchsorted(vocabulary.terms, terms[i]), size - 1)
            hit = vocabulary.terms[at] == terms[i]
            counts[i, at[hit]] = np.frombuffer(bytes(r.counts), np.int32)[hit]
    vectors = _tfidf(counts, model.idf)
    ids = np.array([r.doc_id for r in rows], np.int64)
    # Each label counts as often as it occurs among all labelled rows.
    weight = np.array([numbers[c] / max(1, (truth == c).sum()) for c in (0, 1)])[truth]
    weight *= len(truth) / weight.sum()
    blank = ~vectors.any(axis=1)
    # One example more that is not toxic: where little is known, nothing speaks against a text.
    model.prior = float((weight * truth).sum() / (weight.sum() + SMOOTH))
    model.blank = float(((weight * truth)[blank].sum() + SMOOTH * model.prior) / (weight[blank].sum() + SMOOTH))
    model.index = BlockMaxIndex(ids[~blank], truth[~blank], vectors[~blank])
    vote = model.votes(vectors, ids)[0]
    _calibrate(model, vote, truth, weight)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` with ``score``, ``predicted`` (1 from a half on) and ``evidence``."""
    kept = [c for c in docs.columns if c not in RESULT.names]

    # Only texts go to Python and only verdicts come back; the rest of a row stays where it is.
    @F.arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            made = []
            for part in slices(_lowered(texts)):
                if model.constant is not None:
                    scores, evidence = np.full(part.n, model.constant), [[]] * part.n
                else:
                    vectors = _tfidf(model.vocabulary.counts(part), model.idf)
                    vote, near, cosine = model.votes(vectors)
                    scores = model.score(vote)
                    evidence = [
                        [
                            {"doc_id": int(model.index.ids[r]), "toxic": int(model.index.labels[r]), "similarity": float(s)}
                            for r, s in zip(near[i, :EVIDENCE], cosine[i, :EVIDENCE], strict=True)
                            if r >= 0
                        ]
                        for i in range(part.n)
                    ]
                found = [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(evidence, _EVIDENCE)]
                made.append(pa.StructArray.from_arrays(found, RESULT.names))
            yield pa.concat_arrays(made)

    verdict = "_verdict" + "_" * sum(c.startswith("_verdict") for c in kept)
    judged = docs.select(*kept, judge(F.col("text").cast("string")).alias(verdict))
    return judged.select(*kept, *[F.col(verdict)[name].alias(name) for name in RESULT.names])
