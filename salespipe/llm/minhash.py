"""Near-duplicate documents: an inverted join over the coordinates of MinHash signatures.

A document is its set of distinct word shingles. Each of ``COORDINATES`` hash
functions keeps the least value over the set; the (coordinate, value) pairs are
posted in lists. Two documents whose sets have the similarity sought agree in
nearly all coordinates, so a pair must meet in ``MATCHES`` of them at least
(of 64, for a similarity of 0.8 fewer than 34 agree once in 10^7 pairs).

Coordinate values nobody shares are dropped first, and with them every document
that has too few left. Of the rest a document posts only a prefix, its rarest
ones: two documents with enough collisions meet in their prefixes at least
once. Lists are merged with skips, in two passes. First each document is held
only against the most central one of each of its lists, the one with the most
widely shared signature; most copies are linked then. In the second pass only
lists that hold several components count, and in them a document skips to those
of other components that share one of its rarest shingles: of sets so similar
that must be so, however the documents between are linked. So no link between
components is lost, and neither a list of copies nor one of half-copies costs
its square. What passes the count of collisions is confirmed on the full sets,
and components of confirmed links are the classes.

Documents with equal sets are one class from the start, however many they are;
one row stands for them, and copies of a row cost no more than their reading.
Documents without words (NULL or empty texts) and rows without an id are linked
with nothing and kept. An id on unequal texts is so many documents, each in the
class of its own text. An empty table gives an empty result; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.components import components
from salespipe.llm.store import written
from salespipe.llm.texts import Slice, column, distinct, mix, shingles, slices

SHINGLE = 5
SIMILARITY = 80  # percent
COORDINATES = 64
MATCHES = 34

_RNG = np.random.Generator(np.random.PCG64(64))
_FACTORS = _RNG.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def _sets(part: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, docs = part.words()
    return distinct(*shingles(part.hashes(starts, ends, fold=True), docs, part.n, size))


def _sign(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(column(batch, "text")):
                hashed, owner = _sets(part, size)
                counts = np.bincount(owner, minlength=part.n)
                full = np.flatnonzero(counts)
                tokens = np.zeros((part.n, COORDINATES), np.int64)
                names = np.zeros((part.n, 2), np.uint64)
                if len(full):
                    cuts = np.concatenate(([0], np.cumsum(counts)))[:-1][full]
                    names[full, 0] = np.add.reduceat(mix(hashed), cuts)
                    names[full, 1] = np.add.reduceat(mix(hashed ^ _ADDENDS[0]), cuts)
                    for k in range(COORDINATES):
                        least = np.minimum.reduceat(hashed * _FACTORS[k] + _ADDENDS[k], cuts)
                        tokens[full, k] = ((least >> np.uint64(8)) | (np.uint64(k) << np.uint64(56))).view(np.int64)
                empty = counts == 0
                tokens = pa.FixedSizeListArray.from_arrays(pa.array(tokens.ravel()), COORDINATES).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": column(batch, "doc_id").slice(part.first, part.n),
                    "text_hash": column(batch, "text_hash").slice(part.first, part.n), "n_shingles": counts,
                    "name1": pa.array(names[:, 0].view(np.int64), mask=empty),
                    "name2": pa.array(names[:, 1].view(np.int64), mask=empty), "tokens": tokens,
                })

    return sign


def _shingle_sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(column(batch, "text")):
                hashed, owner = _sets(part, size)
                cuts = np.searchsorted(owner, np.arange(part.n + 1))
                found = [hashed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "rep": column(batch, "doc_id").slice(part.first, part.n), "shingles": pa.array(found, pa.binary())
                })

    return sets


def _confirm(similarity: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(column(batch, "x"), column(batch, "y"), strict=True):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= similarity * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return confirm


def _links(spark: SparkSession, pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) confirmed on their full sets."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return written(spark, both.mapInArrow(_confirm(similarity), "a long, b long"), "links")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest id reachable by links) and kept."""
    found = document_classes(spark, docs, shingle, similarity)
    kept = F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept)


def document_classes(
    spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY
) -> DataFrame:
    """Per document: doc_id, text_hash (XXH64 of the text), n_shingles, component_id and keeper_hash.

    Of a class the document of the smallest id stays, and of texts that share this id the one with ``keeper_hash``.
    """
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").withColumn("text_hash", F.xxhash64("text"))
    signed = written(
        spark,
        texts.mapInArrow(_sign(shingle), "doc_id long, text_hash long, n_shingles long, name1 long, name2 long, tokens array<long>"),
        "signed",
    )
    name = ["name1", "name2", "n_shingles"]
    # Equal sets, whose names agree in 128 bits, have equal signatures; ``rep`` numbers the classes.
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*name).agg(
        F.min(F.struct("doc_id", "text_hash")).alias("keeper"), F.first("tokens").alias("tokens")
    )
    classes = written(spark, classes, "classes").withColumn("rep", F.monotonically_increasing_id())
    classes = written(spark, classes, "numbered")
    reps = classes.select("rep", "n_shingles", "tokens")
    posted = reps.select("rep", F.explode("tokens").alias("token"))
    shared = written(spark, posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    ranked = posted.join(shared, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("ranked"))
    ranked = ranked.where(F.size("ranked") >= MATCHES)
    sizes = reps.select("rep", "n_shingles")
    indexed = written(
        spark,
        ranked.join(sizes, "rep").select(
            "rep", "n_shingles", F.col("ranked.token").alias("tokens"),
            F.slice("ranked.token", F.lit(1), F.size("ranked") - MATCHES + 1).alias("prefix"),
            F.expr("aggregate(ranked.n, 0D, (x, n) -> x + ln(n))").alias("spread"),
        ),
        "indexed",
    )
    lists = indexed.select("rep", "n_shingles", "spread", F.explode("prefix").alias("token"))
    heads = lists.groupBy("token").agg(F.max(F.struct("spread", -F.col("rep"))).alias("head"))
    heads = written(spark, heads.select("token", (-F.col("head.col2")).alias("head")), "heads")
    stars = lists.join(heads, "token").where("rep <> head")
    stars = stars.select(F.least("head", "rep").alias("a"), F.greatest("head", "rep").alias("b"))
    stars = written(spark, _colliding(stars.distinct(), indexed, similarity), "stars")
    keepers = classes.join(indexed.select("rep"), "rep", "left_semi").select("rep", "keeper.doc_id", "keeper.text_hash")
    # Copies of a row fall together before and after the exchange that the join needs anyway.
    texts = texts.where("doc_id is not null").dropDuplicates(["doc_id", "text_hash"]).join(keepers, ["doc_id", "text_hash"])
    sets = texts.selectExpr("rep as doc_id", "text").mapInArrow(_shingle_sets(shingle), "rep long, shingles binary")
    sets = written(spark, sets, "sets")
    links = _links(spark, stars, sets, similarity)
    known = written(spark, components(spark, links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "known")
    placed = indexed.join(known, indexed.rep == known.node, "left")
    placed = written(
        spark, placed.select("rep", "n_shingles", "prefix", F.coalesce("component", "rep").alias("component")), "placed"
    )
    rest = _colliding(_across(spark, placed, sets, similarity), indexed, similarity)
    rest = rest.join(stars, ["a", "b"], "left_anti")
    more = _links(spark, written(spark, rest, "rest"), sets, similarity)
    every = links.unionByName(more).select(F.col("a").alias("u"), F.col("b").alias("v"))
    final = written(spark, components(spark, every), "components")
    named = classes.join(final, classes.rep == final.node, "left").select(
        *name, F.coalesce("component", "rep").alias("component"), "keeper"
    )
    keepers = named.groupBy("component").agg(F.min("keeper").alias("least"))
    named = named.join(keepers, "component").select(
        *name, F.col("least.doc_id").alias("component_id"), F.col("least.text_hash").alias("keeper_hash")
    )
    joined = signed.join(written(spark, named, "named"), name, "left")
    return joined.select(
        "doc_id", "text_hash", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("keeper_hash", "text_hash")).alias("keeper_hash"),
    )


def _colliding(pairs: DataFrame, indexed: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose sizes allow the similarity and whose signatures meet often enough."""
    left = indexed.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("tokens").alias("t_a"))
    right = indexed.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("tokens").alias("t_b"))
    found = pairs.join(left, "a").join(right, "b")
    fits = f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)"
    return found.where(fits).where(F.size(F.array_intersect("t_a", "t_b")) >= MATCHES).select("a", "b")


def _explode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rep, found in zip(column(batch, "rep"), column(batch, "shingles"), strict=True):
            own = np.frombuffer(found.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), rep.as_py())), pa.array(own)], ["rep", "shingle"])


def _across(spark: SparkSession, placed: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs of different components, from lists that hold both, that share one of their rarest shingles."""
    lists = placed.select("rep", "component", F.explode("prefix").alias("token"))
    mixed = lists.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = written(spark, mixed.where("low <> high").select("token"), "mixed")
    involved = written(spark, lists.join(mixed, "token", "left_semi").select("rep").distinct(), "involved")
    own = sets.join(involved, "rep", "left_semi").mapInArrow(_explode_sets, "rep long, shingle long")
    own = written(spark, own, "shingles")
    common = written(spark, own.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "common")
    # Shingles of one document only come first in the order: they take the first places and join with nothing.
    shared = own.join(common, "shingle").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("ranked"))
    docs = placed.select("rep", "n_shingles", "component")
    posted = shared.join(docs, "rep").select(
        "rep", "n_shingles", "component", F.size("ranked").alias("shared"),
        F.posexplode("ranked.shingle").alias("at", "shingle"),
    )
    posted = posted.withColumn("at", F.col("at") + F.col("n_shingles") - F.col("shared"))
    posted = posted.where(f"100 * at <= {100 - similarity} * n_shingles").drop("shared")
    left, right = posted.alias("l"), posted.alias("r")
    both = "(l.n_shingles + r.n_shingles)"
    # Shared shingles that the similarity asks for; one of them has a place this early in both.
    least = f"ceil({similarity} * {both} / {100 + similarity}.0)"
    met = left.join(
        right,
        F.expr(
            "l.shingle = r.shingle and l.rep < r.rep and l.component <> r.component and "
            f"l.at <= l.n_shingles - {least} and r.at <= r.n_shingles - {least}"
        ),
    )
    return met.select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")).distinct()
