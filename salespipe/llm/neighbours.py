"""Approximate nearest neighbours by cosine, over balanced posting lists.

Centroids are fitted to a sample of at most about ``SAMPLE`` vectors by
splitting clusters until each holds few of the sample, so that lists come out
balanced; they are joined in a graph of near centroids, which a best-first
search walks in memory. Every vector is posted to its nearest centroid, and to
the next ones if it lies near the border (distance within ``BORDER`` times the
least, and not behind a centroid that already has it). A query reads the lists
of all centroids whose distance is within ``reach`` times the least, and at least
``least`` lists; the search widens until it has them. Both are calibrated: of the
pairs by which ``QUERIES`` sampled vectors find ``RECALL`` of their nearest in the
sample, the one that reads the fewest lists. The sample's vectors lie further
apart than the table's, so the table's recall is about that or higher. Copies in the sample
count once, and twin centroids are merged; of centroids that lie together as
seen from a query, all are read but one counts towards ``least``. Lists
are stored in blocks of bounded size, and every block of a selected list is
read, however long the list is. Queries meet blocks, not rows.

Scores are exact cosines in double precision; vectors are scaled by powers of
two first, which changes no digit and keeps components of any size finite. Vectors that are NULL, zero, of
another length than most, or hold NULL, NaN or infinite components take no
part; so do rows without an id. Ties go to the smaller id, so that of equal
vectors only the k + 1 with the smallest ids can be among the k nearest of
anything: only those are posted. Of rows that repeat an id one counts. An empty table gives an empty result; other columns are left
out. ``CENTROIDS`` bounds what every task holds: at most that many vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.store import written
from salespipe.llm.texts import column

SAMPLE = 20_000
CENTROIDS = 1024
PER_CENTROID = 128  # vectors a centroid stands for, while there are fewer than CENTROIDS
DEGREE = 16
BEAM = 256  # centroids a search holds at first
REPLICAS = 4
BORDER = 1.02
REACH = 1.25  # before calibration
LEAST_LISTS = 48  # before calibration
QUERIES = 200  # sampled vectors that reach and least lists are calibrated on
RECALL = 0.97  # share of their nearest in the sample that they must find
REACHES = (1.02, 1.05, 1.08, 1.11, 1.14, 1.17, 1.2, 1.25, 1.3, 1.4, 1.6, 2.0)
TWIN = 1e-6  # distance of unit vectors that are copies but for rounding
TOGETHER = 0.25  # of a query's distance: centroids this near to a nearer one lie in the same direction
BLOCK = 1024
QUERY_BLOCK = 256
HELD = 1 << 18  # finds a task holds before it keeps the k best of each query


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, exactly, so that squares of its components neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))
    return np.ldexp(x, -exponent)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def _split(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Cluster numbers of k balanced parts: the largest part is halved along its two means, again and again."""
    part = np.zeros(len(x), np.int64)
    sizes = [len(x)]
    while len(sizes) < k:
        big = int(np.argmax(sizes))
        own = np.flatnonzero(part == big)
        if len(own) < 2:
            break
        a, b = x[own[rng.integers(len(own))]], x[own[rng.integers(len(own))]]
        for _ in range(6):
            lean = x[own] @ (b - a)
            right = np.zeros(len(own), bool)
            right[np.argsort(lean, kind="stable")[len(own) // 2 :]] = True  # equal halves keep lists balanced
            a, b = x[own[~right]].mean(axis=0), x[own[right]].mean(axis=0)
        part[own[right]] = len(sizes)
        sizes[big] = int((~right).sum())
        sizes.append(int(right.sum()))
    return part


def _apart(x: np.ndarray) -> np.ndarray:
    """Unit vectors of which no two are twins: of each group the first stays."""
    x = x[np.sort(np.unique(np.round(x, 7), axis=0, return_index=True)[1])]
    # Rounding parts some twins; those are neighbours in the order of a projection.
    lean = x @ _unit(np.random.Generator(np.random.PCG64(1)).normal(size=(1, x.shape[1])))[0]
    order = np.argsort(lean, kind="stable")
    stay = np.ones(len(x), bool)
    for i, at in enumerate(order):
        near = order[i + 1 : i + 1 + np.searchsorted(lean[order[i + 1 :]], lean[at] + TWIN, side="right")]
        near = near[((x[near] - x[at]) ** 2).sum(axis=1) <= TWIN**2]
        if stay[at]:
            stay[near] = False
    return x[stay]


class Centroids:
    """Unit centroids and the graph that joins each to its nearest ones."""

    def __init__(self, sample: np.ndarray, k: int, seed: int = 7) -> None:
        x, rng = _apart(_unit(sample)), np.random.Generator(np.random.PCG64(seed))
        part = _split(x, k, rng)
        number = part.max(initial=-1) + 1
        self.points = _apart(_unit(np.array([x[part == c].mean(axis=0) for c in range(number)]).reshape(number, -1)))
        number = len(self.points)
        # A graph of near centroids, with a few far links so that every part can be reached.
        self.links = []
        for c in range(number):
            near = np.argsort(-(self.points @ self.points[c]), kind="stable")[1 : DEGREE + 1]
            self.links.append(np.unique(np.concatenate((near, rng.integers(0, number, 4)))))
        back: list[list[int]] = [[] for _ in range(number)]
        for c, near in enumerate(self.links):
            for other in near:
                back[other].append(c)
        self.links = [np.unique(np.concatenate((near, np.array(b, np.int64)))) for near, b in zip(self.links, back, strict=True)]
        self.entries = np.arange(0, number, max(1, number // 8))
        self.reach, self.least = REACH, LEAST_LISTS

    def search(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """About the ``beam`` nearest centroids of a unit vector by best-first search, and their distances."""
        if beam >= len(self.points):
            distance = self._distance(x, np.arange(len(self.points)))
            best = np.argsort(distance, kind="stable")
            return best, distance[best]
        distance = np.full(len(self.points), np.inf)
        distance[self.entries] = self._distance(x, self.entries)
        done = np.zeros(len(self.points), bool)
        while True:
            best = np.argpartition(distance, beam - 1)[:beam]
            todo = best[~done[best] & np.isfinite(distance[best])]
            if not len(todo):
                break
            step = todo[np.argsort(distance[todo], kind="stable")[:8]]
            done[step] = True
            new = np.unique(np.concatenate([self.links[c] for c in step]))
            new = new[np.isinf(distance[new])]
            if len(new):
                distance[new] = self._distance(x, new)
        best = best[np.isfinite(distance[best])]
        best = best[np.lexsort((best, distance[best]))]
        return best, distance[best]

    def _distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * self.points[at] @ x))

    def post(self, x: np.ndarray) -> np.ndarray:
        """The lists that hold a vector."""
        near, distance = self.search(x, 2 * REPLICAS + 8)
        chosen = [near[0]]
        for c, d in zip(near[1:], distance[1:], strict=True):
            if len(chosen) == REPLICAS or d > BORDER * max(distance[0], 1e-9):
                break
            if (self._distance(self.points[c], np.array(chosen)) > d).all():
                chosen.append(c)
        return np.array(chosen)

    def select(self, x: np.ndarray) -> np.ndarray:
        """The lists a query reads: the search is doubled until the next centroid lies beyond all that it must read."""
        beam = BEAM
        while True:
            near, distance = self.search(x, beam)
            least = self._least(near, distance)
            within = int(np.searchsorted(distance, self.reach * max(distance[0], 1e-9), side="right"))
            if beam >= len(self.points) or max(least, within) < len(near):
                return near[: max(least, within)]
            beam *= 2

    def _least(self, near: np.ndarray, distance: np.ndarray) -> int:
        """How many of the nearest centroids hold ``least`` that do not lie together as seen from the query."""
        counted: list[int] = []
        for i, (c, d) in enumerate(zip(near, distance, strict=True)):
            if len(counted) == self.least:
                return i
            if not counted or (self._distance(self.points[c], np.array(counted)) > TOGETHER * d).all():
                counted.append(c)
        return len(near)

    def _before(self, near: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """For each of the nearest centroids, how many nearer ones count towards the least lists."""
        counts = np.ones(len(near), bool)
        for i, c in enumerate(near):
            if counts[i]:
                counts[i + 1 :] &= self._distance(self.points[c], near[i + 1 :]) > TOGETHER * distance[i + 1 :]
        return np.cumsum(counts) - counts

    def calibrate(self, sample: np.ndarray, k: int, seed: int = 11) -> None:
        """Set reach and least lists to the pair that reads the fewest lists and finds ``RECALL`` of the k nearest."""
        x = _apart(_unit(sample))
        asked = np.random.Generator(np.random.PCG64(seed)).permutation(len(x))[:QUERIES]
        k = min(k, len(x) - 1)
        if k < 1:
            return
        cosine = x[asked] @ x.T
        cosine[np.arange(len(asked)), asked] = -2.0
        nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        lists = {v: self.post(x[v]) for v in np.unique(nearest)}
        ratios, before, needed = [], [], []
        for q, own in zip(asked, nearest, strict=True):
            near, distance = self.search(x[q], len(self.points))
            place = np.argsort(near)
            ratios.append(distance / max(distance[0], 1e-9))
            before.append(self._before(near, distance))
            needed.append([place[lists[v]].min() for v in own])
        ratio, ahead = (np.array([a[i] for a, i in zip(of, needed, strict=True)]).ravel() for of in (ratios, before))
        ratios, before = np.array(ratios), np.array(before)
        may_miss = int((1 - RECALL) * len(ratio))
        choices = []
        for reach in REACHES:
            beyond = np.sort(ahead[ratio > reach])[::-1]
            least = int(beyond[may_miss]) + 1 if len(beyond) > may_miss else 1
            choices.append((int(((ratios <= reach) | (before < least)).sum()), -reach, least))
        _, reach, self.least = min(choices)
        self.reach = -reach


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part, one for each id."""
    rows = vectors.selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) embedding")
    finite = "not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    rows = rows.where(f"vec_id is not null and embedding is not null and {finite} and exists(embedding, x -> x <> 0)")
    return rows.groupBy("vec_id").agg(F.max("embedding").alias("embedding"))


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return np.array(vectors.flatten()).reshape(len(vectors), dim)


def _placed(index: Centroids, dim: int, choose):
    """(list, id, vector) for every list that ``choose`` gives a vector."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = np.array(column(batch, "vec_id")), _scaled(_matrix(column(batch, "embedding"), dim))
            lists = [choose(index, v) for v in _unit(x)]
            which = np.repeat(np.arange(len(ids)), [len(c) for c in lists])
            where = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            raw = [v.tobytes() for v in x]
            yield pa.RecordBatch.from_arrays(
                [pa.array(where.astype(np.int64)), pa.array(ids[which]), pa.array([raw[i] for i in which], pa.binary())],
                ["list", "vec_id", "vector"],
            )

    return place


def _blocks(spark: SparkSession, placed: DataFrame, per_block: int) -> DataFrame:
    """The rows of each list in blocks of about ``per_block``, dealt by a hash of their ids: (list, ids, vectors)."""
    placed = written(spark, placed, "placed")
    sizes = written(spark, placed.groupBy("list").agg(F.count(F.lit(1)).alias("n")), "list-sizes")
    block = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / per_block))

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        joined = b"".join(v.as_py() for v in rows.column("vector"))
        return pa.table({"list": rows.column("list").slice(0, 1), "ids": [rows.column("vec_id").to_numpy().tobytes()], "vectors": [joined]})

    dealt = placed.join(sizes, "list").select("list", block.alias("block"), "vec_id", "vector")
    return written(spark, dealt.groupBy("list", "block").applyInArrow(pack, "list long, ids binary, vectors binary"), "blocks")


def _first(finds: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The k best of each query among (query, id, score) arrays; a pair found in several lists counts once."""
    asked, ids, scores = (np.concatenate(a) for a in zip(*finds, strict=True))
    order = np.lexsort((ids, -scores, asked))
    asked, ids, scores = asked[order], ids[order], scores[order]
    again = np.zeros(len(asked), bool)
    again[1:] = (asked[1:] == asked[:-1]) & (ids[1:] == ids[:-1])
    asked, ids, scores = asked[~again], ids[~again], scores[~again]
    keep = np.arange(len(asked)) - np.searchsorted(asked, asked) < k
    return asked[keep], ids[keep], scores[keep]


def _best(dim: int, k: int):
    """The k nearest among all blocks of a task for each query; beyond ``HELD`` finds they are passed on in parts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finds, held = [], 0
        for found in scored(batches):
            finds.append(found)
            held += len(found[0])
            if held > HELD:
                finds = [_first(finds, k)]
                held = len(finds[0][0])
                if held > HELD // 2:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, finds[0])), ["query_id", "vec_id", "score"])
                    finds, held = [], 0
        if finds:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, _first(finds, k))), ["query_id", "vec_id", "score"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, c_ids = (np.frombuffer(column(batch, n)[i].as_buffer(), np.int64) for n in ("q_ids", "ids"))
                q, c = (np.frombuffer(column(batch, n)[i].as_buffer()).reshape(-1, dim) for n in ("q_vectors", "vectors"))
                rough = _unit(q) @ _unit(c).T
                rough[q_ids[:, None] == c_ids[None, :]] = -2.0
                cut = np.partition(rough, max(0, len(c_ids) - k), axis=1)[:, max(0, len(c_ids) - k)]
                at, own = np.nonzero((rough >= cut[:, None] - 1e-9) & (rough > -1.5))
                exact = (q[at] * c[own]).sum(axis=1) / (np.sqrt((q[at] ** 2).sum(axis=1)) * np.sqrt((c[own] ** 2).sum(axis=1)))
                order = np.lexsort((c_ids[own], -exact, at))
                at, own, exact = at[order], own[order], exact[order]
                rank = np.arange(len(at)) - np.searchsorted(at, at)
                keep = rank < k
                yield q_ids[at[keep]], c_ids[own[keep]], exact[keep]

    return score


def nearest(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """For each row where ``is_query`` holds its k nearest other rows: query_id, rank, vec_id, score."""
    rows = written(spark, valid(vectors), "vectors")
    result = "query_id long, rank int, vec_id long, score double"
    common = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return spark.createDataFrame([], result)
    dim = common["dim"]
    rows = rows.where(F.size("embedding") == dim)
    # Spark cuts each group of copies to k + 1 rows a task before the shuffle; the hash spares it comparing arrays.
    copy = F.expr("row_number() over (partition by xxhash64(embedding), embedding order by vec_id)")
    kept = written(spark, rows.withColumn("copy", copy).where(F.col("copy") <= k + 1), "kept")
    number = kept.where("copy = 1").count()
    place = F.pmod(F.xxhash64("vec_id", F.lit("centroids")), F.lit(1 << 30)) / (1 << 30)
    sample = kept.where("copy = 1").where(place < min(1.0, SAMPLE / number)).orderBy("vec_id").select("embedding").toArrow()
    x = _scaled(_matrix(sample.column("embedding").combine_chunks(), dim))
    if not len(x):
        x = np.eye(1, dim)
    index = Centroids(x, max(1, min(CENTROIDS, number // PER_CENTROID, len(x))))
    index.calibrate(x, k)
    schema = "list long, vec_id long, vector binary"
    posted = _blocks(spark, kept.mapInArrow(_placed(index, dim, Centroids.post), schema), BLOCK)
    asked = _blocks(spark, rows.where(is_query).mapInArrow(_placed(index, dim, Centroids.select), schema), QUERY_BLOCK)
    asked = asked.select("list", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    found = posted.join(asked, "list").mapInArrow(_best(dim, k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
