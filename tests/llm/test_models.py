"""Language, toxicity and neighbours: held-out accuracy and brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from salespipe.llm import language, neighbours, toxicity
from salespipe.llm.queries import QUERIES
from tests.conftest import DATA


def test_language_of_held_out_documents(spark):
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op8_language_id"](spark, DATA).join(truth, "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) > 0
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_texts_have_no_part_in_the_language_model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    other = docs.withColumn("text", F.when(train, F.col("text")).otherwise(F.lit("zzq xxv wholly other words")))
    a, b = language.fit(spark, docs, train), language.fit(spark, other, train)
    assert (a.idf == b.idf).all() and (a.w == b.w).all() and a.temperature == b.temperature


def test_language_scores_are_calibrated(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    model = language.fit(spark, docs, train)
    low, high = np.exp(language.LOG_TEMPERATURES)
    assert 1.5 * low < model.temperature < high / 1.5
    truth = docs.where(~train).select("doc_id", "lang")
    got = language.identify(docs, model).join(truth, "doc_id").collect()
    accuracy = np.mean([r.lang == r.lang_pred for r in got])
    assert abs(np.mean([r.score for r in got]) - accuracy) < 0.02 and accuracy > 0.97


def test_temperature_of_flat_and_of_sharp_scores():
    rng = np.random.Generator(np.random.PCG64(3))
    truth = rng.integers(0, 3, 4000)
    logits = rng.normal(size=(4000, 3))
    logits[np.arange(4000), truth] += 1.5
    at = language._temperature(logits, truth)
    # Scores sharpened tenfold need ten times the temperature.
    assert np.isclose(language._temperature(10 * logits, truth), 10 * at, rtol=1e-3)


def test_an_epoch_of_the_language_model_equals_a_plain_loop():
    rng = np.random.Generator(np.random.PCG64(5))
    model = language.Model(["a", "b", "c"], np.ones(language.DIMS))
    z, n = {}, {}

    def weight(i, k):
        zi = z.get((i, k), 0.0)
        if abs(zi) <= language.L1:
            return 0.0
        sign = 1 if zi > 0 else -1
        return -(zi - sign * language.L1) / ((language.BETA + n.get((i, k), 0.0) ** 0.5) / language.ALPHA + language.L2)

    for _ in range(60):
        places = np.sort(rng.choice(40, 6, replace=False))
        values, lang = rng.random(6), int(rng.integers(0, 3))
        model.learn(places, values, lang)
        x = {**dict(zip(places.tolist(), values.tolist(), strict=True)), language.DIMS: 1.0}
        scores = [sum(v * weight(i, k) for i, v in x.items()) for k in range(3)]
        p = np.exp(np.array(scores) - max(scores))
        p /= p.sum()
        old = {(i, k): weight(i, k) for i in x for k in range(3)}
        for i, v in x.items():
            for k in range(3):
                g = v * (p[k] - (k == lang))
                before = n.get((i, k), 0.0)
                z[i, k] = z.get((i, k), 0.0) + g - ((before + g * g) ** 0.5 - before**0.5) / language.ALPHA * old[i, k]
                n[i, k] = before + g * g
    model.finish()
    assert all(np.isclose(model.w[i, k], weight(i, k)) for i, k in z)


def test_language_of_odd_rows(spark, odd, none):
    model = language.fit(spark, odd, F.lit(True))
    got = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0.0
    assert got[5].lang_pred == "de" and got[6].lang_pred == "en"
    blank = language.fit(spark, none, F.lit(True))
    assert {r.lang_pred for r in language.identify(odd, blank).collect()} == {"und"}
    assert language.identify(none, model).collect() == []


def test_block_max_finds_the_exact_neighbours():
    rng = np.random.Generator(np.random.PCG64(8))
    vectors = rng.random((700, 30)) * (rng.random((700, 30)) < 0.15)
    vectors = vectors[vectors.any(axis=1)]
    vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    vectors = np.concatenate((vectors, vectors[:50]))
    ids, labels = rng.permutation(len(vectors)), rng.integers(0, 2, len(vectors))
    index = toxicity.BlockMaxIndex(ids, labels, vectors)
    queries = vectors[::7]
    rows, cosine = index.nearest(queries, 10)
    exact = np.round(queries @ vectors.T, 12)
    for i in range(len(queries)):
        order = np.lexsort((ids, -exact[i]))[:10]
        order = order[exact[i][order] > 0]
        assert index.ids[rows[i][rows[i] >= 0]].tolist() == ids[order].tolist()
        assert np.allclose(cosine[i][: len(order)], exact[i][order])


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.9 * len(got) > 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_of_odd_rows(spark, odd, none):
    texts = [(100 + i, ("calm words flow" if i % 3 else "you utter scoundrel") + f" {chr(97 + i % 26)}bc {chr(97 + i // 26)}de") for i in range(90)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(100 + i, 0 if i % 3 else 1) for i in range(90)] + [(None, 1), (100, None), (101, 0), (7777, 1)], "doc_id long, toxic int"
    )
    model = toxicity.fit(spark, docs, labels, F.lit(True))
    both = odd.selectExpr("*", "'x' as score").unionByName(docs.filter("doc_id < 106"), allowMissingColumns=True)
    got = toxicity.score(both, model)
    assert got.columns == [*odd.columns, "score", "predicted", "evidence"] and got.count() == 15
    by = {r.doc_id: r for r in got.collect()}
    assert by[100].predicted == by[103].predicted == 1 and by[101].predicted == 0
    assert by[1].score == by[2].score == by[3].score < 0.5 and by[1].evidence == []
    assert {e.toxic for e in by[100].evidence} == {1}
    assert toxicity.score(none, model).collect() == []
    for few in (labels.filter("toxic = 0"), labels.limit(0)):
        assert {r.score for r in toxicity.score(odd, toxicity.fit(spark, docs, few, F.lit(True))).collect()} == {0.0}


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.Generator(np.random.PCG64(4))
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 16))
    x[500:900] = x[500]  # a group of copies
    return x


def test_neighbours_against_brute_force(spark, vectors):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(spark, table, F.col("vec_id") % 50 == 0, 5).collect()
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    hits = 0
    for q in range(0, 4000, 50):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and all(r.vec_id != q for r in own)
        exact = unit @ unit[q]
        assert all(abs(r.score - exact[r.vec_id]) < 1e-9 for r in own)
        exact[q] = -9
        wanted = np.lexsort((np.arange(4000), -np.round(exact, 12)))[:5]
        hits += len({r.vec_id for r in own} & set(wanted.tolist()))
        if 500 <= q < 900:
            assert [r.vec_id for r in own] == [i for i in range(500, 507) if i != q][:5], "ties go to the smaller id"
    assert hits >= 0.9 * 5 * 80


def test_copies_do_not_hide_lists():
    rng = np.random.Generator(np.random.PCG64(6))
    x = rng.normal(size=(9000, 16))
    x[:3000] = x[0]
    index = neighbours.Centroids(x, 1024)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * index.points @ index.points.T)) + 9 * np.eye(len(index.points))
    assert len(index.points) > 900 and apart.min() > 1e-6, "no twin centroids"
    for q in (x[0] + 0.5 * rng.normal(size=(20, 16)) for _ in range(2)):
        for v in q / np.sqrt((q * q).sum(axis=1, keepdims=True)):
            distance = np.sqrt(2 - 2 * index.points @ v)
            assert set(np.flatnonzero(distance <= neighbours.REACH * distance.min())) <= set(index.select(v))


def test_search_widens_past_a_hot_topic():
    rng = np.random.Generator(np.random.PCG64(7))
    x = rng.normal(size=(9000, 16))
    x[:3000] = x[0] + 0.002 * rng.normal(size=(3000, 16))  # near copies: no twins, but centroids that lie together
    index = neighbours.Centroids(x, 1024)
    hot, q = x[0] / np.sqrt(x[0] @ x[0]), x[0] + 0.5 * rng.normal(size=16)
    q /= np.sqrt(q @ q)
    chosen = index.select(q)
    elsewhere = index.points[chosen] @ hot < 0.999
    assert elsewhere.sum() >= neighbours.LEAST_LISTS - 1 and len(chosen) > neighbours.BEAM


def test_calibrated_lists_hold_the_nearest():
    rng = np.random.Generator(np.random.PCG64(12))
    centres = rng.normal(size=(30, 24))
    x = centres[rng.integers(0, 30, 6000)] + 0.5 * rng.normal(size=(6000, 24))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    index = neighbours.Centroids(x[:3000], 100)
    index.calibrate(x[:3000], 5)
    posts = [set(index.post(v).tolist()) for v in x]
    hits = read = 0
    for q in range(5900, 6000):
        chosen = set(index.select(x[q]).tolist())
        cosine = x @ x[q]
        cosine[q] = -9
        hits += sum(bool(chosen & posts[i]) for i in np.argsort(-cosine)[:5])
        read += sum(bool(chosen & p) for p in posts)
    assert hits >= 0.93 * 500 and read < 0.5 * 6000 * 100
    assert sum(map(len, posts)) < 2 * 6000


def test_the_best_of_several_lists():
    finds = [(np.array([1, 1, 2]), np.array([7, 8, 9]), np.array([0.5, 0.4, 0.1])), (np.array([2, 1, 1]), np.array([3, 7, 5]), np.array([0.1, 0.5, 0.4]))]
    assert [a.tolist() for a in neighbours._first(finds, 2)] == [[1, 1, 2, 2], [7, 5, 3, 9], [0.5, 0.4, 0.1, 0.1]]


def test_calibration_of_few_vectors():
    for x in (np.eye(1, 4), np.ones((7, 4))):
        index = neighbours.Centroids(x, 1)
        index.calibrate(x, 5)
        assert (index.reach, index.least) == (neighbours.REACH, neighbours.LEAST_LISTS)
        assert index.select(np.eye(1, 4)[0]).tolist() == [0]
    x = np.concatenate((np.eye(3), np.eye(3)))
    index = neighbours.Centroids(x, 2)
    index.calibrate(x, 5)
    assert len(index.select(np.eye(3)[0])) >= 1


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (1, [0.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 0.0]), (1, [0.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in neighbours.nearest(spark, table, F.col("vec_id") % 50 == 0, 5).collect())
    half = 0.7071067811865475
    assert [(a, b, c) for a, b, c, _ in got] == [(0, 1, 50), (0, 2, 1), (50, 1, 0), (50, 2, 1)]
    assert np.allclose([r[3] for r in got], [half, 0.0, half, half])
    assert neighbours.nearest(spark, table.limit(0), F.lit(True), 5).collect() == []


def test_neighbours_of_vectors_with_huge_and_tiny_components(spark):
    rng = np.random.Generator(np.random.PCG64(9))
    x = rng.normal(size=(120, 8))
    big, tiny = x * 1e200, x * 1e-200
    # A power of two changes no digit, so the scores are the same to the last one.
    both = [neighbours.nearest(
        spark, spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(m)], "vec_id long, embedding array<double>"),
        F.col("vec_id") % 50 == 0, 5,
    ).collect() for m in (x, x * 2.0**600, big, tiny)]
    found = [sorted(tuple(r) for r in rows) for rows in both]
    assert found[0] == found[1] and len(found[0]) == 15
    for other in found[2:]:
        assert [r[:3] for r in other] == [r[:3] for r in found[0]]
        assert np.allclose([r[3] for r in other], [r[3] for r in found[0]], rtol=1e-12)


def test_neighbours_leave_out_further_columns(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0], 7, 8), (1, [1.0, 1.0], 7, 8)], "vec_id long, embedding array<double>, list long, rank int")
    got = neighbours.nearest(spark, table, F.col("vec_id") == 0, 5).collect()
    assert [tuple(r)[:3] for r in got] == [(0, 1, 1)]
