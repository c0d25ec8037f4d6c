"""Near duplicates against all pairs."""

from __future__ import annotations

import random
import re

from salespipe.llm import minhash
from salespipe.llm.components import components


def brute(rows, size, similarity):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= similarity * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def family(rng, n, words, edits, start):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"x{rng.randrange(40)}"
        rows.append((start + i, " ".join(text)))
    return rows


def test_all_links_of_families_of_copies_and_half_copies_are_found(spark):
    rng = random.Random(5)
    rows = family(rng, 120, 150, 12, 0) + family(rng, 60, 40, 4, 200) + family(rng, 30, 12, 2, 300)
    rows += [(400 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    rows += [(900, "One two"), (901, "one TWO"), (902, "one two three"), (903, ""), (904, None), (905, "Ärger ärger")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for size in (4, 5):
        got = minhash.near_duplicates(spark, docs, size, 80).collect()
        assert sorted(tuple(r) for r in got) == brute(rows, size, 80)


def test_odd_rows(spark, odd, none):
    got = sorted((tuple(r) for r in minhash.near_duplicates(spark, odd).collect()), key=repr)
    assert [r[0] for r in got].count(4) == 2 and len(got) == 9
    assert all(r[3] for r in got), "rows without words or an id are linked with nothing; a repeated id is its own class"
    assert {r[2] for r in got if r[0] is None} == {None}
    assert minhash.near_duplicates(spark, none).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_thousands_of_copies_of_one_row(spark):
    text = " ".join(f"word{i}" for i in range(120))
    copies = spark.range(5000).selectExpr("7L as doc_id", f"'{text}' as text")
    other = spark.createDataFrame([(3, text + " more"), (9, "nothing like it at all, is it")], "doc_id long, text string")
    found = minhash.near_duplicates(spark, copies.unionByName(other)).groupBy("doc_id", "component_id", "kept").count().collect()
    assert sorted(tuple(r) for r in found) == [(3, 3, True, 1), (7, 3, False, 5000), (9, 9, True, 1)]


def test_an_id_on_several_texts_is_so_many_documents(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (4, b + " tail"), (1, c)]
    found = minhash.document_classes(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    texts = spark.createDataFrame([(t,) for t in (a, b, c, b + " tail")], "text string").selectExpr("text", "xxhash64(text) as h").collect()
    named = {r.h: r.text for r in texts}
    got = sorted((r.doc_id, named[r.text_hash], r.component_id, named[r.keeper_hash]) for r in found.collect())
    assert got == sorted([(1, a, 1, a), (2, a, 1, a), (2, b, 2, b), (4, b + " tail", 2, b), (1, c, 1, c), (3, c, 1, c)])
