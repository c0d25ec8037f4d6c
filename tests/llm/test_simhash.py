"""SimHash classes against all pairs of brute-force fingerprints."""

from __future__ import annotations

import random
import re
from itertools import combinations

import xxhash

from salespipe.llm import simhash
from salespipe.llm.queries import QUERIES
from tests.conftest import DATA


def brute_fingerprint(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes):
    """The least node reachable within four bits, by all pairs."""
    nodes = sorted(set(nodes))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def brute(rows, size):
    prints = [(i, brute_fingerprint(t, size)) for i, t in rows]
    root = classes([f for _, f in prints])
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in prints), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def family(rng, n, words, edits, start):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"X{rng.randrange(40)}"
        rows.append((start + i, rng.choice([" ", "  ", "\n"]).join(text)))
    return rows


def rows(seed=3):
    rng = random.Random(seed)
    found = family(rng, 90, 150, 6, 0) + family(rng, 40, 600, 9, 200) + family(rng, 20, 3, 1, 300)
    found += [(400 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    found += [(900, "One two"), (901, "one TWO"), (903, ""), (904, None), (905, "\t \n"), (906, "Ärger ÄRGER 漢字 🙂"), (907, "x " * 70000)]
    rng.shuffle(found)
    return found


def test_fingerprints_and_classes_equal_brute_force_with_short_and_with_crowded_lists(spark):
    found = rows()
    docs = spark.createDataFrame(found, "doc_id long, text string").repartition(5)
    want = brute(found, 4)
    assert len({c for *_, c in want}) < len(want) - 60, "there are classes to find"
    # With no list allowed to be long, every pair comes from flipped bits, else from intersections.
    for crowded in (simhash.CROWDED, 4):
        assert got(simhash.fingerprint_classes(spark, docs, 4, crowded)) == want


def test_of_any_four_positions_three_are_a_choice():
    assert len(simhash.CHOICES) == 20
    assert all(any({*c} <= {*four} for c in simhash.CHOICES) for four in combinations(range(8), 4))


def test_links_at_each_distance_and_spread_of_bits(spark):
    rng = random.Random(8)
    nodes = []
    for base in (rng.getrandbits(64) for _ in range(30)):
        nodes.append(base)
        for d in range(1, 7):
            nodes.append(base ^ sum(1 << b for b in rng.sample(range(64), d)))
            at = rng.randrange(8)
            nodes.append(base ^ sum(1 << b for b in rng.sample(range(8 * at, 8 * at + 8), d)))
    signed = [(n - (1 << 64) if n >> 63 else n,) for n in set(nodes)]
    df = spark.createDataFrame(signed, "fingerprint long")
    root = classes(nodes)
    for crowded in (simhash.CROWDED, 1):
        links = [(r.u % 2**64, r.v % 2**64) for r in simhash.links(spark, df, crowded).collect()]
        assert all((u ^ v).bit_count() <= 4 for u, v in links)
        joined = {}
        for u, v in links:
            joined.setdefault(u, set()).add(v)
            joined.setdefault(v, set()).add(u)
        for n in set(nodes):
            seen, todo = {n}, [n]
            while todo:
                for m in joined.get(todo.pop(), ()):
                    if m not in seen:
                        seen.add(m)
                        todo.append(m)
            assert min(seen) == root[n]


def test_a_large_group_of_near_copies_is_not_paired_off(spark):
    """Every fingerprint within three bits of one centre: thousands share each list."""
    rng = random.Random(1)
    centre = rng.getrandbits(63)
    nodes = {centre ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(1200)}
    df = spark.createDataFrame([(n - (1 << 64) if n >> 63 else n,) for n in nodes], "fingerprint long")
    found = simhash.links(spark, df)
    assert found.count() < 400 * len(nodes)
    joined = simhash.components(spark, found)
    assert joined.select("component").distinct().count() == 1 and joined.count() == len(nodes)


def test_odd_rows(spark, odd, none):
    more = odd.selectExpr("*", "1 as fingerprint", "2 as component", "'n' as node")
    found = got(simhash.fingerprint_classes(spark, more))
    assert found == brute([(r.doc_id, r.text) for r in odd.collect()], 5)
    zero = [r for r in found if r[1] == "0" * 16]
    # No text, no words: one class, with rows that have no id among them.
    assert {r[0] for r in zero} == {1, 2, 3, None} and {r[2] for r in zero} == {1}
    assert got(simhash.fingerprint_classes(spark, none)) == []
    nameless = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert {r[2] for r in got(simhash.fingerprint_classes(spark, nameless))} == {None}


def test_query_equals_brute_force_on_a_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert got(QUERIES["op11_simhash_dedup"](spark, DATA)) == brute(docs, 4)


def test_many_copies_of_one_row(spark):
    copies = spark.range(5000).selectExpr("id % 2 as doc_id", "repeat('some words that repeat ', 30) as text")
    found = simhash.fingerprint_classes(spark, copies).groupBy("doc_id", "component_id").count().collect()
    assert sorted(tuple(r) for r in found) == [(0, 0, 2500), (1, 0, 2500)]
