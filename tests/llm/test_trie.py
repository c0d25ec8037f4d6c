"""The prefix trie against a plain trie, and the radix tree against a set of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from salespipe.llm import trie

ROWS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Conversations in order: NULL turns first, ties by role (their texts are equal in these tests)."""
    found = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            found[conv].append((role or "", text or ""))
    return dict(found)


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children, below = defaultdict(list), defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
        for d in range(len(path) + 1):
            below[path[:d]].append(path)
    rows = []
    for path, convs_here in members.items():
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below[path] if p)
        ends = ",".join(str(c) for c in convs_here if len(convs[c]) == len(path))
        rows.append((
            convs_here[0], len(path), members[path[:-1]][0] if path else None, len(convs_here), len(children[path]),
            sum(not children[p] for p in below[path]), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


def conversations(seed=4, n=120, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 300), n):
        opening = rng.choice([["a"], ["a", "b"], ["a", "b", "ü漢"], ["c"], []])
        texts = opening + [rng.choice("xyz") * rng.randrange(3) for _ in range(rng.randrange(longest))]
        rows += [(c, i if i or rng.random() < 0.5 else None, rng.choice(["user", "user", None]), t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def test_trie_equals_a_plain_trie(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, ROWS).repartition(6)
    assert got(trie.prefix_trie(spark, df)) == brute(plain(rows))
    turns, convs = trie.reopened(spark, trie.numbered(spark, df))
    assert got(trie.trie(spark, turns, convs)) == brute(rebuilt(plain(rows)))


def test_conversations_of_several_segments_and_a_hot_opening(spark):
    rng = random.Random(7)
    rows = []
    for c in range(30):
        n = rng.choice([63, 64, 65, 128, 129, 200])
        cut = rng.choice([n, n, 60, 64, 70, 127, 130])
        rows += [(c, i, "user", f"t{i}" if i < cut else f"t{i} {rng.randrange(2)}") for i in range(n)]
    rows += [(c, 0, "system", "the same opening") for c in range(100, 160)] + [(c, 1, "user", f"q{c % 7}") for c in range(100, 160, 2)]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert got(trie.prefix_trie(spark, df)) == brute(plain(rows))


def test_trees_cut_off_early_and_short_segments_join_to_the_same_trie(spark):
    rows = conversations(11)
    turns = trie.numbered(spark, spark.createDataFrame(rows, ROWS))
    found = trie.trie(spark, turns, turns.select("conv_id").distinct(), segment=2, tree_bytes=100)
    assert got(found) == brute(plain(rows))


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (2, None, "", ""), (2, 5, "user", "hi"), (None, 0, "user", "no id"),
        (3, 0, "user", "long " * 200_000), (4, 0, "user", "long " * 200_000), (4, 1, None, ""), (5, 2, "1:user", ""), (6, 2, "1", ":user"), (7, None, None, None),
    ]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 as node", "2 as depth", "3 as place", "4 as n")
    assert got(trie.prefix_trie(spark, df)) == brute(plain(rows))
    turns, convs = trie.reopened(spark, trie.numbered(spark, df))
    assert got(trie.trie(spark, turns, convs)) == brute(rebuilt(plain(rows)))
    assert got(trie.prefix_trie(spark, df.limit(0))) == []


def test_only_turnless_conversations(spark):
    """Conversation 1 takes what conversation 0 has (nothing there), and has no turns of its own left."""
    c = next(c for c in range(1, 50) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "hi")]
    turns, convs = trie.reopened(spark, trie.numbered(spark, spark.createDataFrame(rows, ROWS)))
    want = hashlib.sha256(str(c).encode()).hexdigest()
    assert got(trie.trie(spark, turns, convs)) == [(c, 0, None, 1, 0, 1, 0, want)]


def test_many_ends_of_one_node_and_a_long_conversation(spark):
    rows = spark.range(4500).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'same' as text")
    more = spark.range(3000).selectExpr("9000L as conv_id", "id as turn", "'user' as role", "'t' as text")
    found = trie.prefix_trie(spark, rows.unionByName(more))
    node = found.where("depth = 1 and n_convs > 1").first()
    assert (node.n_convs, node.saved_tokens) == (4500, 4499 * 4)
    assert node.ends_sha256 == hashlib.sha256(",".join(map(str, range(4500))).encode()).hexdigest()
    assert found.count() == 3002 and found.where("depth = 0").first().n_leaves == 2


def test_layouts_grow_and_only_aligned_depths_come_out():
    rng = random.Random(2)
    for width, spread in ((2, 256), (2, 3), (3, 40), (1, 256)):
        tree, keys = trie.Tree(), []
        for i in range(600):
            key = bytes(width) + bytes(rng.randrange(spread) for _ in range(width * rng.randrange(4)))
            keys.append(key)
            tree.insert(key, (i, 1, i, 0, key))
        want = defaultdict(list)
        for i, key in enumerate(keys):
            for d in range(2, len(key) // width + 1):
                want[key[: d * width]].append(i)
        found = {(d, t[4][: d * width]): t[:4] for d, t in tree.aligned(width)}
        assert found == {(len(k) // width, k): (min(m), len(m), sum(m), 0) for k, m in want.items()}
        layouts, todo = set(), [tree.root]
        while todo:
            node = todo.pop()
            layouts.add(node.children.layout)
            assert len(node.children) <= node.children.layout
            todo.extend(node.children)
        if spread == 256:
            assert layouts >= {4, 256}
