"""Repeated passages against a dictionary of all strings."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from salespipe.llm import store, suffixes


def brute(rows, length):
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if i is not None:
                first[s] = min(first.get(s, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            if i is not None and first[data[p : p + length]] < i:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        spans = [(int(a), int(b - a)) for a, b in edges.reshape(-1, 2)]
        out.append((i, len(data), int(gone.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~gone])))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, [(s.start, s.length) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize(("length", "hot", "shards"), [(50, 4096, 2), (50, 0, 3), (13, 4096, 1), (64, 1, 2)])
def test_as_brute_force(spark, monkeypatch, length, hot, shards):
    monkeypatch.setattr(suffixes, "PACK_BYTES", 2000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 4000)
    rng = random.Random(length)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.randrange(20, 140))) for _ in range(12)]
    rows = [(i, "".join(rng.choice([rng.choice(parts), "".join(rng.choice("xyzß") for _ in range(30))]) for _ in range(6))) for i in range(60)]
    rows += [(70, "a" * 300), (71, "a" * 200), (72, parts[0][:12]), (73, None), (74, ""), (75, "漢" * 40), (76, "語漢" * 3 + "漢" * 40)]
    rows += [(None, parts[1] * 3)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(suffixes.remove_repeats(spark, docs, length, hot, shards)) == brute(rows, length)


def test_whole_characters_stay_text(spark):
    rows = [(1, "é" * 30), (2, "x" + "é" * 30 + "ü")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept).decode() for r in suffixes.remove_repeats(spark, docs, characters=True).collect()}
    assert got == {1: "é" * 30, 2: "xü"}


def test_odd_rows_keep_their_columns(spark, odd, none):
    more = odd.selectExpr("*", "7 as kept", "lang as slice")
    got = suffixes.remove_repeats(spark, more)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "slice", "n_bytes", "n_removed", "spans", "kept"]
    assert got.count() == 9 and got.filter("n_removed > 0").count() == 0, "a repeated id is one document"
    assert suffixes.remove_repeats(spark, none).collect() == []
    with pytest.raises(ValueError, match="length"):
        suffixes.remove_repeats(spark, odd, 65)


def test_merging_gives_the_order_of_all_rotations():
    rng = np.random.Generator(np.random.PCG64(3))
    size = rng.integers(20, 40, 30)
    data = rng.integers(97, 99, size.sum()).astype(np.uint8)
    first = np.concatenate(([0], np.cumsum(size)))
    length, whole = 20, []
    shards = [(0, 9), (9, 17), (17, 30)]
    made = [suffixes.Transform(data[first[a] : first[b]], size[a:b], length) for a, b in shards]
    place, border = suffixes.merge(made, length)
    where = np.concatenate([t.rotation + first[a] for t, (a, _) in zip(made, shards, strict=True)])[place]
    owner = np.repeat(np.arange(30), size)
    for p in where:
        s = data[first[owner[p]] : first[owner[p] + 1]].tobytes() * 3
        whole.append(s[p - first[owner[p]] :][:length])
    assert whole == sorted(whole)
    assert border.tolist() == [True] + [a != b for a, b in zip(whole, whole[1:], strict=False)]


def test_texts_are_moved_once_and_segments_lie_nowhere_twice(spark, monkeypatch):
    labels, scratch = [], store.scratch_dir
    monkeypatch.setattr(store, "scratch_dir", lambda spark, label: labels.append(label) or scratch(spark, label))
    monkeypatch.setattr(suffixes, "PACK_BYTES", 300)
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles

    def shuffled():
        found = files()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    rows = [(i, f"{i} {'the same passage of more than fifty bytes in every document ' * 2}{i}") for i in range(40)]
    before = shuffled()
    got = suffixes.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert not left, "files of a shuffle whose step is over"
    assert labels == ["packed", "replies", "marks"]
    assert found(got) == brute(rows, suffixes.LENGTH)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert got.select("*")._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(slice") == 1, "only marks go to the slices"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_slices_of_a_task_send_together():
    texts = [f"{i:02d}" + "a passage that all these texts share, long enough to be found" for i in range(6)]
    held = []
    for i, text in enumerate(texts):
        data = np.frombuffer(text.encode(), np.uint8)
        packed = object.__new__(suffixes.Packed)
        packed.slice, packed.length, packed.ids, packed.known = i, 50, np.array([i]), np.array([True])
        packed.text = suffixes.Slice(0, data, np.array([0, len(data)]))
        cut = suffixes.Segments(packed)
        hashed = np.unique(cut.anchor)
        replies = pa.scalar([{"bucket": 0, "shared": suffixes._squeeze(np.ones(len(hashed), np.uint8))}])
        held.append((packed, suffixes.Candidates(packed, replies, 1)))
    rows = suffixes._messages(held, 50, 1)
    assert len(rows) == 1 and rows[0]["n"] == sum(len(f.head) for _, f in held)
    marks = suffixes._merge_bucket(50, 2)(pa.Table.from_pylist(rows, suffixes._SEGMENTS))
    assert sorted(marks.column("slice").to_pylist()) == [1, 2, 3, 4, 5], "all but the first have it from an earlier one"
