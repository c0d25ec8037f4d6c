"""The pipeline on planted cases and on odd rows, stage by stage."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from salespipe.llm.store import written
from tests.llm.test_suffixes import brute

NAMES = [name for name, _ in corpus_pipeline.STAGES]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, folder):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, folder), "test-stage")
        out[name] = docs
    return out


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(60)
    rows = [(i, text(80)) for i in range(60)]
    rows += [(100 + i, text(20) + " scoundrel " + text(20)) for i in range(30)]
    rows += [(200 + i, rows[i][1]) for i in range(5)]  # copies
    rows += [(300 + i, rows[i][1].replace(" ", "  ", 3) + " " + word()) for i in range(5, 10)]  # near copies
    rows += [(400 + i, text(30) + " " + passage + " " + text(30)) for i in range(5)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in rows]
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame([(i, int(100 <= i < 130)) for i, *_ in rows], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return rows, passage, docs, stages(spark, docs, folder)


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is None, i))


def test_stage_names():
    assert NAMES == ["toxicity", "near-duplicates", "repeated-passages", "mixing", "packing"]


def test_each_stage_does_its_work_and_leaves_the_rest(planted):
    rows, passage, docs, out = planted
    assert all(out[name].columns == COLUMNS for name in NAMES[:-1])
    clean = [i for i, *_ in rows if not 100 <= i < 130]
    assert ids(out["toxicity"]) == clean
    single = [i for i in clean if i < 200 or i >= 400]
    assert ids(out["near-duplicates"]) == single
    texts = {r.doc_id: r for r in out["repeated-passages"].collect()}
    assert sorted(texts) == single
    by_id = {i: t for i, t, *_ in rows}
    want = {i: kept.decode() for i, _, _, _, kept in brute([(i, by_id[i]) for i in single], 50)}
    assert {i: r.text for i, r in texts.items()} == want
    assert all(r.n_chars == len(r.text) for r in texts.values())
    assert [passage in texts[400 + i].text for i in range(5)] == [True] + [False] * 4
    assert set(ids(out["mixing"])) == set(single) == set(ids(out["packing"]))


def test_packing_holds_every_word_of_the_mix(planted):
    out = planted[3]
    words = sum(len(r.text.split()) for r in out["mixing"].collect())
    assert sum(r.length for r in out["packing"].collect()) == words


def test_odd_rows_and_empty_tables_pass(spark, odd, none, tmp_path):
    labels = f"{tmp_path}/labels.parquet"
    spark.createDataFrame([(4, 1), (5, 0), (None, 1)], "doc_id long, toxic int").write.parquet(labels)
    more = odd.selectExpr("*", "1 as n_words", "'k' as kept", "2 as block", "3 as component")
    out = stages(spark, more, str(tmp_path))
    assert all(out[name].columns == more.columns for name in NAMES[:-1])
    # Rows 4 repeat each other, and the two rows without an id differ.
    assert ids(out["near-duplicates"]) == [1, 2, 3, 4, 5, 6, None, None]
    assert all(out_stage.count() == 0 for out_stage in stages(spark, none, str(tmp_path)).values())


def test_no_text_is_lost_to_an_id_it_shares_and_copies_go(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (2, b), (4, ""), (None, a), (None, a), (5, c + " end")] + [(9, a)] * 2000
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], ", ".join(["doc_id long, text string, lang string, source string, n_chars long"]))
    left = dict(corpus_pipeline.STAGES)["near-duplicates"](spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([(1, a), (2, b), (3, c), (4, ""), (None, a)], key=repr)
