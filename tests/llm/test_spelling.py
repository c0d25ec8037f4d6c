"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from salespipe.llm import spelling


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(words):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def vocabulary(seed, n=400, syllables=("tion", "ent", "ß", "ü", "an", "er", "aa", "a")):
    rng = random.Random(seed)
    words = {}
    for _ in range(n):
        word = "".join(rng.choice(syllables) for _ in range(rng.randrange(2, 6)))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abt") + word[at:], word[:at] + "x" + word[at + 1 :]])
        if len(word) >= 2:
            words[word] = rng.choice([1, 2, 3, 5, 8, 20, 20, 50])
    return words


def test_forms_and_roots_equal_all_pairs_with_short_and_with_crowded_lists(spark):
    words = vocabulary(3)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    want = brute(words)
    assert sum(r[4] for r in want) > 300 and any(r[1] != r[2] for r in want if r[1])
    for crowded in (spelling.CROWDED, 1, 6):
        assert got(spelling.variants(spark, df, crowded=crowded)) == want


def test_words_that_share_a_half_are_not_paired_off(spark):
    """A thousand words end alike: the list of that ending is split, not squared."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abcdefgh") for _ in range(6)) + "ations": 5 for _ in range(1000)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [tuple(sorted(r)) for r in spelling.near_pairs(spark, df, 16).collect()]
    assert sorted(pairs) == sorted({tuple(sorted((a, b))) for a in words for b in words if one_edit(a, b)})


def test_words_of_texts_and_the_whole_query_equal_brute_force(spark):
    rng = random.Random(6)
    base = list(vocabulary(9, 60))
    texts = [(i, rng.choice([" ", "\n", "-", "1", "漢", "’"]).join(rng.choice(base).title() for _ in range(rng.randrange(200)))) for i in range(80)]
    texts += [(None, "nameless words " * 5), (None, None), (7, ""), (8, "ÀÉÎ×÷ÿ " * 9), (9, "łódź straße STRASSE " * 3), (10, "longrun" * 30_000)] + [(3, "again again again")] * 2
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n")
    words = brute_words(texts)
    found = spelling.vocabulary(spark, df, change=spelling.damaged)
    assert {r.word: r.n for r in found.collect()} == words
    assert got(spelling.variants(spark, found)) == brute(words)


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = spelling.vocabulary(spark, odd, change=spelling.damaged)
    assert got(spelling.variants(spark, found)) == brute(brute_words(rows))
    assert got(spelling.variants(spark, spelling.vocabulary(spark, none))) == []


def test_without_a_change_words_are_counted_as_they_stand(spark):
    df = spark.range(194).select("id", F.lit("Spelling").alias("text")).withColumnRenamed("id", "doc_id")
    assert [tuple(r) for r in spelling.vocabulary(spark, df).collect()] == [("spelling", 194)]


def test_a_long_chain_of_forms_ends_at_its_last(spark):
    words = {"aaaaa" + "b" * i: 4 * 2**i for i in range(14)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r.root for r in spelling.variants(spark, df).collect()} == {"aaaaa" + "b" * 13}
