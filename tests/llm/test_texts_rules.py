"""Quality rules, urls, sharding, mixing and packing."""

from __future__ import annotations

import collections
import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from salespipe.llm import mixing, packing, quality, sharding, urls
from salespipe.llm.queries import ORACLES, QUERIES


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_base_figures(spark, odd):
    texts = ["a b c d e f g h i a b c d e f g h i", "x\nx\ny\n\n \nx ", "#*$%&|<> é漢", None, "", "one two three four five six seven " * 9]
    docs = spark.createDataFrame(list(enumerate(texts, 20)), "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    want = {r.doc_id: base(r.text) for r in docs.collect() if r.doc_id is not None}
    got = [r for r in quality.line_first(docs).collect() if r.doc_id is not None]
    assert {r.doc_id for r in got} == set(want) and max(w[4] for w in want.values()) > 30
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]


def test_stock_phrases_are_whole_words_and_a_share_of_the_line():
    long = "The editors catalog indexes and dialog in scenes, " + "with many further words " * 5 + "to the end."
    assert quality.line_fails(long) is None
    assert quality.line_fails("Please log in.") == "boilerplate" and quality.line_fails("A blog in print.") is None
    assert quality.line_fails("We use cookies here.") == "boilerplate"
    assert quality.line_fails(" ".join(["One cookie among so many words that it is no notice at all,"] * 3) + " is it.") is None
    # Ten words for a reader, but joined by no-break spaces they are one word here.
    assert quality.line_fails("\u00a0".join("ten words that end without a stop in this line".split())) == "punctuation"


def test_stock_phrases_and_odd_spaces_as_in_sql(spark, tmp_path):
    lines = ["Please log in.", "A blog in print, a dialog in a catalog in time.", "\u00a0".join("abcdefghijk"), "Cookies! cookie? COOKIES.", "Read more", "a | b | c", "text with javascript in one word of these twelve words at the end."]
    rows = [(i, "\n".join(lines[i:] + ["A sentence of some length that ends as it should do, well and good."] * i)) for i in range(len(lines))]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(ORACLES["op3_quality_rules"])
    names = [d[0] for d in want.description]
    got = QUERIES["op3_quality_rules"](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(tuple(r)) for r in want.fetchall())


def test_lines_are_cleaned_first(spark, none):
    good = "".join(" ".join(f"word{i}x{j}" for j in range(12)) + ".\n" for i in range(5))
    docs = [(1, good), (2, good + "Home | News | Contact | About\nshort tail"), (3, "We use cookies.\n" * 3 + "\n".join(f"menu {i}" for i in range(60)))]
    got = {r.doc_id: r for r in quality.line_first(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].cleaned_text == good and got[1].n_lines_removed == 0
    assert got[2].kept and got[2].cleaned_text == good.rstrip("\n") and got[2].n_lines_removed == 2
    assert not got[3].kept
    assert quality.line_first(none).collect() == []


RULES = [urls.Rule("allow", "com", "/"), urls.Rule("block", "bad.com", "/x"), urls.Rule("allow", "ok.bad.com", "/x"), urls.Rule("block", "net", "/es/")]


def test_verdicts_reach_aliases(spark):
    canonical = '<head><LINK href="{}" rel=canonical></head>'
    refresh = "<meta http-equiv='refresh' content='0; url={}'>"
    pages = [
        (1, "http://BAD.com/x/1", None), (2, "http://ok.bad.com/x/2", ""), (3, "https://good.com", "<p>"), (4, "http://b.net/es/", None),
        (5, "http://alias.org/a", canonical.format("https://b.net/es")), (6, "http://alias.org/b", refresh.format("http://alias.org/a#f")),
        (7, "http://alias.org/c", canonical.format("/b")), (8, "http://both.org/", canonical.format("http://b.net/es/")),
        (9, "http://both.org/?utm_source=q", canonical.format("http://good.com/allowed")), (10, "http://good.com/allowed", None),
        (11, None, None), (12, "no address", None), (13, "://", None), (14, "http://alone.org/es/?q=1#f", None), (1, "http://BAD.com/x/1", None),
    ]
    got = [tuple(r) for r in urls.verdicts(spark, spark.createDataFrame(pages, "page_id long, url string, html string"), RULES).collect()]
    by = {r[0]: r[3:] for r in got}
    assert len(got) == 15 and by[1] == ("bad.com/x", "block", False) and by[2][:2] == ("ok.bad.com/x", "allow")
    assert by[3] == (None, "allow", False), "no path, so the rule com/ does not fit"
    assert by[4] == ("net/es/", "block", False)
    # 8 joins the blocked pages with an allowed one: allow comes first for all that have no rule.
    assert by[5] == by[6] == by[7] == by[8] == by[9] == (None, "allow", True)
    assert all(by[i] == (None, "allow", False) for i in (11, 12, 13, 14))
    blocked = [p for p in pages if p[0] not in (8, 9)]
    by = {r.page_id: r.verdict for r in urls.verdicts(spark, spark.createDataFrame(blocked, "page_id long, url string, html string"), RULES).collect()}
    assert by[5] == by[6] == by[7] == "block" and by[10] == "allow"


def test_verdicts_follow_relative_and_further_links(spark):
    refresh = "<meta http-equiv=refresh content='0; url={}'>"
    canonical = "<link rel=canonical href='{}'>"
    links = {
        "http://a.org/x/p1?q": refresh.format("bad.html"), "http://a.org/x/y/p2": refresh.format("../bad.html"),
        "http://a.org/x/p3": canonical.format("./y/.././bad.html"), "http://a.org/p4": refresh.format("../../x/bad.html"),
        "http://b.org/list": refresh.format("?id=3&amp;k=1"), "http://a.org": refresh.format("x/bad.html"),
        "http://a.org/p7": canonical.format("/fine") + canonical.format("http://c.org/bad") + refresh.format("#top"),
        "http://a.org/p8": refresh.format("/fine") + refresh.format("/q/../x/bad.html"),
        "http://d.org/p9": "<base href='http://a.org/x/'>" + refresh.format("bad.html"),
        "http://a.org/login": refresh.format("x/bad.html?u=http://e.org/"),
        "http://e.org/": refresh.format("mailto:bad.html"), "http://e.org/a": refresh.format("b.html"), "http://e.org/c": None,
    }
    pages = [(i, u, h) for i, (u, h) in enumerate(links.items())]
    ends = ["http://a.org/x/bad.html", "http://b.org/list?id=3&k=1", "http://c.org/bad", "http://a.org/x/bad.html?u=http://e.org/"]
    pages += [(100 + i, u, refresh.format("http://c.org/bad") if "id=3" in u else None) for i, u in enumerate(ends)]
    rules = [urls.Rule("block", "a.org", "/x/bad"), urls.Rule("block", "c.org", "/")]
    got = {r.page_id: r for r in urls.verdicts(spark, spark.createDataFrame(pages, "page_id int, url string, html string"), rules).collect()}
    assert [got[i].verdict for i in range(len(links))] == ["block"] * 10 + ["allow"] * 3
    assert all(got[i].from_alias for i in range(10))



def test_hosts_and_paths(spark):
    url = spark.createDataFrame([("HTTP://Ex.COM:80?a/b",), ("x://y//z#q?",), ("a\n://h/p\nq",), ("É://É/É",)], "u string")
    got = [tuple(r) for r in url.select(urls.host(F.col("u")), urls.path(F.col("u"))).collect()]
    assert got == [("ex.com:80", ""), ("y", "//z"), ("h", "/p\nq"), ("É", "/É")]


def test_identical_rows_are_spread_over_the_buckets(spark):
    docs = spark.range(12000).selectExpr("if(id < 9000, 1, id) as doc_id", "repeat('x', 50) as text")
    outs = [sharding.two_pass(spark, d, "length(text)", bucket_bytes=20_000) for d in (docs, docs.repartition(5))]
    for out in outs:
        # The permutation mixes copies and others evenly: every tenth of the places holds about three quarters copies.
        rows = out.select("row.doc_id", "place").orderBy("place").collect()
        assert [r.place for r in rows] == list(range(12000))
        assert all(780 < sum(r.doc_id == 1 for r in rows[i : i + 1200]) < 1020 for i in range(0, 12000, 1200))
    ids = [[r.doc_id for r in out.select("row.doc_id", "place").orderBy("place").collect()] for out in outs]
    assert ids[0] == ids[1], "the same however the input is split"


def test_shards(spark, odd, none):
    docs = spark.range(1000).selectExpr("id as doc_id", "repeat('x', cast(id % 90 as int)) as text", "'s' as shard", "id as bucket")
    size = "length(text) + 1"
    out = sharding.shards(spark, docs, size, 7, bucket_bytes=500)
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == list(range(1000)) and out.columns == ["doc_id", "text", "bucket", "shard", "slot"]
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert {len(s) for s in slots.values()} == {142, 143} and all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shards(spark, docs.repartition(7), size, 7, bucket_bytes=500).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}
    near = sum(abs((a.doc_id - b.doc_id)) == 1 for a, b in zip(*(sorted(rows, key=lambda r: (r.slot, r.shard))[i:] for i in (0, 1)), strict=False))
    assert near < 20, "neighbours are scattered"
    assert sharding.shards(spark, odd, "1", 4).count() == 9 and sharding.shards(spark, none, "1", 4).collect() == []


def test_mixing_meets_its_limits(spark):
    counts = {"big": 1500, "mid": 400, "small": 60, None: 40}
    rows = [(f"{s}{i}", s, "w " * (5 + i % 7)) for s, n in counts.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id string, source string, text string").repartition(3)
    tokens = collections.Counter()
    for _, s, t in rows:
        tokens[s] += len(t.split()) + 1
    for entropy, repeats in ((0.8, 100.0), (0.95, 2.0), (1.0, 1e9), (0.1, 1.0)):
        mixed = mixing.mix(spark, docs, entropy=entropy, repeats=repeats, block_tokens=4000)
        rows_out = mixed.collect()
        assert {r.doc_id for r in rows_out} == {r[0] for r in rows}, "every document occurs"
        got = collections.Counter()
        for r in rows_out:
            got[r.source] += r.n_tokens
        share = {s: n / sum(got.values()) for s, n in got.items()}
        h = -sum(p * math.log(p) for p in share.values()) / math.log(4)
        often = {s: got[s] / tokens[s] for s in tokens}
        assert max(often.values()) / min(often.values()) <= repeats * 1.02
        natural = -sum(n / sum(tokens.values()) * math.log(n / sum(tokens.values())) for n in tokens.values()) / math.log(4)
        assert h <= max(entropy, natural) + 0.01
        assert abs(h - max(entropy, natural)) < 0.02 or abs(max(often.values()) / min(often.values()) - repeats) < 0.1 * repeats
        passes = collections.Counter((r.doc_id, r.epoch) for r in rows_out)
        assert set(passes.values()) == {1}, "a pass has each document once"
        places = collections.defaultdict(list)
        for r in rows_out:
            places[r.block].append(r.position)
        assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_a_budget_cuts_the_mix(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * 9) for i in range(400)], "doc_id long, source string, text string")
    mixed = mixing.mix(spark, docs, budget=1000)
    assert mixed.groupBy("source").agg(F.sum("n_tokens").alias("n")).filter("n > 500 or n < 490").count() == 0


def test_mixing_odd_rows(spark, odd, none):
    out = mixing.mix(spark, odd.selectExpr("*", "1 as block"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "epoch", "block", "position"]
    assert out.filter("epoch = 0").count() == 9
    assert mixing.mix(spark, none).collect() == []


def test_best_fit_fills_and_downsizes():
    bins, sizes = packing.best_fit([700, 500, 300, 90, 10], [100, 500, 1000], overhead=10)
    assert bins == [0, 1, 0, 2, 2] and sizes == [1000, 500, 100]
    bins, sizes = packing.best_fit([], [10])
    assert bins == [] and sizes == []


def _least_cost(lengths, capacities):
    """The cost of the cheapest packing, over all ways to part the pieces."""
    def parts(rest):
        if not rest:
            yield []
            return
        for mask in range(1 << (len(rest) - 1)):
            own = [rest[0]] + [x for i, x in enumerate(rest[1:]) if mask >> i & 1]
            if sum(own) <= max(capacities):
                for more in parts([x for i, x in enumerate(rest[1:]) if not mask >> i & 1]):
                    yield [own, *more]

    return min(sum(packing.bin_cost(min(c for c in capacities if c >= sum(own))) for own in found) for found in parts(lengths))


def test_costs_of_small_blocks_are_near_the_least():
    rng = random.Random(12)
    ratios = []
    for _ in range(60):
        capacities = (512, 1024, 2048, 4096)
        lengths = sorted((rng.choice([rng.randrange(1, 200), rng.randrange(1, 4097)]) for _ in range(rng.randrange(1, 8))), reverse=True)
        bins, sizes = packing.best_fit(lengths, capacities)
        held = collections.Counter()
        for b, length in zip(bins, lengths, strict=True):
            held[b] += length
        assert all(held[b] <= c and not any(held[b] <= s < c for s in capacities) for b, c in enumerate(sizes))
        ratios.append(sum(map(packing.bin_cost, sizes)) / _least_cost(lengths, capacities))
    assert max(ratios) < 1.5 and sum(ratios) / len(ratios) < 1.06 and sum(r < 1 + 1e-9 for r in ratios) > 30


def test_sizes_are_chosen_jointly_and_beat_any_single_one():
    rng = random.Random(3)
    lengths = sorted((min(4096, int(rng.lognormvariate(5.5, 1.3)) + 1) for _ in range(4000)), reverse=True)
    bins, sizes = packing.best_fit(lengths)
    used = collections.Counter(sizes)
    assert len(used) >= 3 and max(used.values()) < 0.97 * len(sizes)
    cost = sum(map(packing.bin_cost, sizes))
    alone = packing.best_fit(lengths, [4096])[1]
    assert cost < 0.99 * sum(map(packing.bin_cost, alone)), "cheaper than sequences of 4,096 alone"
    assert sum(sizes) < 1.002 * sum(lengths), "hardly any padding"


def test_packing_loses_no_word(spark, odd, none):
    docs = odd.unionByName(spark.range(300).selectExpr("id + 100 as doc_id", "repeat('w ', cast(id * 7 as int)) as text", "'en' as lang", "'z' as source", "id as n_chars"))
    out = packing.pack(spark, docs, capacities=(64, 256, 1024), per_block=50)
    rows = out.collect()
    want = collections.Counter()
    for r in docs.collect():
        want[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    got = collections.Counter()
    fill = collections.defaultdict(list)
    for r in rows:
        got[r.doc_id] += r.length
        if r.bin is not None:
            fill[r.block, r.bin, r.capacity, r.used].append((r.offset, r.length))
        else:
            assert r.length == 0
    assert +got == +want and set(got) == set(want)
    for (_, _, capacity, used), pieces in fill.items():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) == used <= capacity and not any(used <= c < capacity for c in (64, 256, 1024))
    assert sum(k[3] for k in fill) > 0.95 * sum(k[2] for k in fill)
    assert packing.pack(spark, none).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffling_depends_on_the_seed(spark, seed):
    docs = spark.range(50).selectExpr("id as doc_id", "'t' as text")
    order = [r.doc_id for r in sharding.shards(spark, docs, "1", 1, seed=seed).orderBy("slot").collect()]
    assert sorted(order) == list(range(50)) and order != list(range(50))
