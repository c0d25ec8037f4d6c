"""Spelling variants: words one edit apart, each pointed to its commonest neighbour.

Words are runs of letters of all texts, counted over all documents. Two words are
near if one inserted, deleted or replaced code point turns one into the other.

The join is asymmetric. The shorter word (or either of two of equal length)
contributes two disjoint chunks, its halves; the other all positional grams that
can meet one, which are those within one place of a chunk's own: one edit leaves
a chunk intact, where it stands or shifted by one. Gram and place are the key; what
meets is verified by its edit distance.

Chunks shared by very many words ("-tion" in a language full of it) are not paired
off. In such a list the edit lies in the other half, so the words of the list
are split by the same rule again: the rest of the shorter word in two chunks, the rest
of the other in grams. With every step a list shares half as many letters
less, until only one letter is free, when as many words as there are letters share
a list. Every pair of near words meets in some list, whatever the frequency of
its chunks, and no list is paired off that is longer than ``CROWDED`` postings,
but those of the last step.

The form of a word is its commonest near word, if that is at least ``RATIO`` times as
common as itself; its root is the last of its forms, found by doubling the steps.
Counts grow along forms, so there is no circle.

NULL and empty texts have no words; a row without an id counts like any other.
Repeated rows count as often as they are given. Of equally common near words the
first in code point order is the form. An empty table has no words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.store import written
from salespipe.llm.texts import column

LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
CROWDED = 64
HELD = 200_000  # different words a task counts before it passes them on

# The letters are A-Z, a-z and U+00C0 to U+00FF, as in [A-Za-zÀ-ÿ]+, all of Latin-1.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))

Change = Callable[[object, Counter], Counter]


def runs(text: str) -> list[bytes]:
    """The letter runs of a text in Latin-1, A-Z as a-z. A character beyond Latin-1 is no letter, as '?' is none."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def damaged(doc_id: object, found: Counter) -> Counter:
    """One run in 97 of a document, chosen by CRC-32 of id and run, loses the code point that its hash says."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in found.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % 97 == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def _count(change: Change | None, least_length: int):
    def flush(held: Counter) -> pa.RecordBatch:
        kept = {w: n for w, n in held.items() if len(w) >= least_length}
        words = pa.array([w.decode("latin-1") for w in kept], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(kept.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "text"), strict=True):
                found = Counter(runs(text.as_py() or ""))
                held.update(change(doc_id, found) if change else found)
                if len(held) > HELD:
                    yield flush(held)
                    held = Counter()
        yield flush(held)

    return count


def vocabulary(
    spark: SparkSession, docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, change: Change | None = None
) -> DataFrame:
    """(word, n) of all words long and common enough. ``change`` may alter the counts of one document."""
    texts = docs.selectExpr("cast(doc_id as string) doc_id", "cast(text as string) text")
    counted = texts.mapInArrow(_count(change, least_length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(spark, counted.where(F.col("n") >= least_count), "words")


# Where the edit may be: in letters low + 1 .. high of the shorter word, and as much or one more of the other.
_START = {"low": "0", "high": "length(word)"}


def _halved(open_: DataFrame) -> DataFrame:
    """Each posting twice: the edit in the first or in the second half of where it may be, the other half a chunk or gram."""
    mid = "low + (high - low) div 2"
    halves = F.expr(f"array(struct(low, {mid} as high), struct({mid} as low, high))")
    each = open_.withColumn("half", F.explode(halves)).withColumns({"low": F.col("half.low"), "high": F.col("half.high")})
    # What is before and after the open part: chunks of the shorter word, grams of the other at their places.
    before = F.expr("substring(word, 1, low)")
    after = F.expr("substring(word, high + extra + 1, length(word))")
    return each.drop("half").withColumn("key", F.xxhash64("size", "low", "high", before, after))


def near_pairs(spark: SparkSession, words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Pairs (a, b) of distinct words one edit apart, each pair once: a shorter, or first of equally long ones."""
    size = F.length("word")
    same = F.struct(size.alias("size"), F.lit(0).alias("extra"))
    # A word is the shorter or equal one of some pairs and the longer or equal one of others.
    longer = F.struct((size - 1).alias("size"), F.lit(1).alias("extra"))
    posted = words.select("word", F.explode(F.array(same, longer)).alias("as")).select("word", "as.size", "as.extra")
    posted = posted.where("size > 0").withColumns({"low": F.lit(0), "high": F.col("size")})
    found = None
    while True:
        posted = written(spark, _halved(posted), "grams")
        lists = posted.groupBy("size", "low", "high", "key").agg(
            F.count(F.lit(1)).alias("postings"), F.count_if(F.expr("extra = 0")).alias("chunks")
        )
        # Without a chunk, or with one and nothing else, there is no pair.
        lists = written(spark, lists.where("chunks > 0 and postings > 1"), "lists")
        met = posted.join(lists.select("size", "low", "high", "key", "postings"), ["size", "low", "high", "key"])
        met = written(spark, met, "met")
        long = (F.col("postings") > crowded) & F.expr("high - low > 1")
        short = met.where(~long).select("key", "size", "low", "high", "word", "extra")
        chunks = short.where("extra = 0").select("key", "size", "low", "high", F.col("word").alias("a"))
        grams = short.select("key", "size", "low", "high", "extra", F.col("word").alias("b"))
        pairs = chunks.join(grams, ["key", "size", "low", "high"]).where("extra = 1 or a < b")
        pairs = written(spark, pairs.where("levenshtein(a, b, 1) = 1").select("a", "b"), "pairs")
        found = pairs if found is None else found.unionByName(pairs)
        posted = met.where(long).select("word", "size", "extra", "low", "high")
        if posted.isEmpty():
            return found.distinct()


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last of its forms, every step doubling those before."""
    now = written(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = written(spark, moved, "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO, crowded: int = CROWDED) -> DataFrame:
    """Of (word, n): word, form, root, n, n_near, form_n."""
    pairs = written(spark, near_pairs(spark, words, crowded), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = both.join(counts, "other").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left").withColumn("common", F.expr(f"-best.n >= {ratio} * n"))
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("common"), F.col("best.word")).alias("form"), F.when(F.col("common"), -F.col("best.n")).alias("form_n"),
    )
    found = written(spark, found, "forms")
    roots = _roots(spark, found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
