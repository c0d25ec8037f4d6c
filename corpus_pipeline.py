"""From raw documents to packed training sequences, stage by stage.

Rows of any stage may hold NULLs, empty texts and further columns; an empty
table passes through as an empty one. What each operator does with such rows
stands in its module.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm import minhash, mixing, packing, suffixes, toxicity
from salespipe.llm.store import small_batches, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


@stage
def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the labelled examples nearest to them do not speak against."""
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


@stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates; rows that repeat both id and text are one document.

    Rows go by id and text, so an id on several texts loses none that copies nothing.
    """
    found = minhash.document_classes(spark, docs)
    own = "component_id = doc_id and keeper_hash = text_hash"
    gone = found.where(f"component_id is not null and not ({own})").select("doc_id", "text_hash").distinct()
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = docs.withColumn("_key", key)
    # Only rows of a key that repeats are compared whole.
    repeated = docs.groupBy(key.alias("_again")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_again")
    repeated = written(spark, repeated, "repeated")
    again = F.col("_key") == F.col("_again")
    once = rows.join(repeated, again, "left_anti").drop("_key")
    single = rows.join(repeated, again, "left_semi").drop("_key").dropDuplicates(["doc_id", "text"])
    gone = written(spark, gone, "near-duplicates").withColumnsRenamed({"doc_id": "_id", "text_hash": "_gone"})
    # What goes grows with the documents, so it is never broadcast.
    hashed = once.unionByName(single).withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_hash") == F.col("_gone"))
    return hashed.join(gone.hint("merge"), same, "left_anti").select(*docs.columns)


@stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without passages of an earlier document; a text of which nothing but space is left goes."""
    found = suffixes.remove_repeats(spark, docs.withColumnsRenamed({"n_chars": "_n_chars"}), characters=True)
    text = F.decode("kept", "UTF-8")
    emptied = (F.col("n_removed") > 0) & (F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     ")) == "")
    changed = found.where(~emptied).withColumn("text", text)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("_n_chars"))
    return changed.withColumn("n_chars", n_chars).select(*docs.columns)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources more often."""
    return mixing.mix(spark, docs).select(*docs.columns)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which sequence."""
    return packing.pack(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("near-duplicates", one_of_each_group),
    ("repeated-passages", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

# Learned models decide the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = written(spark, apply(spark, docs, sf_dir), f"stage-{name}")
    return docs
