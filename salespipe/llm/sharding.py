"""A uniform shuffle of a table too large for memory, in two passes, and its shards.

The first pass scatters rows into buckets by a seeded hash, so many that each
fits in a task's memory; the second shuffles the rows of every bucket by Fisher
and Yates under the bucket's own seed. Bucket after bucket, the rows form one
uniform permutation; the row at place r goes to shard r mod n, so that shards
differ by one row at most.

The hash covers the whole row, so a hot source or language spreads evenly. Rows
alike in every column would share a bucket; where they are more than ``COPIES``
they are counted, and laid out again with the number of each copy in its
hash. NULL texts count no bytes. The permutation depends on the rows and the seed
alone, not on their order, and is the same if a task runs again. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.llm.store import written

BUCKET_BYTES = 8 << 20
BLOCK = 1 << 12  # buckets whose places are added up together
COPIES = 1000
SEED = 17


def two_pass(
    spark: SparkSession, df: DataFrame, size: str, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Every row of ``df`` as struct ``row`` with its ``place`` in the permutation. ``size``: SQL for the bytes of a row."""
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.expr(size).cast("long").alias("size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    hashed = rows.select("row", F.xxhash64("row", F.lit(seed)).alias("order"))
    crowds = hashed.groupBy("order").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > COPIES)
    crowds = written(spark, crowds.select("order"), "crowds")
    if crowds.isEmpty():
        scattered = hashed
    else:
        scattered = hashed.join(crowds, "order", "left_anti").select("row", "order")
        scattered = scattered.unionByName(_copies(spark, hashed.join(crowds, "order", "left_semi"), seed))
    scattered = scattered.withColumn("bucket", F.pmod(F.xxhash64("order"), F.lit(buckets)))
    starts = _starts(spark, written(spark, scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")), "sizes"))
    schema = T.StructType([rows.schema["row"], T.StructField("place", T.LongType())])

    def shuffle(own: pa.Table) -> pa.Table:
        at = np.argsort(own.column("order").to_numpy(), kind="stable")  # rows arrive in any order
        generator = np.random.Generator(np.random.PCG64([seed, own.column("bucket")[0].as_py()]))
        generator.shuffle(at)  # Fisher and Yates
        place = np.arange(len(at)) + own.column("start")[0].as_py()
        return pa.table([own.column("row").take(pa.array(at)), pa.array(place)], names=["row", "place"])

    # The join and the buckets need the same exchange, the only one of whole rows.
    return scattered.join(starts, "bucket").groupBy("bucket").applyInArrow(shuffle, schema)


def _copies(spark: SparkSession, crowded: DataFrame, seed: int) -> DataFrame:
    """Equal rows summed up to one with a count, and laid out again, a thousand copies to a task's row."""
    counted = crowded.groupBy("order").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("n"))
    runs = counted.select("order", "row", "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")).alias("run"))
    runs = runs.repartition("order", "run")
    copy = F.explode(F.expr(f"sequence(run * {COPIES}, least(run * {COPIES} + {COPIES} - 1, n - 1))")).alias("copy")
    return runs.select("row", "order", copy).select("row", F.xxhash64("order", "copy", F.lit(seed)).alias("order"))


def _starts(spark: SparkSession, sizes: DataFrame) -> DataFrame:
    """The place of the first row of each bucket, by blocks of buckets, so that no task sees them all."""
    sizes = sizes.withColumn("block", F.expr(f"bucket div {BLOCK}"))
    blocks, before = [], 0
    for block, rows in sizes.groupBy("block").agg(F.sum("rows")).orderBy("block").collect():
        blocks.append((block, before))
        before += rows
    within = sizes.withColumn("before", F.expr("sum(rows) over (partition by block order by bucket) - rows"))
    found = within.join(spark.createDataFrame(blocks, "block long, first long"), "block")
    return written(spark, found.select("bucket", (F.col("first") + F.col("before")).alias("start")), "starts")


def shards(
    spark: SparkSession, df: DataFrame, size: str, n_shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All rows with ``shard`` and gapless ``slot``, as written in the shared folder; columns so named are replaced."""
    place = F.col("place")
    out = two_pass(spark, df, size, seed, bucket_bytes).select(
        *[F.col("row").getField(c).alias(c) for c in df.columns if c not in ("shard", "slot")],
        (place % n_shards).cast("int").alias("shard"), F.expr(f"place div {n_shards}").alias("slot"),
    )
    return written(spark, out, "shards")
