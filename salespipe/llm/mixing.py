"""Mixing sources to target weights by temperature, realised as permuted blocks.

The weight of a source is its share of all tokens to the power of an exponent.
From 1 down to 0 the exponent takes the mix from the natural shares to equal
ones; it is found by bisection, as small as two limits allow: the entropy of
the weights must not pass ``entropy`` times that of equal weights, and no
source may be repeated more than ``repeats`` times as often as the least
repeated one. (A natural mix beyond the entropy asked for is left alone.)

Without a ``budget`` of tokens the mix is as long as it must be for every
document to occur at least once. A source fills its part of the budget with
whole passes over its documents, each in a new random order, and a last one
that ends where its part is full. The passes of all sources are laid out in
blocks of ``BLOCK_TOKENS``, each with every source at its weight, and permuted
within blocks.

A document counts its words and one end mark, so empty texts have a place. Rows
without a source form a source of their own. Repeated rows are rows like any
other. An empty table gives an empty result. Input columns are kept; those
named like a result are replaced. No window spans a source: running sums are
taken over hash ranges of a few thousand rows and put together.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.store import written
from salespipe.llm.texts import counted

ENTROPY = 0.95
REPEATS = 2.0
BLOCK_TOKENS = 1 << 20
RANGE_ROWS = 4096
SEED = 29
PROBES = 16
ROUNDS = 8
RESULT = ("n_tokens", "epoch", "block", "position")


def _entropies(sources: DataFrame, exponents: list[float]) -> list[float]:
    """Entropy of the weights at each exponent; ``sources`` has ``log_p``."""
    sums = []
    for i, a in enumerate(exponents):
        sums += [F.sum(F.exp(F.lit(a) * F.col("log_p"))).alias(f"z{i}"), F.sum(F.exp(F.lit(a) * F.col("log_p")) * F.col("log_p")).alias(f"m{i}")]
    row = sources.agg(*sums).first()
    return [math.log(row[f"z{i}"]) - a * row[f"m{i}"] / row[f"z{i}"] for i, a in enumerate(exponents)]


def exponent(sources: DataFrame, entropy: float, repeats: float) -> float:
    """The least exponent from 0 to 1 within both limits, from a table of sources with ``log_p``."""
    number, high, low = sources.agg(F.count(F.lit(1)), F.max("log_p"), F.min("log_p")).first()
    if number < 2 or high - low < 1e-12:
        return 1.0
    by_repeats = max(0.0, 1 - math.log(max(1.0, repeats)) / (high - low))
    most = entropy * math.log(number)
    a, b = 0.0, 1.0
    if _entropies(sources, [a])[0] > most:
        # Entropy falls with the exponent; each round halves the bracket as often as its probes allow.
        for _ in range(ROUNDS):
            probes = [a + (b - a) * i / PROBES for i in range(PROBES + 1)]
            above = [p for p, h in zip(probes, _entropies(sources, probes), strict=True) if h > most]
            a = max(above, default=a)
            b = min((p for p in probes if p > a), default=b)
        a = b
    return min(1.0, max(a, by_repeats))


def weigh(spark: SparkSession, rows: DataFrame, entropy: float, repeats: float, budget: int | None) -> DataFrame:
    """Per source: its tokens, weight, and quota of the budget. ``rows`` has ``_source`` and ``n_tokens``."""
    sources = rows.groupBy("_source").agg(F.sum("n_tokens").alias("tokens"))
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    sources = written(spark, sources.withColumn("log_p", F.log(F.col("tokens") / F.lit(float(max(1, total))))), "sources")
    if not total:
        return sources.withColumn("weight", F.lit(0.0)).withColumn("quota", F.lit(0.0))
    power = exponent(sources, entropy, repeats)
    z = sources.agg(F.sum(F.exp(power * F.col("log_p")))).first()[0]
    weighed = sources.withColumn("weight", F.exp(power * F.col("log_p")) / z)
    # The least budget that holds every source once.
    length = float(budget) if budget is not None else weighed.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
    quota = F.col("weight") * F.lit(length)
    # Rounding must not cut the last row of a pass that just fits.
    whole = F.round(quota / F.col("tokens"))
    near = F.abs(quota / F.col("tokens") - whole) < 1e-9
    return weighed.withColumn("quota", F.when(near, whole * F.col("tokens")).otherwise(quota))


def mix(
    spark: SparkSession, docs: DataFrame, source: str = "source", entropy: float = ENTROPY, repeats: float = REPEATS,
    budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
) -> DataFrame:
    """The rows of the mix with ``n_tokens``, ``epoch`` (pass), ``block`` and ``position`` in the block."""
    kept = [c for c in docs.columns if c not in RESULT]
    rows = counted(docs.select(F.struct(*kept).alias("_row"), F.col("text").cast("string").alias("text")), "n_words").drop("text")
    rows = rows.select(
        "_row", F.col("_row").getField(source).cast("string").alias("_source"), (F.col("n_words") + 1).alias("n_tokens"),
        F.monotonically_increasing_id().alias("_number"),
    )
    rows = written(spark, rows, "rows")
    narrow = rows.select("_source", "n_tokens", "_number")
    sources = written(spark, weigh(spark, narrow, entropy, repeats, budget), "weights")
    ranges = max(1, narrow.count() // RANGE_ROWS)
    passes = narrow.join(
        sources.select(F.col("_source").alias("_s"), "tokens", "weight", "quota"), F.col("_source").eqNullSafe(F.col("_s"))
    ).drop("_s")
    passes = passes.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.floor(F.col("quota") / F.col("tokens")).cast("int"))))
    passes = passes.withColumn("_order", F.xxhash64("_number", "epoch", F.lit(seed)))
    passes = passes.withColumn("_range", F.pmod(F.shiftright("_order", 16), F.lit(ranges)))
    ends = passes.groupBy("_source", "epoch", "_range").agg(F.sum("n_tokens").alias("in_range"))
    before = F.expr("sum(in_range) over (partition by _source, epoch order by _range) - in_range")
    starts = written(
        spark, ends.select(F.col("_source").alias("_s"), F.col("epoch").alias("_e"), F.col("_range").alias("_r"), before.alias("start")), "starts"
    )
    at_range = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("epoch") == F.col("_e")) & (F.col("_range") == F.col("_r"))
    placed = passes.join(starts, at_range).drop("_s", "_e", "_r")
    within = F.expr("sum(n_tokens) over (partition by _source, epoch, _range order by _order, _number rows unbounded preceding)")
    placed = placed.withColumn("reached", F.col("start") + within + F.col("epoch") * F.col("tokens"))
    placed = placed.where("reached <= quota + 1e-6")
    block = F.floor((F.col("reached") - F.col("n_tokens")) / (F.col("weight") * block_tokens)).cast("long")
    placed = placed.select("_number", "epoch", block.alias("block"), F.xxhash64("_order", F.lit(seed + 1)).alias("_shuffle"))
    position = F.expr("cast(row_number() over (partition by block order by _shuffle, _number, epoch) - 1 as long)")
    placed = written(spark, placed.withColumn("position", position).drop("_shuffle"), "placed")
    return rows.join(placed, "_number").select(
        *[F.col("_row").getField(c).alias(c) for c in kept], "n_tokens", "epoch", "block", "position"
    )
