"""Packing documents into training sequences of several permitted lengths.

Documents are cut into pieces no longer than the largest sequence. Pieces are
dealt to blocks of bounded size; in each, longest first, a piece goes to the
open bin it fills best. Where none has room a bin is opened. Its size is chosen
jointly for the piece and what is left of the block: of the sizes that hold the
piece, the one that costs least for each token it would hold, filled up from the
lengths that remain. A bin costs its size, a fixed ``OVERHEAD``, and a share that
grows with its square, as attention does: ``size * size / ATTENTION``. With these
costs a bin of 1,024 full tokens is the cheapest, a longer one pays where
long pieces need it, a shorter one where little is left. In the end each
bin is changed for the smallest size that holds its contents.

Lengths are words. Every word is packed once. A document without words (NULL
and empty texts) gives one row of length 0 without a bin. Repeated rows are
packed as often as they occur; equal lengths go in order of ids. An empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.store import written
from salespipe.llm.texts import counted

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16
ATTENTION = 1 << 16
PIECES_PER_BLOCK = 1 << 13


def bin_cost(size: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    return size + overhead + size * size / attention


def _filled(room: int, lengths: int, counts: list[int]) -> int:
    """How much of a room the remaining lengths fill, the longest that fits first. Bit l of ``lengths``: some are of length l."""
    filled = 0
    while room and (fitting := lengths & ((1 << (room + 1)) - 1)):
        length = fitting.bit_length() - 1
        n = min(counts[length], room // length)
        filled += n * length
        room -= n * length
        lengths ^= 1 << length
    return filled


def best_fit(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION
) -> tuple[list[int], list[int]]:
    """The bin of each piece, taken in the order given, and the final size of each bin."""
    sizes = sorted(capacities)
    counts = [0] * (sizes[-1] + 1)  # pieces not yet packed, by length
    for length in lengths:
        counts[length] += 1
    remaining = sum(1 << length for length, n in enumerate(counts) if n)
    room: list[int] = []
    opened: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room for exactly r
    bins = []
    for length in lengths:
        counts[length] -= 1
        if not counts[length]:
            remaining ^= 1 << length
        fitting = rooms >> length
        if fitting:
            r = length + (fitting & -fitting).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms ^= 1 << r
        else:
            held = {c: length + _filled(c - length, remaining, counts) for c in sizes if c >= length}
            size = min(held, key=lambda c: (bin_cost(c, overhead, attention) / held[c], c))
            b, r = len(room), size
            room.append(size)
            opened.append(size)
        room[b] = r - length
        by_room.setdefault(room[b], []).append(b)
        rooms |= 1 << room[b]
        bins.append(b)
    used = [c - r for c, r in zip(opened, room, strict=True)]
    return bins, [next(c for c in sizes if c >= u) for u in used]


def _pack_block(capacities: Sequence[int], overhead: int, attention: int):
    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("row", "ascending"), ("piece", "ascending")])
        lengths = rows.column("length").to_numpy()
        bins, sizes = best_fit(lengths.tolist(), capacities, overhead, attention)
        bins = np.array(bins, np.int64)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        heads = np.searchsorted(bins[order], np.arange(len(sizes)))
        offset = np.empty(len(bins), np.int64)
        offset[order] = before - before[heads][bins[order]]
        used = np.bincount(bins, lengths, len(sizes)).astype(np.int64)
        return pa.table({
            "doc_id": rows.column("doc_id"), "piece": rows.column("piece"), "start": rows.column("start"), "length": lengths,
            "block": rows.column("block"), "bin": bins, "capacity": np.array(sizes, np.int64)[bins], "used": used[bins],
            "offset": offset,
        })

    return pack


_RESULT = "doc_id long, piece long, start long, length long, block long, bin long, capacity long, used long, offset long"


def pack(
    spark: SparkSession, docs: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD,
    per_block: int = PIECES_PER_BLOCK, attention: int = ATTENTION,
) -> DataFrame:
    """One row per piece: which words of which document lie where in which bin of which block."""
    largest = max(capacities)
    counts = counted(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), "n_words").select("doc_id", "n_words")
    # Rows are numbered as they are written; the number tells repeated rows apart.
    counts = written(spark, counts.withColumn("row", F.monotonically_increasing_id()), "lengths")
    pieces = counts.where("n_words > 0").select(
        "doc_id", "row", F.posexplode(F.expr(f"sequence(0L, n_words - 1, {largest}L)")).alias("piece", "start"), "n_words"
    )
    pieces = pieces.select(
        "doc_id", "row", F.col("piece").cast("long").alias("piece"), "start", F.expr(f"least({largest}, n_words - start)").alias("length")
    )
    blocks = max(1, -(-pieces.count() // per_block))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)))
    packed = dealt.groupBy("block").applyInArrow(_pack_block(tuple(capacities), overhead, attention), _RESULT)
    none = F.lit(None).cast("long")
    empty = counts.where("n_words = 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length"),
        *[none.alias(c) for c in ("block", "bin", "capacity", "used", "offset")],
    )
    return packed.unionByName(empty)
