"""Near-duplicate documents: fingerprints of 64 bits, paired by an inverted index over their bytes.

The fingerprint of a document has the bits that are set in over half the XXH64
values of its word shingles, repeats included. Two fingerprints link if at most
``BITS`` (4) bits differ. These lie in at most 4 of the 8 bytes, so a pair has at
least ``SHARED`` = 8 - 4 equal bytes at equal positions.

Distinct fingerprints are posted by (byte position, byte value). A pair that
reaches the guaranteed minimum stands in four of these lists at once, so the
lists are read as intersections of three, which stay short where single lists
would grow with a 256th of the table: of any four positions some three are among 20 choices
(three groups of positions: triples within a group, or of two from one group and
one from the next). In an intersection the equal bytes of each pair are tallied;
a pair that reaches the minimum is retained in the first of the intersections it
is in, and its differing bits are counted.

An intersection of more than ``CROWDED`` fingerprints, as large groups of near
copies make, is never paired off. Its members are posted under every value
within ``BITS`` / 2 flipped bits instead: two of them differ in 4 bits or fewer
exactly if they share such a value, and all members of one value are linked, so
each is linked to the least of them. That costs 2,081 postings for a
fingerprint, however large its group. A pair of which one side is in no crowded
intersection meets in a short one. No link is lost, and none is made up.

Documents of equal fingerprints are one node, however many they are. Components
of the links are the classes, named by their smallest doc_id. NULL and empty texts
and texts without words have the fingerprint zero and link like any other. Rows
without an id take part, but never name a class; a class of such rows has the name
NULL. Repeated ids are so many rows, each with the fingerprint of its own text;
an id on unequal texts is in several classes. Rows come back as often as given;
an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.components import components
from salespipe.llm.store import written
from salespipe.llm.texts import LOWER, Slice, column, slices

SHINGLE = 5
SEED = 42
BITS = 4
BYTES = 8
SHARED = BYTES - BITS
CROWDED = 1024  # where pairing off 20 lists costs about as much as 2,081 postings, at ten checks of a pair each
CHUNK = 1 << 16  # shingles hashed at a time


def _shingle_bounds(part: Slice, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words joined by single spaces; start, end and document of every shingle."""
    starts, ends, docs = part.words()
    keep = np.zeros(len(part.data) + 1, bool)
    marks = np.zeros(len(part.data) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    keep[:] = np.cumsum(marks) > 0
    followed = np.flatnonzero(docs[:-1] == docs[1:]) if len(docs) else np.zeros(0, np.int64)
    keep[ends[followed]] = True
    data = np.append(LOWER[part.data], np.uint8(0x20))
    data[ends[followed]] = 0x20
    at = np.concatenate(([0], np.cumsum(keep)))
    counts = np.bincount(docs, minlength=part.n)
    firsts = np.concatenate(([0], np.cumsum(counts)))
    made = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    owner = np.repeat(np.arange(part.n), made)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + firsts[owner]
    last = np.minimum(first + size, firsts[owner + 1]) - 1
    return data[keep].tobytes(), at[starts][first], at[ends][last], owner


def fingerprints(part: Slice, size: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each document of the slice."""
    text, starts, ends, owner = _shingle_bounds(part, size)
    set_bits = np.zeros((part.n, 64), np.int64)
    for a in range(0, len(owner), CHUNK):
        own = owner[a : a + CHUNK]
        bounds = zip(starts[a : a + CHUNK].tolist(), ends[a : a + CHUNK].tolist(), strict=True)
        h = np.array([xxhash.xxh64_intdigest(text[x:y], SEED) for x, y in bounds], "<u8")
        # A bit to a byte, eight bytes added as one number: runs of 255 cannot overflow them.
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view("<u8")
        new = np.concatenate(([True], own[1:] != own[:-1]))
        place = np.arange(len(own))
        runs = np.flatnonzero((place - np.maximum.accumulate(np.where(new, place, 0))) % 255 == 0)
        sums = np.add.reduceat(bits, runs, axis=0).view(np.uint8)
        np.add.at(set_bits, own[runs], sums.astype(np.int64))
    counts = np.bincount(owner, minlength=part.n)
    over = 2 * set_bits > counts[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def _sign(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(column(batch, "text")):
                found = fingerprints(part, size).view(np.int64)
                ids = column(batch, "doc_id").slice(part.first, part.n)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found)], ["doc_id", "fingerprint"])

    return sign


_GROUPS = ({0, 1, 2}, {3, 4, 5}, {6, 7})
CHOICES = [
    choice
    for choice in combinations(range(BYTES), SHARED - 1)
    if any(
        len(own & {*choice}) == 3 or (len(own & {*choice}) == 2 and len(_GROUPS[(i + 1) % 3] & {*choice}) == 1)
        for i, own in enumerate(_GROUPS)
    )
]


def _mask(positions: Iterable[int]) -> int:
    """The bytes at these positions, as a signed long."""
    return int.from_bytes(bytes(0xFF * (p in positions) for p in range(BYTES)), "little", signed=True)


def _posted(nodes: DataFrame) -> DataFrame:
    """Every fingerprint under its bytes at each choice of positions."""
    masks = F.array(*[F.lit(_mask(choice)) for choice in CHOICES])
    each = nodes.select("fingerprint", F.posexplode(masks).alias("choice", "mask"))
    return each.select("fingerprint", "choice", F.expr("fingerprint & mask").alias("bytes"))


def _retained(a: str, b: str, choice: str) -> Column:
    """Whether the tally of equal bytes reaches the minimum, this choice is the first to tell, and few bits differ."""
    differing = F.col(a).bitwiseXOR(F.col(b))
    alike = lambda positions: differing.bitwiseAND(F.lit(_mask(positions))) == 0
    tally = sum((F.when(alike([p]), 1).otherwise(0) for p in range(BYTES)), F.lit(0))
    first = F.array_position(F.array(*[alike(positions) for positions in CHOICES]), True)
    return (tally >= SHARED) & (first == F.col(choice) + 1) & (F.bit_count(differing) <= BITS)


def _flipped(fingerprints: DataFrame) -> DataFrame:
    """Every fingerprint under each value within two flipped bits (the place 64 stands for none)."""
    one = fingerprints.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))
    two = one.select("fingerprint", "i", F.explode(F.expr("sequence(least(i + 1, 64), 64)")).alias("j"))
    bit = "if({0} = 64, 0L, shiftleft(1L, {0}))"
    return two.select("fingerprint", F.expr(f"fingerprint ^ {bit.format('i')} ^ {bit.format('j')}").alias("value"))


def links(spark: SparkSession, nodes: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Of distinct fingerprints (long): pairs (u, v) within ``BITS`` bits that join all such pairs into components."""
    lists = _posted(nodes).groupBy("choice", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(spark, _posted(nodes).join(written(spark, lists, "lists"), ["choice", "bytes"]), "met")
    short = met.where(F.col("n") <= crowded).select("fingerprint", "choice", "bytes")
    left, right = (short.withColumnRenamed("fingerprint", name) for name in ("u", "v"))
    pairs = left.join(right, ["choice", "bytes"]).where("u < v").where(_retained("u", "v", "choice")).select("u", "v")
    long = written(spark, met.where(F.col("n") > crowded).select("fingerprint").distinct(), "crowded")
    around = _flipped(long)
    least = around.groupBy("value").agg(F.min("fingerprint").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    near = around.join(written(spark, least.select("value", "v"), "flipped"), "value")
    near = near.select(F.col("fingerprint").alias("u"), "v").where("u <> v").distinct()
    return written(spark, pairs.unionByName(near), "links")


def fingerprint_classes(
    spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, crowded: int = CROWDED
) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    signed = written(spark, texts.mapInArrow(_sign(shingle), "doc_id long, fingerprint long"), "fingerprints")
    nodes = written(spark, signed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(spark, links(spark, nodes.select("fingerprint"), crowded))
    placed = nodes.join(found, nodes.fingerprint == found.node, "left")
    placed = placed.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    placed = written(spark, placed, "placed")
    named = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = written(spark, placed.join(named, "component").select("fingerprint", "component_id"), "classes")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return signed.join(classes, "fingerprint").select("doc_id", digits, "component_id")
