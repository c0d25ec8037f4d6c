"""The prefix trie of conversations: which openings are shared, by whom, and what sharing saves.

Each turn (role and text) has an id of 16 bytes, so a conversation is a byte
string of fixed-width ids, and the openings of ``n`` turns are its prefixes of
``16 n`` bytes. Tasks put the strings of their range of the sorted table into an
adaptive radix tree: inner nodes grow through layouts of 4, 16, 48 and 256
children, and bytes without a branch are kept together as one path. Only byte
depths that are whole turns come out as nodes, with their numbers of members. Trees are
cut off at ``TREE_BYTES``; their nodes are named by a hash of the whole opening, and an
aggregate by that name puts the trees together, so a hot opening is spread over
as many tasks as its rows fill.

Long conversations are cut into segments of ``SEGMENT`` turns. The key of a
segment starts with the name of the opening before it, so the tree of a later
segment hangs below the right node, and no task holds a long conversation whole.

Sums over a subtree need no walk up the trie. A node belongs to its smallest member;
what a conversation owns is always the rest of its path from some depth on. So
the sum over a subtree is the part of its owner's nodes from there on, and all
that its other members own: a second run of the same trees adds that up, with
what each conversation owns as its weight, over the shared openings only.

Turns are ordered by ``turn``, NULL first, equal ones by role (40 characters) and turn id; rows that
repeat are turns of their own. A NULL role or text is empty. Rows without a
conv_id are left out. Texts of any length take 16 bytes from the first step on. An
empty table has no nodes, not even a root. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salespipe.llm.store import written
from salespipe.llm.texts import column

WIDTH = 16  # bytes of a turn id and of the name of an opening
SEGMENT = 64
TREE_BYTES = 4 << 20
ENDS = 1000  # conversation ids joined to one text
LAYOUTS = (4, 16, 48, 256)
ROOT = bytes(WIDTH)
RESULT = (
    "conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)


# ---------------------------------------------------------------- radix tree


class Children:
    """Child nodes by byte, in the smallest layout that holds them."""

    __slots__ = ("layout", "keys", "nodes")

    def __init__(self) -> None:
        self.layout, self.keys, self.nodes = LAYOUTS[0], bytearray(), []

    def get(self, byte: int) -> Node | None:
        if self.layout == 256:
            return self.nodes[byte]
        at = self.keys[byte] if self.layout == 48 else self.keys.find(byte)
        # Layout 48: place 255 of the index stands for none.
        return None if at in (-1, 255) else self.nodes[at]

    def __len__(self) -> int:
        return len(self.nodes) - self.nodes.count(None) if self.layout == 256 else len(self.nodes)

    def add(self, byte: int, node: Node) -> None:
        if len(self) == self.layout:
            self._grow()
        if self.layout == 256:
            self.nodes[byte] = node
        elif self.layout == 48:
            self.keys[byte] = len(self.nodes)
            self.nodes.append(node)
        else:
            self.keys.append(byte)
            self.nodes.append(node)

    def replace(self, byte: int, node: Node) -> None:
        at = byte if self.layout == 256 else self.keys[byte] if self.layout == 48 else self.keys.find(byte)
        self.nodes[at] = node

    def _grow(self) -> None:
        self.layout = LAYOUTS[LAYOUTS.index(self.layout) + 1]
        if self.layout == 48:
            index = bytearray(b"\xff" * 256)
            for at, byte in enumerate(self.keys):
                index[byte] = at
            self.keys = index
        elif self.layout == 256:
            slots: list[Node | None] = [None] * 256
            for byte, at in enumerate(self.keys):
                if at != 255:
                    slots[byte] = self.nodes[at]
            self.keys, self.nodes = bytearray(), slots

    def __iter__(self) -> Iterator[Node]:
        return (node for node in self.nodes if node is not None)


class Node:
    """The bytes of its path after the branching byte, the rows that end here, and sums over the subtree."""

    __slots__ = ("path", "children", "rows", "total")

    def __init__(self, path: bytes) -> None:
        self.path, self.children, self.rows, self.total = path, Children(), [], None


def _shared(a: bytes, b: bytes, at: int) -> int:
    """How many first bytes of ``a`` are in ``b`` from ``at`` on."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at : at + n]:
        return n
    low, high = 0, n  # the first ``low`` agree, the first ``high`` do not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid
    return low


class Tree:
    """An adaptive radix tree of byte strings; a string may be the prefix of another."""

    def __init__(self) -> None:
        self.root, self.size = Node(b""), 0

    def insert(self, key: bytes, row: tuple) -> None:
        self.size += len(key)
        node, above, at = self.root, None, 0
        while True:
            same = _shared(node.path, key, at)
            if same < len(node.path):
                top = Node(node.path[:same])
                if above is None:
                    self.root = top
                else:
                    above.children.replace(key[at - 1], top)
                top.children.add(node.path[same], node)
                node.path = node.path[same + 1 :]
                node = top
            at += same
            if at == len(key):
                node.rows.append(row)
                return
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at + 1 :])
                child.rows.append(row)
                node.children.add(key[at], child)
                return
            node, above, at = child, node, at + 1

    def aligned(self, width: int) -> Iterator[tuple[int, tuple]]:
        """(depth in units of ``width`` bytes, sums) of every aligned depth below the first unit."""
        order, stack = [], [(self.root, 0)]
        while stack:
            node, start = stack.pop()
            order.append((node, start))
            end = start + len(node.path)
            stack.extend((child, end + 1) for child in node.children)
        for node, start in reversed(order):
            below = [row for row in node.rows] + [child.total for child in node.children]
            least = min(below, key=lambda t: t[0])
            node.total = (least[0], sum(t[1] for t in below), sum(t[2] for t in below), sum(t[3] for t in below), least[4])
            # The branching byte and the path of a node are byte depths start .. end.
            first, end = max(2, -(-start // width)), start + len(node.path)
            for depth in range(first, end // width + 1):
                yield depth, node.total


# --------------------------------------------------------------- Spark steps

NODE = (
    "node binary, parent binary, turn_id binary, depth long, n_convs long, least long, n_bytes long, "
    "saved long, leaves long"
)


def _emit(tree: Tree) -> Iterator[tuple]:
    for depth, (least, n, saved, leaves, (first, anchor, turns)) in tree.aligned(WIDTH):
        at = depth - 2
        one = two = 0
        named = [anchor]
        # Names of the openings along the least member's turns, made once for each of its rows.
        if isinstance(turns[0], tuple):
            for _, size, x, y in turns:
                one, two = one ^ x, two ^ y
                base = int.from_bytes(anchor, "big") ^ ((one % 2**64) << 64 | two % 2**64)
                named.append(base.to_bytes(WIDTH, "big"))
            turns[:] = [named, [t[1] for t in turns], [t[0] for t in turns]]
        names, sizes, ids = turns
        yield names[at + 1], names[at], ids[at], first + at + 1, n, least, sizes[at], saved, leaves


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in NODE.split(", ")]
    kinds = {"binary": pa.binary(), "long": pa.int64()}
    types = [kinds[field.split()[1]] for field in NODE.split(", ")]
    for at in range(0, len(rows), 10_000):
        columns = zip(*rows[at : at + 10_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _grown(tree_bytes: int):
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree()
        for batch in batches:
            names = ("conv_id", "first", "key", "turns", "saved", "leaves")
            for conv, first, key, turns, saved, leaves in zip(*(column(batch, n).to_pylist() for n in names), strict=True):
                own = [(t["turn_id"], t["n_bytes"], t["x"], t["y"]) for t in turns]
                tree.insert(key, (conv, 1, saved, leaves, (first, key[:WIDTH], own)))
                if tree.size > tree_bytes:
                    yield from _batches(list(_emit(tree)))
                    tree = Tree()
        yield from _batches(list(_emit(tree)) if tree.size else [])

    return grow


def _joined_trees(keyed: DataFrame, tree_bytes: int) -> DataFrame:
    """Every opening once, from the trees of all tasks. ``first``: how many turns are before the key's."""
    ordered = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key")
    return ordered.mapInArrow(_grown(tree_bytes), NODE).groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("turn_id").alias("turn_id"), F.min("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.min("least").alias("least"), F.min("n_bytes").alias("n_bytes"),
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"),
    )


def turn_ids(conversations: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, role, text, the turn's id and its text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.unhex(F.md5(named)).alias("turn_id"), F.octet_length(text).cast("long").alias("n_bytes"),
    )


def numbered(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, n_bytes): places from 1 in each conversation.

    Sorted ranges are numbered inside and shifted, so a conversation of any length is spread over tasks.
    """
    rows = turn_ids(conversations).where("conv_id is not null").drop("text")
    rows = rows.withColumn("role", F.substring("role", 1, 40)).withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("turn_id"), F.col("copy")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The borders of the ranges come from a sample; the written table pins them.
    at = F.monotonically_increasing_id().alias("at")
    placed = written(spark, placed.select("conv_id", "turn_id", "n_bytes", at), "placed")
    ranged = placed.withColumn("range", F.shiftright("at", 33))
    parts = ranged.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    found = ranged.join(written(spark, parts, "ranges"), ["conv_id", "range"])
    place = F.expr("before + at - first + 1").alias("place")
    return written(spark, found.select("conv_id", place, "turn_id", "n_bytes"), "turns")


def reopened(spark: SparkSession, turns: DataFrame, family: int = 5, remainder: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations with the opening of the first of their family in place of their own.

    Of conversation c the first h turns (h = crc32(c) % ``remainder``) become those of
    conversation c - c % ``family``: all it has if fewer, none if it is absent. Returns the turns and
    (conv_id, length) of all conversations.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % remainder)
    convs = written(spark, convs.withColumn("first_id", F.expr(f"conv_id - conv_id % {family}")), "conversations")
    heads = convs.select(F.col("conv_id").alias("first_id"), F.col("n").alias("n_first"))
    convs = convs.join(heads, "first_id", "left").withColumn("taken", F.least("h", F.coalesce("n_first", F.lit(0))))
    convs = written(spark, convs.withColumn("length", F.expr("taken + greatest(n - h, 0)")), "openings")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place > h")
    own = own.withColumn("place", F.expr("taken + place - h"))
    given = turns.where(F.col("place") < remainder).withColumnRenamed("conv_id", "first_id")
    given = given.join(convs.select("conv_id", "first_id", "h"), "first_id").where("place <= h")
    names = ["conv_id", "place", "turn_id", "n_bytes"]
    return own.select(*names).unionByName(given.select(*names)), convs.select("conv_id", "length")


def _segments(spark: SparkSession, turns: DataFrame, segment: int) -> DataFrame:
    """Each conversation's turns in runs of ``segment``, under the name of the opening before the run."""
    x, y = (F.xxhash64("turn_id", "place", F.lit(seed)).alias(n) for n, seed in (("x", 1), ("y", 2)))
    rows = turns.withColumn("segment", F.expr(f"(place - 1) div {segment}")).withColumns({"x": x, "y": y})
    rows = rows.groupBy("conv_id", "segment").agg(
        F.array_sort(F.collect_list(F.struct("place", "turn_id", "n_bytes", "x", "y"))).alias("turns"),
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
    )
    rows = written(spark, rows, "segments")
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations of several segments have anything before one.
    later = rows.where("segment > 0").select("conv_id").distinct()
    slim = rows.select("conv_id", "segment", "x", "y").join(later, "conv_id", "left_semi")
    slim = slim.select("conv_id", "segment", *(F.bit_xor(c).over(before).alias(f"{c}_before") for c in ("x", "y")))
    rows = rows.join(written(spark, slim.where("segment > 0"), "anchors"), ["conv_id", "segment"], "left")
    anchor = _name(F.coalesce("x_before", F.lit(0)), F.coalesce("y_before", F.lit(0)))
    ids = F.array_join(F.transform("turns", lambda t: F.hex(t["turn_id"])), "")
    key = F.concat(anchor, F.unhex(ids)).alias("key")
    return written(spark, rows.select("conv_id", "segment", "turns", key, "x", "y"), "keys")


def _name(x: Column | str, y: Column | str) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(x), 16, "0"), F.lpad(F.hex(y), 16, "0")))


def _ends(segments: DataFrame, convs: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the openings at which conversations end.

    A thousand ids become one text first; SHA-256 reads these in order, one batch in memory at a time.
    """
    last = segments.groupBy("conv_id").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    at = convs.join(last, "conv_id", "left").select("conv_id", _name(F.coalesce("x", F.lit(0)), F.coalesce("y", F.lit(0))).alias("node"))
    run = F.expr(f"conv_id div {ENDS} - if(conv_id % {ENDS} < 0, 1, 0)").alias("run")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    runs = at.groupBy("node", run).agg(listed.alias("ids"))
    ordered = runs.repartition("node").sortWithinPartitions("node", "run").select("node", "ids")
    return ordered.mapInArrow(_digests, "node binary, ends_sha256 string")


def _digested(done: list[tuple]) -> pa.RecordBatch:
    nodes, digests = pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())
    return pa.RecordBatch.from_arrays([nodes, digests], ["node", "ends_sha256"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest = None, None
    for batch in batches:
        done = []
        for node, ids in zip(column(batch, "node").to_pylist(), column(batch, "ids").to_pylist(), strict=True):
            if node == now:
                digest.update(b",")
            else:
                if now is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = node, hashlib.sha256()
            digest.update(ids.encode())
        yield _digested(done)
    yield _digested([(now, digest.hexdigest())] if now is not None else [])


def _from_here_on(nodes: DataFrame, segment: int) -> DataFrame:
    """Adds ``rest``: the sum of ``saving`` over the owner's nodes of this depth and deeper, by segments."""
    nodes = nodes.withColumn("segment", F.expr(f"(depth - 1) div {segment}"))
    sums = nodes.groupBy("least", "segment").agg(F.sum("saving").alias("s"))
    after = Window.partitionBy("least").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("least", "segment", F.coalesce(F.sum("s").over(after), F.lit(0)).alias("after"))
    within = Window.partitionBy("least", "segment").orderBy(F.desc("depth"))
    nodes = nodes.withColumn("within", F.sum("saving").over(within)).join(sums, ["least", "segment"])
    return nodes.withColumn("rest", F.expr("within + after")).drop("segment", "within", "after")


def trie(
    spark: SparkSession, turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, tree_bytes: int = TREE_BYTES
) -> DataFrame:
    """The nodes of the prefix trie of (conv_id, place, turn_id, n_bytes), places gapless from 1.

    ``convs`` (conv_id) names all members, turnless ones too. Columns: node and parent (names of openings),
    turn_id of the last turn, depth, conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    segments = _segments(spark, turns, segment)
    first = F.expr(f"segment * {segment}").alias("first")
    none = F.lit(0).cast("long")
    weightless = segments.select("conv_id", first, "key", "turns", none.alias("saved"), none.alias("leaves"))
    nodes = written(spark, _joined_trees(weightless, tree_bytes).drop("saved", "leaves"), "nodes")
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(spark, nodes.withColumn("saving", F.expr("(n_convs - 1) * n_bytes")), "counted")
    owned = nodes.groupBy(F.col("least").alias("conv_id")).agg(
        F.sum("saving").alias("saved"), F.count_if(F.expr("n_children = 0")).alias("leaves"),
        # What it shares of its path: all before what it owns, and of that what has other members.
        F.coalesce(F.max(F.expr("if(n_convs > 1, depth, null)")), F.min("depth") - 1).alias("shared"),
    )
    owned = written(spark, owned, "owned")
    # A conversation that owns nothing shares all its turns.
    turns_shared = F.expr(f"coalesce(least(shared - segment * {segment}, {segment}), {segment})")
    weighted = segments.join(owned, "conv_id", "left").withColumn("turns_shared", turns_shared).where("turns_shared > 0")
    weighted = weighted.select(
        "conv_id", first, F.expr(f"substring(key, 1, cast({WIDTH} * (1 + turns_shared) as int))").alias("key"), "turns",
        F.coalesce("saved", none).alias("saved"), F.coalesce("leaves", none).alias("leaves"),
    )
    sums = _joined_trees(weighted, tree_bytes).select("node", F.col("saved").alias("members_own"), "leaves")
    nodes = _from_here_on(nodes, segment)
    return _finished(spark, nodes, owned, written(spark, sums, "sums"), _ends(segments, convs), convs)


def _finished(
    spark: SparkSession, nodes: DataFrame, owned: DataFrame, sums: DataFrame, ends: DataFrame, convs: DataFrame
) -> DataFrame:
    every = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    if not every["n"]:
        return spark.createDataFrame([], "node binary, parent binary, turn_id binary, depth long, " + RESULT)
    total = owned.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).first()
    own = owned.select(F.col("conv_id").alias("least"), F.col("saved").alias("owner_own"))
    found = nodes.join(own, "least").join(sums, "node", "left")
    only = F.col("n_convs") == 1
    found = found.select(
        "node", "parent", "turn_id", "depth", F.col("least").alias("conv_id"), "n_convs", "n_children",
        F.when(only, F.lit(1)).otherwise(F.col("leaves")).alias("n_leaves"),
        F.when(only, F.col("rest")).otherwise(F.expr("rest + members_own - owner_own")).alias("saved_tokens"),
    )
    # The root stands above all: its children need no join to find their parent's member.
    above = nodes.select(F.col("node").alias("parent"), F.col("least").alias("parent_conv_id"))
    deep = found.where("depth > 1").join(above, "parent")
    first = found.where("depth = 1").withColumn("parent_conv_id", F.lit(every["least"]).cast("long"))
    n_children = nodes.where("depth = 1").count()
    root = spark.createDataFrame(
        [(bytearray(ROOT), None, None, 0, every["least"], every["n"], n_children, total["leaves"] or 1, total["saved"] or 0, None)],
        "node binary, parent binary, turn_id binary, depth long, conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, parent_conv_id long",
    )
    whole = deep.unionByName(first).unionByName(root).join(ends, "node", "left")
    none = hashlib.sha256(b"").hexdigest()
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))).select(
        "node", "parent", "turn_id", "depth", *[c.split()[0] for c in RESULT.split(", ")]
    )


def prefix_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of (conv_id, turn, role, text) as it stands."""
    turns = numbered(spark, conversations)
    return trie(spark, turns, turns.select("conv_id").distinct())
