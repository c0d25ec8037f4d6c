"""Repeated passages across documents, from merged Burrows-Wheeler transforms.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller id is removed; matches never cross documents, and
strings are judged on the input. The work is cut up by content, so that equal
strings meet and nothing else has to:

1. Texts are packed into slices of some megabytes, written once. In each string
   of ``LENGTH`` bytes the gram of ``GRAM`` bytes with the least hash is its
   anchor; consecutive strings with one anchor form a segment. Equal strings
   have equal anchors. An anchor that occurs in one document only cannot belong
   to a repeat; slices send the anchors they hold to their buckets, which answer
   which are shared.
2. Slices send their distinct segments with shared anchors, with the least
   document of each, to the anchors' buckets; the slices of a task send together,
   some megabytes of text at a time, so that messages stay long however many
   buckets there are. There the segments are dealt to
   shards, each shard gets the transform of its rotations (sorted once, alone),
   and the transforms are merged by refining their interleave: every round
   reads the symbols before each rotation in the order so far and deals the
   interleave out anew, stably, by symbol. A symbol is a gram of up to eight
   bytes, so seven rounds compare ``LENGTH`` bytes; borders between unlike
   prefixes are refined in the same rounds. Intervals without a border are the
   repeated strings, and the least document in each goes back to the slices.
3. Slices mark the bytes and cut them out.

Slices lie in files dealt by their number, so that answers and marks come to them
and the texts are moved once. Segments are on disk once, as files of their shuffle,
and what a step has shuffled goes with its end.

A passage copied a billion times is sent once by each slice. An anchor that
more than ``HOT`` slices hold is split: its strings go to buckets by their own
hash, one by one.

NULL texts are empty. Rows without an id are returned whole. Rows that repeat an
id count as one document's. Texts shorter than ``LENGTH`` bytes are returned
whole; an empty table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespipe.llm.store import shuffles_dropped, written, written_by
from salespipe.llm.texts import Slice, column, mix, rolling, slices

LENGTH = 50
GRAM = 20
HOT = 4096
SHARDS = 2
PACK_BYTES = 1 << 20
BUCKET_BYTES = 12 << 20
SEND_BYTES = 16 << 20  # of slices whose segments are sent together
MERGE_BYTES = 1 << 16  # of segments merged at a time, about what a processor keeps at hand
SYMBOL = 8

RESULT = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))),
    T.StructField("kept", T.BinaryType()),
])
_LAST = np.iinfo(np.int64).max


# -- slices ---------------------------------------------------------------------------------------------------------


def _squeeze(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def _expand(data: pa.Scalar, dtype, size: int) -> np.ndarray:
    raw = pa.decompress(data.as_buffer(), size * np.dtype(dtype).itemsize, codec="zstd")
    return np.frombuffer(raw, dtype, size)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for part in slices(column(batch, "text"), PACK_BYTES):
            own = batch.slice(part.first, part.n)
            ids = column(own, "doc_id").cast(pa.int64())
            known = np.array(ids.is_valid())
            rest = pa.BufferOutputStream()
            with pa.ipc.new_stream(rest, own.schema.remove(own.schema.get_field_index("text"))) as out:
                out.write_batch(own.drop_columns(["text"]))
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([(task << 32) + number]), "docs": pa.array([part.n]), "bytes": pa.array([len(part.data)]),
                "ids": [_squeeze(np.array(ids.fill_null(_LAST)))], "known": [_squeeze(known)],
                "lengths": [_squeeze(np.diff(part.at))], "text": [_squeeze(part.data)],
                "rest": [rest.getvalue().to_pybytes()],
            })
            number += 1


_PACKED = "slice long, docs long, bytes long, ids binary, known binary, lengths binary, text binary, rest binary"


class Packed:
    """One slice: its ids and texts."""

    def __init__(self, row: dict[str, pa.Scalar], length: int) -> None:
        n, size = row["docs"].as_py(), row["bytes"].as_py()
        self.slice, self.length = row["slice"].as_py(), length
        self.ids, self.known = _expand(row["ids"], np.int64, n), _expand(row["known"], bool, n)
        at = np.concatenate(([0], np.cumsum(_expand(row["lengths"], np.int64, n))))
        self.text = Slice(0, _expand(row["text"], np.uint8, size), at)


class Segments:
    """The segments of a slice: start, number of strings, document, and the anchor's hash."""

    def __init__(self, packed: Packed) -> None:
        found, first, at, n = [], 0, packed.text.at, packed.text.n
        while first < n:
            # Short runs of documents keep the arrays of each step in the processor's cache.
            last = max(first + 1, int(np.searchsorted(at, at[first] + (1 << 17), "right")) - 1)
            found.append(_segments(packed, first, last))
            first = last
        self.start, self.strings, self.doc, self.anchor = (np.concatenate(x) for x in zip(*found, strict=True))


def _segments(packed: Packed, first: int, last: int) -> tuple[np.ndarray, ...]:
    length, gram = packed.length, min(GRAM, packed.length)
    base = packed.text.at[first]
    data, at = packed.text.data[base : packed.text.at[last]], packed.text.at[first : last + 1] - base
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total, inverse = rolling(data)
    hashed = (total[gram:] - total[:-gram]) * inverse[: len(data) - gram + 1]
    # Hash above, place below: the least is the leftmost of equal grams.
    least = (hashed & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashed), dtype=np.uint64)
    reach, width = 1, length - gram + 1
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    new = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    owned = np.flatnonzero((np.diff(at) >= length) & packed.known[first:last])
    new[at[owned]] = True
    heads = np.flatnonzero(new)
    doc = np.searchsorted(at, heads, "right") - 1
    end = at[doc + 1] - length + 1  # of the starts of strings inside the document
    inside = (heads < end) & packed.known[first:last][doc]
    strings = np.minimum(np.append(heads[1:], len(least)), end) - heads
    heads, strings, doc = heads[inside], strings[inside], doc[inside]
    anchor = hashed[(least[heads] & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    return heads + base, strings, doc + first, mix(anchor)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}


def _bucket(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashed >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    at = bucket[order]
    cuts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)])) if len(at) else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(at[a]), order[a:b]


# -- which anchors are shared ---------------------------------------------------------------------------------------


def _anchors(packed: Packed, cut: Segments) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchors of a slice, ascending, and whether several documents of the slice have each."""
    order = np.argsort(cut.anchor)
    hashed, ids = cut.anchor[order], packed.ids[cut.doc[order]]
    heads = np.flatnonzero(np.concatenate(([True], hashed[1:] != hashed[:-1]))) if len(hashed) else np.zeros(0, np.int64)
    if not len(heads):
        return hashed, np.zeros(0, bool)
    return hashed[heads], np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)


def _short(hashed: np.ndarray) -> bytes:
    """Five bytes of each hash: enough inside a bucket, where taking two anchors for one only costs work."""
    return hashed.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _long(data: pa.Scalar) -> np.ndarray:
    short = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, 5)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, :5] = short
    return out.view(np.uint64)[:, 0]


def _tell_anchors(length: int, buckets: int):
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            packed = Packed(row, length)
            hashed, several = _anchors(packed, Segments(packed))
            out = [(b, _short(hashed[at]), _squeeze(several[at])) for b, at in _by_bucket(_bucket(hashed, buckets))]
            if out:
                bucket, anchors, flags = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(bucket), "slice": pa.array([packed.slice] * len(out)),
                    "anchors": pa.array(anchors, pa.binary()), "several": pa.array(flags, pa.binary()),
                })

    return tell


def _answer_anchors(hot: int):
    def answer(rows: pa.Table) -> pa.Table:
        anchors = [_long(x) for x in rows.column("anchors")]
        several = [_expand(x, bool, len(a)) for x, a in zip(rows.column("several"), anchors, strict=True)]
        several = np.concatenate(several)
        _, at, count = np.unique(np.concatenate(anchors), return_inverse=True, return_counts=True)
        inner = np.zeros(len(count), bool)
        inner[at[several]] = True
        verdict = np.where((count > 1) | inner, np.where(count > hot, 2, 1), 0).astype(np.uint8)[at]
        cuts = np.concatenate(([0], np.cumsum([len(a) for a in anchors])))
        shared = [_squeeze(verdict[a:b]) if verdict[a:b].any() else None for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table({
            "slice": rows.column("slice"), "bucket": rows.column("bucket"), "shared": pa.array(shared, pa.binary()),
        }).filter(pa.array([s is not None for s in shared]))

    return answer


# -- candidates -----------------------------------------------------------------------------------------------------


class Candidates:
    """The segments of a slice that may repeat; ``kind`` numbers the distinct ones, as they first occur."""

    def __init__(self, packed: Packed, replies: pa.Scalar, buckets: int) -> None:
        cut = Segments(packed)
        hashed = np.sort(cut.anchor)
        hashed = hashed[np.concatenate(([True], hashed[1:] != hashed[:-1]))] if len(hashed) else hashed
        answers = {r["bucket"]: r["shared"] for r in replies.as_py() or []}
        verdict = np.zeros(len(hashed), np.uint8)
        for b, at in _by_bucket(_bucket(hashed, buckets)):
            if b in answers:
                verdict[at] = np.frombuffer(pa.decompress(answers[b], len(at), codec="zstd"), np.uint8)
        own = verdict[np.searchsorted(hashed, cut.anchor)] if len(hashed) else verdict
        start, strings, doc, anchor = (x[own == 1] for x in (cut.start, cut.strings, cut.doc, cut.anchor))
        hot = np.flatnonzero(own == 2)
        text = packed.text
        if len(hot):
            repeat = cut.strings[hot]
            first = np.repeat(cut.start[hot], repeat) + np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
            start, doc = np.concatenate((start, first)), np.concatenate((doc, np.repeat(cut.doc[hot], repeat)))
            strings = np.concatenate((strings, np.ones(len(first), np.int64)))
            anchor = np.concatenate((anchor, text.hashes(first, first + packed.length)))
        self.start, self.strings, self.doc = start, strings, doc
        content = text.hashes(start, start + strings + packed.length - 1)
        _, head, kind = np.unique(content, return_index=True, return_inverse=True)
        # Numbered as they first occur, which packs well.
        rank = np.empty(len(head), np.int64)
        rank[np.argsort(head)] = np.arange(len(head))
        head, self.kind = np.sort(head), rank[kind]
        self.anchor, self.head = anchor[head], head
        ids = packed.ids[doc]
        order = np.argsort(self.kind, kind="stable")
        cuts = np.searchsorted(self.kind[order], np.arange(len(head)))
        self.least = np.minimum.reduceat(ids[order], cuts) if len(head) else ids
        self.most = np.maximum.reduceat(ids[order], cuts) if len(head) else ids


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The byte ranges one after another."""
    first = np.cumsum(size) - size
    return data[np.repeat(start - first, size) + np.arange(size.sum())]


def _delta(values: np.ndarray, dtype=np.int64) -> bytes:
    return _squeeze(np.diff(values, prepend=0).astype(dtype))


def _places(packed: Packed, found: Candidates) -> dict:
    """Where each segment occurs, in the order of the slice; goes by a bucket of its own to the marks of the slice."""
    order = np.argsort(found.start, kind="stable")
    return {
        "bucket": -1 - packed.slice, "n": len(order), "bytes": 0, "kind": _delta(found.kind[order], np.int32),
        "least": _delta(found.start[order]), "most": _delta(found.doc[order]),
    }


def _messages(held: list[tuple[Packed, Candidates]], length: int, buckets: int) -> list[dict]:
    """The distinct segments of some slices, one row for each bucket."""
    base = np.cumsum([0] + [len(packed.text.data) for packed, _ in held])
    data = np.concatenate([packed.text.data for packed, _ in held])
    own = [found.head for _, found in held]
    start = np.concatenate([found.start[head] + b for (_, found), head, b in zip(held, own, base, strict=False)])
    strings = np.concatenate([found.strings[head] for (_, found), head in zip(held, own, strict=True)])
    anchor, least, most = (np.concatenate([getattr(found, name) for _, found in held]) for name in ("anchor", "least", "most"))
    kind = np.concatenate([np.arange(len(head)) for head in own])
    home = np.repeat([packed.slice for packed, _ in held], [len(head) for head in own])
    out = []
    for b, at in _by_bucket(_bucket(anchor, buckets)):
        size = strings[at] + length - 1
        text = _gather(data, start[at], size)
        group = (anchor[at] & np.uint64(0xFF)).astype(np.uint8)
        out.append({
            "bucket": b, "n": len(at), "bytes": len(text), "slice": _delta(home[at]), "kind": _delta(kind[at], np.int32),
            "size": _squeeze(size.astype(np.int32)), "least": _squeeze(least[at]), "most": _squeeze(most[at] - least[at]),
            "group": _squeeze(group), "text": _squeeze(text),
        })
    return out


def _tell_segments(length: int, buckets: int):
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in _rows(batches):
            packed = Packed(row, length)
            found = Candidates(packed, row["replies"], buckets)
            if not len(found.head):
                continue
            yield pa.RecordBatch.from_pylist([_places(packed, found)], _SEGMENTS)
            held.append((packed, found))
            size += len(packed.text.data)
            if size >= SEND_BYTES:
                yield pa.RecordBatch.from_pylist(_messages(held, length, buckets), _SEGMENTS)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(_messages(held, length, buckets), _SEGMENTS)

    return tell


_SEGMENTS = pa.schema([
    ("bucket", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("slice", pa.binary()), ("kind", pa.binary()),
    ("size", pa.binary()), ("least", pa.binary()), ("most", pa.binary()), ("group", pa.binary()), ("text", pa.binary()),
])
_SEGMENT_ROWS = (
    "bucket long, n long, bytes long, slice binary, kind binary, size binary, least binary, most binary, group binary, text binary"
)


# -- transforms and their merge -------------------------------------------------------------------------------------


class Transform:
    """The rotations of a shard's strings in sorted order: the symbol before each, and which rotation it is.

    ``before[s]`` are the ``s`` bytes before each rotation as one number. The
    order is that of the first ``length`` bytes.
    """

    def __init__(self, data: np.ndarray, size: np.ndarray, length: int) -> None:
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(size)), size)
        here, end, long = np.arange(len(data)), np.repeat(first + size, size), np.repeat(size, size)

        def shift(k: int) -> np.ndarray:
            """The byte k further on in the same string, from the end on at its start; k is less than its length."""
            at = here + k
            return at - np.where(at >= end, long, 0) if k > 0 else at + np.where(at < end - long, long, 0)

        ahead, have = {1: data.astype(np.uint64)}, 1
        while have < SYMBOL:
            ahead[2 * have] = (ahead[have] << np.uint64(8 * have)) | ahead[have][shift(have)]
            have *= 2
        (rank, order), depth = _ranks(ahead[SYMBOL]), SYMBOL
        number, half = _width(len(data))
        rank = rank.astype(number)
        while depth < length:
            step = min(depth, length - depth)
            (rank, order), depth = _ranks((rank << half) | rank[shift(step)]), depth + step
        self.rotation = order
        self.owner, self.offset = owner[order], (here - (end - long))[order]
        self.before = {s: (ahead[SYMBOL] >> np.uint64(8 * (SYMBOL - s)))[shift(-s)[order]] for s in set(_steps(length))}


def _width(n: int) -> tuple[type, np.unsignedinteger]:
    """A type for two numbers below n, and the bits of one of them."""
    return (np.uint32, np.uint32(16)) if n < 1 << 16 else (np.uint64, np.uint64(32))


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of smaller distinct keys, for each key, and the sorted order."""
    order = np.argsort(keys)
    at = keys[order]
    new = np.zeros(len(at), bool)
    np.not_equal(at[1:], at[:-1], out=new[1:])
    out = np.empty(len(at), keys.dtype)
    out[order] = np.cumsum(new, dtype=keys.dtype)
    return out, order


def merge(shards: list[Transform], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of sorted shards, as places in all shards one after another, and which begin a new string of ``length``.

    A round takes the interleave by h bytes to that by h + s bytes: rotation i
    of a shard, wherever the interleave has it, sends the rotation s bytes
    earlier to the place its symbol gives.
    """
    total = sum(len(t.rotation) for t in shards)
    z = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(t.rotation) for t in shards])
    number, half = _width(total)
    low = number((1 << int(half)) - 1)
    block, border = np.zeros(total, number), np.zeros(total, bool)
    at = np.arange(total, dtype=number)
    symbols = {s: _ranks(np.concatenate([t.before[s] for t in shards]))[0].astype(number) << half for s in set(_steps(length))}
    for s in _steps(length):
        # The k-th entry of a shard in the interleave reads the k-th symbol of its transform.
        key = np.empty(total, number)
        key[np.argsort(z, kind="stable")] = symbols[s]
        # Sorting (symbol, place) is a stable distribution by symbol.
        key |= at
        key.sort()
        order = key & low
        key >>= half
        z, block = z[order], block[order]
        border = np.ones(total, bool)
        border[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(border, dtype=number)
    place = np.empty(total, np.int64)
    place[np.argsort(z, kind="stable")] = np.arange(total)  # shards lie one after another
    return place, border


def _steps(length: int) -> list[int]:
    """Symbols from the last bytes of a string to its first."""
    return [SYMBOL] * (length // SYMBOL) + [length % SYMBOL] * (length % SYMBOL > 0)


def least_documents(data: np.ndarray, size: np.ndarray, least: np.ndarray, length: int, shards: int) -> np.ndarray:
    """For every byte of some distinct segments: the least document with the string of ``length`` that starts there."""
    cut = np.searchsorted(np.cumsum(size), np.linspace(0, size.sum(), shards + 1)[1:-1], "right")
    cut = np.unique(np.concatenate(([0], cut, [len(size)])))
    first = np.concatenate(([0], np.cumsum(size)))
    transforms = [Transform(data[first[a] : first[b]], size[a:b], length) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    place, border = merge(transforms, length)
    where = np.concatenate([t.rotation + first[a] for t, a in zip(transforms, cut[:-1], strict=True)])[place]
    owner = np.concatenate([t.owner + a for t, a in zip(transforms, cut[:-1], strict=True)])
    whole = np.concatenate([t.offset for t in transforms]) + length <= size[owner]  # others run over the segment's end
    doc = np.where(whole, least[owner], _LAST)[place]
    heads = np.flatnonzero(border)
    out = np.empty(len(data), np.int64)
    out[where] = np.repeat(np.minimum.reduceat(doc, heads), np.diff(np.append(heads, len(data))))
    return out


def _merge_bucket(length: int, shards: int):
    def answer(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        if bucket < 0:
            # The places of a slice, on their way to its marks.
            own = rows.select(["n", "kind", "least", "most"]).rename_columns(["n", "kind", "string", "doc"])
            return own.add_column(0, "slice", pa.array([-1 - bucket])).add_column(4, "run", pa.nulls(1, pa.binary())).cast(_MARKS)
        n, sizes = rows.column("n").to_pylist(), rows.column("bytes").to_pylist()

        def joined(name: str, dtype, counts=n) -> np.ndarray:
            return np.concatenate([_expand(x, dtype, k) for x, k in zip(rows.column(name), counts, strict=True)])

        data, size = joined("text", np.uint8, sizes), joined("size", np.int32).astype(np.int64)
        least, more, group = joined("least", np.int64), joined("most", np.int64), joined("group", np.uint8)
        firsts = np.cumsum(n) - n

        def summed(steps: np.ndarray) -> np.ndarray:
            return np.cumsum(steps) - np.repeat(np.cumsum(steps)[firsts] - steps[firsts], n)

        kind, home = summed(joined("kind", np.int32).astype(np.int64)), summed(joined("slice", np.int64))
        start = np.cumsum(size) - size
        out, order = [], np.argsort(group, kind="stable")
        filled = np.cumsum(size[order]) // MERGE_BYTES
        # Groups stay whole; as many as fit are merged together.
        begins = np.flatnonzero(np.concatenate(([True], group[order][1:] != group[order][:-1])))
        begins = begins[np.concatenate(([True], filled[begins[1:]] != filled[begins[:-1]]))]
        for a, b in zip(begins, np.append(begins[1:], len(order)), strict=True):
            own = order[a:b]
            text = _gather(data, start[own], size[own])
            end = np.cumsum(size[own])
            content = Slice(0, text, np.array([0, len(text)])).hashes(end - size[own], end)
            _, head, same = np.unique(content, return_index=True, return_inverse=True)
            first = np.full(len(head), _LAST)
            np.minimum.at(first, same, least[own])
            head = own[head]
            text = _gather(data, start[head], size[head])
            found = least_documents(text, size[head], first, length, shards)
            # Runs of strings with one least document, per distinct segment.
            at = np.cumsum(size[head]) - size[head]
            owner = np.repeat(np.arange(len(head)), size[head] - length + 1)
            string = np.arange(len(owner)) - np.repeat(np.cumsum(size[head] - length + 1) - (size[head] - length + 1), size[head] - length + 1)
            doc = found[at[owner] + string]
            begin = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1]))))
            run = np.diff(np.append(begin, len(owner)))
            per = np.bincount(owner[begin], minlength=len(head))
            top = np.cumsum(per) - per
            many = per[same]
            which = np.repeat(top[same], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row = np.repeat(own, many)
            useful = doc[begin[which]] < least[row] + more[row]
            row, which = row[useful], which[useful]
            out.append((home[row], kind[row], string[begin[which]], run[which], doc[begin[which]]))
        home, kind, string, run, doc = (np.concatenate(x) for x in zip(*out, strict=True))
        marks = [
            {"slice": s, "n": len(at), "kind": _squeeze(kind[at].astype(np.int32)), "string": _squeeze(string[at].astype(np.int32)),
             "run": _squeeze(run[at].astype(np.int32)), "doc": _squeeze(doc[at])}
            for s, at in _by_bucket(home)
        ]
        return pa.Table.from_pylist(marks, _MARKS)

    return answer


_MARKS = pa.schema([
    ("slice", pa.int64()), ("n", pa.int64()), ("kind", pa.binary()), ("string", pa.binary()), ("run", pa.binary()), ("doc", pa.binary()),
])
_MARK_ROWS = "slice long, n long, kind binary, string binary, run binary, doc binary"


# -- cutting --------------------------------------------------------------------------------------------------------


def _covered(packed: Packed, places: dict, marks: list[dict]) -> np.ndarray:
    """Which bytes of a slice go."""
    change = np.zeros(len(packed.text.data) + 1, np.int64)

    def read(row: dict, name: str, dtype) -> np.ndarray:
        return np.frombuffer(pa.decompress(row[name], row["n"] * np.dtype(dtype).itemsize, codec="zstd"), dtype)

    kinds, start, doc = (np.cumsum(read(places, name, kind)) for name, kind in (("kind", np.int32), ("string", np.int64), ("doc", np.int64)))
    order = np.argsort(kinds, kind="stable")
    kinds, start, ids = kinds[order], start[order], packed.ids[doc[order]]
    for m in marks:
        kind, string, run = (read(m, name, np.int32) for name in ("kind", "string", "run"))
        first = np.searchsorted(kinds, kind)
        many = np.searchsorted(kinds, kind, "right") - first
        at = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        later = np.repeat(read(m, "doc", np.int64), many) < ids[at]
        begin = start[at[later]] + np.repeat(string, many)[later]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + np.repeat(run, many)[later] + packed.length - 1, -1)
    return np.cumsum(change[:-1]) > 0


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The marks, without those of characters that are not marked whole."""
    first = (data & 0xC0) != 0x80
    if first.all() or not gone.any():
        return gone
    heads = np.flatnonzero(first)
    whole = np.logical_and.reduceat(gone, heads)
    return np.repeat(whole, np.diff(np.append(heads, len(data))))


def _cut(length: int, characters: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            packed = Packed(row, length)
            text, marks = packed.text, row["marks"].as_py() or []
            gone = np.zeros(len(text.data), bool)
            if marks:
                gone = _covered(packed, row["places"].as_py(), marks)
                gone = _whole_characters(text.data, gone) if characters else gone
            starts, ends, docs = text.runs(gone)
            cuts = np.searchsorted(docs, np.arange(text.n + 1))
            spans = [
                [{"start": int(s), "length": int(e - s)} for s, e in zip(starts[a:b] - text.at[i], ends[a:b] - text.at[i], strict=True)]
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
            ]
            kept = [text.data[a:b][~gone[a:b]].tobytes() for a, b in zip(text.at[:-1], text.at[1:], strict=True)]
            rest = pa.ipc.open_stream(row["rest"].as_buffer()).read_all().combine_chunks().to_batches()
            own = {name: rest[0].column(name) for name in rest[0].schema.names}
            yield pa.RecordBatch.from_pydict(own | {
                "n_bytes": pa.array(np.diff(text.at)), "n_removed": pa.array(text.sums(gone)),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()),
            })

    return cut


def remove_repeats(
    spark: SparkSession, docs: DataFrame, length: int = LENGTH, hot: int = HOT, shards: int = SHARDS, characters: bool = False
) -> DataFrame:
    """The rows without ``text``, with n_bytes, n_removed, the spans removed (byte offsets) and the bytes kept.

    ``length``: 2 to 64. With ``characters``, characters that are not covered whole are kept, so that ``kept`` is text.
    """
    if not 2 <= length <= 64:
        raise ValueError("length must be from 2 to 64 bytes")
    texts = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    others = [f for f in texts.schema.fields if f.name not in ("text", *RESULT.names)]
    texts = texts.select(*[f.name for f in others], "text")
    packed = written_by(spark, texts.mapInArrow(_pack, _PACKED), "packed", "slice")
    with shuffles_dropped(spark):
        total = packed.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    told = packed.mapInArrow(_tell_anchors(length, buckets), "bucket long, slice long, anchors binary, several binary")
    shared = told.groupBy("bucket").applyInArrow(_answer_anchors(hot), "slice long, bucket long, shared binary")
    replies = shared.groupBy("slice").agg(F.collect_list(F.struct("bucket", "shared")).alias("replies"))
    with shuffles_dropped(spark):
        replies = written(spark, replies, "replies")
        segments = packed.join(replies, "slice").mapInArrow(_tell_segments(length, buckets), _SEGMENT_ROWS)
        marked = segments.groupBy("bucket").applyInArrow(_merge_bucket(length, shards), _MARK_ROWS)
        # A row without runs has the places of its slice.
        told, place = F.struct("n", "kind", "string", "run", "doc"), F.struct("n", "kind", "string", "doc")
        marks = marked.groupBy("slice").agg(
            F.collect_list(F.when(F.col("run").isNotNull(), told)).alias("marks"),
            F.first(F.when(F.col("run").isNull(), place), ignorenulls=True).alias("places"),
        )
        marks = written(spark, marks.where(F.size("marks") > 0), "marks")
    return packed.join(marks, "slice", "left").mapInArrow(
        _cut(length, characters), T.StructType([*others, *RESULT.fields])
    )
