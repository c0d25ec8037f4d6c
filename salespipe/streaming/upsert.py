"""Upsert every micro-batch of a stream into a versioned table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from salespipe.operators.latest import latest_per_key
from salespipe.streaming.triggers import with_trigger
from salespipe.tables.versioned import VersionedTable

QUERY_ID = "sql.streaming.queryId"


def upsert_batch(
    table: VersionedTable,
    keys: str | list[str],
    order_by: str,
    *,
    ties: str = "one",
    tie_break: str | list[str] = (),
    stream_id: str | None = None,
    **options,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` callback: newest row per key of the batch, then upsert.

    With ``on_match="replace"`` the last batch wins, whatever its dates; with
    ``on_match="if_newer"`` the newest row wins however rows fell into batches
    (``newer_by`` defaults to the order and tie-break columns). ``ties="all"``
    lets tied rows through, and the upsert raises where they match a row.

    The batch is committed under the id the checkpoint gives the stream, so a
    batch replayed after a failure is skipped, and a stream with a new
    checkpoint starts over.
    """
    breaks = [tie_break] if isinstance(tie_break, str) else list(tie_break)
    if options.get("on_match") == "if_newer":
        options.setdefault("newer_by", [order_by, *breaks])

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id or batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if not stream:
            raise RuntimeError("the stream has no id to commit its batches under; pass stream_id")
        done = (stream, batch_id)
        if table.has_batch(done):
            return
        newest = latest_per_key(batch, keys, order_by, ties=ties, tie_break=breaks)
        table.upsert(newest, keys, batch=done, **options)

    return apply


def start_upsert(
    stream: DataFrame,
    table: VersionedTable,
    keys: str | list[str],
    order_by: str,
    checkpoint: str,
    *,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Run ``upsert_batch`` on a stream; the checkpoint is required."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return with_trigger(writer.foreachBatch(upsert_batch(table, keys, order_by, **options)), every).start()
