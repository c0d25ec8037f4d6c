"""How often a stream runs."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter


def with_trigger(writer: DataStreamWriter, every: str | None = None) -> DataStreamWriter:
    """Micro-batches at a fixed interval, or (no interval) work off what is there and stop.

    The one-off run keeps the source's limit of files per batch.
    """
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
