"""Running a stream over what is available now."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from vigilmart.sources.batches import own_checkpoint


def drain(writer: DataStreamWriter, checkpoint: str | None = None) -> None:
    """Process all new input in as many batches as the source makes, then stop.

    Streams that write a log bring their checkpoint along; others are given one.
    """
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def each_batch(stream: DataFrame, log: str, handle: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """A writer that hands each batch to ``handle``, under the checkpoint of ``log``."""
    writer = stream.writeStream.outputMode("append").foreachBatch(handle)
    return writer.option("checkpointLocation", own_checkpoint(stream.sparkSession, log))
