"""Duplicates and corrections in a stream: first seen, or latest by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vigilmart.operators.dedup import latest_per_key
from vigilmart.sources.keyed import KeyedLog, same_keys
from vigilmart.sources.workspace import settle
from vigilmart.streaming.runs import each_batch


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def first_seen(stream: DataFrame, log: str, keys: Sequence[str], **shape: int) -> DataStreamWriter:
    """The row of each key that arrived first; of several in one batch the smallest.

    Each batch writes the rows whose key no earlier batch had. The log is the memory, so no
    row is too late: however old its event time, it is kept if its key is new. Only buckets
    and key ranges that may hold the batch's keys are opened. ``shape``: ``buckets`` and
    ``most_runs`` of the log.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = KeyedLog(batch.sparkSession, log, _schema(stream), keys, **shape)
        once = settle(latest_per_key(batch, keys), "once")
        known = held.matching(once, before=batch_id).select(*[F.col(k).alias(f"_{k}") for k in keys])
        held.add(once.join(known, same_keys(keys, [f"_{k}" for k in keys]), "left_anti"), batch_id)

    return each_batch(stream, log, handle)


def read_first_seen(spark: SparkSession, log: str, schema: str, keys: Sequence[str]) -> DataFrame:
    return KeyedLog(spark, log, schema, keys).read()


def latest_log(
    stream: DataFrame,
    log: str,
    keys: Sequence[str],
    newest: str | Sequence[Column],
    ties: Sequence[str] | None = None,
    **shape: int,
) -> DataStreamWriter:
    """Each batch reduced to its latest row per key and added to a keyed log.

    No state is kept and no late row is lost: a correction may arrive any time later and
    wins when the log is read. Buckets that collect many runs are reduced to the latest rows
    on the way, so what a reader goes through stays near the number of keys.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        latest = _latest_log(batch.sparkSession, log, _schema(stream), keys, newest, ties, **shape)
        latest.add(latest.merge(batch), batch_id)

    return each_batch(stream, log, handle)


def _latest_log(spark, log, schema, keys, newest, ties, **shape) -> KeyedLog:
    return KeyedLog(spark, log, schema, keys, lambda rows: latest_per_key(rows, keys, newest, ties), **shape)


def read_latest(
    spark: SparkSession,
    log: str,
    schema: str,
    keys: Sequence[str],
    newest: str | Sequence[Column],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    return _latest_log(spark, log, schema, keys, newest, ties).read()
