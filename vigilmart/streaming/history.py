"""Incremental customer history: each bronze delivery becomes a new version of the table.

The current versions lie in hash buckets of the customer. A version of the table is a map from
bucket to the run that wrote it last: a batch rewrites the buckets it changes and takes the
others over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vigilmart import settings
from vigilmart.operators import scd2
from vigilmart.operators.dedup import latest_per_key
from vigilmart.operators.silver import CUSTOMER_FIELDS
from vigilmart.functions.columns import field
from vigilmart.sources.batches import read_batches, write_batch
from vigilmart.sources.keyed import BUCKET, bucket_of, last_version, read_map, read_parts, write_map, write_run
from vigilmart.sources.workspace import settle
from vigilmart.streaming.bronze import stream_from_bronze
from vigilmart.streaming.runs import each_batch

BUCKETS = 8
KEY = ["customer_id"]
# Bucket by bucket the run that holds it; on every row the last surrogate key and load time.
MAP_SCHEMA = "bucket INT, run BIGINT, n BIGINT, last_key BIGINT, last_load TIMESTAMP_NTZ"


def _paths(root: str, parts: Sequence[Row]) -> list[str]:
    return [f"{root}/buckets/{p['run']}/{BUCKET}={p['bucket']}" for p in parts]


def current_map(spark: SparkSession, root: str, before: int | None = None) -> list[Row]:
    """One row per bucket of the last version, below ``before`` if given."""
    return read_map(spark, f"{root}/current", MAP_SCHEMA, before)


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """The whole history as of the last finished batch."""
    version = last_version(spark, f"{root}/current")
    current = read_parts(spark, scd2.DIM_SCHEMA, _paths(root, current_map(spark, root)))
    if version is None:
        return current
    closed = read_batches(spark, f"{root}/closed", scd2.DIM_SCHEMA)
    # What a batch closed counts once the batch has published its current versions.
    return current.unionByName(closed.where(F.col("batch_id") <= version).drop("batch_id"))


def deliveries(bronze: DataFrame) -> DataFrame:
    """The customers of each delivery: one row per load time and customer_id, the latest."""
    rows = bronze.select("_load_ts", *[field(name, kind) for name, kind in CUSTOMER_FIELDS.items()])
    return latest_per_key(rows, ["_load_ts", "customer_id"], "last_modified").drop("last_modified")


def history_stream(
    spark: SparkSession,
    raw: str,
    root: str,
    tracked: Sequence[str] = settings.TRACKED_COLUMNS,
    files_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Apply the deliveries of the bronze customers in the order of their load time.

    All deliveries of a batch are applied in one pass. A batch reads the current versions of
    the buckets its customers lie in, and rewrites those in which a version closes or opens;
    what it closed goes to a folder of its own, and what earlier batches closed is neither read
    nor written again. The validity start is the load time found in the rows, not the clock,
    and a batch continues from the version before its own: replaying it gives the same tables.
    A delivery should reach bronze in one write, so that a batch sees it whole.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = current_map(session, root, before=batch_id)
        came = settle(deliveries(batch).withColumn(BUCKET, bucket_of(KEY, buckets)), "deliveries")
        found = came.groupBy(BUCKET).agg(F.min("_load_ts").alias("first"), F.max("_load_ts").alias("last")).collect()
        if not found:
            return
        last_key, last_load = (before[0]["last_key"], before[0]["last_load"]) if before else (0, None)
        load = min(r["first"] for r in found)
        if last_load is not None and load < last_load:
            raise ValueError(f"delivery of {load} arrived after that of {last_load}")
        touched = {r[BUCKET] for r in found}
        current = read_parts(session, scd2.DIM_SCHEMA, _paths(root, [p for p in before if p["bucket"] in touched]))
        changes = settle(scd2.advance_many(current, came.drop(BUCKET), last_key, tracked), "changes")
        sums = changes.groupBy(bucket_of(KEY, buckets).alias(BUCKET)).agg(F.max("customer_sk").alias("last_key")).collect()
        rewritten = {r[BUCKET] for r in sums}
        old = read_parts(session, scd2.DIM_SCHEMA, _paths(root, [p for p in before if p["bucket"] in rewritten]))
        closed = changes.where(~F.col("is_current"))
        kept = old.join(closed.select("customer_sk"), "customer_sk", "left_anti").select(*scd2.DIM_COLUMNS)
        write_run(kept.unionByName(changes.where("is_current")), KEY, buckets, f"{root}/buckets/{batch_id}")
        write_batch(closed, f"{root}/closed", batch_id)
        new = read_parts(session, scd2.DIM_SCHEMA, [f"{root}/buckets/{batch_id}"])
        counts = new.groupBy(bucket_of(KEY, buckets).alias("bucket")).agg(F.count("*").alias("n")).collect()
        last_key = max([last_key, *[r["last_key"] for r in sums]])
        parts = [(p["bucket"], p["run"], p["n"]) for p in before if p["bucket"] not in rewritten]
        parts += [(r["bucket"], batch_id, r["n"]) for r in counts]
        state = (last_key, max(r["last"] for r in found))
        write_map(session, f"{root}/current", MAP_SCHEMA, [(*p, *state) for p in sorted(parts)], batch_id)

    source = stream_from_bronze(spark, raw, "customers", files_per_batch)
    return each_batch(source, f"{root}/current", handle)
