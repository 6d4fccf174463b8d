"""Folders written once per streaming batch, and numbered versions of a table.

Both are plain Parquet folders. A batch that is replayed after a failure overwrites its own
folder, so it counts once. A version is visible once a row that names it is written, after the
version itself; whether the committer leaves marker files does not matter.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("text").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def own_checkpoint(spark: SparkSession, log: str) -> str:
    """The checkpoint that belongs to a log, beside it.

    Batch numbers start again with a new checkpoint, so a log without its checkpoint can't be
    continued: it would be counted twice, or overwritten in part.
    """
    checkpoint = f"{log}-checkpoint"
    if exists(spark, log) and not exists(spark, f"{checkpoint}/offsets"):
        raise RuntimeError(f"{log} holds batches but its checkpoint {checkpoint} is gone; use a new folder")
    return checkpoint


def write_batch(df: DataFrame, log: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")


def read_batches(spark: SparkSession, log: str, schema: str, before: int | None = None) -> DataFrame:
    """All rows of a log, or of its batches below ``before``, with the number of their batch."""
    columns = f"{schema}, batch_id BIGINT"
    if before is not None and not exists(spark, log):
        return spark.createDataFrame([], columns)
    rows = spark.read.schema(columns).parquet(log)
    return rows if before is None else rows.where(F.col("batch_id") < before)


def publish(df: DataFrame, root: str, version: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/v={version}")
    done = df.sparkSession.range(1).select(F.lit(version).cast("bigint").alias("version"))
    done.coalesce(1).write.mode("overwrite").parquet(f"{root}/done/v={version}")


def latest_version(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """The highest complete version, below ``before`` if given."""
    if not exists(spark, f"{root}/done"):
        if exists(spark, f"{root}/v=*") and before is None:
            raise RuntimeError(f"{root} holds versions but none is complete")
        return None
    done = spark.read.schema("version BIGINT").parquet(f"{root}/done")
    if before is not None:
        done = done.where(F.col("version") < before)
    return done.agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, root: str, version: int, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/v={version}")
