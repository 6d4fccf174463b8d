"""Shared folder for intermediate tables and stream checkpoints.

The folder is the one the cluster names in ``spark.checkpoint.dir``, so every executor
reaches it and a table written there outlives the executor that wrote it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "txn_month"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MOST_SENT = 50_000  # rows of a join's side that may be sent to all tasks: some MB


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or one beside the tables of the warehouse.

    The warehouse is shared like every table's folder, so it can stand in for the option.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/vigilmart/{label}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write Parquet and return the written table; the given schema spares a footer scan.

    Reading it back also gives the planner the true file size, which is what decides
    whether a later join may broadcast it.
    """
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_month(df: DataFrame, path: str, day: str) -> DataFrame:
    """Write a large table with one folder per month of ``day``, kept as column ``month``.

    Rebalancing lets Spark cut up large months and join small ones, so file sizes stay even
    and no task holds a whole month. ``within_days`` filters by the month too, so that only
    the folders of those months are opened.
    """
    monthly = df.withColumn(MONTH, F.date_format(day, "yyyy-MM")).hint("rebalance", MONTH)
    monthly.write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return df.sparkSession.read.schema(monthly.schema).parquet(path)


def within_days(df: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """Rows of a table of ``write_by_month`` from one day to another, both included."""
    months = F.col(MONTH).between(first[:7], last[:7])
    return df.where(months & F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def by_rows(df: DataFrame, n: int | None = None) -> DataFrame:
    """A side of a join, sent to all tasks only if it has few rows; ``n``: how many at most, if known.

    Ids in order take a byte or two each in a file, so a table whose file is under the limit of
    Spark's own choice may fill the driver. Sides with more rows are joined by a shuffle.
    """
    n = df.count() if n is None else n
    return df if n <= MOST_SENT else df.hint("merge")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and continue from there."""
    return write_table(df, new_folder(df.sparkSession, label))


def settle_tidily(df: DataFrame, label: str) -> DataFrame:
    """``settle``, and the shuffles of this write go at once, not with the driver's next garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return settle(df, label)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)
