"""Incremental bronze load: only files that were not loaded before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from vigilmart.sources.bronze import BRONZE_SCHEMA, as_bronze
from vigilmart.sources.files import entity_path


def stream_files(
    spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def bronze_stream(
    spark: SparkSession,
    landing: str,
    raw: str,
    entity: str,
    schema: StructType | str,
    as_of: str | None = None,
    files_per_batch: int | None = None,
) -> DataStreamWriter:
    """New files of an entity appended to bronze. The load time is that of the batch, which
    Spark keeps with the batch's offsets, so a replay writes the same rows.

    A folder is filled by this stream or by batch loads, not by both: readers of a
    stream's folder see what the stream has committed.
    """
    rows = stream_files(spark, entity_path(landing, entity), schema, files_per_batch)
    landed = as_bronze(rows, as_of if as_of is not None else F.current_timestamp())
    return landed.writeStream.format("parquet").option("path", entity_path(raw, entity))


def stream_from_bronze(
    spark: SparkSession, raw: str, entity: str, files_per_batch: int | None = None
) -> DataFrame:
    return stream_files(spark, entity_path(raw, entity), BRONZE_SCHEMA, files_per_batch)
