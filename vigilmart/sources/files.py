"""Parquet entity folders: scan, listing, landing sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITIES = ("customers", "accounts", "transactions", "watchlist")


def entity_path(root: str, entity: str) -> str:
    if entity not in ENTITIES:
        raise ValueError(f"unknown entity {entity!r}; expected one of {ENTITIES}")
    return f"{root.rstrip('/')}/{entity}"


def scan_entity(spark: SparkSession, root: str, entity: str) -> DataFrame:
    return spark.read.parquet(entity_path(root, entity))


def land_entity(df: DataFrame, root: str, entity: str) -> None:
    """Parquet sink for one source entity (full reload)."""
    df.write.mode("overwrite").parquet(entity_path(root, entity))


def file_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per file under the paths; contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )
