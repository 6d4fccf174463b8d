"""Bronze landing: each source row whole, as VARIANT, with load time and source file."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilmart.sources.files import ENTITIES, entity_path, scan_entity


def load_instant(as_of: str | datetime | Column | None = None) -> Column:
    """One fixed instant per run: a literal, so that re-evaluation cannot move it."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    moment = as_of if as_of is not None else datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(str(moment)).cast("timestamp_ntz")


def as_bronze(rows: DataFrame, as_of: str | datetime | Column | None = None) -> DataFrame:
    """Rows of a file scan (batch or stream) in bronze form: data, _load_ts, _file."""
    return rows.select(
        F.to_variant_object(F.struct(*[F.col(f"`{name}`") for name in rows.columns])).alias("data"),
        load_instant(as_of).alias("_load_ts"),
        F.col("_metadata.file_path").alias("_file"),
    )


def bronze_load(
    spark: SparkSession,
    landing: str,
    raw: str,
    as_of: str | datetime | None = None,
    mode: str = "overwrite",
    entities: tuple[str, ...] = ENTITIES,
) -> None:
    """Full reload of the entities by default; ``mode="append"`` adds a delivery."""
    for entity in entities:
        landed = as_bronze(scan_entity(spark, landing, entity), as_of)
        landed.write.mode(mode).parquet(entity_path(raw, entity))


BRONZE_SCHEMA = "data VARIANT, _load_ts TIMESTAMP_NTZ, _file STRING"


def read_bronze(spark: SparkSession, raw: str, entity: str) -> DataFrame:
    return spark.read.schema(BRONZE_SCHEMA).parquet(entity_path(raw, entity))


def bronze_schema(bronze: dict[str, DataFrame]) -> DataFrame:
    """Merged schema of the VARIANT rows of each entity."""
    parts = [
        df.agg(F.expr("schema_of_variant_agg(data)").alias("data_schema")).select(
            F.lit(entity).alias("entity"), "data_schema"
        )
        for entity, df in bronze.items()
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def bronze_fields(bronze: dict[str, DataFrame]) -> DataFrame:
    """Fields of each entity's VARIANT rows: name, kind of value and number of rows with one."""
    parts = []
    for entity, df in bronze.items():
        fields = df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("data").outer())).select(
            F.col("key").alias("field"),
            F.regexp_extract(F.schema_of_variant("value"), "^[A-Z_]+", 0).alias("kind"),
        )
        counts = fields.where("kind <> 'VOID'").groupBy("field", "kind").agg(F.count("*").alias("filled"))
        parts.append(counts.select(F.lit(entity).alias("entity"), "field", "kind", "filled"))
    return reduce(DataFrame.unionByName, parts)


def rows_by_folder(bronze: dict[str, DataFrame], listing: DataFrame) -> DataFrame:
    """Rows per entity folder, by the file each row names, and whether all files are listed."""
    parts = [df.groupBy("_file").agg(F.count("*").alias("_rows")) for df in bronze.values()]
    files = reduce(DataFrame.unionByName, parts).withColumn("_name", F.element_at(F.split("_file", "/"), -1))
    names = listing.select(F.col("file_name").alias("_name"), F.lit(True).alias("_listed"))
    return (
        files.join(names, "_name", "left")
        .withColumn("entity", F.element_at(F.split("_file", "/"), -2))
        .groupBy("entity")
        .agg(F.sum("_rows").alias("row_count"), F.bool_and(F.coalesce("_listed", F.lit(False))).alias("all_listed"))
    )


def peek(bronze: DataFrame, n: int = 1) -> DataFrame:
    return bronze.limit(n)
