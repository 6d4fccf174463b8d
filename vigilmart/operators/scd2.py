"""Type-2 customer history: close changed versions, add new ones, keep the rest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.operators.keys import dense_key
from vigilmart.sources.workspace import settle

ATTRIBUTES = ("full_name", "ssn", "country", "branch_id", "kyc_status")
DIM_SCHEMA = (
    "customer_sk BIGINT, customer_id BIGINT, full_name STRING, ssn STRING, country STRING, "
    "branch_id INT, kyc_status STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, "
    "is_current BOOLEAN"
)
DIM_COLUMNS = [part.split()[0] for part in DIM_SCHEMA.split(", ")]

Instant = str | datetime


def empty_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_SCHEMA)


def _instant(as_of: Instant) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _is_closed() -> Column:
    return ~F.coalesce(F.col("is_current"), F.lit(False))


def _differs(old: Column, new: Column, null_safe: bool) -> Column:
    """A NULL on either side is no change, unless ``null_safe``."""
    return ~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False))


def _changed(old: str, new: str, tracked: Sequence[str], null_safe: bool) -> Column:
    tests = [_differs(F.col(f"{old}.{c}"), F.col(f"{new}.{c}"), null_safe) for c in tracked]
    return reduce(lambda a, b: a | b, tests)


def _one_row(count: Column) -> Column:
    """True, or an error that names the customer with several source rows."""
    several = F.concat(F.lit("several source rows of customer "), F.col("customer_id").cast("string"))
    return F.when(F.col("customer_id").isNotNull() & (count > 1), F.raise_error(several).cast("boolean")).otherwise(True)


def one_row_per_customer(src: DataFrame) -> DataFrame:
    """The source; reading it fails where a customer_id has several rows. NULL keys match nothing.

    The rows of a key are counted where they meet, so a join on customer_id after it needs no
    shuffle of its own.
    """
    count = F.count("*").over(Window.partitionBy("customer_id"))
    return src.withColumn("_sound", _one_row(count)).where("_sound").drop("_sound")


def _fresh_versions(src: DataFrame, as_of: Instant) -> DataFrame:
    return src.select(
        "customer_id",
        *ATTRIBUTES,
        _instant(as_of).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def last_key(dim: DataFrame) -> int:
    return dim.agg(F.max("customer_sk")).first()[0] or 0


def first_load(src: DataFrame, as_of: Instant) -> DataFrame:
    """Every source customer as a current version; keys follow customer_id."""
    return dense_key(_fresh_versions(src, as_of), ["customer_id"], "customer_sk")


def close_out(
    dim: DataFrame,
    src: DataFrame,
    as_of: Instant,
    tracked: Sequence[str] = settings.TRACKED_COLUMNS,
    null_safe: bool = False,
) -> DataFrame:
    """End the current versions whose tracked columns differ from the source.

    Only the current slice meets the source; closed history passes by. Several source rows of
    one customer are an error.
    """
    source = one_row_per_customer(src).select("customer_id", *tracked, F.lit(True).alias("seen"))
    joined = dim.where("is_current").alias("old").join(
        source.alias("new"), F.col("old.customer_id") == F.col("new.customer_id"), "left"
    )
    changed = F.col("new.seen") & _changed("old", "new", tracked, null_safe)
    changed = F.coalesce(changed, F.lit(False))
    kept = [F.col(f"old.{c}").alias(c) for c in DIM_COLUMNS if c not in ("valid_to", "is_current")]
    current = joined.select(
        *kept,
        F.when(changed, _instant(as_of)).otherwise(F.col("old.valid_to")).alias("valid_to"),
        (~changed).alias("is_current"),
    )
    return dim.where(_is_closed()).unionByName(current)


def insert_missing(dim: DataFrame, src: DataFrame, as_of: Instant) -> DataFrame:
    """Add a current version for every source customer that has none; several source rows of one
    customer are an error."""
    src = one_row_per_customer(src)
    has_version = dim.where("is_current").select("customer_id")
    fresh = _fresh_versions(src.join(has_version, "customer_id", "left_anti"), as_of)
    keyed = dense_key(fresh, ["customer_id"], "customer_sk", start=last_key(dim))
    return dim.unionByName(keyed)


def advance(
    current: DataFrame,
    src: DataFrame,
    as_of: Instant,
    highest_key: int,
    tracked: Sequence[str] = settings.TRACKED_COLUMNS,
    null_safe: bool = False,
) -> DataFrame:
    """The current versions after a snapshot: kept, closed now, and new ones.

    Current versions and source rows meet in one exchange on customer_id. A key yields its
    versions, closed where changed, and the source row when no version stays current.
    The result of that step is written once, so new rows get their keys from a finished
    table. ``src`` must have one row per customer_id, as ``silver.customer_src`` gives; this is
    checked where the rows of a key meet.
    """
    row = [c for c in DIM_COLUMNS if c != "customer_id"]
    held = current.select("customer_id", F.struct(*row).alias("old"), F.lit(None).alias("new"))
    incoming = _fresh_versions(src, as_of).withColumn("customer_sk", F.lit(None).cast("bigint"))
    incoming = incoming.select(
        "customer_id", F.lit(None).alias("old"), F.struct(*row).alias("new")
    )
    per_key = Window.partitionBy("customer_id")
    both = held.unionByName(incoming)
    # A NULL key matches nothing, so neither test may hold for it.
    keyed_row = F.col("customer_id").isNotNull()
    matched = (
        both.withColumn("src", F.max("new").over(per_key))
        .withColumn("sound", _one_row(F.count("new").over(per_key)))
        .where("sound")
        .withColumn(
            "closes",
            keyed_row
            & F.col("old").isNotNull()
            & F.col("src").isNotNull()
            & _changed("old", "src", tracked, null_safe),
        )
        .withColumn(
            "stays_current",
            keyed_row
            & (F.count_if(F.col("old").isNotNull() & ~F.col("closes")).over(per_key) > 0),
        )
        .where(F.col("old").isNotNull() | ~F.col("stays_current"))
    )
    version = F.coalesce("old", "new")
    fields = [version[c].alias(c) for c in row if c not in ("valid_to", "is_current")]
    staged = matched.select(
        "customer_id",
        *fields,
        F.when(F.col("closes"), _instant(as_of)).otherwise(version["valid_to"]).alias("valid_to"),
        (version["is_current"] & ~F.col("closes")).alias("is_current"),
    )
    staged = settle(staged.select(*DIM_COLUMNS), "scd2")
    fresh = staged.where("customer_sk IS NULL").drop("customer_sk")
    keyed = dense_key(fresh, ["customer_id"], "customer_sk", start=highest_key)
    return staged.where("customer_sk IS NOT NULL").unionByName(keyed)


def advance_many(
    current: DataFrame,
    deliveries: DataFrame,
    highest_key: int,
    tracked: Sequence[str] = settings.TRACKED_COLUMNS,
    null_safe: bool = False,
    load: str = "_load_ts",
) -> DataFrame:
    """What deliveries change in the current versions: those they close, and new ones.

    ``deliveries`` has one row per load time and customer_id, any number of loads. Each key's
    rows are folded in the order of their load onto its current version: a row that differs
    in a tracked column closes the version before and opens one. The result equals ``advance``
    delivery by delivery, keys included, in one pass; keys that stay as they are don't appear.
    ``current`` needs the current versions of the delivered keys only.
    """
    row = [c for c in DIM_COLUMNS if c != "customer_id"]
    version = ", ".join(f"{c}: {dict(p.split() for p in DIM_SCHEMA.split(', '))[c]}" for c in row)
    known = F.col("customer_id").isNotNull()
    opened = F.struct(
        F.lit(None).cast("bigint").alias("customer_sk"),
        *ATTRIBUTES,
        F.col(load).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    steps = deliveries.where(known).select("customer_id", F.struct(F.col(load).alias("at"), opened.alias("new")).alias("step"))
    steps = steps.groupBy("customer_id").agg(F.array_sort(F.collect_list("step")).alias("steps"))
    held = current.where(known).select("customer_id", F.struct(*row).cast(f"struct<{version}>").alias("old"))

    def folded(versions: Column, step: Column) -> Column:
        last = F.try_element_at(versions, F.lit(-1))
        new = step["new"].cast(f"struct<{version}>")
        differs = reduce(lambda a, b: a | b, [_differs(last[c], new[c], null_safe) for c in tracked])
        ended = {"valid_to": step["at"], "is_current": F.lit(False)}
        closed = F.struct(*[ended.get(c, last[c]).alias(c) for c in row]).cast(f"struct<{version}>")
        head = F.slice(versions, 1, F.size(versions) - 1)
        return F.when(F.size(versions) == 0, F.array(new)).when(differs, F.concat(head, F.array(closed, new))).otherwise(versions)

    start = F.when(F.col("old").isNotNull(), F.array("old")).otherwise(F.array().cast(f"array<struct<{version}>>"))
    met = steps.join(held, "customer_id", "left").select("customer_id", F.aggregate("steps", start, folded).alias("versions"), "old")
    changed = met.where((F.size("versions") > 1) | F.col("old").isNull()).select("customer_id", F.inline("versions"))
    # A NULL key matches nothing: each of its rows opens a version and none closes.
    unknown = deliveries.where(~known).select("customer_id", opened.alias("new")).select("customer_id", "new.*")
    staged = settle(changed.unionByName(unknown).select(*DIM_COLUMNS), "scd2")
    fresh = staged.where("customer_sk IS NULL").drop("customer_sk")
    keyed = dense_key(fresh, ["valid_from", "customer_id"], "customer_sk", start=highest_key)
    return staged.where("customer_sk IS NOT NULL").unionByName(keyed.select(*DIM_COLUMNS))


def apply_snapshot(
    dim: DataFrame,
    src: DataFrame,
    as_of: Instant,
    tracked: Sequence[str] = settings.TRACKED_COLUMNS,
    null_safe: bool = False,
) -> DataFrame:
    """``close_out`` then ``insert_missing``, with one shuffle of the current slice and the
    source; closed history passes by."""
    current = dim.where("is_current")
    advanced = advance(current, src, as_of, last_key(dim), tracked, null_safe)
    return dim.where(_is_closed()).unionByName(advanced)


def verify(dim: DataFrame) -> DataFrame:
    return dim.agg(
        F.count("*").alias("total_rows"),
        F.sum(F.when(F.col("is_current"), 1).otherwise(0)).alias("current_rows"),
    )


def history(dim: DataFrame) -> DataFrame:
    """Every version with its number within the customer."""
    by_time = Window.partitionBy("customer_id").orderBy("valid_from", "customer_sk")
    return dim.select(
        "customer_id",
        F.row_number().over(by_time).cast("bigint").alias("version_no"),
        *ATTRIBUTES,
        "valid_from",
        "valid_to",
        "is_current",
    )
