"""The fact kept up to date: a delivery rebuilds the months it touches, no others.

The latest transactions lie in a keyed log, which finds earlier versions of a delivery's rows,
and by month, from which months are rebuilt. A version of the fact is a map from month to the
run that wrote it; untouched months keep their files, and a version is seen once its map is.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vigilmart.operators import star
from vigilmart.operators.dedup import latest_per_key
from vigilmart.sources.keyed import KeyedLog, last_version, read_map, read_parts, write_map
from vigilmart.sources.workspace import MONTH, by_rows, settle, write_table

TXN_SCHEMA = (
    "txn_id BIGINT, account_id BIGINT, txn_date DATE, amount DECIMAL(12,2), txn_type STRING, direction STRING, "
    "last_modified TIMESTAMP_NTZ"
)
FACT_SCHEMA = (
    "txn_id BIGINT, account_sk BIGINT, txn_type_sk BIGINT, branch_sk BIGINT, date_sk BIGINT, txn_date DATE, txn_type STRING, "
    "direction STRING, amount DECIMAL(12,2)"
)
MAP_SCHEMA = "month STRING, run BIGINT, n BIGINT, in_fact BOOLEAN"
UNDATED = "undated"
COLUMNS = [c.split()[0] for c in TXN_SCHEMA.split(", ")]


def _latest(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["txn_id"], "last_modified")


def by_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.coalesce(F.date_format("txn_date", "yyyy-MM"), F.lit(UNDATED)))


def months_written(table: DataFrame) -> set[str]:
    """The months for which a table partitioned by month has files."""
    folders = {part for file in table.inputFiles() for part in file.split("/")[-2:-1]}
    return {f.removeprefix(f"{MONTH}=") for f in folders if f.startswith(f"{MONTH}=")}


def differing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose row is new, gone or another one."""
    row = F.struct(*[F.col(c) for c in new.columns if c != key])
    left = old.select(F.col(key).alias("_old_key"), row.alias("_old"), F.lit(True).alias("_held"))
    right = new.select(key, row.alias("_new"), F.lit(True).alias("_came"))
    both = left.join(right, F.col("_old_key").eqNullSafe(F.col(key)), "full")
    same = F.col("_held").eqNullSafe(F.col("_came")) & F.col("_old").eqNullSafe(F.col("_new"))
    return both.where(~same).select(F.when(F.col("_came"), F.col(key)).otherwise(F.col("_old_key")).alias(key))


class FactStore:
    """The fact under ``root``, month by month. ``shape``: ``buckets`` and ``most_runs`` of the log."""

    def __init__(self, spark: SparkSession, root: str, **shape: int):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = KeyedLog(spark, f"{self.root}/txns", TXN_SCHEMA, ["txn_id"], _latest, **shape)

    def months(self, before: int | None = None) -> list[Row]:
        """The map of the last version: one row a month."""
        return read_map(self.spark, f"{self.root}/fact", MAP_SCHEMA, before)

    def _paths(self, kind: str, parts: Iterable[Row]) -> list[str]:
        """Folders of months; one whose transactions all lack an account or type has no fact."""
        held = [p for p in parts if kind != "fact" or p["in_fact"] is not False]
        return [f"{self.root}/runs/{p['run']}/{kind}/{MONTH}={p['month']}" for p in held]

    def _parts(self, months: Collection[str] | None) -> list[Row]:
        return [p for p in self.months() if months is None or p["month"] in months]

    def read(self, months: Collection[str] | None = None) -> DataFrame:
        return read_parts(self.spark, FACT_SCHEMA, self._paths("fact", self._parts(months)))

    def transactions(self, months: Collection[str] | None = None) -> DataFrame:
        return read_parts(self.spark, TXN_SCHEMA, self._paths("txns", self._parts(months)))

    def _write(self, rows: DataFrame, schema: str, path: str) -> DataFrame:
        by_month(rows).hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)
        return read_parts(self.spark, schema, [path])

    def _hung(self, table: DataFrame, name: str, key: str, version: int, parts: list[Row]) -> DataFrame:
        """Months whose rows hang on a changed row of a dimension; its state is kept for the next time."""
        held = last_version(self.spark, f"{self.root}/{name}", version)
        now = write_table(table, f"{self.root}/{name}/{version}")
        write_map(self.spark, f"{self.root}/{name}", "n BIGINT", [(now.count(),)], version)
        months = self.spark.createDataFrame([], f"{MONTH} STRING")
        if held is None or not parts:
            return months
        before = self.spark.read.schema(table.schema).parquet(f"{self.root}/{name}/{held}")
        changed = settle(differing(before, now, key).withColumnRenamed(key, "_key"), "changed")
        if changed.isEmpty():
            return months
        rows = read_parts(self.spark, TXN_SCHEMA, self._paths("txns", parts))
        return by_month(rows.join(by_rows(changed), F.col(key).eqNullSafe(F.col("_key")), "left_semi")).select(MONTH)

    def refresh(
        self,
        delivery: DataFrame,
        dim_account: DataFrame,
        dim_transaction_type: DataFrame,
        dim_customer: DataFrame,
        dim_branch: DataFrame,
        dim_date: DataFrame,
        version: int,
    ) -> list[str]:
        """Take in a delivery and the dimensions as they are now; the months that were rebuilt.

        Touched are the months that a new, corrected or moved transaction leaves or enters, and
        those with transactions whose account, branch or type key has changed. A row that is
        delivered again as it was touches nothing. Refreshing a version again gives the same.
        """
        parts = self.months(before=version)
        came = settle(_latest(delivery.select(*COLUMNS)), "came")
        earlier = settle(self.log.matching(came, before=version), "earlier")
        now = settle(_latest(came.unionByName(earlier)), "now")
        changed = settle(differing(earlier, now, "txn_id"), "changed")
        self.log.add(came, version)
        same = F.col("txn_id").eqNullSafe(F.col("_id"))
        ids = by_rows(changed.select(F.col("txn_id").alias("_id")))
        moved = by_month(earlier.unionByName(now).join(ids, same, "left_semi")).select(MONTH)
        chain = (
            dim_account.select("account_id", "account_sk", "customer_id")
            .join(by_rows(star.current_customers(dim_customer, "branch_id"), dim_customer.count()), "customer_id", "left")
            .join(dim_branch.select("branch_id", "branch_sk"), "branch_id", "left")
            .select("account_id", "account_sk", "branch_sk")
        )
        types = dim_transaction_type.select("txn_type", "txn_type_sk")
        hung = self._hung(chain, "chain", "account_id", version, parts).unionByName(self._hung(types, "types", "txn_type", version, parts))
        touched = sorted(r[0] for r in moved.unionByName(hung).distinct().collect())  # one row a month
        kept = read_parts(self.spark, TXN_SCHEMA, self._paths("txns", [p for p in parts if p["month"] in touched]))
        kept = kept.join(ids, same, "left_anti").unionByName(now.join(ids, same, "left_semi"))
        rows = self._write(kept, TXN_SCHEMA, f"{self.root}/runs/{version}/txns")
        fact = star.fact_transaction(rows, dim_account, dim_transaction_type, dim_customer, dim_branch, dim_date)
        in_fact = months_written(self._write(fact, FACT_SCHEMA, f"{self.root}/runs/{version}/fact"))
        counts = by_month(rows).groupBy(MONTH).agg(F.count("*").alias("n")).collect()
        new = [tuple(p) for p in parts if p["month"] not in touched]
        new += [(r[MONTH], version, r["n"], r[MONTH] in in_fact) for r in counts]
        write_map(self.spark, f"{self.root}/fact", MAP_SCHEMA, sorted(new), version)
        return touched
