"""Figures and checks kept beside the fact: a refresh reads the months that changed, no others.

For each month of a ``FactStore`` there are small tables that add up over months: sums by day
and branch, cash by account and day, rows by account, and the customers over the reporting
limit as bitmaps, so that distinct customers are exact over any months. Transaction ids lie in
sorted runs whose ranges are known, so ids that repeat are looked for only in runs that may hold them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Collection, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.functions.columns import cash_credit, money
from vigilmart.operators import kpis, quality, reports
from vigilmart.operators.star import current_customers
from vigilmart.plans.incremental import UNDATED, FactStore, by_month, differing, months_written
from vigilmart.sources.keyed import last_version, read_map, read_parts, write_map
from vigilmart.sources.workspace import MONTH, by_rows, settle, write_table

SCHEMAS = {
    "days": "txn_date DATE, branch_sk BIGINT, n BIGINT, amounts BIGINT, total DECIMAL(38,2), cash DECIMAL(38,2), "
    "cash_credits DECIMAL(38,2)",
    "accounts": "account_sk BIGINT, n BIGINT",
    "cash": "account_sk BIGINT, txn_date DATE, n BIGINT, total DECIMAL(38,2)",
    "keys": "txn_id BIGINT, in_month STRING",
    "over_limit": "bucket BIGINT, customers BINARY",
}
REPEATS_SCHEMA = "txn_id BIGINT, in_month STRING, n BIGINT"
# Of each month: the run of the fact it was made from, the versions that wrote its sums and its
# bitmaps, what tables it has rows in, and its counts.
MEASURES = ("silver_rows", "accepted_txn_type", "accepted_direction", "amount_positive", "fact_rows")
MAP_SCHEMA = "month STRING, run BIGINT, at BIGINT, limit_at BIGINT, held STRING, " + ", ".join(f"{m} BIGINT" for m in MEASURES)
FILE_SCHEMA = "month STRING, at BIGINT, file STRING, low BIGINT, high BIGINT, nulls BOOLEAN"


def meeting(files: Collection[Row], asked: Collection[Row]) -> list[Row]:
    """The files that may hold a key of one of ``asked``, by their ranges."""
    spans: list[list[int]] = []
    for low, high in sorted((f["low"], f["high"]) for f in asked if f["low"] is not None):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    starts = [low for low, _ in spans]
    nulls = any(f["nulls"] for f in asked)

    def meets(file: Row) -> bool:
        if nulls and file["nulls"]:
            return True
        if file["low"] is None:
            return False
        before = bisect_right(starts, file["high"])  # spans that begin within or before the file
        return before > 0 and spans[before - 1][1] >= file["low"]

    return [f for f in files if meets(f)]


class Rollups:
    """Sums of the months of ``store``, under ``root``; ``limit`` is that of the cash report."""

    def __init__(self, store: FactStore, root: str, limit: Decimal = settings.CASH_LIMIT):
        self.store, self.spark, self.root, self.limit = store, store.spark, root.rstrip("/"), limit

    def months(self, before: int | None = None) -> list[Row]:
        """The map of the last version: one row a month."""
        return read_map(self.spark, f"{self.root}/months", MAP_SCHEMA, before)

    def key_files(self, before: int | None = None) -> list[Row]:
        return read_map(self.spark, f"{self.root}/files", FILE_SCHEMA, before)

    def _folder(self, kind: str, version: int) -> str:
        return f"{self.root}/runs/{version}/{kind}"

    def _part(self, kind: str, parts: Collection[Row]) -> DataFrame:
        at = "limit_at" if kind == "over_limit" else "at"
        held = [p for p in parts if kind in p["held"].split()]
        return read_parts(self.spark, SCHEMAS[kind], [f"{self._folder(kind, p[at])}/{MONTH}={p['month']}" for p in held])

    def _write(self, rows: DataFrame, kind: str, version: int) -> DataFrame:
        path = self._folder(kind, version)
        rows.write.mode("overwrite").partitionBy(MONTH).parquet(path)
        return read_parts(self.spark, SCHEMAS[kind], [path])

    def _write_keys(self, fact: DataFrame, version: int) -> list[tuple]:
        """Ids sorted within a month; of each file, its range."""
        keys = by_month(fact).select("txn_id", F.col(MONTH).alias("in_month"), MONTH)
        ranged = keys.repartitionByRange(MONTH, "txn_id").sortWithinPartitions(MONTH, "txn_id")
        written = self._write(ranged, "keys", version)
        stats = written.groupBy("in_month", F.col("_metadata.file_name").alias("file")).agg(
            F.min("txn_id").alias("low"),
            F.max("txn_id").alias("high"),
            F.bool_or(F.col("txn_id").isNull()).alias("nulls"),
        )
        return [(r["in_month"], version, r["file"], r["low"], r["high"], r["nulls"]) for r in stats.collect()]

    def _key_rows(self, files: Collection[Row]) -> DataFrame:
        paths = [f"{self._folder('keys', f['at'])}/{MONTH}={f['month']}/{f['file']}" for f in files]
        return read_parts(self.spark, SCHEMAS["keys"], paths)

    def _find_repeats(self, changed: set[str], kept: list[Row], new: list[Row], version: int, before: int | None) -> None:
        """Ids in more than one row of the fact, with their rows by month.

        Rows of unchanged months come from those found before, or from the files whose range
        meets one of the new files.
        """
        counted = lambda rows: rows.groupBy("txn_id", "in_month").agg(F.count("*").alias("n"))
        keys = self._key_rows(new)
        came = counted(keys)
        asked = by_rows(came.select(F.col("txn_id").alias("_id")).distinct(), keys.count())
        there = self._key_rows(meeting(kept, new)).join(asked, F.col("txn_id").eqNullSafe(F.col("_id")), "left_semi")
        rows = came.unionByName(counted(there))
        if before is not None:
            known = self.spark.read.schema(REPEATS_SCHEMA).parquet(f"{self.root}/repeats/{before}")
            rows = rows.unionByName(known.where(~F.col("in_month").isin(*changed)) if changed else known)
        rows = rows.distinct()
        total = F.sum("n").alias("_total")
        often = rows.groupBy(F.col("txn_id").alias("_id")).agg(total).where("_total > 1").drop("_total")
        found = rows.join(often, F.col("txn_id").eqNullSafe(F.col("_id")), "left_semi")
        write_table(found, f"{self.root}/repeats/{version}")

    def _moved_accounts(self, owners: DataFrame, version: int, kept: list[Row]) -> set[str]:
        """Unchanged months with cash of accounts that have changed hands since the version before."""
        held = last_version(self.spark, f"{self.root}/owners", version)
        now = write_table(owners, f"{self.root}/owners/{version}")
        write_map(self.spark, f"{self.root}/owners", "n BIGINT", [(version,)], version)
        if held is None or not kept:
            return set()
        before = self.spark.read.schema(owners.schema).parquet(f"{self.root}/owners/{held}")
        moved = settle(differing(before, now, "account_sk").withColumnRenamed("account_sk", "_key"), "moved")
        if moved.isEmpty():
            return set()
        cash = self._part("cash", kept).join(by_rows(moved), F.col("account_sk").eqNullSafe(F.col("_key")), "left_semi")
        return {r[0] for r in by_month(cash).select(MONTH).distinct().collect()}

    def refresh(self, dim_account: DataFrame, dim_customer: DataFrame, version: int) -> list[str]:
        """Follow the store's last version; the months whose facts were read.

        A month is read if the run of the fact it was made from is no longer the store's. The
        customers over the limit are found anew, from the cash by account and day, also where
        an account got another owner or its owner is no longer current. Refreshing a version
        again gives the same.
        """
        held = {p["month"]: p for p in self.months(before=version)}
        before = last_version(self.spark, f"{self.root}/months", version)
        runs = {p["month"]: p["run"] for p in self.store.months()}
        stale = {m for m, run in runs.items() if m not in held or held[m]["run"] != run}
        kept = [p for m, p in held.items() if m in runs and m not in stale]

        fact = self.store.read(stale)
        days = by_month(fact).groupBy(MONTH, "txn_date", "branch_sk").agg(*kpis.sums())
        days = self._write(days, "days", version)
        accounts = by_month(fact).groupBy(MONTH, "account_sk").agg(F.count("*").alias("n"))
        accounts = self._write(accounts, "accounts", version)
        cash = reports.daily_sums(fact.where(cash_credit()), "account_sk").withColumn("total", money(F.col("total")))
        cash = self._write(by_month(cash), "cash", version)
        written = {"days": months_written(days), "accounts": months_written(accounts), "cash": months_written(cash)}

        owned = dim_account.select("account_sk", "customer_id").join(
            by_rows(current_customers(dim_customer).distinct(), dim_customer.count()), "customer_id", "left_semi"
        )
        moved = self._moved_accounts(owned.select("account_sk", "customer_id"), version, kept)
        again = self._part("cash", [p for p in kept if p["month"] in moved]).unionByName(cash)
        customer_days = reports.roll_up_to_customer(again, "account_sk", dim_account, dim_customer)
        over = by_month(reports.over_limit(customer_days, self.limit))
        bitmaps = over.groupBy(MONTH, F.bitmap_bucket_number("customer_id").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("customers")
        )
        written["over_limit"] = months_written(self._write(bitmaps, "over_limit", version))

        files = self._write_keys(fact, version)
        kept_files = [f for f in self.key_files(before=version) if f["month"] in runs and f["month"] not in stale]
        names = [c.split()[0] for c in FILE_SCHEMA.split(", ")]
        new_files = [Row(**dict(zip(names, f, strict=True))) for f in files]
        self._find_repeats(stale | (held.keys() - runs.keys()), kept_files, new_files, version, before)
        write_map(self.spark, f"{self.root}/files", FILE_SCHEMA, [*map(tuple, kept_files), *files], version)

        counts = by_month(self.store.transactions(stale)).groupBy(MONTH).agg(*quality.transaction_counts())
        facts = by_month(days).groupBy(MONTH).agg(F.sum("n").alias("fact_rows"))
        rows = []
        for p in kept:
            if p["month"] in moved:
                names_held = (set(p["held"].split()) - {"over_limit"}) | {k for k in ("over_limit",) if p["month"] in written[k]}
                p = Row(**{**p.asDict(), "limit_at": version, "held": " ".join(sorted(names_held))})
            rows.append(tuple(p))
        for r in counts.join(facts, MONTH, "left").collect():  # one row a month
            names_held = " ".join(sorted(k for k, months in written.items() if r[MONTH] in months))
            rows.append((r[MONTH], runs[r[MONTH]], version, version, names_held, *[r[m] or 0 for m in MEASURES]))
        write_map(self.spark, f"{self.root}/months", MAP_SCHEMA, sorted(rows), version)
        return sorted(stale)

    def _range(self, first: str | None, last: str | None) -> list[Row]:
        """Months from ``first`` to ``last``, both included; without bounds all, undated ones too."""
        if first is None and last is None:
            return self.months()
        dated = [p for p in self.months() if p["month"] != UNDATED]
        return [p for p in dated if (first is None or p["month"] >= first) and (last is None or p["month"] <= last)]

    def days(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Sums by day and branch."""
        return self._part("days", self._range(first, last))

    def ctr_customers(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """How many customers have a day over the limit in these months."""
        per_bucket = self._part("over_limit", self._range(first, last)).groupBy("bucket")
        counts = per_bucket.agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("n"))
        return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("ctr_customers"))

    def summary(self, first: str | None = None, last: str | None = None) -> DataFrame:
        return kpis.summary(self.days(first, last).agg(*kpis.added()), self.ctr_customers(first, last))

    def _added_by(self, key: str, first: str | None, last: str | None) -> DataFrame:
        added = self.days(first, last).groupBy(key).agg(*kpis.added())
        return added.select(key, F.col("n").alias("txn_count"), F.col("total").alias("total_amount"))

    def branch_breakdown(self, dim_branch: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
        return kpis.named_branches(self._added_by("branch_sk", first, last), dim_branch)

    def volume_trend(self, first: str | None = None, last: str | None = None) -> DataFrame:
        return self._added_by("txn_date", first, last)

    def repeats(self) -> DataFrame:
        """Transaction ids in more than one row of the fact, with their rows by month."""
        version = last_version(self.spark, f"{self.root}/months")
        if version is None:
            return self.spark.createDataFrame([], REPEATS_SCHEMA)
        return self.spark.read.schema(REPEATS_SCHEMA).parquet(f"{self.root}/repeats/{version}")

    def scorecard(
        self,
        bronze: Mapping[str, DataFrame],
        accounts: DataFrame,
        dim_customer: DataFrame,
        dim_account: DataFrame,
        expected: Mapping[str, int] | None,
    ) -> DataFrame:
        """The scorecard; what it says of transactions and fact comes from the months' counts."""
        version = last_version(self.spark, f"{self.root}/months")
        paths = [] if version is None else [f"{self.root}/months/map/v={version}"]
        months = read_parts(self.spark, MAP_SCHEMA, paths)
        measures = [
            months.agg(*[F.sum(m).alias(m) for m in MEASURES]),
            self.repeats().agg(_distinct_keys().alias("pk_fact_txn_unique")),
            quality.orphan_measure(
                self._part("accounts", self.months()), dim_account, "account_sk", "fk_fact_to_account", F.col("n")
            ),
        ]
        return quality.scorecard_with(measures, bronze, accounts, dim_customer, dim_account, expected)


def _distinct_keys() -> Column:
    """Distinct ids, a missing one counted as one."""
    missing = F.coalesce(F.bool_or(F.col("txn_id").isNull()), F.lit(False))
    return F.count_distinct("txn_id") + missing.cast("bigint")
