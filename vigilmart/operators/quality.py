"""Data-quality scorecard: fifteen checks from one aggregate per table, and a gate.

A table yields its measures as rows (measure, n). The scorecard unions them, turns them
into one row and derives the checks from it. A single check selects its own measures, and
Spark prunes the others.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.sources.workspace import by_rows


class QualityGateError(RuntimeError):
    """The scorecard has failing checks."""


@dataclass(frozen=True)
class Tables:
    """The tables the scorecard looks at."""

    bronze: Mapping[str, DataFrame]
    accounts: DataFrame
    transactions: DataFrame
    dim_customer: DataFrame
    dim_account: DataFrame
    fact: DataFrame


# Check name -> (category, metric text after the count)
ZERO_CHECKS = {
    "pk_dim_customer_unique": ("uniqueness", "duplicate current customer_id"),
    "pk_dim_account_unique": ("uniqueness", "duplicate account_id"),
    "pk_fact_txn_unique": ("uniqueness", "duplicate txn_id"),
    "null_customer_id": ("completeness", "null customer_id"),
    "null_ssn": ("completeness", "null ssn (current rows)"),
    "fk_account_to_customer": ("integrity", "orphan accounts (no current customer)"),
    "fk_fact_to_account": ("integrity", "fact rows with no dim_account"),
    "scd2_one_current_per_customer": ("scd2", "customers with != 1 current row"),
    "accepted_txn_type": ("validity", "rows with unexpected txn_type"),
    "accepted_direction": ("validity", "rows with unexpected direction"),
    "amount_positive": ("validity", "rows with amount <= 0"),
}
RECONCILIATION_CHECK = "fact_vs_silver_txns"
CARDINALITY_ENTITIES = ("customers", "accounts", "transactions")


def customer_measures(dim_customer: DataFrame) -> DataFrame:
    """One count per customer serves uniqueness, completeness and the history check."""
    current = F.coalesce(F.col("is_current"), F.lit(False))
    per_customer = dim_customer.groupBy("customer_id").agg(
        F.count("*").alias("versions"),
        F.count_if(current).alias("current_rows"),
        F.count_if(current & F.col("ssn").isNull()).alias("no_ssn"),
    )
    return per_customer.agg(
        F.count_if(F.col("current_rows") > 1).alias("pk_dim_customer_unique"),
        F.sum(F.when(F.col("customer_id").isNull(), F.col("versions"))).alias("null_customer_id"),
        F.sum("no_ssn").alias("null_ssn"),
        # Only customers that have a current row are looked at, as in the duplicate check.
        F.count_if((F.col("current_rows") != 1) & (F.col("current_rows") > 0)).alias(
            "scd2_one_current_per_customer"
        ),
        F.count_if(F.col("current_rows") != 1).alias("scd2_one_current_strict"),
    )


def duplicate_measure(df: DataFrame, key: str, measure: str) -> DataFrame:
    repeats = df.groupBy(key).agg(F.count("*").alias("n"))
    return repeats.agg(F.count_if(F.col("n") > 1).alias(measure))


def orphan_measure(
    child: DataFrame, parent: DataFrame, key: str, measure: str, rows: Column | None = None
) -> DataFrame:
    """Child rows whose key has no parent; counted per key first, so hot keys are one row.

    ``rows``: how many rows one of ``child`` stands for, if it is counted already.
    """
    per_key = child.groupBy(key).agg((F.count("*") if rows is None else F.sum(rows)).alias("n"))
    orphans = per_key.join(by_rows(parent.select(key), parent.count()), key, "left_anti")
    return orphans.agg(F.sum("n").alias(measure))


def transaction_counts() -> list[Column]:
    return [
        F.count("*").alias("silver_rows"),
        F.count_if(~F.col("txn_type").isin(*settings.TXN_TYPES)).alias("accepted_txn_type"),
        F.count_if(~F.col("direction").isin(*settings.DIRECTIONS)).alias("accepted_direction"),
        F.count_if(F.col("amount") <= 0).alias("amount_positive"),
    ]


def transaction_measures(transactions: DataFrame) -> DataFrame:
    return transactions.agg(*transaction_counts())


def row_measure(df: DataFrame, measure: str) -> DataFrame:
    return df.agg(F.count("*").alias(measure))


def _combined(frames: list[DataFrame]) -> DataFrame:
    """One-row frames with different measures as a single row."""
    longs = []
    for frame in frames:
        pairs = [
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("bigint").alias("n"))
            for c in frame.columns
        ]
        longs.append(frame.select(F.inline(F.array(*pairs))))
    measures = [c for frame in frames for c in frame.columns]
    return reduce(DataFrame.unionByName, longs).agg(
        *[
            F.coalesce(F.max(F.when(F.col("measure") == m, F.col("n"))), F.lit(0)).alias(m)
            for m in measures
        ]
    )


def _check(name: str, category: str, passed: Column, metric: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(category).alias("category"),
        F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        metric.alias("metric"),
    )


def _text(count: str) -> Column:
    return F.col(count).cast("string")


def _cardinality_check(entity: str, expected: int) -> Column:
    count = f"bronze_{entity}_count"
    metric = F.concat(F.lit(f"expected={expected} actual="), _text(count))
    return _check(count, "rowcount", F.col(count) == expected, metric)


def _reconciliation_check() -> Column:
    metric = F.concat(F.lit("fact="), _text("fact_rows"), F.lit(" silver="), _text("silver_rows"))
    matches = F.col("fact_rows") == F.col("silver_rows")
    return _check(RECONCILIATION_CHECK, "reconciliation", matches, metric)


def _zero_check(name: str) -> Column:
    category, text = ZERO_CHECKS[name]
    return _check(name, category, F.col(name) == 0, F.concat(_text(name), F.lit(f" {text}")))


def _rows(measures: DataFrame, checks: list[Column]) -> DataFrame:
    return measures.select(F.inline(F.array(*checks)))


def rowcount_checks(bronze: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    frames = [row_measure(bronze[e], f"bronze_{e}_count") for e in CARDINALITY_ENTITIES]
    checks = [_cardinality_check(e, expected[e]) for e in CARDINALITY_ENTITIES]
    return _rows(_combined(frames), checks)


def reconciliation_check(fact: DataFrame, transactions: DataFrame) -> DataFrame:
    frames = [row_measure(fact, "fact_rows"), row_measure(transactions, "silver_rows")]
    return _rows(_combined(frames), [_reconciliation_check()])


def zero_check(name: str, measures: DataFrame) -> DataFrame:
    """One check from the measures of its table."""
    return _rows(_combined([measures.select(name)]), [_zero_check(name)])


def strict_one_current(dim_customer: DataFrame) -> DataFrame:
    """Also counts customers that have no current row at all."""
    measures = _combined([customer_measures(dim_customer).select("scd2_one_current_strict")])
    name = "scd2_one_current_strict"
    metric = F.concat(_text(name), F.lit(" customers with != 1 current row"))
    return _rows(measures, [_check(name, "scd2", F.col(name) == 0, metric)])


def scorecard(t: Tables, expected: Mapping[str, int] | None) -> DataFrame:
    """All checks, unordered; those of row counts only where the counts to expect are given."""
    fact = [
        row_measure(t.fact, "fact_rows"),
        transaction_measures(t.transactions),
        duplicate_measure(t.fact, "txn_id", "pk_fact_txn_unique"),
        orphan_measure(t.fact, t.dim_account, "account_sk", "fk_fact_to_account"),
    ]
    return scorecard_with(fact, t.bronze, t.accounts, t.dim_customer, t.dim_account, expected)


def scorecard_with(
    fact_measures: list[DataFrame],
    bronze: Mapping[str, DataFrame],
    accounts: DataFrame,
    dim_customer: DataFrame,
    dim_account: DataFrame,
    expected: Mapping[str, int] | None,
) -> DataFrame:
    """The scorecard where the measures of the transactions and the fact are known already."""
    current = dim_customer.where("is_current")
    counted = CARDINALITY_ENTITIES if expected is not None else ()
    frames = [
        *[row_measure(bronze[e], f"bronze_{e}_count") for e in counted],
        *fact_measures,
        customer_measures(dim_customer).drop("scd2_one_current_strict"),
        duplicate_measure(dim_account, "account_id", "pk_dim_account_unique"),
        orphan_measure(accounts, current, "customer_id", "fk_account_to_customer"),
    ]
    checks = [
        *[_cardinality_check(e, expected[e]) for e in counted],
        _reconciliation_check(),
        *[_zero_check(name) for name in ZERO_CHECKS],
    ]
    return _rows(_combined(frames), checks)


def for_display(card: DataFrame) -> DataFrame:
    """Failing checks first, with their place; a scorecard has one row per check."""
    place = F.row_number().over(Window.orderBy("status", "category", "check_name"))
    return card.withColumn("place", place).orderBy("place")


def gate(card: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAIL")
    return card.agg(failed.alias("n")).select(
        F.when(F.col("n") == 0, F.lit("ALL CHECKS PASSED"))
        .otherwise(F.concat(_text("n"), F.lit(" CHECK(S) FAILED")))
        .alias("overall_result")
    )


def enforce(card: DataFrame) -> None:
    """Raise when a check fails, naming it. The scorecard has one row per check."""
    failing = [f"{r.check_name}: {r.metric}" for r in card.where("status = 'FAIL'").collect()]
    if failing:
        raise QualityGateError(f"{len(failing)} CHECK(S) FAILED: " + "; ".join(sorted(failing)))
