"""Daily cash reports, counts and lookups over the star."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.functions.columns import cash_credit, money
from vigilmart.operators.star import current_customers
from vigilmart.operators.keys import dense_key
from vigilmart.sources.workspace import by_rows


def daily_sums(rows: DataFrame, account_key: str) -> DataFrame:
    """Count and sum per account and day."""
    return rows.groupBy(account_key, "txn_date").agg(
        F.count("*").alias("n"), F.sum("amount").alias("total")
    )


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), money(F.sum("total")).alias("total"))


def roll_up_to_customer(
    daily: DataFrame, account_key: str, dim_account: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """Daily account sums to daily sums of the current customers.

    They are summed per customer and day before they meet the customers, so a customer with
    very many accounts brings one row per day to the join.
    """
    owners = by_rows(dim_account.select(account_key, "customer_id"), dim_account.count())
    owned = daily.join(owners, account_key)
    per_customer = _summed(owned, "customer_id", "txn_date")
    names = by_rows(current_customers(dim_customer, "full_name"), dim_customer.count())
    named = per_customer.join(names, "customer_id")
    return _summed(named, "customer_id", "full_name", "txn_date")


def _customer_days(
    fact: DataFrame, dim_account: DataFrame, dim_customer: DataFrame, rows: Column
) -> DataFrame:
    # One row per account and day is all that leaves the scan of the facts, so a hot
    # account reaches no join with all of them.
    daily = daily_sums(fact.where(rows), "account_sk")
    return roll_up_to_customer(daily, "account_sk", dim_account, dim_customer)


def _versions_days(fact: DataFrame, dim_customer: DataFrame, rows: Column) -> DataFrame:
    # The fact names the customer version itself, so the account hop falls away.
    daily = daily_sums(fact.where(rows), "customer_sk")
    versions = dim_customer.select("customer_sk", "customer_id", "full_name")
    return _summed(daily.join(versions, "customer_sk"), "customer_id", "full_name", "txn_date")


def over_limit(customer_days: DataFrame, limit: Decimal = settings.CASH_LIMIT) -> DataFrame:
    return customer_days.where(F.col("total") > F.lit(limit)).select(
        "customer_id",
        "full_name",
        "txn_date",
        F.col("n").alias("cash_txn_count"),
        F.col("total").alias("total_cash"),
    )


def ctr_candidates(
    fact: DataFrame,
    dim_account: DataFrame,
    dim_customer: DataFrame,
    limit: Decimal = settings.CASH_LIMIT,
) -> DataFrame:
    """Customer days whose cash credits sum to more than the limit."""
    return over_limit(_customer_days(fact, dim_account, dim_customer, cash_credit()), limit)


def ctr_by_customer_key(
    fact: DataFrame, dim_customer: DataFrame, limit: Decimal = settings.CASH_LIMIT
) -> DataFrame:
    """The same report from a fact that carries customer_sk, with the customer as in the
    version the fact points to."""
    return over_limit(_versions_days(fact, dim_customer, cash_credit()), limit)


def structuring_flags(
    fact: DataFrame,
    dim_account: DataFrame,
    dim_customer: DataFrame,
    limit: Decimal = settings.CASH_LIMIT,
    min_deposits: int = settings.MIN_SPLIT_DEPOSITS,
) -> DataFrame:
    """Customer days with several cash credits below the limit that sum to more than it."""
    below = cash_credit() & (F.col("amount") < F.lit(limit))
    return split_deposits(
        _customer_days(fact, dim_account, dim_customer, below), limit, min_deposits
    )


def structuring_by_customer_key(
    fact: DataFrame,
    dim_customer: DataFrame,
    limit: Decimal = settings.CASH_LIMIT,
    min_deposits: int = settings.MIN_SPLIT_DEPOSITS,
) -> DataFrame:
    below = cash_credit() & (F.col("amount") < F.lit(limit))
    return split_deposits(_versions_days(fact, dim_customer, below), limit, min_deposits)


def split_deposits(
    customer_days: DataFrame,
    limit: Decimal = settings.CASH_LIMIT,
    min_deposits: int = settings.MIN_SPLIT_DEPOSITS,
) -> DataFrame:
    many = (F.col("n") >= min_deposits) & (F.col("total") > F.lit(limit))
    return customer_days.where(many).select(
        "customer_id",
        "full_name",
        "txn_date",
        F.col("n").alias("deposit_count"),
        F.col("total").alias("total_cash"),
    )


def ranked(report: DataFrame) -> DataFrame:
    """The report with its rank, from the largest total down, numbered without a single task."""
    keyed = report.withColumn("_falling", -F.col("total_cash"))
    numbered = dense_key(keyed, ["_falling", "customer_id", "txn_date"], "rank").drop("_falling")
    return numbered.orderBy("rank")


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Labelled row counts, one per table."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
        for name, df in tables.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of each column, from one scan of all of them."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
    )
    combinations = df.select(*columns).distinct()
    return (
        combinations.select(F.inline(pairs))
        .distinct()
        .orderBy("column_name", F.col("value").asc_nulls_last())
    )
