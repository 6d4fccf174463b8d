"""Star schema: dimensions and the transaction fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.functions.columns import date_key, txn_type_label, weekday_from_sunday
from vigilmart.operators.keys import dense_key
from vigilmart.sources.workspace import by_rows


EARLIEST = "0001-01-01 00:00:00"


def dim_date(
    spark: SparkSession,
    start: str = settings.CALENDAR_START,
    days: int = settings.CALENDAR_DAYS,
) -> DataFrame:
    day = F.col("date")
    spine = spark.range(days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date")
    )
    return spine.select(
        date_key(day).alias("date_sk"),
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.dayofmonth(day).alias("day"),
        weekday_from_sunday(day).alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        weekday_from_sunday(day).isin(0, 6).alias("is_weekend"),
    )


def calendar_activity(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """The calendar with the transactions of each day: days without any count zero, days
    outside the calendar, and transactions without a day, have no key."""
    days = fact.groupBy(F.col("txn_date").alias("_day")).agg(
        F.count("*").alias("_n"), F.sum("amount").alias("_total")
    )
    joined = dim_date.join(days, F.col("date") == F.col("_day"), "full")
    return joined.withColumns(
        {
            "date": F.coalesce("date", "_day"),
            "txn_count": F.coalesce("_n", F.lit(0)),
            "total_amount": F.coalesce("_total", F.lit(0)).cast("decimal(38,2)"),
        }
    ).drop("_day", "_n", "_total")


def dim_branch(dim_customer: DataFrame) -> DataFrame:
    """Branches of all customer versions, not only the current ones."""
    branches = dim_customer.select("branch_id").where("branch_id IS NOT NULL").distinct()
    return dense_key(branches, ["branch_id"], "branch_sk").withColumn(
        "branch_name", F.concat(F.lit("Branch "), F.col("branch_id").cast("string"))
    )


def dim_transaction_type(transactions: DataFrame) -> DataFrame:
    types = transactions.select("txn_type").distinct()
    return dense_key(types, ["txn_type"], "txn_type_sk").withColumn(
        "txn_type_desc", txn_type_label(F.col("txn_type"))
    )


def dim_account(accounts: DataFrame) -> DataFrame:
    rows = accounts.select("account_id", "customer_id", "account_type", "open_date")
    return dense_key(rows, ["account_id"], "account_sk")


def current_customers(dim_customer: DataFrame, *columns: str) -> DataFrame:
    return dim_customer.where("is_current").select("customer_id", *columns)


def _star(
    transactions: DataFrame,
    account_chain: DataFrame,
    dim_transaction_type: DataFrame,
    dim_date: DataFrame,
    matches: Column,
    *extra: str,
) -> DataFrame:
    """Join the facts once: type and calendar, then the account with all that hangs on it."""
    facts = transactions.alias("t")
    types = dim_transaction_type.select("txn_type", "txn_type_sk")
    calendar = dim_date.select(F.col("date").alias("txn_date"), "date_sk")
    return (
        facts.join(types, "txn_type")
        .join(calendar, "txn_date", "left")
        .join(account_chain.alias("a"), matches)
        .select(
            "txn_id",
            "account_sk",
            "txn_type_sk",
            "branch_sk",
            "date_sk",
            "txn_date",
            "txn_type",
            "direction",
            "amount",
            *extra,
        )
    )


def fact_transaction(
    transactions: DataFrame,
    dim_account: DataFrame,
    dim_transaction_type: DataFrame,
    dim_customer: DataFrame,
    dim_branch: DataFrame,
    dim_date: DataFrame,
    with_customer_sk: bool = False,
) -> DataFrame:
    """One row per transaction with its dimension keys.

    Account, current customer and branch are joined with each other first: the facts, by
    far the largest side, then move at most once, on account_id. No side is forced into a
    broadcast; dimensions come as written tables, so Spark broadcasts those of few rows and
    sort-merges the others, splitting a hot account's partition.
    """
    extra = ["customer_sk"] if with_customer_sk else []
    chain = (
        dim_account.select("account_id", "account_sk", "customer_id")
        .join(by_rows(current_customers(dim_customer, "branch_id", *extra), dim_customer.count()), "customer_id", "left")
        .join(dim_branch.select("branch_id", "branch_sk"), "branch_id", "left")
        .select("account_id", "account_sk", "branch_sk", *extra)
    )
    same_account = F.col("t.account_id") == F.col("a.account_id")
    chain = by_rows(chain, dim_account.count())
    return _star(transactions, chain, dim_transaction_type, dim_date, same_account, *extra)


def version_spans(dim_customer: DataFrame) -> DataFrame:
    """Per customer the spans of time and the version valid in each.

    The first version counts as open towards the past, as its start is only the load time.
    Time that no version covers becomes a span without a version, so a join on the spans
    loses no transaction.
    """
    by_start = Window.partitionBy("customer_id").orderBy("valid_from", "customer_sk")
    previous_from = F.lag("valid_from").over(by_start)
    next_from = F.lead("valid_from").over(by_start)
    bounded = dim_customer.select(
        "customer_id",
        "customer_sk",
        "branch_id",
        "valid_to",
        F.when(previous_from.isNotNull(), F.col("valid_from")).alias("span_from"),
        next_from.alias("next_from"),
    )
    version = F.struct("customer_sk", "branch_id", "span_from", F.col("valid_to").alias("span_to"))
    gap = F.struct(
        F.lit(None).cast("bigint").alias("customer_sk"),
        F.lit(None).cast("int").alias("branch_id"),
        F.col("valid_to").alias("span_from"),
        F.col("next_from").alias("span_to"),
    )
    open_after = F.col("valid_to").isNotNull() & (
        F.col("next_from").isNull() | (F.col("valid_to") < F.col("next_from"))
    )
    spans = F.when(open_after, F.array(version, gap)).otherwise(F.array(version))
    return bounded.select("customer_id", F.inline(spans))


def fact_point_in_time(
    transactions: DataFrame,
    dim_account: DataFrame,
    dim_transaction_type: DataFrame,
    dim_customer: DataFrame,
    dim_branch: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """The fact with the customer version valid on the transaction date.

    A customer has at most one version per load, which bounds the spans an account brings
    into the join; the time test is part of the join, so no other pair leaves it.
    """
    chain = (
        dim_account.select("account_id", "account_sk", "customer_id")
        .join(version_spans(dim_customer), "customer_id", "left")
        .join(dim_branch.select("branch_id", "branch_sk"), "branch_id", "left")
        .select("account_id", "account_sk", "branch_sk", "customer_sk", "span_from", "span_to")
    )
    # A transaction without a date meets the first span, to stay in. It gets that version
    # only if it is valid at all times.
    sure = F.col("txn_date").isNotNull() | (F.col("span_from").isNull() & F.col("span_to").isNull())
    at = F.coalesce(F.col("t.txn_date").cast("timestamp_ntz"), F.lit(EARLIEST).cast("timestamp_ntz"))
    valid = (
        (F.col("t.account_id") == F.col("a.account_id"))
        & (F.col("a.span_from").isNull() | (at >= F.col("a.span_from")))
        & (F.col("a.span_to").isNull() | (at < F.col("a.span_to")))
    )
    extra = ("customer_sk", "span_from", "span_to")
    fact = _star(transactions, chain, dim_transaction_type, dim_date, valid, *extra)
    of_version = {c: F.when(sure, F.col(c)) for c in ("branch_sk", "customer_sk")}
    return fact.withColumns(of_version).drop("span_from", "span_to")


def fact_reconciliation(fact: DataFrame, transactions: DataFrame) -> DataFrame:
    counts = fact.agg(F.count("*").alias("fact_rows")).unionByName(
        transactions.agg(F.count("*").alias("silver_rows")), allowMissingColumns=True
    )
    return counts.agg(
        F.max("fact_rows").alias("fact_rows"), F.max("silver_rows").alias("silver_rows")
    )
