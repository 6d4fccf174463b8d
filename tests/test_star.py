from __future__ import annotations

from datetime import date

import pytest
from frames import FEB, JAN, accounts, customers, dim, rows, transactions

from pyspark.sql import functions as F

from vigilmart.operators import star


def build(spark, txns, accts, dim_customer, fact=star.fact_transaction, **options):
    return fact(
        txns,
        star.dim_account(accts),
        star.dim_transaction_type(txns),
        dim_customer,
        star.dim_branch(dim_customer),
        star.dim_date(spark),
        **options,
    )


def test_calendar(spark):
    days = star.dim_date(spark)
    assert days.count() == 2922
    last = days.orderBy("date").tail(1)[0]
    assert (last.date, last.date_sk) == (date(2027, 12, 31), 20271231)
    sunday = days.where("date = DATE '2023-01-01'").first()
    assert (sunday.day_of_week, sunday.day_name, sunday.month_name) == (0, "Sun", "Jan")
    assert sunday.is_weekend and (sunday.year, sunday.quarter, sunday.day) == (2023, 1, 1)
    assert days.where("is_weekend AND day_name NOT IN ('Sat', 'Sun')").count() == 0


def test_branches_come_from_all_versions_and_skip_null(spark):
    held = dim(
        spark,
        (1, 1, "A", "s", 12, JAN, FEB, False),
        (2, 1, "A", "s", 3, FEB, None, True),
        (3, 2, "B", "s", None, JAN, None, True),
    )
    assert rows(star.dim_branch(held), "branch_sk", "branch_id", "branch_name") == [
        (1, 3, "Branch 3"),
        (2, 12, "Branch 12"),
    ]


def test_type_labels_and_unknown_and_null_types(spark):
    txns = transactions(
        spark,
        (1, 1, "2024-01-01", "1", "WIRE"),
        (2, 1, "2024-01-01", "1", "CRYPTO"),
        (3, 1, "2024-01-01", "1", None),
    )
    assert rows(star.dim_transaction_type(txns), "txn_type_sk", "txn_type", "txn_type_desc") == [
        (1, "CRYPTO", "CRYPTO"),
        (2, "WIRE", "Wire Transfer"),
        (3, None, None),
    ]


def test_fact_drops_orphans_and_null_types_and_keeps_the_rest(spark):
    txns = transactions(
        spark,
        (1, 10, "2024-01-01", "1"),
        (2, 99, "2024-01-01", "1"),
        (3, 10, "2024-01-01", "1", None),
        (4, 10, "2024-01-01", "1", "CRYPTO"),
        (5, 20, "2019-12-31", "1"),
        (6, 20, "2028-01-01", "1"),
    )
    fact = build(spark, txns, accounts(spark, (10, 1), (20, 2)), customers(spark, 1, branch=4))
    assert rows(fact, "txn_id", "account_sk", "branch_sk", "date_sk") == [
        (1, 1, 1, 20240101),
        (4, 1, 1, 20240101),
        (5, 2, None, None),
        (6, 2, None, None),
    ]
    recon = star.fact_reconciliation(fact, txns).first()
    assert (recon.fact_rows, recon.silver_rows) == (4, 6)


def test_two_current_versions_fan_out(spark):
    held = dim(spark, (1, 1, "A", "s", 1, JAN, None, True), (2, 1, "A", "s", 2, JAN, None, True))
    txns = transactions(spark, (1, 10, "2024-01-01", "1"))
    assert build(spark, txns, accounts(spark, (10, 1)), held).count() == 2


def test_closed_versions_do_not_reach_the_fact(spark):
    held = dim(spark, (1, 1, "A", "s", 1, JAN, FEB, False), (2, 1, "A", "s", 2, FEB, None, True))
    txns = transactions(spark, (1, 10, "2024-01-01", "1"))
    fact = build(spark, txns, accounts(spark, (10, 1)), held, with_customer_sk=True)
    assert rows(fact, "branch_sk", "customer_sk") == [(2, 2)]


def test_point_in_time_takes_the_version_of_the_day(spark):
    held = dim(
        spark,
        (1, 1, "A", "s", 1, "2024-01-10 00:00:00", "2024-01-20 00:00:00", False),
        (2, 1, "A", "s", 2, "2024-01-20 00:00:00", None, True),
    )
    txns = transactions(
        spark,
        (1, 10, "2024-01-01", "1"),
        (2, 10, "2024-01-19", "1"),
        (3, 10, "2024-01-20", "1"),
        (4, 10, "2024-01-21", "1"),
        (5, 20, "2024-01-21", "1"),
    )
    fact = build(
        spark, txns, accounts(spark, (10, 1), (20, 7)), held, fact=star.fact_point_in_time
    )
    assert rows(fact, "txn_id", "customer_sk", "branch_sk") == [
        (1, 1, 1),
        (2, 1, 1),
        (3, 2, 2),
        (4, 2, 2),
        (5, None, None),
    ]


def test_point_in_time_keeps_transactions_that_no_version_covers(spark):
    held = dim(
        spark,
        (1, 1, "A", "s", 1, "2024-01-01 00:00:00", "2024-01-10 00:00:00", False),
        (2, 1, "A", "s", 2, "2024-01-15 00:00:00", "2024-01-20 00:00:00", False),
    )
    days = ["2024-01-05", "2024-01-12", "2024-01-15", "2024-01-25"]
    txns = transactions(spark, *[(i, 10, day, "1") for i, day in enumerate(days)])
    undated = transactions(spark, (4, 10, "2024-01-05", "1")).withColumn("txn_date", F.lit(None).cast("date"))
    txns = txns.unionByName(undated)
    fact = build(spark, txns, accounts(spark, (10, 1)), held, fact=star.fact_point_in_time)
    assert rows(fact, "txn_id", "customer_sk") == [
        (0, 1),
        (1, None),
        (2, 2),
        (3, None),
        (4, None),
    ]


@pytest.mark.parametrize("fact", [star.fact_transaction, star.fact_point_in_time])
def test_empty_inputs(spark, fact):
    empty = build(spark, transactions(spark), accounts(spark), customers(spark), fact=fact)
    assert empty.count() == 0


def test_a_hot_account_is_split(spark, conf):
    """With both sides too big to broadcast, the partition of an account that holds most of
    the facts is cut up at run time, and the result stays whole."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")
    txns = spark.range(0, 60_000, 1, 16).selectExpr(
        "id AS txn_id",
        "CASE WHEN id % 3 < 2 THEN 1 ELSE id % 500 END AS account_id",
        "DATE '2024-01-01' AS txn_date",
        "cast(1 AS decimal(12,2)) AS amount",
        "'CASH' AS txn_type",
        "'CREDIT' AS direction",
    )
    held = customers(spark, *range(500))
    fact = build(spark, txns, accounts(spark, *[(i, i) for i in range(500)]), held)
    assert fact.where("branch_sk IS NOT NULL").count() == 60_000
    counted = fact.select("txn_id", "account_sk")
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
