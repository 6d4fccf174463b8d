from __future__ import annotations

from datetime import date
from decimal import Decimal

from frames import JAN, accounts, customers, dim, rows, transactions

from vigilmart.operators import kpis, reports, star

DAY = "2024-01-02"


def star_of(spark, txns, accts, held):
    dim_account = star.dim_account(accts)
    fact = star.fact_transaction(
        txns,
        dim_account,
        star.dim_transaction_type(txns),
        held,
        star.dim_branch(held),
        star.dim_date(spark),
    )
    return fact, dim_account, held


def ctr(spark, txns, accts, held):
    return reports.ctr_candidates(*star_of(spark, txns, accts, held))


split = reports.structuring_flags


def test_the_limit_itself_is_not_reported(spark):
    txns = transactions(
        spark,
        (1, 10, DAY, "6000.00"),
        (2, 10, DAY, "4000.00"),
        (3, 20, DAY, "6000.00"),
        (4, 20, DAY, "4000.01"),
    )
    found = ctr(spark, txns, accounts(spark, (10, 1), (20, 2)), customers(spark, 1, 2))
    assert rows(found, "customer_id", "txn_date", "cash_txn_count", "total_cash") == [
        (2, date(2024, 1, 2), 2, Decimal("10000.01"))
    ]


def test_only_cash_credits_of_one_day_count(spark):
    txns = transactions(
        spark,
        (1, 10, DAY, "6000"),
        (2, 10, DAY, "6000", "WIRE"),
        (3, 10, DAY, "6000", "CASH", "DEBIT"),
        (4, 10, "2024-01-03", "6000"),
    )
    assert ctr(spark, txns, accounts(spark, (10, 1)), customers(spark, 1)).count() == 0


def test_accounts_of_one_customer_add_up(spark):
    txns = transactions(spark, (1, 10, DAY, "4000"), (2, 11, DAY, "4000"), (3, 11, DAY, "4000"))
    tables = star_of(spark, txns, accounts(spark, (10, 1), (11, 1)), customers(spark, 1))
    assert rows(reports.ctr_candidates(*tables), "cash_txn_count") == [(3,)]
    assert rows(split(*tables), "deposit_count") == [(3,)]


def test_a_deposit_at_the_limit_is_no_split_deposit(spark):
    txns = transactions(
        spark,
        (1, 10, DAY, "10000"),
        *[(i, 10, DAY, "4000") for i in (2, 3, 4)],
        (5, 20, DAY, "10000"),
        (6, 20, DAY, "4000"),
        (7, 20, DAY, "4000"),
    )
    tables = star_of(spark, txns, accounts(spark, (10, 1), (20, 2)), customers(spark, 1, 2))
    assert rows(split(*tables), "customer_id", "deposit_count", "total_cash") == [
        (1, 3, Decimal("12000.00"))
    ]
    assert rows(reports.ctr_candidates(*tables), "customer_id") == [(1,), (2,)]


def test_three_deposits_are_needed(spark):
    txns = transactions(
        spark,
        (1, 10, DAY, "9000"),
        (2, 10, DAY, "9000"),
        *[(i, 20, DAY, "3500") for i in (3, 4, 5)],
    )
    tables = star_of(spark, txns, accounts(spark, (10, 1), (20, 2)), customers(spark, 1, 2))
    assert rows(split(*tables), "customer_id") == [(2,)]
    assert rows(split(*tables, min_deposits=2), "customer_id") == [(1,), (2,)]
    assert rows(split(*tables, limit=Decimal(9500)), "customer_id") == [(2,)]


def test_null_amounts_count_but_add_nothing(spark):
    txns = transactions(spark, (1, 10, DAY, "10001"), (2, 10, DAY, None))
    assert rows(
        ctr(spark, txns, accounts(spark, (10, 1)), customers(spark, 1)), "cash_txn_count", "total_cash"
    ) == [(2, Decimal("10001.00"))]


def test_customers_without_a_current_version_are_left_out(spark):
    held = dim(spark, (1, 1, "A", "s", 1, JAN, "2024-02-01 00:00:00", False))
    txns = transactions(spark, (1, 10, DAY, "20000"))
    assert ctr(spark, txns, accounts(spark, (10, 1)), held).count() == 0


def test_two_current_versions_double_as_in_a_plain_join(spark):
    held = dim(spark, (1, 1, "A", "s", 1, JAN, None, True), (2, 1, "A", "s", 1, JAN, None, True))
    txns = transactions(spark, (1, 10, DAY, "6000"))
    # The fact has the transaction twice, and each copy meets both versions again.
    assert rows(ctr(spark, txns, accounts(spark, (10, 1)), held), "cash_txn_count", "total_cash") == [
        (4, Decimal("24000.00"))
    ]


def test_ranking_is_by_sum_then_customer_and_day(spark):
    txns = transactions(
        spark,
        (1, 10, DAY, "20000"),
        (2, 20, DAY, "30000"),
        (3, 30, "2024-01-03", "20000"),
        (4, 30, DAY, "20000"),
    )
    accts = accounts(spark, (10, 1), (20, 2), (30, 3))
    ranked = reports.ranked(ctr(spark, txns, accts, customers(spark, 1, 2, 3))).collect()
    assert [(r.customer_id, r.txn_date.day) for r in ranked] == [(2, 2), (1, 2), (3, 2), (3, 3)]


def test_distinct_values_are_sorted_and_keep_null(spark):
    txns = transactions(
        spark,
        (1, 1, DAY, "1", "WIRE", "DEBIT"),
        (2, 1, DAY, "1", "CASH", None),
        (3, 1, DAY, "1", "CASH", "CREDIT"),
    )
    found = reports.distinct_values(txns, "txn_type", "direction").collect()
    assert [tuple(r) for r in found] == [
        ("direction", "CREDIT"),
        ("direction", "DEBIT"),
        ("direction", None),
        ("txn_type", "CASH"),
        ("txn_type", "WIRE"),
    ]


def test_facts_are_summed_before_they_are_joined(spark, conf):
    """Below the joins the plan aggregates, and it reads only the columns it needs."""
    conf("spark.sql.adaptive.enabled", "false")
    from vigilmart.plans.catalog import mart

    m = mart(spark, "/root/testdata/sf0.001")
    df = reports.ctr_candidates(m.fact, m.dim_account, m.dim_customer)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    (scan,) = [line for line in lines if "EqualTo(txn_type,CASH)" in line]
    above = "\n".join(lines[: lines.index(scan)])
    assert above.rindex("HashAggregate") > above.rindex("Join")
    assert "EqualTo(direction,CREDIT)" in scan
    assert "txn_id" not in scan.split("ReadSchema")[1]


def test_empty_inputs(spark):
    txns, accts, held = transactions(spark), accounts(spark), customers(spark)
    fact, dim_account, _ = star_of(spark, txns, accts, held)
    found = reports.ctr_candidates(fact, dim_account, held)
    assert found.count() == 0
    assert split(fact, dim_account, held).count() == 0
    assert rows(reports.layer_counts({"a": txns, "b": accts}), "tbl", "row_count") == [("a", 0), ("b", 0)]
    assert kpis.kpi_summary(fact, found).first().asDict() == {
        "total_cash_credits": None,
        "txn_count": 0,
        "avg_txn_value": None,
        "cash_pct_of_volume": None,
        "ctr_customers": 0,
    }
    assert kpis.kpi_branch_breakdown(fact, star.dim_branch(held)).count() == 0
    assert kpis.kpi_volume_trend(fact).count() == 0


def test_figures(spark):
    txns = transactions(
        spark,
        (1, 10, DAY, "30000"),
        (2, 20, DAY, "10000", "WIRE"),
        (3, 30, "2024-01-03", "20000", "CASH", "DEBIT"),
    )
    fact, dim_account, held = star_of(
        spark, txns, accounts(spark, (10, 1), (20, 2), (30, 9)), customers(spark, 1, 2, branch=4)
    )
    found = reports.ctr_candidates(fact, dim_account, held)
    assert kpis.kpi_summary(fact, found).first().asDict() == {
        "total_cash_credits": Decimal("30000.00"),
        "txn_count": 3,
        "avg_txn_value": 20000.0,
        "cash_pct_of_volume": 83.333333,
        "ctr_customers": 1,
    }
    breakdown = kpis.kpi_branch_breakdown(fact, star.dim_branch(held))
    assert rows(breakdown, "branch_name", "txn_count", "total_amount") == [
        ("Branch 4", 2, Decimal("40000.00")),
        (None, 1, Decimal("20000.00")),
    ]
    assert rows(kpis.kpi_volume_trend(fact), "txn_date", "txn_count") == [
        (date(2024, 1, 2), 2),
        (date(2024, 1, 3), 1),
    ]


def test_a_customer_with_most_accounts_brings_one_row_per_day(spark, conf):
    """Between the account join and the customer join the plan sums up by customer."""
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    txns = spark.range(3_000).selectExpr(
        "id AS txn_id",
        "id AS account_id",
        "DATE '2024-01-02' AS txn_date",
        "cast(10 AS decimal(12,2)) AS amount",
        "'CASH' AS txn_type",
        "'CREDIT' AS direction",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS last_modified",
    )
    accts = accounts(spark, *[(i, 1 if i % 3 else i) for i in range(3_000)])
    found = ctr(spark, txns, accts, customers(spark, *range(1, 3_000)))
    assert rows(found, "customer_id", "cash_txn_count", "total_cash") == [
        (1, 2_000, Decimal("20000.00"))
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    lines = list(enumerate(plan.splitlines()))
    joins = [i for i, line in lines if "SortMergeJoin [customer_id" in line]
    sums = [i for i, line in lines if "keys=[customer_id" in line and "full_name" not in line]
    assert any(i > joins[0] for i in sums)


def test_report_by_customer_key_equals_the_one_by_account(spark):
    txns = transactions(spark, (1, 10, DAY, "6000"), (2, 11, DAY, "6000"), (3, 20, DAY, "9000"))
    accts, held = accounts(spark, (10, 1), (11, 1), (20, 2)), customers(spark, 1, 2)
    dim_account = star.dim_account(accts)
    keyed = star.fact_transaction(
        txns,
        dim_account,
        star.dim_transaction_type(txns),
        held,
        star.dim_branch(held),
        star.dim_date(spark),
        with_customer_sk=True,
    )
    found = reports.ctr_by_customer_key(keyed, held)
    expected = reports.ctr_candidates(keyed, dim_account, held)
    assert rows(found, *found.columns) == rows(expected, *found.columns)
    assert rows(found, "customer_id", "cash_txn_count") == [(1, 2)]
