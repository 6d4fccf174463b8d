from __future__ import annotations

import pytest
from frames import FEB, JAN, accounts, customers, dim, rows, transactions

from vigilmart.operators import quality, star

DAY = "2024-01-02"


def tables(spark, txns, accts, held, fact=None):
    dim_account = star.dim_account(accts)
    if fact is None:
        fact = star.fact_transaction(
            txns,
            dim_account,
            star.dim_transaction_type(txns),
            held,
            star.dim_branch(held),
            star.dim_date(spark),
        )
    return quality.Tables(
        bronze={"customers": held, "accounts": accts, "transactions": txns},
        accounts=accts,
        transactions=txns,
        dim_customer=held,
        dim_account=dim_account,
        fact=fact,
    )


def test_clean_tables_pass(spark):
    t = tables(
        spark,
        transactions(spark, (1, 10, DAY, "5"), (2, 10, DAY, "6")),
        accounts(spark, (10, 1)),
        customers(spark, 1),
    )
    card = quality.scorecard(t, {"customers": 1, "accounts": 1, "transactions": 2})
    assert card.count() == 15
    assert card.where("status <> 'PASS'").count() == 0
    assert quality.gate(card).first()[0] == "ALL CHECKS PASSED"
    quality.enforce(card)


def test_every_check_can_fail(spark):
    held = dim(
        spark,
        (1, 1, "A", "s", 1, JAN, None, True),
        (2, 1, "A", "s", 1, JAN, None, True),
        (3, None, "N", "s", 1, JAN, None, True),
        (4, 2, "B", None, 1, JAN, None, True),
        (5, 3, "C", None, 1, JAN, FEB, False),
    )
    accts = accounts(spark, (10, 1), (10, 1), (20, 3), (30, None), (40, 2))
    txns = transactions(
        spark,
        (1, 10, DAY, "5"),
        (2, 99, DAY, "0"),
        (3, 40, DAY, "-1", "CRYPTO"),
        (4, 40, DAY, None, None, None),
        (5, 40, DAY, "1", "CASH", "SIDEWAYS"),
    )
    fact = txns.selectExpr("txn_id % 4 AS txn_id", "account_id AS account_sk")
    card = quality.scorecard(
        tables(spark, txns, accts, held, fact), {"customers": 1, "accounts": 1, "transactions": 1}
    )
    assert dict(rows(card, "check_name", "metric")) == {
        "bronze_customers_count": "expected=1 actual=5",
        "bronze_accounts_count": "expected=1 actual=5",
        "bronze_transactions_count": "expected=1 actual=5",
        "fact_vs_silver_txns": "fact=5 silver=5",
        "pk_dim_customer_unique": "1 duplicate current customer_id",
        "pk_dim_account_unique": "1 duplicate account_id",
        "pk_fact_txn_unique": "1 duplicate txn_id",
        "null_customer_id": "1 null customer_id",
        "null_ssn": "1 null ssn (current rows)",
        "fk_account_to_customer": "2 orphan accounts (no current customer)",
        "fk_fact_to_account": "5 fact rows with no dim_account",
        "scd2_one_current_per_customer": "1 customers with != 1 current row",
        "accepted_txn_type": "1 rows with unexpected txn_type",
        "accepted_direction": "1 rows with unexpected direction",
        "amount_positive": "2 rows with amount <= 0",
    }
    assert rows(card.where("status = 'PASS'"), "check_name") == [("fact_vs_silver_txns",)]
    assert quality.gate(card).first()[0] == "14 CHECK(S) FAILED"
    assert quality.for_display(card).first()["status"] == "FAIL"
    with pytest.raises(quality.QualityGateError, match="14 CHECK"):
        quality.enforce(card)
    # The strict form also sees the customer whose versions are all closed.
    assert quality.strict_one_current(held).first()["metric"] == "2 customers with != 1 current row"


def test_empty_tables_count_zero(spark):
    t = tables(spark, transactions(spark), accounts(spark), customers(spark))
    card = quality.scorecard(t, {"customers": 0, "accounts": 0, "transactions": 0})
    assert card.where("status = 'PASS'").count() == 15


def test_each_table_is_read_once_or_per_key(spark):
    """Fifteen checks, but one pass per table; the fact has two, for its two keys."""
    from vigilmart.plans.catalog import EXPECTED_ROWS, mart

    m = mart(spark, "/root/testdata/sf0.001")
    card = quality.scorecard(m.quality_tables(), EXPECTED_ROWS)
    plan = card._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 13
    assert "Join Cross" not in plan and "Join Inner" not in plan
