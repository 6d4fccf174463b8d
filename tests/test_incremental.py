"""The month-wise fact against full rebuilds."""

from __future__ import annotations

from frames import FEB, JAN, MAR, accounts, customers, dim, rows, transactions

from pyspark.sql import functions as F

from vigilmart.operators import star
from vigilmart.plans.incremental import COLUMNS, FactStore, _latest

FACT = ["txn_id", "account_sk", "txn_type_sk", "branch_sk", "date_sk", "txn_date", "txn_type", "direction", "amount"]


def dims(spark, accts, held, types):
    return star.dim_account(accts), types, held, star.dim_branch(held), star.dim_date(spark)


def at_load(df, load):
    return df.withColumn("last_modified", F.lit(load).cast("timestamp_ntz"))


def test_deliveries_rebuild_only_touched_months_and_equal_a_full_rebuild(spark, tmp_path):
    store = FactStore(spark, str(tmp_path), buckets=2, most_runs=2)
    accts, held = accounts(spark, (10, 1), (20, 2)), customers(spark, 1, 2)
    first = transactions(spark, (1, 10, "2024-01-05", "5"), (2, 20, "2024-02-05", "6"), (3, 10, "2024-03-05", "7", "WIRE"))
    types = star.dim_transaction_type(first)
    every = first

    def step(version, delivery, *tables):
        nonlocal every
        every = every.unionByName(delivery)
        touched = store.refresh(delivery, *tables, version)
        full = star.fact_transaction(_latest(every.select(*COLUMNS)), *tables)
        assert rows(store.read(), *FACT) == rows(full, *FACT)
        return touched

    tables = dims(spark, accts, held, types)
    assert step(0, first, *tables) == ["2024-01", "2024-02", "2024-03"]
    runs = lambda: {p["month"]: p["run"] for p in store.months()}
    assert step(1, first.limit(2), *tables) == []  # delivered again as it was
    moved = at_load(transactions(spark, (1, 10, "2024-02-20", "9")), FEB)
    assert step(2, moved, *tables) == ["2024-01", "2024-02"]
    assert runs() == {"2024-02": 2, "2024-03": 0}  # the month left empty is gone
    assert step(3, at_load(transactions(spark, (1, 10, "2024-01-05", "5")), "2023-01-01"), *tables) == []  # outdated
    undated = at_load(transactions(spark, (2, 20, "2024-02-05", "6")), MAR).withColumn("txn_date", F.lit(None).cast("date"))
    assert step(4, undated, *tables) == ["2024-02", "undated"]
    # A moved customer: the months of the account's transactions, found by the changed branch key.
    other = dim(spark, (1, 1, "Name 1", "s", 1, JAN, None, True), (2, 2, "Name 2", "s", 1, JAN, FEB, False), (3, 2, "Name 2", "s", 9, FEB, None, True))
    assert step(5, first.where("false"), *dims(spark, accts, other, types)) == ["undated"]
    # A new account with a smaller id moves all keys.
    more = accounts(spark, (5, 1), (10, 1), (20, 2))
    late = transactions(spark, (9, 5, "2024-03-30", "1"))
    assert step(6, late, *dims(spark, more, other, types)) == ["2024-02", "2024-03", "undated"]
    new_types = star.dim_transaction_type(transactions(spark, (1, 1, "2024-01-01", "1", "ACH")).unionByName(every))
    assert "2024-03" in step(7, first.where("false"), *dims(spark, more, other, new_types))


def test_a_version_refreshed_again_gives_the_same(spark, tmp_path):
    store = FactStore(spark, str(tmp_path))
    first = transactions(spark, (1, 10, "2024-01-05", "5"), (2, 10, "2024-02-05", "6"))
    tables = dims(spark, accounts(spark, (10, 1)), customers(spark, 1), star.dim_transaction_type(first))
    store.refresh(first, *tables, 0)
    more = transactions(spark, (3, 10, "2024-02-07", "7"))
    for _ in range(2):
        assert FactStore(spark, str(tmp_path)).refresh(more, *tables, 1) == ["2024-02"]
    assert rows(store.read(), "txn_id") == [(1,), (2,), (3,)]
    assert {p["month"]: p["run"] for p in store.months()} == {"2024-01": 0, "2024-02": 1}
