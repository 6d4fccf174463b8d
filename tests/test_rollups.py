"""Figures and checks kept by month against those of the whole fact."""

from __future__ import annotations

from pathlib import Path

from frames import FEB, JAN, accounts, customers, dim, rows, transactions

from pyspark.sql import Row
from pyspark.sql import functions as F

from vigilmart.operators import kpis, quality, reports, star
from vigilmart.plans.incremental import FactStore
from vigilmart.plans.rollups import Rollups, meeting
from vigilmart.sources.workspace import settle

FIRST = (
    (1, 10, "2024-01-05", "9000"),
    (2, 11, "2024-01-05", "2000"),
    (3, 20, "2024-01-06", "20000"),
    (4, 20, "2024-02-05", "10001"),
    (5, 30, "2024-02-07", "6", "WIRE"),
    (6, 10, "2024-03-05", "12000", "CASH", "DEBIT"),
    (7, 30, "2024-03-09", "40000"),
)


def tables(spark, accts, held, delivered):
    made = star.dim_account(accts), star.dim_transaction_type(delivered), held, star.dim_branch(held), star.dim_date(spark)
    return tuple(settle(table, "dim") for table in made)


def load(df, when):
    return df.withColumn("last_modified", F.lit(when).cast("timestamp_ntz"))


def same_as_whole(rollups, accts, dims, first=None, last=None, card=False):
    fact, silver = rollups.store.read(), rollups.store.transactions()
    account, _, customer, branch, _ = dims
    if first:
        fact = fact.where(F.date_format("txn_date", "yyyy-MM").between(first, last))
    whole = kpis.kpi_summary(fact, reports.ctr_candidates(fact, account, customer))
    assert rows(rollups.summary(first, last), *whole.columns) == rows(whole, *whole.columns)
    per_branch = kpis.kpi_branch_breakdown(fact, branch)
    assert rows(rollups.branch_breakdown(branch, first, last), *per_branch.columns) == rows(per_branch, *per_branch.columns)
    trend = kpis.kpi_volume_trend(fact)
    assert rows(rollups.volume_trend(first, last), *trend.columns) == rows(trend, *trend.columns)
    if card:
        bronze = {e: accts for e in quality.CARDINALITY_ENTITIES}
        expected = {e: 3 for e in quality.CARDINALITY_ENTITIES}
        card = quality.scorecard(quality.Tables(bronze, accts, silver, customer, account, fact), expected)
        kept = rollups.scorecard(bronze, accts, customer, account, expected)
        assert rows(kept, *card.columns) == rows(card, *card.columns)
        return {r.check_name: r.metric for r in card.collect()}


def spoil(store, months):
    """Make the facts and transactions of months unreadable."""
    parts = [p for p in store.months() if p["month"] in months]
    for folder in store._paths("fact", parts) + store._paths("txns", parts):
        for file in Path(folder).glob("*.parquet"):
            file.write_bytes(b"not a table")


def test_figures_follow_every_change_of_facts_and_owners(spark, tmp_path):
    store = FactStore(spark, f"{tmp_path}/fact", buckets=2)
    rollups = Rollups(store, f"{tmp_path}/rollups")
    accts = accounts(spark, (10, 1), (11, 1), (20, 2), (30, 3))
    held = customers(spark, 1, 2, 3)
    first = transactions(spark, *FIRST)
    dims = tables(spark, accts, held, first)

    def step(version, delivery, dims):
        store.refresh(delivery, *dims, version)
        read = rollups.refresh(dims[0], dims[2], version)
        same_as_whole(rollups, accts, dims)
        return read

    assert step(0, first, dims) == ["2024-01", "2024-02", "2024-03"]
    assert rollups.ctr_customers().first()[0] == 3
    assert rollups.ctr_customers("2024-01", "2024-02").first()[0] == 2
    moved = load(transactions(spark, (3, 20, "2024-02-20", "20000"), (2, 11, "2024-01-05", "900")), FEB)
    undated = load(transactions(spark, (7, 30, "2024-03-09", "-1")), FEB).withColumn("txn_date", F.lit(None).cast("date"))
    assert step(1, moved.unionByName(undated), dims) == ["2024-01", "2024-02", "2024-03", "undated"]
    assert rollups.ctr_customers("2024-01", "2024-01").first()[0] == 0
    same_as_whole(rollups, accts, dims, "2024-02", "2024-03")
    # The account gets another owner in the same branch: no fact changes, the bitmaps do.
    accts = accounts(spark, (10, 1), (11, 1), (20, 1), (30, 3))
    before = {p["month"]: p["limit_at"] for p in rollups.months()}
    assert step(2, first.where("false"), tables(spark, accts, held, first)) == []
    after = {p["month"]: p["limit_at"] for p in rollups.months()}
    assert {m for m in after if before[m] != after[m]} == {"2024-02"}
    assert rollups.ctr_customers().first()[0] == 1
    # The owner is no longer current: without a branch the months of the accounts are rebuilt.
    gone = dim(spark, (1, 1, "Name 1", "s", 1, JAN, FEB, False), (2, 2, "Name 2", "s", 1, JAN, None, True), (3, 3, "Name 3", "s", 1, JAN, None, True))
    assert step(3, first.where("false"), tables(spark, accts, gone, first)) == ["2024-01", "2024-02", "2024-03"]
    assert rollups.ctr_customers().first()[0] == 0


def test_only_changed_months_are_read(spark, tmp_path):
    store, accts, held = FactStore(spark, f"{tmp_path}/fact"), accounts(spark, (10, 1), (11, 1), (20, 2), (30, 3)), customers(spark, 1, 2, 3)
    rollups, first = Rollups(store, f"{tmp_path}/rollups"), transactions(spark, *FIRST)
    dims = tables(spark, accts, held, first)
    store.refresh(first, *dims, 0)
    rollups.refresh(dims[0], dims[2], 0)
    spoil(store, {"2024-01", "2024-02"})
    store.refresh(transactions(spark, (9, 30, "2024-03-30", "1")), *dims, 1)
    for _ in range(2):  # a version refreshed again gives the same
        assert Rollups(store, f"{tmp_path}/rollups").refresh(dims[0], dims[2], 1) == ["2024-03"]
        assert rollups.summary().first()["txn_count"] == 8
        assert rollups.scorecard({}, accts, held, dims[0], None).where("status = 'FAIL'").count() == 0


def test_repeated_and_orphaned_facts_are_found_across_months(spark, tmp_path):
    store, accts = FactStore(spark, f"{tmp_path}/fact"), accounts(spark, (10, 1), (20, 2))
    rollups, held = Rollups(store, f"{tmp_path}/rollups"), customers(spark, 1, 2)
    first = transactions(spark, (1, 10, "2024-01-05", "5"), (2, 20, "2024-02-05", "6"), (3, 99, "2024-04-05", "7"), (4, 10, "2024-05-01", "0"))
    account, types, customer, branch, calendar = tables(spark, accts, held, first)
    twice = account.unionByName(account.where("account_id = 10"))  # a repeated account repeats its facts
    dims = (twice, types, customer, branch, calendar)
    store.refresh(first, *dims, 0)
    rollups.refresh(twice, held, 0)
    found = same_as_whole(rollups, accts, dims, card=True)  # no account of 2024-04 is known, so it has no fact
    assert found["pk_fact_txn_unique"].startswith("2 ") and found["fact_vs_silver_txns"] == "fact=5 silver=4"
    assert found["amount_positive"].startswith("1 ")
    dims = (account, types, customer, branch, calendar)
    corrected = load(transactions(spark, (1, 10, "2024-01-05", "8"), (4, 10, "2024-05-01", "1")), FEB)
    store.refresh(corrected, *dims, 1)
    rollups.refresh(account, held, 1)
    found = same_as_whole(rollups, accts, dims, card=True)
    assert found["pk_fact_txn_unique"].startswith("0 ") and found["amount_positive"].startswith("0 ")
    less = account.where("account_id <> 20")  # facts of an account that the dimension no longer has
    bronze = {}
    card = rollups.scorecard(bronze, accts, held, less, None)
    assert card.where("check_name = 'fk_fact_to_account'").first().metric.startswith("1 ")


def test_an_id_in_two_months_is_found_in_unchanged_files(spark, tmp_path):
    rollups = Rollups(FactStore(spark, f"{tmp_path}/fact"), f"{tmp_path}/rollups")
    fact = transactions(spark, (1, 10, "2024-01-05", "5"), (5, 10, "2024-01-06", "5"), (50, 10, "2024-02-05", "5"), (5, 10, "2024-03-05", "6"))

    def add(version, part, kept, changed, before):
        files = [Row(month=m, at=a, file=f, low=lo, high=hi, nulls=n) for m, a, f, lo, hi, n in rollups._write_keys(part, version)]
        rollups._find_repeats(changed, kept, files, version, before)
        found = spark.read.parquet(f"{tmp_path}/rollups/repeats/{version}")
        return files, rows(found, "txn_id", "in_month", "n")

    old, none = add(0, fact.where("txn_date < '2024-03-01'"), [], {"2024-01", "2024-02"}, None)
    assert none == []
    new, both = add(1, fact.where("txn_date >= '2024-03-01'"), old, {"2024-03"}, 0)
    assert both == [(5, "2024-01", 1), (5, "2024-03", 1)]
    assert {f["month"] for f in meeting(old, new)} == {"2024-01"}
    assert add(2, fact.where("false"), [f for f in old if f["month"] != "2024-01"] + new, {"2024-01"}, 1)[1] == []


def test_ranges_meet():
    file = lambda low, high, nulls=False: Row(low=low, high=high, nulls=nulls)
    files = [file(0, 4), file(5, 9), file(None, None, True), file(20, 30)]
    assert meeting(files, [file(9, 12), file(11, 19)]) == [files[1]]
    assert meeting(files, [file(None, None, True)]) == [files[2]]
    assert meeting(files, [file(3, 25)]) == [files[0], files[1], files[3]]
    assert meeting(files, []) == [] and meeting([], [file(1, 2)]) == []
