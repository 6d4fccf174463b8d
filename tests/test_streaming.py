from __future__ import annotations

import random
import shutil
from decimal import Decimal

import pytest
from frames import FEB, JAN, MAR, accounts, at, customers, rows, transactions

from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.operators import reports, scd2, silver, star
from vigilmart.operators.dedup import latest_per_key
from vigilmart.sources.batches import latest_version, publish
from vigilmart.sources.bronze import as_bronze, bronze_load, read_bronze
from vigilmart.sources.files import land_entity
from vigilmart.sources.keyed import KeyedLog
from vigilmart.streaming import cash, dedup, history
from vigilmart.streaming.bronze import bronze_stream, stream_files
from vigilmart.streaming.runs import drain

DAY = "2024-01-02"
TXN_COLUMNS = ("txn_id", "account_id", "txn_date", "amount", "txn_type", "direction")


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def arrive(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_bronze_loads_each_file_once(spark, folder):
    landing, raw = f"{folder}/landing", f"{folder}/raw"
    first = transactions(spark, (1, 10, DAY, "5"), (2, 10, DAY, "6"))
    arrive(first, f"{landing}/transactions")

    def run():
        drain(bronze_stream(spark, landing, raw, "transactions", first.schema), f"{folder}/c")
        return read_bronze(spark, raw, "transactions")

    assert run().count() == 2
    assert run().count() == 2
    arrive(transactions(spark, (3, 11, DAY, "7")), f"{landing}/transactions")
    loaded = run()
    typed = silver.typed(loaded, silver.TRANSACTION_FIELDS)
    amounts = [(1, Decimal("5.00")), (2, Decimal("6.00")), (3, Decimal("7.00"))]
    assert rows(typed, "txn_id", "amount") == amounts
    assert loaded.where("_load_ts IS NULL OR _file NOT LIKE '%/transactions/%'").count() == 0


def test_malformed_value_fails_strict_and_is_null_when_lenient(spark, folder):
    bad = spark.createDataFrame([("x", "L")], "account_id STRING, account_type STRING")
    bad.write.parquet(f"{folder}/bad")
    bronze = as_bronze(spark.read.parquet(f"{folder}/bad"), JAN)
    fields = {"account_id": "bigint", "open_date": "date"}
    assert rows(silver.typed(bronze, fields, strict=False), "account_id", "open_date") == [(None, None)]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        silver.typed(bronze, fields).collect()


def test_latest_log_equals_batch_and_takes_late_corrections(spark, folder):
    schema = "k BIGINT, v STRING, t TIMESTAMP_NTZ"
    deliveries = [
        [(1, "a", at(FEB)), (2, "b", at(JAN)), (1, "older", at(JAN))],
        [(2, "c", at(MAR)), (1, "late", at(JAN))],
        [(3, "d", None), (3, "e", at(MAR))],
    ]
    for delivery in deliveries:
        arrive(spark.createDataFrame(delivery, schema), f"{folder}/in")
    stream = stream_files(spark, f"{folder}/in", schema, files_per_batch=1)
    drain(dedup.latest_log(stream, f"{folder}/log", ["k"], "t"))
    latest = dedup.read_latest(spark, f"{folder}/log", schema, ["k"], "t")
    assert rows(latest, "k", "v") == [(1, "a"), (2, "c"), (3, "d")]
    batch = latest_per_key(spark.read.schema(schema).parquet(f"{folder}/in"), ["k"], "t")
    assert rows(latest, "k", "v") == rows(batch, "k", "v")


def test_first_seen_drops_repeats_across_batches(spark, folder):
    df = transactions(spark, (1, 10, DAY, "5"), (2, 10, DAY, "6"))
    arrive(df, f"{folder}/in")
    arrive(transactions(spark, (2, 10, DAY, "6"), (3, 10, DAY, "7")), f"{folder}/in")
    stream = stream_files(spark, f"{folder}/in", df.schema, files_per_batch=1)
    drain(dedup.first_seen(stream, f"{folder}/log", ["txn_id"]))
    out = dedup.read_first_seen(spark, f"{folder}/log", cash.TXN_SCHEMA, ["txn_id"])
    assert rows(out, "txn_id") == [(1,), (2,), (3,)]


def test_first_seen_keeps_new_keys_however_late(spark, folder):
    df = transactions(spark, (1, 10, "2024-06-01", "5"))
    arrive(df, f"{folder}/in")
    late = transactions(spark, (2, 10, "2001-01-01", "6"), (1, 10, "2024-06-01", "7"))
    arrive(late.withColumn("last_modified", F.lit("1999-01-01").cast("timestamp_ntz")), f"{folder}/in")
    stream = stream_files(spark, f"{folder}/in", df.schema, files_per_batch=1)
    drain(dedup.first_seen(stream, f"{folder}/log", ["txn_id"]))
    out = dedup.read_first_seen(spark, f"{folder}/log", cash.TXN_SCHEMA, ["txn_id"])
    assert rows(out, "txn_id", "amount") == [(1, Decimal("5.00")), (2, Decimal("6.00"))]


CUSTOMER_SCHEMA = (
    "customer_id BIGINT, full_name STRING, ssn STRING, country STRING, branch_id INT, "
    "kyc_status STRING, last_modified TIMESTAMP_NTZ"
)


def deliver(spark, folder, load, *versions):
    df = spark.createDataFrame(
        [(cid, "A", "s", "US", 1, kyc, at(load)) for cid, kyc in versions], CUSTOMER_SCHEMA
    )
    land_entity(df, f"{folder}/landing-{load[:10]}", "customers")
    bronze_load(
        spark, f"{folder}/landing-{load[:10]}", f"{folder}/raw", load, "append", ("customers",)
    )


def run_history(spark, folder):
    drain(history.history_stream(spark, f"{folder}/raw", f"{folder}/dim"))
    return history.read_history(spark, f"{folder}/dim")


VERSION = ("customer_sk", "customer_id", "kyc_status", "valid_from", "valid_to", "is_current")
AFTER_THREE = [
    (1, 1, "VERIFIED", at(JAN), at(FEB), False),
    (2, 2, "VERIFIED", at(JAN), None, True),
    (3, 1, "PENDING", at(FEB), at(MAR), False),
    (4, 1, "VERIFIED", at(MAR), None, True),
    (5, 9, "VERIFIED", at(MAR), None, True),
]
DELIVERIES = (
    (JAN, (1, "VERIFIED"), (2, "VERIFIED")),
    (FEB, (1, "PENDING"), (2, "VERIFIED")),
    (MAR, (1, "VERIFIED"), (9, "VERIFIED")),
)


def test_history_delivery_by_delivery(spark, folder):
    for load, *versions in DELIVERIES:
        deliver(spark, folder, load, *versions)
        held = run_history(spark, folder)
    assert rows(held, *VERSION) == AFTER_THREE
    assert rows(run_history(spark, folder), *VERSION) == AFTER_THREE


def test_history_of_several_deliveries_in_one_batch(spark, folder):
    for load, *versions in DELIVERIES:
        deliver(spark, folder, load, *versions)
    assert rows(run_history(spark, folder), *VERSION) == AFTER_THREE


def test_one_changed_customer_rewrites_one_bucket(spark, folder):
    many = [(i, "VERIFIED") for i in range(200)]
    deliver(spark, folder, JAN, *many)
    run_history(spark, folder)
    first = {p["bucket"]: p["run"] for p in history.current_map(spark, f"{folder}/dim", 1)}
    deliver(spark, folder, FEB, *many[:7], (7, "PENDING"), *many[8:])
    held = run_history(spark, folder)
    second = {p["bucket"]: p["run"] for p in history.current_map(spark, f"{folder}/dim")}
    assert set(first) == set(second) == set(range(history.BUCKETS))
    assert [b for b in second if second[b] != first[b]] == [b for b in second if second[b] == 1] and list(second.values()).count(1) == 1
    assert held.count() == 201 and held.where("is_current").count() == 200
    assert rows(held.where("customer_id = 7"), *VERSION) == [
        (201, 7, "PENDING", at(FEB), None, True),
        (8, 7, "VERIFIED", at(JAN), at(FEB), False),
    ]
    deliver(spark, folder, MAR, *many[:3])  # no change: no bucket is written
    assert run_history(spark, folder).count() == 201
    assert {p["run"] for p in history.current_map(spark, f"{folder}/dim")} == {0, 1}


def test_a_hundred_deliveries_in_one_pass_equal_one_by_one(spark):
    pick = random.Random(3)
    loads = [f"2024-{1 + i // 28:02d}-{1 + i % 28:02d} 00:00:00" for i in range(100)]
    schema = f"_load_ts TIMESTAMP_NTZ, {CUSTOMER_SCHEMA}"
    every = [
        (at(load), cid, pick.choice("AB"), "s", pick.choice(["US", None, "DE"]), pick.randrange(3), pick.choice(["V", "P", None]), at(load))
        for load in loads
        for cid in [None, *range(12)]
        if cid is None or pick.random() < 0.7
    ]
    came = spark.createDataFrame(every, schema).drop("last_modified")
    start = scd2.first_load(customers(spark, 1, 2, 40).select("customer_id", *scd2.ATTRIBUTES), "2023-01-01 00:00:00")
    found = scd2.advance_many(start, came, 3)
    changed = rows(start.join(found, "customer_sk", "left_anti").unionByName(found), *scd2.DIM_COLUMNS)
    # One by one, in plain Python.
    held = {r["customer_id"]: [r.asDict()] for r in start.collect()}
    key, lone = 3, []
    for load in loads:
        fresh = []
        for row in sorted((r for r in every if r[0] == at(load)), key=lambda r: (r[1] is None, r[1] or 0)):
            new = dict(zip(("valid_from", "customer_id", "full_name", "ssn", "country", "branch_id", "kyc_status"), row[:7], strict=True))
            new |= {"valid_to": None, "is_current": True}
            versions = lone if row[1] is None else held.setdefault(row[1], [])
            last = versions[-1] if versions and row[1] is not None else None
            if last is not None:
                differs = [last[c] is not None and new[c] is not None and last[c] != new[c] for c in settings.TRACKED_COLUMNS]
                if not any(differs):
                    continue
                last |= {"valid_to": at(load), "is_current": False}
            versions.append(new)
            fresh.append(new)
        for new in fresh:
            key += 1
            new["customer_sk"] = key
    expected = [tuple(v[c] for c in scd2.DIM_COLUMNS) for versions in [*held.values(), lone] for v in versions]
    assert sorted(changed, key=repr) == sorted(expected, key=repr)
    assert len(expected) > 400


LOG_SCHEMA = "k BIGINT, v STRING, t BIGINT"


def keyed_log(spark, folder, **shape):
    return KeyedLog(spark, f"{folder}/keyed", LOG_SCHEMA, ["k"], lambda rows: latest_per_key(rows, ["k"], "t"), **shape)


def test_a_keyed_log_opens_only_what_a_batch_touches(spark, folder):
    log = keyed_log(spark, folder, buckets=8)
    for batch in range(4):  # growing keys: each run has a range of its own
        log.add(spark.range(batch * 1000, batch * 1000 + 1000).selectExpr("id AS k", f"'{batch}' AS v", f"{batch}L AS t"), batch)
    assert len(log.parts()) == 32
    one = spark.createDataFrame([(2500, "x", 9)], LOG_SCHEMA)
    opened = log.opened(one, before=4)
    assert len(opened) == 1 and "/runs/2/" in opened[0]
    assert rows(log.matching(one, before=4), "k", "v") == [(2500, "2")]
    assert log.opened(spark.createDataFrame([(9999, "x", 9)], LOG_SCHEMA), before=4) == []
    # The files of a plan over the opened folders are of that bucket and run alone.
    files = [f for f in log.matching(one, before=4).inputFiles()]
    assert files and all("/runs/2/_bucket=" in f for f in files)


def test_many_keys_are_not_sent_to_all_tasks(spark, folder):
    """60,000 ids in order are a small file, but fill the driver as a table of a join."""
    log = keyed_log(spark, folder, buckets=2)
    came = log.add(spark.range(60_000).selectExpr("id AS k", "'a' AS v", "1L AS t"), 0)
    found = log.matching(came, before=1)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 60_000


def test_compaction_changes_no_result_and_bounds_the_runs(spark, folder):
    pick = random.Random(1)
    log, plain = keyed_log(spark, folder, buckets=4, most_runs=2), {}
    for batch in range(7):
        came = {k: (f"{batch}", pick.randrange(100)) for k in pick.sample(range(60), 25)}
        if batch == 3:
            came = {None: ("none", 1), **came}
        for k, (v, t) in came.items():
            if k not in plain or t > plain[k][1]:
                plain[k] = (v, t)
        frame = spark.createDataFrame([(k, v, t) for k, (v, t) in came.items()], LOG_SCHEMA)
        log.add(frame, batch)
        log.add(frame, batch)  # replayed
        if batch:
            assert rows(log.matching(frame, before=batch), "k").count((None,)) == (batch > 3 and None in came)
    held = {}
    for part in log.parts():
        held[part["bucket"]] = held.get(part["bucket"], 0) + 1
    assert max(held.values()) <= 2
    assert sorted(((r["k"], r["v"], r["t"]) for r in log.read().collect()), key=repr) == sorted(((k, *x) for k, x in plain.items()), key=repr)


def test_cash_streams_with_compaction_equal_the_batch_report(spark, folder):
    stream, fact, dim_account, held = cash_inputs(spark, folder)
    expected = reports.ctr_candidates(fact, dim_account, held)
    drain(cash.windowed_cash_stream(stream, f"{folder}/log", buckets=2, most_runs=1))
    found = cash.ctr_from_sums(cash.windows_log(spark, f"{folder}/log", buckets=2).read().where("n > 0"), dim_account, held)
    assert rows(found, *found.columns) == rows(expected, *found.columns)
    assert max(p["run"].count("merged") for p in cash.sums_log(spark, f"{folder}/log", buckets=2).parts()) == 1


def test_streams_refuse_to_go_on_without_their_checkpoint(spark, folder):
    for load, *versions in DELIVERIES:
        deliver(spark, folder, load, *versions)
        run_history(spark, folder)
    shutil.rmtree(f"{folder}/dim/current-checkpoint")
    with pytest.raises(RuntimeError, match="checkpoint"):
        run_history(spark, folder)
    assert rows(history.read_history(spark, f"{folder}/dim"), *VERSION) == AFTER_THREE
    stream, *_ = cash_inputs(spark, folder)
    drain(cash.cash_sums_stream(stream, f"{folder}/log"))
    shutil.rmtree(f"{folder}/log-checkpoint")
    with pytest.raises(RuntimeError, match="checkpoint"):
        cash.cash_sums_stream(stream, f"{folder}/log")


def test_history_without_marker_files(spark, folder):
    option = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set(option, "false")
    try:
        for load, *versions in DELIVERIES:
            deliver(spark, folder, load, *versions)
            held = run_history(spark, folder)
        assert rows(held, *VERSION) == AFTER_THREE
    finally:
        hadoop.unset(option)


def test_a_map_folder_without_a_file_is_no_version(spark, folder, tmp_path):
    log = keyed_log(spark, folder)
    log.add(spark.createDataFrame([(1, "a", 1)], LOG_SCHEMA), 0)
    (tmp_path / "keyed" / "map" / "v=5").mkdir()
    again = keyed_log(spark, folder)
    assert rows(again.read(), "k", "v") == [(1, "a")]
    assert again.parts(0) == []
    log.add(spark.createDataFrame([], LOG_SCHEMA), 1)
    assert rows(keyed_log(spark, folder).read(), "k", "v") == [(1, "a")]


def test_versions_of_which_none_is_complete_are_an_error(spark, folder, tmp_path):
    (tmp_path / "dim" / "v=1").mkdir(parents=True)
    with pytest.raises(RuntimeError, match="none is complete"):
        latest_version(spark, f"{folder}/dim")


def test_history_refuses_a_delivery_from_the_past(spark, folder):
    deliver(spark, folder, MAR, (1, "VERIFIED"))
    run_history(spark, folder)
    deliver(spark, folder, JAN, (1, "PENDING"))
    with pytest.raises(Exception, match="arrived after"):
        run_history(spark, folder)


def test_an_unfinished_version_is_not_read(spark, folder, tmp_path):
    held = scd2.empty_dim(spark)
    publish(held, f"{folder}/dim", 0)
    publish(held, f"{folder}/dim", 3)
    (tmp_path / "dim" / "v=7").mkdir()
    assert latest_version(spark, f"{folder}/dim") == 3
    assert latest_version(spark, f"{folder}/dim", before=3) == 0
    assert latest_version(spark, f"{folder}/none") is None


def cash_inputs(spark, folder):
    """Days that grow over several batches, one transaction being two months late."""
    arrive(transactions(spark, (1, 10, DAY, "6000"), (2, 20, DAY, "9000")), f"{folder}/in")
    arrive(transactions(spark, (3, 11, "2024-03-15", "50000"), (4, 20, DAY, "500")), f"{folder}/in")
    arrive(transactions(spark, (5, 11, DAY, "4000.01"), (6, 10, DAY, "1", "WIRE")), f"{folder}/in")
    every = spark.read.parquet(f"{folder}/in")
    accts, held = accounts(spark, (10, 1), (11, 1), (20, 2)), customers(spark, 1, 2)
    dim_account = star.dim_account(accts)
    fact = star.fact_transaction(
        every,
        dim_account,
        star.dim_transaction_type(every),
        held,
        star.dim_branch(held),
        star.dim_date(spark),
    )
    stream = stream_files(spark, f"{folder}/in", every.schema, files_per_batch=1)
    return stream, fact, dim_account, held


def test_cash_sums_equal_the_batch_report_with_late_rows(spark, folder):
    stream, fact, dim_account, held = cash_inputs(spark, folder)
    expected = reports.ctr_candidates(fact, dim_account, held)
    drain(cash.cash_sums_stream(stream, f"{folder}/log"))
    sums = cash.read_cash_sums(spark, f"{folder}/log")
    found = cash.ctr_from_sums(sums, dim_account, held)
    assert rows(found, *found.columns) == rows(expected, *found.columns)
    assert found.count() == 2
    # Below the limit and in two parts each, but not the single large one.
    split = cash.structuring_from_sums(sums, dim_account, held, min_deposits=2)
    expected = reports.structuring_flags(fact, dim_account, held, min_deposits=2)
    assert rows(split, *split.columns) == rows(expected, *split.columns)
    assert split.count() == 1


def test_a_replayed_batch_counts_once(spark, folder):
    sums = spark.sql(
        "SELECT 10L AS account_id, DATE '2024-01-02' AS txn_date, 1L AS n, "
        "cast(6000 AS decimal(22,2)) AS total, 1L AS n_below, cast(6000 AS decimal(22,2)) AS total_below"
    )
    log = cash.sums_log(spark, f"{folder}/log")
    for _ in range(2):
        log.add(sums, 0)
    log.add(sums, 1)
    assert rows(cash.read_cash_sums(spark, f"{folder}/log"), "n", "total") == [(2, Decimal("12000.00"))]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_day_windows_equal_the_batch_report(spark, folder, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    stream, fact, dim_account, held = cash_inputs(spark, folder)
    expected = reports.ctr_candidates(fact, dim_account, held)
    drain(cash.windowed_cash_stream(stream, f"{folder}/log"))
    found = cash.ctr_from_sums(cash.read_cash_windows(spark, f"{folder}/log"), dim_account, held)
    assert rows(found, *found.columns) == rows(expected, *found.columns)


def test_corrections_across_batches_count_once_through_the_latest_log(spark, folder):
    def version(amount, load):
        df = transactions(spark, (1, 10, DAY, amount), (2, 10, DAY, "100"))
        return df.selectExpr("* EXCEPT (last_modified)", f"TIMESTAMP_NTZ '{load}' AS last_modified")

    for amount, load in (("20000", JAN), ("11000", MAR), ("30000", FEB)):
        arrive(version(amount, load), f"{folder}/in")
    schema = version("1", JAN).schema
    stream = stream_files(spark, f"{folder}/in", schema, files_per_batch=1)
    drain(dedup.latest_log(stream, f"{folder}/log", ["txn_id"], "last_modified"))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    latest = dedup.read_latest(spark, f"{folder}/log", columns, ["txn_id"], "last_modified")
    assert rows(cash.cash_sums(latest), "n", "total") == [(2, Decimal("11100.00"))]


@pytest.mark.parametrize("start, read", [(cash.cash_sums_stream, cash.read_cash_sums), (cash.windowed_cash_stream, cash.read_cash_windows)])
def test_redelivered_corrected_late_and_undated_transactions_count_once(spark, folder, start, read):
    def at_load(df, load):
        return df.withColumn("last_modified", F.lit(load).cast("timestamp_ntz"))

    undated = transactions(spark, (9, 30, DAY, "20000")).withColumn("txn_date", F.lit(None).cast("date"))
    arrive(transactions(spark, (1, 10, DAY, "6000"), (2, 20, DAY, "100")).unionByName(undated), f"{folder}/in")
    arrive(transactions(spark, (1, 10, DAY, "6000")), f"{folder}/in")  # delivered again
    arrive(at_load(transactions(spark, (2, 21, DAY, "300")), MAR), f"{folder}/in")  # moved to another account
    arrive(at_load(transactions(spark, (2, 20, DAY, "999")), FEB), f"{folder}/in")  # an older version, late
    arrive(at_load(transactions(spark, (3, 10, "2020-01-01", "50"), (1, 10, DAY, "1", "WIRE")), MAR), f"{folder}/in")
    stream = stream_files(spark, f"{folder}/in", undated.schema, files_per_batch=1)
    drain(start(stream, f"{folder}/log"))
    found = rows(read(spark, f"{folder}/log"), "account_id", "n", "total")
    assert found == [(10, 1, Decimal("50.00")), (21, 1, Decimal("300.00")), (30, 1, Decimal("20000.00"))]
