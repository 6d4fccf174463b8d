from __future__ import annotations

from types import SimpleNamespace

import pytest
from frames import FEB, JAN, SRC_SCHEMA, accounts, at, rows, transactions

from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.operators import governance, quality, reports, scd2, silver
from vigilmart.plans.build import build, build_next, expired, latest_published, published
from vigilmart.sources import workspace
from vigilmart.sources.bronze import bronze_schema, peek
from vigilmart.sources.files import ENTITIES, entity_path, file_manifest, land_entity, scan_entity


def land(spark, folder, kyc="VERIFIED", load=JAN, extra_account=None):
    people = [(i, f"Name {i}", f"000-00-000{i}", "US", i, kyc) for i in (1, 2)]
    frames = {
        "customers": spark.createDataFrame(people, SRC_SCHEMA).withColumn(
            "last_modified", F.lit(load).cast("timestamp_ntz")
        ),
        "accounts": accounts(spark, (10, 1), (20, 2), *([extra_account] if extra_account else [])),
        "transactions": transactions(
            spark,
            (1, 10, "2024-01-02", "9000"),
            (2, 10, "2024-01-02", "2000"),
            (3, 20, "2024-01-02", "5", "ACH"),
        ),
        "watchlist": spark.createDataFrame([("NAME 2", "L")], "name STRING, list_source STRING"),
    }
    for entity, df in frames.items():
        land_entity(df, folder, entity)
    return folder


COUNTS = {"customers": 2, "accounts": 2, "transactions": 3}


def test_build_writes_all_layers_and_passes_its_gate(spark, tmp_path):
    landing = land(spark, str(tmp_path / "landing"))
    m = build(spark, landing, str(tmp_path / "mart"), JAN, expected_rows=COUNTS)
    assert m.fact.count() == 3
    assert governance.classifications(m.dim_customer) == settings.CUSTOMER_TAGS
    written = {str(p.relative_to(tmp_path / "mart")) for p in (tmp_path / "mart").glob("*/*")}
    assert written == {f"raw/{e}" for e in ENTITIES} | {
        "silver/accounts",
        "silver/transactions",
        "silver/watchlist",
        "silver/dim_customer",
        "gold/dim_date",
        "gold/dim_branch",
        "gold/dim_transaction_type",
        "gold/dim_account",
        "gold/fact_transaction",
        "checks/scorecard",
    } | {str(p.relative_to(tmp_path / "mart")) for p in (tmp_path / "mart/published").glob("*")}
    assert published(spark, str(tmp_path / "mart"))


def test_build_stops_at_a_failing_check(spark, tmp_path):
    landing = land(spark, str(tmp_path / "landing"), extra_account=(30, 99))
    with pytest.raises(quality.QualityGateError, match="1 orphan accounts"):
        build(
            spark, landing, str(tmp_path / "mart"), JAN, expected_rows={**COUNTS, "accounts": 3}
        )


def test_the_gate_is_on_without_expected_counts_and_publishes_nothing(spark, tmp_path):
    landing = land(spark, str(tmp_path / "landing"), extra_account=(30, 99))
    with pytest.raises(quality.QualityGateError, match="1 orphan accounts"):
        build(spark, landing, str(tmp_path / "mart"), JAN)
    assert not published(spark, str(tmp_path / "mart"))
    build(spark, landing, str(tmp_path / "told"), JAN, on_fail="report")
    row = spark.read.parquet(str(tmp_path / "told/published")).first()
    assert row["failed"] == "fk_account_to_customer"
    with pytest.raises(ValueError, match="on_fail"):
        build(spark, landing, str(tmp_path / "other"), JAN, on_fail="ignore")


def test_the_next_build_continues_the_history(spark, tmp_path):
    first = build(spark, land(spark, str(tmp_path / "l1")), str(tmp_path / "m1"), JAN)
    second = build(
        spark,
        land(spark, str(tmp_path / "l2"), kyc="PENDING", load=FEB),
        str(tmp_path / "m2"),
        FEB,
        previous_customers=first.dim_customer,
        expected_rows=COUNTS,
    )
    assert rows(second.dim_customer, "customer_sk", "customer_id", "valid_to") == [
        (1, 1, at(FEB)),
        (2, 2, at(FEB)),
        (3, 1, None),
        (4, 2, None),
    ]
    assert scd2.verify(second.dim_customer).first()["current_rows"] == 2


def test_scan_and_listing(spark, tmp_path):
    landing = land(spark, str(tmp_path / "landing"))
    assert scan_entity(spark, landing, "transactions").count() == 3
    listed = file_manifest(spark, landing)
    assert listed.where("size_bytes > 0 AND file_name LIKE '%.parquet'").count() == listed.count() >= 4
    with pytest.raises(ValueError, match="unknown entity"):
        entity_path(landing, "loans")


def test_bronze_schema_and_peek(spark, tmp_path):
    m = build(spark, land(spark, str(tmp_path / "landing")), str(tmp_path / "mart"), JAN)
    schemas = dict(rows(bronze_schema(m.bronze), "entity", "data_schema"))
    assert schemas["watchlist"] == "OBJECT<list_source: STRING, name: STRING>"
    assert set(schemas) == set(ENTITIES)
    assert peek(m.bronze["customers"]).count() == 1


def stub_session(named, warehouse="hdfs://w/warehouse"):
    values = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": warehouse}
    context = SimpleNamespace(getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default=None: values[key] or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_is_the_one_the_cluster_names():
    named = stub_session("hdfs://shared/checkpoints/")
    assert workspace.new_folder(named, "x").startswith("hdfs://shared/checkpoints/vigilmart/x-")


def test_without_a_named_folder_the_warehouse_holds_the_work():
    assert workspace.shared_root(stub_session(None)) == "hdfs://w/warehouse/_work"


def test_fields_of_the_variant_rows_are_read_as_columns(spark, tmp_path):
    """Bronze files are shredded, and silver takes its fields straight from the scan."""
    m = build(spark, land(spark, str(tmp_path / "landing")), str(tmp_path / "mart"), JAN)
    one = silver.typed(m.bronze["transactions"], {"txn_type": "string"})
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<data:struct<0:string>>" in plan
    assert rows(one, "txn_type") == [("ACH",), ("CASH",), ("CASH",)]


def test_a_day_filter_on_a_report_reaches_the_fact_scan(spark, conf, tmp_path):
    conf("spark.sql.maxMetadataStringLength", "10000")
    m = build(spark, land(spark, str(tmp_path / "landing")), str(tmp_path / "mart"), JAN)
    months = {p.name for p in (tmp_path / "mart/gold/fact_transaction").glob("txn_month=*")}
    assert months == {"txn_month=2024-01"}
    one_day = reports.ctr_candidates(
        workspace.within_days(m.fact, "txn_date", "2024-01-02", "2024-01-02"), m.dim_account, m.dim_customer
    )
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan
    assert "GreaterThanOrEqual(txn_date,2024-01-02)" in plan
    assert one_day.count() == 1


def test_readers_are_pointed_to_the_last_build_that_passed(spark, tmp_path):
    base = str(tmp_path / "builds")
    good = land(spark, str(tmp_path / "good"))
    bad = land(spark, str(tmp_path / "bad"), extra_account=(30, 99))
    assert latest_published(spark, base) is None
    build_next(spark, good, base, as_of=JAN)
    assert latest_published(spark, base) == f"{base}/build-0"
    with pytest.raises(quality.QualityGateError):
        build_next(spark, bad, base, as_of=JAN)
    assert latest_published(spark, base) == f"{base}/build-0"
    build_next(spark, good, base, as_of=JAN)
    assert latest_published(spark, base) == f"{base}/build-2"
    assert published(spark, latest_published(spark, base))
    assert expired(spark, base, keep=1) == [f"{base}/build-0", f"{base}/build-1"]
    assert expired(spark, base, keep=2) == [f"{base}/build-1"]


def test_unreadable_rows_go_to_quarantine_and_the_others_load(spark, tmp_path):
    landing = land(spark, str(tmp_path / "landing"))
    texts = scan_entity(spark, landing, "transactions").selectExpr(
        "* EXCEPT (amount)", "CASE txn_id WHEN 2 THEN 'much' ELSE cast(amount AS string) END AS amount"
    )
    other = str(tmp_path / "other")
    for entity in ENTITIES:
        land_entity(texts if entity == "transactions" else scan_entity(spark, landing, entity), other, entity)
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        build(spark, other, str(tmp_path / "strict"), JAN)
    m = build(spark, other, str(tmp_path / "lenient"), JAN, on_fail="report", bad_rows="quarantine")
    assert rows(m.fact, "txn_id") == [(1,), (3,)]
    held = spark.read.parquet(f"{tmp_path}/lenient/quarantine/transactions")
    assert held.count() + m.transactions.count() == m.bronze["transactions"].count() == 3
    assert [(p["field"], p["reason"]) for p in held.first()["problems"]] == [("amount", "not a decimal(12,2)")]
    assert spark.read.parquet(f"{tmp_path}/lenient/quarantine/customers").count() == 0


def test_sifting_keeps_nulls_and_absent_fields(spark):
    odd = spark.sql(
        "SELECT try_parse_json(j) AS data FROM VALUES ('{\"a\":1}'), ('{\"a\":null}'), ('{}'), ('{\"a\":\"x\"}'), ('{\"a\":{\"b\":1}}'), ('[1]'), (NULL) AS v(j)"
    )
    good, bad = silver.sifted(odd, {"a": "bigint"})
    assert good.count() == 3
    assert sorted(str(r["problems"][0]["reason"]) for r in bad.collect()) == ["no object", "no object", "not a bigint", "not a bigint"]
