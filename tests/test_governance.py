from __future__ import annotations

import json

import pytest
from frames import FEB, JAN, accounts, dim, rows, transactions

from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.functions.columns import mask_ssn
from vigilmart.operators import governance, star
from vigilmart.plans import views
from vigilmart.plans.catalog import mart


@pytest.fixture
def held(spark):
    return dim(
        spark,
        (1, 1, "A", "123-45-6789", 1, JAN, None, True),
        (2, 2, "B", "12", 6, JAN, None, True),
        (3, 3, "C", None, 7, JAN, None, True),
        (4, 4, "D", "987-65-4321", None, JAN, None, True),
    )


@pytest.mark.parametrize(
    "role, plain",
    [
        ("COMPLIANCE_ANALYST", True),
        ("accountadmin", True),
        ("SYSADMIN", False),
        ("AUDITOR", False),
        ("ENG", False),
        ("somebody", False),
    ],
)
def test_mask_by_role(held, role, plain):
    column = mask_ssn(F.col("ssn"), role).alias("s")
    seen = [r.s for r in held.orderBy("customer_id").select(column).collect()]
    masked = ["XXX-XX-6789", "XXX-XX-12", None, "XXX-XX-4321"]
    assert seen == (["123-45-6789", "12", None, "987-65-4321"] if plain else masked)


@pytest.mark.parametrize(
    "role, visible",
    [
        ("ACCOUNTADMIN", [1, 2, 3, 4]),
        ("SYSADMIN", [1, 2, 3, 4]),
        ("AUDITOR", [1, 2, 3, 4]),
        ("eng", [1, 2, 3, 4]),
        ("COMPLIANCE_ANALYST", [1, 2]),
        ("compliance_analyst", [1, 2]),
        ("UNMAPPED", []),
    ],
)
def test_rows_by_role(spark, held, role, visible):
    seen = governance.row_access(held, role, governance.branch_access(spark))
    assert rows(seen, "customer_id") == [(i,) for i in visible]
    assert seen.columns == held.columns


def test_a_branch_mapped_twice_does_not_repeat_rows(spark, held):
    twice = governance.branch_access(spark).union(governance.branch_access(spark))
    assert governance.row_access(held, "COMPLIANCE_ANALYST", twice).count() == 2


def test_governed_masks_what_is_tagged(spark, held):
    tagged = governance.classify(held, {"full_name": "PII_RESTRICTED"})
    seen = governance.governed(tagged, "AUDITOR", governance.branch_access(spark)).first()
    assert (seen.full_name, seen.ssn) == ("XXX-XX-A", "XXX-XX-6789")
    plain = governance.governed(held, "AUDITOR", governance.branch_access(spark)).first()
    assert (plain.full_name, plain.ssn) == ("A", "XXX-XX-6789")


def test_tags_survive_writing(spark, held, tmp_path):
    tagged = governance.classify(held, settings.CUSTOMER_TAGS)
    tagged.write.parquet(str(tmp_path / "t"))
    assert governance.classifications(spark.read.parquet(str(tmp_path / "t"))) == settings.CUSTOMER_TAGS


def test_tags_outside_the_allowed_set_are_refused(held):
    with pytest.raises(ValueError, match="SECRET"):
        governance.classify(held, {"ssn": "SECRET"})


def test_classified_columns(held):
    report = governance.classified_columns(governance.classify(held, settings.CUSTOMER_TAGS))
    assert rows(report, "column_name", "classification", "row_count", "filled_count", "distinct_count") == [
        ("country", "INTERNAL", 4, 4, 1),
        ("full_name", "PII", 4, 4, 4),
        ("ssn", "PII_RESTRICTED", 4, 3, 3),
    ]


def test_sample_shows_the_same_customers_to_both_roles(spark, held):
    sample = governance.masked_sample(
        held, governance.branch_access(spark), ("COMPLIANCE_ANALYST", "AUDITOR")
    )
    assert rows(sample, "role_name", "customer_id", "ssn") == [
        ("AUDITOR", 1, "XXX-XX-6789"),
        ("AUDITOR", 2, "XXX-XX-12"),
        ("COMPLIANCE_ANALYST", 1, "123-45-6789"),
        ("COMPLIANCE_ANALYST", 2, "12"),
    ]


def test_visible_rows_and_branches(spark, held):
    mapping = governance.branch_access(spark)
    counts = governance.rows_visible_by_role(held, mapping, ("AUDITOR", "COMPLIANCE_ANALYST", "NOBODY"))
    assert rows(counts, "role_name", "rows_visible") == [
        ("AUDITOR", 4),
        ("COMPLIANCE_ANALYST", 2),
        ("NOBODY", 0),
    ]
    branches = governance.visible_branches(held, "COMPLIANCE_ANALYST", mapping)
    assert [r.branch_id for r in branches.collect()] == [1, 6]


def test_open_roles_are_not_joined(spark, held):
    plan = governance.row_access(held, "AUDITOR", governance.branch_access(spark))
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def nested(spark):
    return spark.sql(
        "SELECT 1L AS customer_id, 1 AS branch_id, '123-45-6789' AS SSN, named_struct('ssn', '123-45-6789', 'n', 1) AS person,"
        " array(named_struct('id', 7, 'ssn', '123-45-6780')) AS held, map('ssn', '123-45-6781', 'x', 'y') AS facts,"
        " parse_json('{\"ssn\":\"123-45-6789\",\"n\":1,\"kin\":{\"ssn\":\"1-2-3456\",\"age\":4},\"list\":[{\"ssn\":\"9-9-9999\"}],\"z\":null}') AS data"
    )


@pytest.mark.parametrize("role", ["AUDITOR", "SYSADMIN", "nobody"])
def test_no_plain_value_is_left_in_any_shape(spark, role):
    seen = governance.masked(nested(spark), role)
    row = seen.withColumn("data", F.to_json("data")).first()
    assert row["SSN"] == "XXX-XX-6789"
    assert row["person"]["ssn"] == "XXX-XX-6789" and row["person"]["n"] == 1
    assert row["held"][0]["ssn"] == "XXX-XX-6780" and row["held"][0]["id"] == 7
    assert row["facts"] == {"ssn": "XXX-XX-6781", "x": "y"}
    data = json.loads(row["data"])
    assert data["ssn"] == "XXX-XX-6789" and data["n"] == 1 and data["kin"] == {"ssn": "XXX-XX-3456", "age": 4}
    assert data["list"] is None and data["z"] is None  # a list that names it is hidden
    assert "123-45" not in str(row)


def test_cleared_roles_see_all_shapes(spark):
    assert governance.masked(nested(spark), "compliance_analyst ").select("person").first()["person"]["ssn"] == "123-45-6789"


def test_an_untagged_sensitive_column_beside_tagged_ones_is_masked(spark):
    df = governance.classify(spark.sql("SELECT 'A' AS full_name, '123-45-6789' AS ssn, 9 AS pin"), {"full_name": "PII", "pin": "PII_RESTRICTED"})
    assert rows(governance.masked(df, "AUDITOR"), "full_name", "ssn", "pin") == [("A", "XXX-XX-6789", None)]
    assert governance.classifications(governance.masked(df, "AUDITOR")) == {"full_name": "PII", "pin": "PII_RESTRICTED"}


def test_odd_variants_are_hidden_from_uncleared_roles(spark):
    odd = spark.sql("SELECT parse_json(j) AS data FROM VALUES ('[{\"ssn\":\"123\"}]'), ('\"123-45-6789\"'), (NULL), ('{}') AS v(j)")
    assert [r[0] for r in governance.masked(odd, "AUDITOR").select(F.to_json("data")).collect()] == [None, None, None, "{}"]


def test_frames_without_a_branch_are_scoped_by_their_key(spark):
    held = dim(
        spark,
        (1, 1, "A", "s", 1, JAN, None, True),
        (2, 2, "B", "s", 9, JAN, None, True),
        (3, 3, "C", "s", 9, JAN, FEB, False),
        (4, 3, "C", "s", 2, FEB, None, True),
    )
    accts = star.dim_account(accounts(spark, (10, 1), (20, 2), (30, 3), (40, None), (50, 77)))
    ways = governance.scopes(held, accts)
    mapping = governance.branch_access(spark)
    moved = transactions(spark, *[(i, i * 10, "2024-01-02", "5") for i in range(1, 7)])
    seen = governance.governed(moved, "compliance_analyst", mapping, "transactions", ways)
    assert rows(seen, "account_id") == [(10,), (30,)]
    assert seen.columns == moved.columns
    assert rows(governance.governed(accts, "COMPLIANCE_ANALYST", mapping, ways=ways), "customer_id") == [(1,), (3,)]
    assert governance.governed(moved, "AUDITOR", mapping, "transactions", ways).count() == 6
    for entity, given in (("transactions", {}), (None, {}), ("transactions", None)):
        with pytest.raises(ValueError, match="no branch"):
            governance.governed(moved, "COMPLIANCE_ANALYST", mapping, entity, given)


def test_views_follow_the_role_of_the_session(spark):
    m = mart(spark, "/root/testdata/sf0.001")
    session = views.register(m)
    assert session.sql("SELECT * FROM dim_customer").count() == 0  # no role, no row
    counts = {}
    for role in ("AUDITOR", " compliance_analyst", "intern", None):
        views.as_role(session, role)
        counts[role] = [session.sql(f"SELECT * FROM {v}").count() for v in ("dim_customer", "dim_account", "fact_transaction")]
    assert counts["AUDITOR"] == [m.dim_customer.count(), m.dim_account.count(), m.fact.count()]
    assert 0 < counts[" compliance_analyst"][0] < counts["AUDITOR"][0]
    assert 0 < counts[" compliance_analyst"][2] < counts["AUDITOR"][2]
    assert counts["intern"] == counts[None] == [0, 0, 0]
    auditor = views.as_role(session, "AUDITOR").sql("SELECT ssn FROM dim_customer")
    views.as_role(session, "COMPLIANCE_ANALYST")
    assert auditor.where("ssn NOT LIKE 'XXX-XX-%'").count() == 0  # a frame keeps the role it was made under
    assert session.sql("SELECT ssn FROM dim_customer").where("ssn LIKE 'XXX-%'").count() == 0
