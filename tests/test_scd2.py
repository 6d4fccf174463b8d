from __future__ import annotations

import random

import pytest
from frames import FEB, JAN, MAR, SRC_SCHEMA, at, dim, rows, src

from vigilmart.operators import scd2

SHAPE = ("customer_id", "kyc_status", "valid_from", "valid_to", "is_current")


def loaded(spark, *customers):
    return scd2.first_load(src(spark, *customers), JAN)


def test_first_load_is_all_current_with_keys_from_one(spark):
    first = loaded(spark, (7, "VERIFIED", "US", "A"), (3, "PENDING", "US", "B"))
    assert rows(first, "customer_sk", "customer_id", "is_current", "valid_to") == [
        (1, 3, True, None),
        (2, 7, True, None),
    ]
    assert scd2.verify(first).first().asDict() == {"total_rows": 2, "current_rows": 2}


def test_a_status_change_gives_a_second_version(spark):
    first = loaded(spark, (1, "VERIFIED", "US", "A"), (2, "VERIFIED", "US", "B"))
    second = scd2.apply_snapshot(
        first, src(spark, (1, "PENDING", "US", "A"), (2, "VERIFIED", "US", "B")), FEB
    )
    assert rows(second, "customer_sk", *SHAPE) == [
        (1, 1, "VERIFIED", at(JAN), at(FEB), False),
        (2, 2, "VERIFIED", at(JAN), None, True),
        (3, 1, "PENDING", at(FEB), None, True),
    ]


def test_applying_the_same_snapshot_twice_changes_nothing(spark):
    snapshot = src(spark, (1, "PENDING", "US", "A"), (4, "VERIFIED", "US", "N"))
    once = scd2.apply_snapshot(loaded(spark, (1, "VERIFIED", "US", "A")), snapshot, FEB)
    twice = scd2.apply_snapshot(once, snapshot, MAR)
    assert rows(once, *scd2.DIM_COLUMNS) == rows(twice, *scd2.DIM_COLUMNS)


def test_null_on_either_side_is_no_change_by_default(spark):
    first = loaded(spark, (1, None, "US", "A"), (2, "VERIFIED", "US", "B"))
    snapshot = src(spark, (1, "VERIFIED", "US", "A"), (2, None, "US", "B"))
    assert scd2.apply_snapshot(first, snapshot, FEB).count() == 2
    assert scd2.apply_snapshot(first, snapshot, FEB, null_safe=True).count() == 4


def test_untracked_columns_do_not_make_a_version_unless_asked(spark):
    first = loaded(spark, (1, "VERIFIED", "US", "A"))
    moved = spark.createDataFrame([(1, "A", "000-00-0001", "US", 9, "VERIFIED")], SRC_SCHEMA)
    assert scd2.apply_snapshot(first, moved, FEB).count() == 1
    assert scd2.apply_snapshot(first, moved, FEB, tracked=("branch_id",)).count() == 2


def test_a_customer_missing_from_the_source_stays_current(spark):
    first = loaded(spark, (1, "VERIFIED", "US", "A"))
    after = scd2.apply_snapshot(first, src(spark, (2, "VERIFIED", "US", "B")), FEB)
    assert rows(after.where("is_current"), "customer_id") == [(1,), (2,)]


def test_a_customer_with_only_closed_versions_becomes_current_again(spark):
    old = dim(spark, (5, 1, "A", "s", 1, JAN, FEB, False))
    after = scd2.apply_snapshot(old, src(spark, (1, "VERIFIED", "US", "A")), MAR)
    assert rows(after, "customer_sk", "is_current") == [(5, False), (6, True)]


def test_starting_from_an_empty_history(spark):
    after = scd2.apply_snapshot(scd2.empty_dim(spark), src(spark, (1, "VERIFIED", "US", "A")), JAN)
    assert rows(after, "customer_sk", "customer_id", "is_current") == [(1, 1, True)]
    assert scd2.verify(scd2.empty_dim(spark)).first().asDict() == {
        "total_rows": 0,
        "current_rows": None,
    }


def test_null_keys_never_match(spark):
    first = loaded(spark, (None, "VERIFIED", "US", "A"))
    after = scd2.apply_snapshot(first, src(spark, (None, "PENDING", "US", "A")), FEB)
    assert rows(after, "customer_sk", "is_current") == [(1, True), (2, True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_single_pass_equals_close_out_then_insert(spark, seed):
    """Also where the history already breaks its rule of one current version."""
    pick = random.Random(seed)

    def attributes():
        return pick.choice(["VERIFIED", "PENDING", None]), pick.choice(["US", "XX"])

    versions, incoming = [], []
    for cid in range(300):
        for _ in range(pick.randrange(4)):
            kyc, country = attributes()
            now = pick.random() < 0.6
            sk = len(versions) + 1
            ended = None if now else at(JAN)
            versions.append((sk, cid, "A", "s", country, 1, kyc, at(JAN), ended, now))
        if pick.random() < 0.7:
            incoming.append((cid, *attributes(), "A"))
    before = spark.createDataFrame(versions, scd2.DIM_SCHEMA)
    source = src(spark, *incoming)
    expected = scd2.insert_missing(scd2.close_out(before, source, FEB), source, FEB)
    assert rows(scd2.apply_snapshot(before, source, FEB), *scd2.DIM_COLUMNS) == rows(
        expected, *scd2.DIM_COLUMNS
    )


def test_history_invariants_after_several_loads(spark):
    held = scd2.empty_dim(spark)
    for month in range(1, 5):
        snapshot = src(
            spark,
            *[(i, "PENDING" if (i + month) % 3 else "VERIFIED", "US", "A") for i in range(20)],
        )
        held = scd2.apply_snapshot(held, snapshot, f"2024-{month:02d}-01 00:00:00")
    versions = sorted(held.collect(), key=lambda r: (r.customer_id, r.valid_from))
    assert sorted(r.customer_sk for r in versions) == list(range(1, len(versions) + 1))
    for a, b in zip(versions, versions[1:]):
        if a.customer_id == b.customer_id:
            assert a.valid_to == b.valid_from and not a.is_current
        else:
            assert a.is_current and a.valid_to is None
    numbered = scd2.history(held)
    assert numbered.where("version_no = 1").count() == 20


@pytest.mark.parametrize("operator", [scd2.close_out, scd2.apply_snapshot])
def test_an_empty_source_changes_nothing(spark, operator):
    first = loaded(spark, (1, "VERIFIED", "US", "A"))
    after = operator(first, src(spark), FEB)
    assert rows(after, *scd2.DIM_COLUMNS) == rows(first, *scd2.DIM_COLUMNS)


@pytest.mark.parametrize("step", [scd2.apply_snapshot, scd2.close_out, scd2.insert_missing])
def test_several_source_rows_of_a_customer_are_an_error(spark, step):
    first = loaded(spark, (1, "VERIFIED", "US", "A"))
    twice = src(spark, (1, "PENDING", "US", "A"), (7, "PENDING", "US", "B"), (7, "VERIFIED", "US", "B"))
    with pytest.raises(Exception, match="several source rows of customer 7"):
        step(first, twice, FEB).collect()
    nobody = src(spark, (None, "PENDING", "US", "A"), (None, "PENDING", "US", "B"))
    assert step(first, nobody, FEB).count() >= 1
