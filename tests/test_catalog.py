"""Every named query against its SQL, and the expected counts of the mapped tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

from vigilmart.plans.catalog import QUERIES, mart
from vigilmart.plans.oracles import ORACLES

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("ctr_candidates", 517),
        ("structuring_flags", 56),
        ("sanctions_hits", 30),
        ("row_access", 750),
        ("dedup_latest", 45832),
        ("scd2_apply", 1725),
    ],
)
def test_counts_at_the_next_size(spark, name, expected):
    assert QUERIES[name](spark, MEDIUM).count() == expected


def test_current_rows_after_the_second_delivery(spark):
    assert QUERIES["scd2_verify"](spark, MEDIUM).first()["current_rows"] == 1515


def test_mart_is_reused_until_a_source_changes(spark):
    assert mart(spark, SMALL) is mart(spark, SMALL)


def test_entry_points(spark):
    import __spark_entry__ as points

    assert points.entry(spark).count() == 54
    assert set(points.oracle_sql()) <= set(points.queries())
