from __future__ import annotations

import random

import pytest
from frames import FEB, JAN, dim, rows

from pyspark.sql import functions as F

from vigilmart.functions.columns import match_name
from vigilmart.operators import screening
from vigilmart.sources import adapters


def watch(spark, *entries):
    return spark.createDataFrame(list(entries), "name STRING, list_source STRING")


def named(spark, *names):
    return dim(spark, *[(i, i, n, "s", 1, JAN, None, True) for i, n in enumerate(names)])


def edits(a, b):
    """Levenshtein distance, the plain way."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_case_and_outer_spaces_do_not_matter_inner_spaces_do(spark):
    held = named(spark, " ada Stone", "ADA STONE ", "Ada  Stone", None)
    hits = screening.sanctions_hits(held, watch(spark, ("  Ada stone ", "L"), (None, "L")))
    assert rows(hits, "customer_id", "list_source") == [(0, "L"), (1, "L")]


def test_only_current_versions_and_each_hit_once(spark):
    held = dim(
        spark,
        (1, 1, "Ada", "s", 1, JAN, FEB, False),
        (2, 2, "Ada", "s", 1, JAN, None, True),
        (3, 2, "Ada", "s", 1, JAN, None, True),
    )
    listed = watch(spark, ("ada", "L"), ("ADA ", "L"), ("Ada", "M"))
    assert rows(screening.sanctions_hits(held, listed), "customer_id", "list_source") == [
        (2, "L"),
        (2, "M"),
    ]


def brute_force(names, listed, distance):
    found = []
    for i, name in enumerate(names):
        per_list = {}
        for other, source in listed:
            if name is not None and other is not None:
                d = edits(name.strip(" ").upper(), other.strip(" ").upper())
                if d <= distance:
                    per_list[source] = min(d, per_list.get(source, d))
        found += [(i, source, d) for source, d in per_list.items()]
    return sorted(found, key=repr)


def mutate(pick, text):
    for _ in range(pick.randrange(4)):
        at = pick.randrange(len(text) + 1)
        kind = pick.randrange(3)
        if kind == 0:
            text = text[:at] + pick.choice("abc ") + text[at:]
        elif kind == 1:
            text = text[:at] + text[at + 1 :]
        else:
            text = text[:at] + pick.choice("abc") + text[at + 1 :]
    return text


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_fuzzy_match_finds_exactly_the_near_names(spark, distance):
    """Names around the lengths where grams take over from variants, long and empty ones."""
    pick = random.Random(distance)
    lengths = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 20, 30, 61, 62, 63, 64, 65, 66, 67, 68, 90, 200]
    roots = ["".join(pick.choice("abc") for _ in range(n)) for n in lengths]
    shared = ["common prefix of all names " + root for root in roots[4:9]]
    listed = [(root, pick.choice("LM")) for root in roots + shared] + [(None, "L")]
    names = [mutate(pick, root) for root, _ in listed[:-1] for _ in range(6)] + [None, ""]
    found = screening.sanctions_fuzzy(named(spark, *names), watch(spark, *listed), distance)
    assert rows(found, "customer_id", "list_source", "distance") == brute_force(names, listed, distance)


def test_names_with_one_long_prefix_do_not_all_meet(spark):
    """What all names have in common is no join key: candidates stay near the real hits."""
    prefix = "INTERNATIONAL TRADING AND HOLDING COMPANY OF THE EASTERN SEA NUMBER "
    names = spark.range(2_000).selectExpr(f"'{prefix}' || md5(cast(id AS string)) AS match_name")
    listed = names.limit(500).withColumnRenamed("match_name", "listed_name")
    assert screening.candidate_names(names, listed, 2).count() < 20_000
    assert screening.similar_names(names, listed, 2).where("distance = 0").count() == 500


@pytest.mark.parametrize("size", ["0.01", "0.1"])
def test_numbered_names_hardly_meet_unless_near(spark, size):
    root = f"/root/testdata/sf{size}"
    names = adapters.customers(spark, root).select(match_name(F.col("full_name")).alias("match_name")).distinct()
    listed = adapters.watchlist(spark, root).select(match_name(F.col("name")).alias("listed_name")).distinct()
    pairs = names.count() * listed.count()
    met = screening.candidate_names(names, listed, 2)
    near = met.where(F.levenshtein("match_name", "listed_name") <= 2).count()
    assert met.count() < max(0.02 * pairs, 2 * near)


def test_empty_inputs(spark):
    empty, listed = named(spark), watch(spark, ("Ada", "L"))
    for screen in (screening.sanctions_hits, screening.sanctions_fuzzy):
        assert screen(empty, listed).count() == 0
        assert screen(named(spark, "Ada"), watch(spark)).count() == 0


def test_names_are_broadcast_only_by_their_written_size(spark, conf):
    pick = random.Random(5)
    roots = ["".join(pick.choice("abc") for _ in range(n)) for n in (3, 9, 30, 70)]
    listed = spark.createDataFrame([(r,) for r in roots], "listed_name STRING")
    names = spark.createDataFrame(
        [(mutate(pick, r),) for r in roots for _ in range(5)], "match_name STRING"
    ).distinct()
    small = screening.similar_names(names, listed, 2)
    found = rows(small, "match_name", "listed_name", "distance")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = screening.similar_names(names, listed, 2)
    assert "Broadcast" not in large._jdf.queryExecution().executedPlan().toString()
    assert rows(large, "match_name", "listed_name", "distance") == found


def test_many_variants_are_not_sent_to_all_tasks(spark):
    """The file of 400 names is small, their 60,000 variants are not."""
    names = spark.range(500).selectExpr("'CUSTOMER#' || lpad(cast(id AS string), 9, '0') AS match_name")
    listed = names.limit(400).withColumnRenamed("match_name", "listed_name")
    met = screening.candidate_names(names, listed, 2)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [key#" not in plan
    assert "SortMergeJoin [key#" in plan
    near = names.crossJoin(listed).where(F.levenshtein("match_name", "listed_name") <= 2)
    assert near.exceptAll(met).count() == 0


def test_a_name_shared_by_most_customers_is_compared_once(spark):
    shared = spark.range(20_000).selectExpr(
        "id AS customer_sk",
        "id AS customer_id",
        "CASE WHEN id % 3 < 2 THEN 'Jon Smith' ELSE 'Name ' || id END AS full_name",
        "TRUE AS is_current",
    )
    found = screening.sanctions_fuzzy(shared, watch(spark, ("JOHN SMITH", "L")), 1)
    assert found.count() == 13_334
    assert found.where("distance <> 1").count() == 0
