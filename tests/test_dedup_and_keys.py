from __future__ import annotations

from frames import at, rows

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigilmart.operators.dedup import latest_per_key
from vigilmart.operators.keys import dense_key

SCHEMA = "k BIGINT, v STRING, t TIMESTAMP_NTZ"


def test_null_time_counts_as_newest(spark):
    df = spark.createDataFrame([(1, "old", at("2024-01-01")), (1, "unknown", None)], SCHEMA)
    assert rows(latest_per_key(df, ["k"], "t"), "v") == [("unknown",)]


def test_equal_times_fall_back_to_the_other_columns(spark):
    tied = [(1, "b", at("2024-01-01")), (1, "a", at("2024-01-01"))]
    for order in (tied, tied[::-1]):
        df = spark.createDataFrame(order, SCHEMA)
        assert rows(latest_per_key(df, ["k"], "t"), "v") == [("a",)]


def test_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, "a", at("2024-01-01")), (None, "b", at("2024-01-02"))], SCHEMA)
    assert rows(latest_per_key(df, ["k"], "t"), "v") == [("b",)]


def test_without_a_time_the_other_columns_decide(spark):
    df = spark.createDataFrame([("n", "z"), ("n", "a"), ("m", None)], "name STRING, list STRING")
    assert rows(latest_per_key(df, ["name"]), "name", "list") == [("m", None), ("n", "a")]


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert latest_per_key(empty, ["k"], "t").count() == 0
    assert dense_key(empty, ["k"], "sk").count() == 0


def test_losers_are_pruned_before_the_shuffle(spark):
    """A key with most of the rows sends one row per input partition."""
    hot = spark.range(100_000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("v"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"),
    )
    best = latest_per_key(hot, ["k"], "t")
    plan = best._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle
    assert best.where("k = 0").first()["v"] == "99999"
    assert best.count() == 1 + 100_000 // 3


def test_dense_key_equals_the_global_numbering(spark):
    df = spark.range(5_000).select(
        F.when(F.col("id") % 1_000 == 7, F.lit(None)).otherwise(F.xxhash64("id")).alias("k"),
        F.col("id").alias("v"),
    ).repartition(7)
    order = [F.col("k").asc_nulls_last(), F.col("v").asc_nulls_last()]
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    keyed = dense_key(df, ["k", "v"], "sk")
    assert rows(keyed, "sk", "k", "v") == rows(expected, "sk", "k", "v")


def test_dense_key_over_several_partitions_and_with_a_start(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "6")
    keyed = dense_key(spark.range(1_000).select(F.col("id").alias("k")), ["k"], "sk", start=50)
    assert rows(keyed, "k", "sk") == sorted(((i, i + 51) for i in range(1_000)), key=repr)
    assert len({p for (p,) in rows(keyed.select(F.spark_partition_id().alias("p")), "p")}) > 1


def test_dense_key_has_no_single_partition_step(spark):
    keyed = dense_key(spark.range(100).select(F.col("id").alias("k")), ["k"], "sk")
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Exchange" not in plan
