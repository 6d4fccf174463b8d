"""Dashboard figures over the star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilmart.functions.columns import cash_credit, money


def _ratio(part: Column, whole: Column) -> Column:
    quotient = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(quotient, 6)


def sums() -> list[Column]:
    """Counts and sums of facts from which all figures follow, and which add up themselves."""
    cash = F.col("txn_type") == "CASH"
    return [
        F.count("*").alias("n"),
        F.count("amount").alias("amounts"),
        money(F.sum("amount")).alias("total"),
        money(F.sum(F.when(cash, F.col("amount")))).alias("cash"),
        money(F.sum(F.when(cash_credit(), F.col("amount")))).alias("cash_credits"),
    ]


def added() -> list[Column]:
    """Sums of ``sums``."""
    counts = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "amounts")]
    return counts + [money(F.sum(c)).alias(c) for c in ("total", "cash", "cash_credits")]


def summary(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """The figures from one row of ``sums`` and one row with ``ctr_customers``."""
    figures = totals.select(
        F.col("cash_credits").alias("total_cash_credits"),
        F.col("n").alias("txn_count"),
        _ratio(F.col("total"), F.col("amounts")).alias("avg_txn_value"),
        (_ratio(F.col("cash") * 100, F.col("total"))).alias("cash_pct_of_volume"),
    )
    both = figures.unionByName(customers, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def kpi_summary(fact: DataFrame, ctr_candidates: DataFrame) -> DataFrame:
    """One row of totals: a single pass over the fact, plus the report's customers."""
    customers = ctr_candidates.agg(F.count_distinct("customer_id").alias("ctr_customers"))
    return summary(fact.agg(*sums()), customers)


def kpi_branch_breakdown(fact: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Count and sum per branch; transactions without one stay as a row of their own."""
    per_branch = fact.groupBy("branch_sk").agg(
        F.count("*").alias("txn_count"), money(F.sum("amount")).alias("total_amount")
    )
    return named_branches(per_branch, dim_branch)


def named_branches(per_branch: DataFrame, dim_branch: DataFrame) -> DataFrame:
    names = dim_branch.select("branch_sk", "branch_name")
    return per_branch.join(names, "branch_sk", "left").select(
        "branch_name", "txn_count", "total_amount"
    )


def kpi_volume_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("txn_date").agg(
        F.count("*").alias("txn_count"), money(F.sum("amount")).alias("total_amount")
    )
