"""The four source shapes, derived from a TPC-H-like set of tables.

The expressions are plain SQL that other engines evaluate to the same values. Every row of
the customer, supplier and event tables takes part. Which customers are listed, and which
change between the two deliveries, follows from their id: that makes the cases the reports
have to tell apart, at any size of the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_SNAPSHOT = "2024-01-01 00:00:00"
SECOND_SNAPSHOT = "2024-02-01 00:00:00"
NEW_CUSTOMER_OFFSET = 1_000_000_000_000

SSN = (
    "lpad(cast((c_custkey*7919)%1000 as string),3,'0') || '-' || "
    "lpad(cast((c_custkey*31)%100 as string),2,'0') || '-' || "
    "lpad(cast((c_custkey*6101)%10000 as string),4,'0')"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _delivered_again(rows: DataFrame, key: str, older: dict[str, str]) -> DataFrame:
    """The rows with older versions of some and repeats of others, as deliveries have them.

    ``older`` says how a version of the day before differs. Latest versions are the rows.
    """
    old = rows.where(f"{key} % 25 = 5").selectExpr(
        *[f"{older[c]} AS {c}" if c in older else c for c in rows.columns]
    ).withColumn("last_modified", F.col("last_modified") - F.expr("INTERVAL 1 DAY"))
    return rows.unionByName(old).unionByName(rows.where(f"{key} % 25 = 6"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf_dir, "customer")
    first = rows.join(nation, rows["c_nationkey"] == nation["n_nationkey"]).selectExpr(
        "c_custkey AS customer_id",
        "c_name AS full_name",
        f"{SSN} AS ssn",
        "n_name AS country",
        "cast(c_custkey%12+1 AS int) AS branch_id",
        "CASE WHEN c_mktsegment='FURNITURE' THEN 'PENDING' ELSE 'VERIFIED' END AS kyc_status",
        f"TIMESTAMP_NTZ '{FIRST_SNAPSHOT}' AS last_modified",
    )
    return _delivered_again(first, "customer_id", {"country": "'ZZ'", "kyc_status": "'PENDING'"})


def customers_second_snapshot(first: DataFrame) -> DataFrame:
    """The later delivery: changed, moved, missing and new customers."""
    first = first.where(F.col("last_modified") == F.lit(FIRST_SNAPSHOT).cast("timestamp_ntz"))
    cid = F.col("customer_id")
    flipped = F.when(F.col("kyc_status") == "VERIFIED", "PENDING").otherwise("VERIFIED")
    kept = first.where(cid % 100 != 7).select(
        "customer_id",
        "full_name",
        "ssn",
        F.when(cid % 25 == 1, "XX").otherwise(F.col("country")).alias("country"),
        F.when(cid % 10 == 5, F.col("branch_id") % 12 + 1)
        .otherwise(F.col("branch_id"))
        .cast("int")
        .alias("branch_id"),
        F.when(cid % 10 == 0, flipped).otherwise(F.col("kyc_status")).alias("kyc_status"),
        F.lit(SECOND_SNAPSHOT).cast("timestamp_ntz").alias("last_modified"),
    )
    added = (
        first.where(cid % 100 == 3)
        .withColumn("customer_id", cid + NEW_CUSTOMER_OFFSET)
        .withColumn("last_modified", F.lit(SECOND_SNAPSHOT).cast("timestamp_ntz"))
    )
    return kept.unionByName(added)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = (
        table(spark, sf_dir, "customer")
        .selectExpr(
            "c_custkey",
            "explode(CASE WHEN c_custkey%2=0 THEN array(0,1) ELSE array(0) END) AS k",
        )
        .selectExpr(
            "c_custkey*2+k AS account_id",
            "c_custkey AS customer_id",
            "CASE WHEN k=0 THEN 'CHECKING' ELSE 'SAVINGS' END AS account_type",
            "date_add(DATE '2020-01-01', cast(c_custkey%1000 AS int)) AS open_date",
            f"TIMESTAMP_NTZ '{FIRST_SNAPSHOT}' AS last_modified",
        )
    )
    return _delivered_again(first, "account_id", {"account_type": "'CLOSED'"})


TRANSACTION_COLUMNS = (
    "event_id AS txn_id",
    "user_id*2 + CASE WHEN user_id%2=0 THEN event_id%2 ELSE 0 END AS account_id",
    "cast(ts AS date) AS txn_date",
    "cast(round(value*100,2) AS decimal(12,2)) AS amount",
    "CASE event_type WHEN 'purchase' THEN 'CASH' WHEN 'click' THEN 'CASH' "
    "WHEN 'view' THEN 'CARD' WHEN 'signup' THEN 'ACH' ELSE 'WIRE' END AS txn_type",
    "CASE WHEN event_id%4=3 THEN 'DEBIT' ELSE 'CREDIT' END AS direction",
    "ts AS last_modified",
)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").selectExpr(*TRANSACTION_COLUMNS)
    return _delivered_again(first, "txn_id", {"amount": "cast(amount*2 AS decimal(12,2))"})


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers in another spelling, half of them on two lists, and all suppliers, which
    match nobody."""
    matching = table(spark, sf_dir, "customer").where("c_custkey%50=1")
    twice = matching.where("c_custkey%100=1").selectExpr("'  ' || lower(c_name) || ' ' AS name", "'EU LIST' AS list_source")
    other = table(spark, sf_dir, "supplier")
    names = matching.selectExpr("'  ' || lower(c_name) || ' ' AS name")
    listed = names.unionByName(other.selectExpr("s_name AS name")).withColumn(
        "list_source", F.lit("OFAC SDN")
    )
    return listed.unionByName(twice)


UNDATED = "txn_id % 50 = 7"
OUTDATED = "txn_id % 10 = 0"


def transaction_deliveries(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transactions as they might arrive: repeated, corrected, out of order, some undated.

    The latest versions over all deliveries are ``rows``, with no date where ``UNDATED`` says.
    """
    final = rows.withColumn("txn_date", F.when(~F.expr(UNDATED), F.col("txn_date")))
    old = final.withColumn("amount", (F.col("amount") * 2).cast("decimal(12,2)")).withColumn(
        "last_modified", F.col("last_modified") - F.expr("INTERVAL 1 DAY")
    )
    first = final.where(f"txn_id % 2 = 0 AND NOT {OUTDATED}").unionByName(old.where(OUTDATED))
    second = final.where("txn_id % 2 <> 0").unionByName(first.where("txn_id % 4 = 0"))
    third = final.where(OUTDATED).unionByName(old.where("txn_id % 20 = 0")).unionByName(second.where("txn_id % 5 = 1"))
    return first, second, third


SOURCES = {
    "customers": customers,
    "accounts": accounts,
    "transactions": transactions,
    "watchlist": watchlist,
}
