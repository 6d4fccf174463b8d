"""Daily cash reports kept up to date by a stream of transactions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vigilmart import settings
from vigilmart.functions.columns import cash_credit
from vigilmart.operators.dedup import latest_per_key
from vigilmart.operators.reports import over_limit, roll_up_to_customer, split_deposits
from vigilmart.sources.keyed import KeyedLog
from vigilmart.streaming.runs import each_batch

SUMS_SCHEMA = (
    "account_id BIGINT, txn_date DATE, n BIGINT, total DECIMAL(22,2), "
    "n_below BIGINT, total_below DECIMAL(22,2)"
)
MEASURES = ("n", "total", "n_below", "total_below")
TXN_SCHEMA = (
    "txn_id BIGINT, account_id BIGINT, txn_date DATE, amount DECIMAL(12,2), txn_type STRING, "
    "direction STRING, last_modified TIMESTAMP_NTZ"
)


def _sums(limit: Decimal) -> list[Column]:
    """Of all cash credits, and of those below the limit."""
    below = F.col("amount") < F.lit(limit)
    return [
        F.count("*").alias("n"),
        F.sum("amount").alias("total"),
        F.count_if(below).alias("n_below"),
        F.sum(F.when(below, F.col("amount"))).alias("total_below"),
    ]


def cash_sums(transactions: DataFrame, limit: Decimal = settings.CASH_LIMIT) -> DataFrame:
    cash = transactions.where(cash_credit())
    return cash.groupBy("account_id", "txn_date").agg(*_sums(limit))


def _latest(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["txn_id"], "last_modified")


def _added_up(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("account_id", "txn_date").agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES])
    return _as_logged(sums)


def _last_emitted(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, ["account_id", "txn_date"], [F.desc("emitted")], ties=[])


def transaction_log(spark: SparkSession, log: str, **shape: int) -> KeyedLog:
    """The latest version of every transaction."""
    return KeyedLog(spark, f"{log}/txns", TXN_SCHEMA, ["txn_id"], _latest, **shape)


def sums_log(spark: SparkSession, log: str, **shape: int) -> KeyedLog:
    """What batches added to the sums of an account and day."""
    return KeyedLog(spark, f"{log}/sums", SUMS_SCHEMA, ["account_id", "txn_date"], _added_up, **shape)


def windows_log(spark: SparkSession, log: str, **shape: int) -> KeyedLog:
    """The states of the day windows that batches emitted."""
    return KeyedLog(spark, f"{log}/windows", f"{SUMS_SCHEMA}, emitted BIGINT", ["account_id", "txn_date"], _last_emitted, **shape)


def _changed_sums(batch: DataFrame, log: str, batch_id: int, limit: Decimal, shape: dict[str, int]) -> DataFrame:
    """What a batch changes in the sums: its transactions' latest versions, less what earlier
    batches had counted for them. The versions of the batch are logged for later batches."""
    columns = [c.split()[0] for c in TXN_SCHEMA.split(", ")]
    txns = transaction_log(batch.sparkSession, log, **shape)
    own = txns.add(_latest(batch.select(*columns)), batch_id)
    counted = txns.matching(own, before=batch_id)
    now = _latest(own.unionByName(counted))
    less = cash_sums(counted, limit).select(
        "account_id", "txn_date", *[(-F.coalesce(F.col(m), F.lit(0))).alias(m) for m in MEASURES]
    )
    return _added_up(cash_sums(now, limit).unionByName(less))


def _as_logged(sums: DataFrame) -> DataFrame:
    kinds = dict(c.split() for c in SUMS_SCHEMA.split(", "))
    return sums.select(*[F.col(c).cast(kind) for c, kind in kinds.items()])


def cash_sums_stream(
    transactions: DataFrame, log: str, limit: Decimal = settings.CASH_LIMIT, **shape: int
) -> DataStreamWriter:
    """Each batch adds what it changes in the sums per account and day.

    Of all versions of a transaction, in this batch or earlier ones, the latest counts, once:
    a redelivery changes nothing, a correction moves the difference. Transactions count
    however late they are, and with or without a date. A replayed batch overwrites its own
    runs, and looks at versions below it only. Earlier versions of the batch's transactions
    are looked up in the buckets, and there in the key ranges, that hold them. ``shape``:
    ``buckets`` and ``most_runs`` of the logs.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        sums_log(batch.sparkSession, log, **shape).add(_changed_sums(batch, log, batch_id, limit, shape), batch_id)

    return each_batch(transactions, log, handle)


def read_cash_sums(spark: SparkSession, log: str) -> DataFrame:
    return sums_log(spark, log).read().where("n > 0")


def windowed_cash_stream(
    transactions: DataFrame, log: str, limit: Decimal = settings.CASH_LIMIT, **shape: int
) -> DataStreamWriter:
    """Running day windows per account, emitted again whenever a batch changes them.

    For alerts while the day is running. No window ever closes: late, corrected and undated
    transactions change theirs, at whatever time they come. Only buckets of changed windows
    are opened.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        sums = sums_log(batch.sparkSession, log, **shape)
        added = sums.add(_changed_sums(batch, log, batch_id, limit, shape), batch_id)
        state = _added_up(added.unionByName(sums.matching(added, before=batch_id)))
        windows_log(batch.sparkSession, log, **shape).add(state.withColumn("emitted", F.lit(batch_id).cast("bigint")), batch_id)

    return each_batch(transactions, log, handle)


def read_cash_windows(spark: SparkSession, log: str) -> DataFrame:
    """The last emitted state of every window that still holds a transaction."""
    return windows_log(spark, log).read().where("n > 0").drop("emitted")


def ctr_from_sums(
    sums: DataFrame,
    dim_account: DataFrame,
    dim_customer: DataFrame,
    limit: Decimal = settings.CASH_LIMIT,
) -> DataFrame:
    """The report over the sums, with customers as they are when it is read."""
    return over_limit(roll_up_to_customer(sums, "account_id", dim_account, dim_customer), limit)


def structuring_from_sums(
    sums: DataFrame,
    dim_account: DataFrame,
    dim_customer: DataFrame,
    limit: Decimal = settings.CASH_LIMIT,
    min_deposits: int = settings.MIN_SPLIT_DEPOSITS,
) -> DataFrame:
    """Split deposits from sums that were taken with the same limit."""
    below = sums.where("n_below > 0").select(
        "account_id", "txn_date", F.col("n_below").alias("n"), F.col("total_below").alias("total")
    )
    days = roll_up_to_customer(below, "account_id", dim_account, dim_customer)
    return split_deposits(days, limit, min_deposits)
