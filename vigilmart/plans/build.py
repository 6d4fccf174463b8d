"""The batch build: landing -> bronze -> silver -> customer history -> star, then the gate.

Each layer is a folder of written tables. Every step reads finished tables, so a lost
executor costs at most the running step, and the planner knows the size of each input.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilmart import settings
from vigilmart.operators import governance, quality, scd2, silver, star
from vigilmart.sources.batches import exists
from vigilmart.sources.bronze import bronze_load, read_bronze
from vigilmart.sources.keyed import last_version, versions, write_map
from vigilmart.sources.workspace import write_by_month, write_table

PUBLISHED = "published"


@dataclass(frozen=True)
class Mart:
    """The written tables of one build."""

    spark: SparkSession
    root: str
    bronze: Mapping[str, DataFrame]
    accounts: DataFrame
    transactions: DataFrame
    watchlist: DataFrame
    dim_customer: DataFrame
    dim_date: DataFrame
    dim_branch: DataFrame
    dim_transaction_type: DataFrame
    dim_account: DataFrame
    fact: DataFrame

    def quality_tables(self) -> quality.Tables:
        return quality.Tables(
            bronze=self.bronze,
            accounts=self.accounts,
            transactions=self.transactions,
            dim_customer=self.dim_customer,
            dim_account=self.dim_account,
            fact=self.fact,
        )


def side_by_side(*steps: Callable[[], Any]) -> list[Any]:
    """Run independent steps at the same time, so small jobs fill the cluster together."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(step) for step in steps]
        return [step.result() for step in running]


def build(
    spark: SparkSession,
    landing: str,
    root: str,
    as_of: str | datetime | None = None,
    previous_customers: DataFrame | None = None,
    expected_rows: Mapping[str, int] | None = None,
    on_fail: str = "raise",
    bad_rows: str = "raise",
) -> Mart:
    """Build all layers under ``root`` from the entity folders under ``landing``.

    ``previous_customers`` is the customer history to continue; without it the history
    starts. ``root`` must be a new folder then, as the history is read while it is written.

    The scorecard decides on publication; its row counts are checked where ``expected_rows``
    are given. If a check fails the build raises and ``root`` stays unpublished, so readers
    that ask ``published`` go on with the build before. ``on_fail="report"`` publishes with
    the failing checks named in the publication's row.

    A value that is none of its field's type fails the build; with ``bad_rows="quarantine"`` its
    row goes to ``quarantine/<entity>`` with what is wrong, and the others load.
    """
    if bad_rows not in ("raise", "quarantine"):
        raise ValueError(f"bad_rows is raise or quarantine, not {bad_rows!r}")
    if on_fail not in ("raise", "report"):
        raise ValueError(f"on_fail is raise or report, not {on_fail!r}")
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    raw = f"{root}/raw"

    def loaded(entity: str) -> DataFrame:
        bronze_load(spark, landing, raw, as_of, entities=(entity,))
        return read_bronze(spark, raw, entity)

    def written(df: DataFrame, layer: str, table: str) -> DataFrame:
        return write_table(df, f"{root.rstrip('/')}/{layer}/{table}")

    # Sifted rows are read leniently: strict extraction may run in the scan, before the sieve.
    strict = bad_rows == "raise"

    def sound(rows: DataFrame, entity: str) -> DataFrame:
        if strict:
            return rows
        good, bad = silver.sifted(rows, silver.FIELDS[entity])
        written(bad, "quarantine", entity)
        return good

    def account_chain() -> tuple[DataFrame, ...]:
        rows = loaded("accounts")
        accounts = written(silver.accounts(sound(rows, "accounts"), strict), "silver", "accounts")
        return rows, accounts, written(star.dim_account(accounts), "gold", "dim_account")

    def transaction_chain() -> tuple[DataFrame, ...]:
        rows = loaded("transactions")
        transactions = written(silver.transactions(sound(rows, "transactions"), strict), "silver", "transactions")
        types = star.dim_transaction_type(transactions)
        return rows, transactions, written(types, "gold", "dim_transaction_type")

    def customer_chain() -> tuple[DataFrame, ...]:
        rows = loaded("customers")
        source = silver.customer_src(sound(rows, "customers"), strict)
        if previous_customers is None:
            versions = scd2.first_load(source, as_of)
        else:
            versions = scd2.apply_snapshot(previous_customers, source, as_of)
        versions = governance.classify(versions, settings.CUSTOMER_TAGS)
        dim_customer = written(versions, "silver", "dim_customer")
        return rows, dim_customer, written(star.dim_branch(dim_customer), "gold", "dim_branch")

    def watchlist_chain() -> tuple[DataFrame, ...]:
        rows = loaded("watchlist")
        return rows, written(silver.watchlist(sound(rows, "watchlist"), strict), "silver", "watchlist")

    def calendar() -> DataFrame:
        return written(star.dim_date(spark), "gold", "dim_date")

    (
        (raw_customers, dim_customer, dim_branch),
        (raw_accounts, accounts, dim_account),
        (raw_transactions, transactions, dim_transaction_type),
        (raw_watchlist, watchlist),
        dim_date,
    ) = side_by_side(customer_chain, account_chain, transaction_chain, watchlist_chain, calendar)
    bronze = {
        "customers": raw_customers,
        "accounts": raw_accounts,
        "transactions": raw_transactions,
        "watchlist": raw_watchlist,
    }
    fact = star.fact_transaction(
        transactions, dim_account, dim_transaction_type, dim_customer, dim_branch, dim_date
    )
    mart = Mart(
        spark=spark,
        root=root,
        bronze=bronze,
        accounts=accounts,
        transactions=transactions,
        watchlist=watchlist,
        dim_customer=dim_customer,
        dim_date=dim_date,
        dim_branch=dim_branch,
        dim_transaction_type=dim_transaction_type,
        dim_account=dim_account,
        fact=write_by_month(fact, f"{root.rstrip('/')}/gold/fact_transaction", "txn_date"),
    )
    card = written(quality.scorecard(mart.quality_tables(), expected_rows), "checks", "scorecard")
    if on_fail == "raise":
        quality.enforce(card)
    failed = card.agg(F.concat_ws(", ", F.sort_array(F.collect_list(F.when(F.col("status") == "FAIL", F.col("check_name"))))).alias("failed"))
    write_table(failed.withColumn("as_of", F.lit(str(as_of)).cast("timestamp_ntz")), f"{root.rstrip('/')}/{PUBLISHED}")
    return mart


def published(spark: SparkSession, root: str) -> bool:
    """Whether the build under ``root`` passed its checks and may be read."""
    return exists(spark, f"{root.rstrip('/')}/{PUBLISHED}")


def build_next(spark: SparkSession, landing: str, base: str, **options: Any) -> Mart:
    """Build into a folder of its own under ``base`` and, once published, point readers to it.

    The folder is numbered after the last build that was pointed to or began; a build that fails
    its checks leaves the pointer where it is.
    """
    number = (max(build_numbers(spark, base), default=-1)) + 1
    write_map(spark, f"{base.rstrip('/')}/begun", "n BIGINT", [(number,)], number)
    mart = build(spark, landing, f"{base.rstrip('/')}/build-{number}", **options)
    write_map(spark, base, "build BIGINT", [(number,)], number)
    return mart


def build_numbers(spark: SparkSession, base: str) -> list[int]:
    """Of the builds that began last, and that readers were pointed to last."""
    found = (last_version(spark, root) for root in (f"{base.rstrip('/')}/begun", base.rstrip("/")))
    return [n for n in found if n is not None]


def latest_published(spark: SparkSession, base: str) -> str | None:
    """The folder of the last build under ``base`` that passed its checks."""
    number = last_version(spark, base.rstrip("/"))
    return None if number is None else f"{base.rstrip('/')}/build-{number}"


def expired(spark: SparkSession, base: str, keep: int = 3) -> list[str]:
    """Folders of builds that are neither among the last ``keep`` published ones nor still running:
    what a retention job may delete."""
    base = base.rstrip("/")
    published_builds = versions(spark, base)
    begun = versions(spark, f"{base}/begun")
    held = set(published_builds[-keep:])
    last = published_builds[-1] if published_builds else -1
    return [f"{base}/build-{n}" for n in begun if n not in held and n < last]
