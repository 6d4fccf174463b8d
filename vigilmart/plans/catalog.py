"""Named queries over a folder of source tables.

The mart of a folder is built once per session and rebuilt when a source file changes; the
queries of a layer read the layer below it, as the reports of a warehouse read its tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vigilmart import settings
from vigilmart.functions.columns import field
from vigilmart.operators import (
    governance,
    kpis,
    quality,
    reports,
    scd2,
    screening,
    silver,
    star,
)
from vigilmart.operators.dedup import latest_per_key
from vigilmart.plans import incremental, rollups, views
from vigilmart.plans.build import Mart, build, side_by_side
from vigilmart.sources import adapters, bronze, files
from vigilmart.sources.bronze import bronze_load, read_bronze
from vigilmart.sources.workspace import new_folder, settle
from vigilmart.streaming import bronze as bronze_streams
from vigilmart.streaming import cash, dedup, history
from vigilmart.streaming.runs import drain

Query = Callable[[SparkSession, str], DataFrame]

SOURCE_TABLES = ("customer", "nation", "supplier", "events")
FIRST, SECOND = adapters.FIRST_SNAPSHOT, adapters.SECOND_SNAPSHOT
MID_MONTH = "2024-01-15 00:00:00"
# The row counts that the scorecard expects, and the roles its samples show.
EXPECTED_ROWS = {"customers": 500, "accounts": 773, "transactions": 31153}
LOOKED_UP_NAME = "Customer#000000001"
SUMMED_MONTHS = ("2024-01", "2024-03")
STREAM_BUCKETS = 2  # the tables of these queries are a few MB
SAMPLE_ROLES = ("COMPLIANCE_ANALYST", "AUDITOR")
COUNTED_ROLES = ("ACCOUNTADMIN", "AUDITOR", "COMPLIANCE_ANALYST")

_built: dict[tuple, tuple[str, Mart]] = {}


def _files_stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """One row that changes whenever a source file does."""
    listing = files.file_manifest(spark, *[f"{sf_dir}/{t}.parquet" for t in SOURCE_TABLES])
    return tuple(
        listing.agg(
            F.count("*"),
            F.sum("size_bytes"),
            F.max("modified_at"),
            F.bit_xor(F.xxhash64("path", "size_bytes", "modified_at")),
        ).first()
    )


def land_sources(spark: SparkSession, sf_dir: str) -> str:
    landing = new_folder(spark, "landing")

    def land(entity: str) -> Callable[[], None]:
        derived = adapters.SOURCES[entity](spark, sf_dir)
        return lambda: files.land_entity(derived, landing, entity)

    side_by_side(*[land(entity) for entity in adapters.SOURCES])
    return landing


def built(spark: SparkSession, sf_dir: str) -> tuple[str, Mart]:
    """Landing folder and mart of a source folder."""
    key = (spark.sparkContext.applicationId, sf_dir, _files_stamp(spark, sf_dir))
    if key not in _built:
        landing = land_sources(spark, sf_dir)
        _built[key] = landing, build(spark, landing, new_folder(spark, "mart"), FIRST, on_fail="report")
    return _built[key]


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    return built(spark, sf_dir)[1]


def _of_mart(query: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(mart(spark, sf_dir))


# --- sources ---


def _scan(entity: str) -> Query:
    return lambda spark, sf_dir: files.scan_entity(spark, built(spark, sf_dir)[0], entity)


def _bronze_land(entity: str, fields: dict[str, str]) -> Query:
    """The loaded rows with their fields taken out of the VARIANT again."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = mart(spark, sf_dir).bronze[entity]
        in_folder = F.col("_file").contains(f"/{entity}/").alias("from_entity_folder")
        typed = [field(name, kind) for name, kind in fields.items()]
        return rows.select(*typed, F.col("_load_ts").alias("load_ts"), in_folder)

    return query


def _peek(m: Mart) -> DataFrame:
    """The customer with the smallest id, its fields taken out of the VARIANT."""
    rows = silver.typed(m.bronze["customers"], silver.CUSTOMER_FIELDS)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in ("customer_id", "last_modified")]).limit(1)


def _sifted_transactions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The transactions as texts, some amounts and days of them unreadable, landed and sifted."""
    rows = files.scan_entity(spark, built(spark, sf_dir)[0], "transactions")
    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]).withColumns(
        {
            "amount": F.when(F.col("txn_id") % 100 == 9, "n/a").otherwise(F.col("amount")),
            "txn_date": F.when(F.col("txn_id") % 50 == 9, "2024-02-30").otherwise(F.col("txn_date")),
        }
    )
    landing, raw = new_folder(spark, "landing"), new_folder(spark, "raw")
    files.land_entity(texts, landing, "transactions")
    bronze_load(spark, landing, raw, FIRST, entities=("transactions",))
    return silver.sifted(read_bronze(spark, raw, "transactions"), silver.TRANSACTION_FIELDS)


def rejected_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _sifted_transactions(spark, sf_dir)[1]
    return rejected.select(field("txn_id", "bigint"), F.array_join("problems.field", ",").alias("fields"))


def accepted_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.typed(_sifted_transactions(spark, sf_dir)[0], silver.TRANSACTION_FIELDS, strict=False)


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, m = built(spark, sf_dir)
    return bronze.rows_by_folder(m.bronze, files.file_manifest(spark, landing))


# --- customer history ---


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The history after the first delivery, and the source rows of the second."""
    m = mart(spark, sf_dir)
    first = silver.typed(m.bronze["customers"], silver.CUSTOMER_FIELDS)
    second = adapters.customers_second_snapshot(first)
    return m.dim_customer, latest_per_key(second, ["customer_id"], "last_modified").drop("last_modified")


def scd2_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    return scd2.first_load(silver.customer_src(m.bronze["customers"]), FIRST)


def scd2_close_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, src = _snapshots(spark, sf_dir)
    return scd2.close_out(dim, src, SECOND)


def scd2_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, src = _snapshots(spark, sf_dir)
    return scd2.insert_missing(settle(scd2.close_out(dim, src, SECOND), "closed"), src, SECOND)


def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, src = _snapshots(spark, sf_dir)
    return scd2.apply_snapshot(dim, src, SECOND)


def scd2_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.verify(scd2_apply(spark, sf_dir))


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.history(scd2_apply(spark, sf_dir))


# --- star ---


def fact_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    return star.fact_transaction(
        m.transactions, m.dim_account, m.dim_transaction_type, m.dim_customer, m.dim_branch, m.dim_date
    )


_followed: dict[str, rollups.Rollups] = {}


def followed(spark: SparkSession, sf_dir: str) -> rollups.Rollups:
    """Three deliveries that repeat, correct, move and outdate each other: the fact month by
    month, and the figures and checks that follow it."""
    landing, m = built(spark, sf_dir)
    if landing not in _followed:
        store = incremental.FactStore(spark, new_folder(spark, "fact"), buckets=STREAM_BUCKETS)
        kept = rollups.Rollups(store, new_folder(spark, "rollups"))
        dims = (m.dim_account, m.dim_transaction_type, m.dim_customer, m.dim_branch, m.dim_date)
        for version, delivery in enumerate(adapters.transaction_deliveries(m.transactions)):
            store.refresh(delivery, *dims, version)
            kept.refresh(m.dim_account, m.dim_customer, version)
        _followed[landing] = kept
    return _followed[landing]


def _of_followed(query: Callable[[Mart, rollups.Rollups], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(mart(spark, sf_dir), followed(spark, sf_dir))


def fact_with_customer_sk(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    return star.fact_transaction(
        m.transactions,
        m.dim_account,
        m.dim_transaction_type,
        m.dim_customer,
        m.dim_branch,
        m.dim_date,
        with_customer_sk=True,
    )


def fact_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery dated mid-month and branch changes tracked, so both versions of a
    customer meet transactions."""
    m = mart(spark, sf_dir)
    dim, src = _snapshots(spark, sf_dir)
    tracked = (*settings.TRACKED_COLUMNS, "branch_id")
    versions = settle(scd2.apply_snapshot(dim, src, MID_MONTH, tracked), "versions")
    return star.fact_point_in_time(
        m.transactions,
        m.dim_account,
        m.dim_transaction_type,
        versions,
        star.dim_branch(versions),
        m.dim_date,
    )


# --- governance ---


def _mask_both_roles(m: Mart) -> DataFrame:
    return m.dim_customer.select(
        "customer_id",
        governance.mask_ssn(F.col("ssn"), "COMPLIANCE_ANALYST").alias("ssn_analyst"),
        governance.mask_ssn(F.col("ssn"), "AUDITOR").alias("ssn_auditor"),
        governance.mask_ssn(F.col("ssn"), "SYSADMIN").alias("ssn_sysadmin"),
    )


def _ways(m: Mart) -> dict[str, DataFrame]:
    return governance.scopes(m.dim_customer, m.dim_account)


def _bronze_as(entity: str, fields: dict[str, str], role: str) -> Query:
    """Bronze rows as the role may see them, their fields taken out of the VARIANT."""

    def query(m: Mart) -> DataFrame:
        seen = governance.governed(m.bronze[entity], role, governance.branch_access(m.spark), entity, _ways(m))
        return silver.typed(seen, fields)

    return _of_mart(query)


def _accounts_as_analyst(m: Mart) -> DataFrame:
    return governance.governed(m.accounts, "COMPLIANCE_ANALYST", governance.branch_access(m.spark), "accounts", _ways(m))


def _by_role(query: str) -> Query:
    """A query in SQL over the named views, as the session sees it under each role."""

    def run(m: Mart) -> DataFrame:
        spark = views.register(m)
        rows = None
        for role in COUNTED_ROLES:
            seen = views.as_role(spark, role).sql(query).select(F.lit(role).alias("role_name"), "*")
            rows = seen if rows is None else rows.unionByName(seen)
        return rows

    return _of_mart(run)


def _row_access(m: Mart) -> DataFrame:
    return governance.row_access(
        m.dim_customer, "COMPLIANCE_ANALYST", governance.branch_access(m.spark)
    )


def _as_analyst(m: Mart) -> DataFrame:
    return governance.governed(
        m.dim_customer, "COMPLIANCE_ANALYST", governance.branch_access(m.spark)
    )


# --- quality ---


def _zero(name: str, measures: Callable[[Mart], DataFrame]) -> Query:
    return _of_mart(lambda m: quality.zero_check(name, measures(m)))


def _customer_check(name: str) -> Query:
    return _zero(name, lambda m: quality.customer_measures(m.dim_customer))


def _transaction_check(name: str) -> Query:
    return _zero(name, lambda m: quality.transaction_measures(m.transactions))


def _scorecard(m: Mart) -> DataFrame:
    return quality.scorecard(m.quality_tables(), EXPECTED_ROWS)


def _dirty(m: Mart) -> quality.Tables:
    """The mart with every fault that the scorecard looks for."""
    customers = m.dim_customer.withColumn("ssn", F.when(F.col("customer_id") % 11 != 0, F.col("ssn")))
    nameless = customers.where("customer_id % 17 = 0").withColumn("customer_id", F.lit(None).cast("bigint"))
    repeated = customers.where("customer_id % 13 = 0")
    accounts = m.accounts.withColumn(
        "customer_id", F.when(F.col("account_id") % 7 == 0, F.col("customer_id") + 10**12).otherwise(F.col("customer_id"))
    )
    txn = F.col("txn_id")
    transactions = m.transactions.withColumns(
        {
            "txn_type": F.when(txn % 9 == 0, "CRYPTO").otherwise(F.col("txn_type")),
            "direction": F.when(txn % 8 == 0, "SIDEWAYS").otherwise(F.col("direction")),
            "amount": F.when(txn % 6 == 0, -F.col("amount")).otherwise(F.col("amount")).cast("decimal(12,2)"),
        }
    )
    fact = m.fact.withColumn(
        "account_sk", F.when(txn % 10 == 3, -F.col("account_sk")).otherwise(F.col("account_sk"))
    )
    return quality.Tables(
        bronze=m.bronze,
        accounts=accounts,
        transactions=transactions,
        dim_customer=customers.unionByName(nameless).unionByName(repeated),
        dim_account=m.dim_account.unionByName(m.dim_account.where("account_id % 5 = 0")),
        fact=fact.unionByName(fact.where("txn_id % 4 = 0")),
    )


def _landed_counts(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    landing, _ = built(spark, sf_dir)
    return {e: files.scan_entity(spark, landing, e).count() for e in quality.CARDINALITY_ENTITIES}


def dq_scorecard_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard with the row counts that were landed."""
    return quality.scorecard(mart(spark, sf_dir).quality_tables(), _landed_counts(spark, sf_dir))


# --- streams ---


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed transactions in two deliveries, loaded by a stream that is started after each
    and once more; the last start finds nothing."""
    landing, _ = built(spark, sf_dir)
    rows = files.scan_entity(spark, landing, "transactions")
    folder = new_folder(spark, "stream-bronze")
    for part in (rows.where("txn_id % 3 = 0"), rows.where("txn_id % 3 <> 0"), None):
        if part is not None:
            part.write.mode("append").parquet(f"{folder}/landing/transactions")
        writer = bronze_streams.bronze_stream(
            spark, f"{folder}/landing", f"{folder}/raw", "transactions", rows.schema, FIRST
        )
        drain(writer, f"{folder}/checkpoint")
    loaded = read_bronze(spark, f"{folder}/raw", "transactions")
    return silver.typed(loaded, silver.TRANSACTION_FIELDS)


LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def _line_order() -> list:
    return [
        F.col("l_shipdate").desc_nulls_first(),
        F.col("l_partkey").asc_nulls_last(),
        F.col("l_suppkey").asc_nulls_last(),
        F.col("l_extendedprice").desc_nulls_first(),
    ]


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapters.table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return latest_per_key(lines, LINE_KEYS, _line_order(), ties=[])


def _schema_text(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with real duplicates, arriving in three batches."""
    lines = adapters.table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    folder = new_folder(spark, "stream-dedup")
    for part in range(3):
        lines.where(F.col("l_suppkey") % 3 == part).write.mode("append").parquet(f"{folder}/arrivals")
        stream = bronze_streams.stream_files(spark, f"{folder}/arrivals", lines.schema)
        drain(dedup.latest_log(stream, f"{folder}/log", LINE_KEYS, _line_order(), ties=[], buckets=STREAM_BUCKETS))
    return dedup.read_latest(spark, f"{folder}/log", _schema_text(lines), LINE_KEYS, _line_order(), ties=[])


def _streamed_deliveries(
    m: Mart, name: str, start: Callable[[DataFrame, str], DataStreamWriter]
) -> tuple[str, DataFrame]:
    """Run a stream after each of three deliveries that repeat, correct and outdate each
    other and hold transactions without a date; returns its log and the rows' frame."""
    folder = new_folder(m.spark, name)
    for delivery in adapters.transaction_deliveries(m.transactions):
        delivery.write.mode("append").parquet(f"{folder}/arrivals")
        stream = bronze_streams.stream_files(m.spark, f"{folder}/arrivals", m.transactions.schema)
        drain(start(stream, f"{folder}/log"))
    return f"{folder}/log", m.transactions


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of transactions delivered several times, in several versions, what came first."""
    log, frame = _streamed_deliveries(
        mart(spark, sf_dir), "stream-first-seen", lambda s, log: dedup.first_seen(s, log, ["txn_id"], buckets=STREAM_BUCKETS)
    )
    return dedup.read_first_seen(spark, log, _schema_text(frame), ["txn_id"])


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both customer deliveries through bronze; the stream runs after each of them."""
    landing, _ = built(spark, sf_dir)
    folder = new_folder(spark, "stream-scd2")
    first = files.scan_entity(spark, landing, "customers")
    deliveries = ((FIRST, first), (SECOND, adapters.customers_second_snapshot(first)))
    for load, delivered in deliveries:
        stop = f"{folder}/landing-{load[:10]}"
        files.land_entity(delivered, stop, "customers")
        bronze_load(spark, stop, f"{folder}/raw", load, mode="append", entities=("customers",))
        drain(history.history_stream(spark, f"{folder}/raw", f"{folder}/dim", buckets=STREAM_BUCKETS))
    return history.read_history(spark, f"{folder}/dim")


def _cash_stream(
    name: str,
    start: Callable[..., DataStreamWriter],
    read: Callable[[SparkSession, str], DataFrame],
    report: Callable[[DataFrame, DataFrame, DataFrame], DataFrame] = cash.ctr_from_sums,
) -> Query:
    def query(m: Mart) -> DataFrame:
        log, _ = _streamed_deliveries(m, name, lambda s, log: start(s, log, buckets=STREAM_BUCKETS))
        return report(read(m.spark, log), m.dim_account, m.dim_customer)

    return _of_mart(query)


QUERIES: dict[str, Query] = {
    "scan_parquet": _scan("transactions"),
    "scan_customers": _scan("customers"),
    "scan_accounts": _scan("accounts"),
    "scan_watchlist": _scan("watchlist"),
    "bronze_land": _bronze_land("transactions", silver.TRANSACTION_FIELDS),
    "bronze_land_customers": _bronze_land("customers", silver.CUSTOMER_FIELDS),
    "bronze_land_accounts": _bronze_land("accounts", silver.ACCOUNT_FIELDS),
    "bronze_land_watchlist": _bronze_land("watchlist", silver.WATCHLIST_FIELDS),
    "bronze_schema": _of_mart(lambda m: bronze.bronze_fields(m.bronze)),
    "bronze_peek": _of_mart(_peek),
    "file_manifest": file_manifest,
    "silver_accounts": _of_mart(lambda m: silver.accounts(m.bronze["accounts"])),
    "silver_transactions": _of_mart(lambda m: silver.transactions(m.bronze["transactions"])),
    "rejected_transactions": rejected_transactions,
    "accepted_transactions": accepted_transactions,
    "silver_watchlist": _of_mart(lambda m: silver.watchlist(m.bronze["watchlist"])),
    "customer_src": _of_mart(lambda m: silver.customer_src(m.bronze["customers"])),
    "customer_lookup": _of_mart(lambda m: silver.customer_lookup(m.dim_customer, LOOKED_UP_NAME)),
    "dedup_latest": dedup_latest,
    "layer_counts": _of_mart(
        lambda m: reports.layer_counts(
            {
                **{f"raw.{e}": df for e, df in m.bronze.items()},
                "silver.accounts": m.accounts,
                "silver.transactions": m.transactions,
                "silver.watchlist": m.watchlist,
            }
        )
    ),
    "distinct_values": _of_mart(
        lambda m: reports.distinct_values(m.transactions, "txn_type", "direction")
    ),
    "scd2_first_load": scd2_first_load,
    "scd2_close_out": scd2_close_out,
    "scd2_insert": scd2_insert,
    "scd2_apply": scd2_apply,
    "scd2_verify": scd2_verify,
    "scd2_history": scd2_history,
    "dim_date": _of_mart(lambda m: star.calendar_activity(m.dim_date, m.fact)),
    "dim_branch": _of_mart(lambda m: star.dim_branch(m.dim_customer)),
    "dim_transaction_type": _of_mart(lambda m: star.dim_transaction_type(m.transactions)),
    "dim_account": _of_mart(lambda m: star.dim_account(m.accounts)),
    "fact_transaction": fact_transaction,
    "fact_reconciliation": _of_mart(lambda m: star.fact_reconciliation(m.fact, m.transactions)),
    "fact_incremental": _of_followed(lambda m, kept: kept.store.read()),
    "fact_with_customer_sk": fact_with_customer_sk,
    "fact_point_in_time": fact_point_in_time,
    "ctr_candidates": _of_mart(
        lambda m: reports.ctr_candidates(m.fact, m.dim_account, m.dim_customer)
    ),
    "ctr_ranked": _of_mart(
        lambda m: reports.ranked(reports.ctr_candidates(m.fact, m.dim_account, m.dim_customer))
    ),
    "ctr_by_customer_key": lambda spark, sf_dir: reports.ctr_by_customer_key(
        fact_with_customer_sk(spark, sf_dir), mart(spark, sf_dir).dim_customer
    ),
    "structuring_flags": _of_mart(
        lambda m: reports.structuring_flags(m.fact, m.dim_account, m.dim_customer)
    ),
    "structuring_by_customer_key": lambda spark, sf_dir: reports.structuring_by_customer_key(
        fact_with_customer_sk(spark, sf_dir), mart(spark, sf_dir).dim_customer
    ),
    "structuring_ranked": _of_mart(
        lambda m: reports.ranked(reports.structuring_flags(m.fact, m.dim_account, m.dim_customer))
    ),
    "sanctions_hits": _of_mart(lambda m: screening.sanctions_hits(m.dim_customer, m.watchlist)),
    "sanctions_fuzzy": _of_mart(lambda m: screening.sanctions_fuzzy(m.dim_customer, m.watchlist)),
    "mask_ssn": _of_mart(_mask_both_roles),
    "row_access": _of_mart(_row_access),
    "bronze_as_auditor": _bronze_as("customers", silver.CUSTOMER_FIELDS, "AUDITOR"),
    "bronze_customers_as_analyst": _bronze_as("customers", silver.CUSTOMER_FIELDS, "COMPLIANCE_ANALYST"),
    "bronze_transactions_as_analyst": _bronze_as("transactions", silver.TRANSACTION_FIELDS, "COMPLIANCE_ANALYST"),
    "accounts_region_scoped": _of_mart(_accounts_as_analyst),
    "sql_customers_by_role": _by_role("SELECT customer_id, full_name, ssn, branch_id FROM dim_customer"),
    "sql_ctr_by_role": _by_role("SELECT * FROM reporting_ctr_candidates"),
    "sql_structuring_by_role": _by_role("SELECT * FROM reporting_structuring_flags"),
    "sql_sanctions_by_role": _by_role("SELECT * FROM reporting_sanctions_hits"),
    "ctr_region_scoped": _of_mart(
        lambda m: reports.ctr_candidates(m.fact, m.dim_account, _as_analyst(m))
    ),
    "sanctions_region_scoped": _of_mart(
        lambda m: screening.sanctions_hits(_as_analyst(m), m.watchlist)
    ),
    "masked_sample": _of_mart(
        lambda m: governance.masked_sample(
            m.dim_customer, governance.branch_access(m.spark), SAMPLE_ROLES
        )
    ),
    "rows_visible_by_role": _of_mart(
        lambda m: governance.rows_visible_by_role(
            m.dim_customer, governance.branch_access(m.spark), COUNTED_ROLES
        )
    ),
    "visible_branches": _of_mart(
        lambda m: governance.visible_branches(
            m.dim_customer, "COMPLIANCE_ANALYST", governance.branch_access(m.spark)
        )
    ),
    "classified_columns": _of_mart(
        lambda m: governance.classified_columns(
            governance.classify(m.dim_customer, settings.CUSTOMER_TAGS)
        )
    ),
    "dq_rowcount": _of_mart(lambda m: quality.rowcount_checks(m.bronze, EXPECTED_ROWS)),
    "dq_fact_vs_silver": _of_mart(lambda m: quality.reconciliation_check(m.fact, m.transactions)),
    "dq_pk_dim_customer": _customer_check("pk_dim_customer_unique"),
    "dq_pk_dim_account": _zero(
        "pk_dim_account_unique",
        lambda m: quality.duplicate_measure(m.dim_account, "account_id", "pk_dim_account_unique"),
    ),
    "dq_pk_fact_txn": _zero(
        "pk_fact_txn_unique",
        lambda m: quality.duplicate_measure(m.fact, "txn_id", "pk_fact_txn_unique"),
    ),
    "dq_null_customer_id": _customer_check("null_customer_id"),
    "dq_null_ssn": _customer_check("null_ssn"),
    "dq_fk_account_to_customer": _zero(
        "fk_account_to_customer",
        lambda m: quality.orphan_measure(
            m.accounts, m.dim_customer.where("is_current"), "customer_id", "fk_account_to_customer"
        ),
    ),
    "dq_fk_fact_to_account": _zero(
        "fk_fact_to_account",
        lambda m: quality.orphan_measure(m.fact, m.dim_account, "account_sk", "fk_fact_to_account"),
    ),
    "dq_scd2_one_current": _customer_check("scd2_one_current_per_customer"),
    "dq_scd2_one_current_strict": _of_mart(lambda m: quality.strict_one_current(m.dim_customer)),
    "dq_accepted_txn_type": _transaction_check("accepted_txn_type"),
    "dq_accepted_direction": _transaction_check("accepted_direction"),
    "dq_amount_positive": _transaction_check("amount_positive"),
    "dq_scorecard": _of_mart(_scorecard),
    "dq_scorecard_display": _of_mart(lambda m: quality.for_display(_scorecard(m))),
    "dq_scorecard_dirty": _of_mart(lambda m: quality.scorecard(_dirty(m), EXPECTED_ROWS)),
    "dq_gate_dirty": _of_mart(lambda m: quality.gate(quality.scorecard(_dirty(m), EXPECTED_ROWS))),
    "dq_scorecard_clean": dq_scorecard_clean,
    "dq_scorecard_rollup": _of_followed(
        lambda m, kept: kept.scorecard(m.bronze, m.accounts, m.dim_customer, m.dim_account, EXPECTED_ROWS)
    ),
    "dq_gate_clean": lambda spark, sf_dir: quality.gate(dq_scorecard_clean(spark, sf_dir)),
    "dq_gate": _of_mart(lambda m: quality.gate(_scorecard(m))),
    "kpi_summary": _of_mart(
        lambda m: kpis.kpi_summary(
            m.fact, reports.ctr_candidates(m.fact, m.dim_account, m.dim_customer)
        )
    ),
    "kpi_branch_breakdown": _of_mart(lambda m: kpis.kpi_branch_breakdown(m.fact, m.dim_branch)),
    "kpi_volume_trend": _of_mart(lambda m: kpis.kpi_volume_trend(m.fact)),
    "kpi_summary_rollup": _of_followed(lambda m, kept: kept.summary()),
    "kpi_summary_months": _of_followed(lambda m, kept: kept.summary(*SUMMED_MONTHS)),
    "kpi_branch_breakdown_rollup": _of_followed(lambda m, kept: kept.branch_breakdown(m.dim_branch)),
    "kpi_volume_trend_rollup": _of_followed(lambda m, kept: kept.volume_trend()),
    "stream_bronze": stream_bronze,
    "stream_dedup": stream_dedup,
    "stream_first_seen": stream_first_seen,
    "stream_scd2": stream_scd2,
    "stream_ctr": _cash_stream("stream-ctr", cash.cash_sums_stream, cash.read_cash_sums),
    "stream_structuring": _cash_stream(
        "stream-structuring", cash.cash_sums_stream, cash.read_cash_sums, cash.structuring_from_sums
    ),
    "stream_ctr_windowed": _cash_stream(
        "stream-ctr-windowed", cash.windowed_cash_stream, cash.read_cash_windows
    ),
}
