"""Typed, deduplicated tables from the bronze VARIANT rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilmart.functions.columns import field
from vigilmart.operators.dedup import latest_per_key

ACCOUNT_FIELDS = {
    "account_id": "bigint",
    "customer_id": "bigint",
    "account_type": "string",
    "open_date": "date",
    "last_modified": "timestamp_ntz",
}
TRANSACTION_FIELDS = {
    "txn_id": "bigint",
    "account_id": "bigint",
    "txn_date": "date",
    "amount": "decimal(12,2)",
    "txn_type": "string",
    "direction": "string",
    "last_modified": "timestamp_ntz",
}
WATCHLIST_FIELDS = {"name": "string", "list_source": "string"}
CUSTOMER_FIELDS = {
    "customer_id": "bigint",
    "full_name": "string",
    "ssn": "string",
    "country": "string",
    "branch_id": "int",
    "kyc_status": "string",
    "last_modified": "timestamp_ntz",
}
FIELDS = {
    "customers": CUSTOMER_FIELDS,
    "accounts": ACCOUNT_FIELDS,
    "transactions": TRANSACTION_FIELDS,
    "watchlist": WATCHLIST_FIELDS,
}


def typed(bronze: DataFrame, fields: dict[str, str], strict: bool = True) -> DataFrame:
    return bronze.select(*[field(name, sql_type, strict) for name, sql_type in fields.items()])


def sifted(bronze: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Bronze rows that load, and the others as they came, with what can't be read in them.

    A field is unreadable where a value is there but is none of its type. ``problems`` names
    field and type, not the value, which may be one to be masked. Together both have all rows.
    Read the rows that load with ``strict=False``: a strict extraction may run before the sieve.
    """

    def problem(name: str, kind: str) -> Column:
        raw = F.try_variant_get("data", f"$.{name}", "variant")
        there = F.coalesce(raw.isNotNull() & ~F.is_variant_null(raw), F.lit(False))
        unread = there & F.try_variant_get("data", f"$.{name}", kind).isNull()
        return F.when(unread, F.struct(F.lit(name).alias("field"), F.lit(f"not a {kind}").alias("reason")))

    found = F.filter(F.array(*[problem(name, kind) for name, kind in fields.items()]), lambda p: p.isNotNull())
    no_row = F.struct(F.lit(None).cast("string").alias("field"), F.lit("no object").alias("reason"))
    whole = F.coalesce(F.regexp_like(F.schema_of_variant("data"), F.lit("^OBJECT")), F.lit(False))
    tested = bronze.withColumn("problems", F.when(whole, found).otherwise(F.array(no_row)))
    return tested.where(F.size("problems") == 0).drop("problems"), tested.where(F.size("problems") > 0)


def accounts(bronze: DataFrame, strict: bool = True) -> DataFrame:
    return latest_per_key(typed(bronze, ACCOUNT_FIELDS, strict), ["account_id"], "last_modified")


def transactions(bronze: DataFrame, strict: bool = True) -> DataFrame:
    return latest_per_key(typed(bronze, TRANSACTION_FIELDS, strict), ["txn_id"], "last_modified")


def watchlist(bronze: DataFrame, strict: bool = True) -> DataFrame:
    return latest_per_key(typed(bronze, WATCHLIST_FIELDS, strict), ["name"])


def customer_src(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """The customer snapshot the history is maintained from: one row per customer_id."""
    rows = typed(bronze, CUSTOMER_FIELDS, strict)
    return latest_per_key(rows, ["customer_id"], "last_modified").drop("last_modified")


def customer_lookup(dim_customer: DataFrame, full_name: str) -> DataFrame:
    return dim_customer.where(dim_customer["full_name"] == full_name)
