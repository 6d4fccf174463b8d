"""Small literal frames."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from vigilmart.operators import scd2

JAN, FEB, MAR = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


SRC_SCHEMA = (
    "customer_id BIGINT, full_name STRING, ssn STRING, country STRING, branch_id INT, kyc_status STRING"
)


def src(spark, *rows):
    """Rows (customer_id, kyc_status, country, full_name), the rest filled in."""
    full = [
        (cid, name, f"000-00-{cid or 0:04d}", country, 1, kyc) for cid, kyc, country, name in rows
    ]
    return spark.createDataFrame(full, SRC_SCHEMA)


def dim(spark, *rows):
    """Rows (sk, customer_id, full_name, ssn, branch_id, valid_from, valid_to, is_current)."""
    full = [
        (sk, cid, name, ssn, "US", branch, "VERIFIED", at(lo), at(hi) if hi else None, current)
        for sk, cid, name, ssn, branch, lo, hi, current in rows
    ]
    return spark.createDataFrame(full, scd2.DIM_SCHEMA)


def customers(spark, *ids, branch=1):
    return dim(
        spark, *[(i, i, f"Name {i}", f"000-00-{i:04d}", branch, JAN, None, True) for i in ids]
    )


TXN_SCHEMA = (
    "txn_id BIGINT, account_id BIGINT, txn_date DATE, amount DECIMAL(12,2), txn_type STRING, "
    "direction STRING, last_modified TIMESTAMP_NTZ"
)


def transactions(spark, *rows):
    """Rows (txn_id, account_id, day, amount[, txn_type[, direction]]); cash credits by default."""
    full = []
    for row in rows:
        txn_id, account_id, day, amount, *rest = row
        kind = rest[0] if rest else "CASH"
        direction = rest[1] if len(rest) > 1 else "CREDIT"
        amount = None if amount is None else Decimal(amount)
        full.append((txn_id, account_id, date.fromisoformat(day), amount, kind, direction, at(JAN)))
    return spark.createDataFrame(full, TXN_SCHEMA)


def accounts(spark, *rows):
    """Rows (account_id, customer_id)."""
    full = [(a, c, "CHECKING", date(2020, 1, 1), at(JAN)) for a, c in rows]
    return spark.createDataFrame(
        full,
        "account_id BIGINT, customer_id BIGINT, account_type STRING, open_date DATE, "
        "last_modified TIMESTAMP_NTZ",
    )


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
