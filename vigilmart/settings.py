"""Values that results depend on, and the Spark settings the jobs are tuned for."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import SparkSession

# --- Fixed values: accepted codes, labels, roles, tags and limits of the data model ---
TXN_TYPE_LABELS = {
    "CASH": "Cash",
    "WIRE": "Wire Transfer",
    "ACH": "ACH Transfer",
    "CARD": "Card",
}
TXN_TYPES = ("CASH", "WIRE", "ACH", "CARD")
DIRECTIONS = ("CREDIT", "DEBIT")
CASH_LIMIT = Decimal("10000")
MIN_SPLIT_DEPOSITS = 3

UNMASKED_ROLES = ("COMPLIANCE_ANALYST", "ACCOUNTADMIN")
ALL_BRANCH_ROLES = ("ACCOUNTADMIN", "SYSADMIN", "AUDITOR", "ENG")
ANALYST_BRANCHES = (1, 2, 3, 4, 5, 6)
SSN_MASK_PREFIX = "XXX-XX-"

CLASSIFICATION_TAG = "data_classification"
CLASSIFICATIONS = ("PUBLIC", "INTERNAL", "PII", "PII_RESTRICTED")
# Names that are restricted wherever they stand, tagged or not.
SENSITIVE_NAMES = ("ssn",)
# Restricted fields by entity, as dotted paths; what an entity's rows are scoped by.
RESTRICTED_PATHS = {"customers": ("ssn",)}
SCOPED_BY = {"customers": "branch_id", "accounts": "customer_id", "transactions": "account_id"}
CUSTOMER_TAGS = {"ssn": "PII_RESTRICTED", "full_name": "PII", "country": "INTERNAL"}

CALENDAR_START = "2020-01-01"
CALENDAR_DAYS = 2922

TRACKED_COLUMNS = ("kyc_status", "country", "full_name")
# --- end of fixed values ---

SPARK_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


def tuned(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Apply the settings; leave shuffle partitions to the cluster unless given."""
    for key, value in SPARK_SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder
