"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilmart import settings


def field(name: str, sql_type: str, strict: bool = True, source: str = "data") -> Column:
    """Typed field of a VARIANT column. Strict fails on a malformed value, lenient gives NULL."""
    extract = F.variant_get if strict else F.try_variant_get
    return extract(F.col(source), f"$.{name}", sql_type).alias(name)


def match_name(name: Column) -> Column:
    """Name in the form names are compared in: outer spaces off, upper case."""
    return F.upper(F.trim(name))


def money(total: Column) -> Column:
    return total.cast("decimal(38,2)")


def date_key(day: Column) -> Column:
    """YYYYMMDD as a number."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def weekday_from_sunday(day: Column) -> Column:
    """0 for Sunday through 6 for Saturday."""
    return F.dayofweek(day) - 1


def txn_type_label(code: Column) -> Column:
    label = F.when(F.lit(False), code)
    for known, text in settings.TXN_TYPE_LABELS.items():
        label = label.when(code == known, F.lit(text))
    return label.otherwise(code)


def normal_role(role: str) -> str:
    return role.strip().upper()


def mask_ssn(ssn: Column, role: str) -> Column:
    """Plain value for the roles cleared for it; for any other role the last four only."""
    if normal_role(role) in settings.UNMASKED_ROLES:
        return ssn
    return F.concat(F.lit(settings.SSN_MASK_PREFIX), F.right(ssn, F.lit(4)))


def cash_credit() -> Column:
    return (F.col("txn_type") == "CASH") & (F.col("direction") == "CREDIT")
