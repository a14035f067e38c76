"""Scalar helpers with the warehouse semantics the products rely on.

All are Column -> Column built from Spark built-ins, so they stay inside
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- strings
def concat_nullsafe(*parts) -> Column:
    """CONCAT that reads NULL as '' (NULL names still leave the blank)."""
    return F.concat(*[F.coalesce(col(p), F.lit("")) for p in parts])


def sha256_hex_upper(c, encoding: str = "UTF-8") -> Column:
    """upper-case hex SHA-256 of TRIM(UPPER(x)); NULL -> ''. The bytes are
    UTF-8 (VARCHAR columns) or, with ``encoding="UTF-16LE"``, those of an
    NVARCHAR column."""
    x = col(c)
    return F.when(x.isNull(), F.lit("")).otherwise(F.upper(F.sha2(F.encode(F.trim(F.upper(x)), encoding), 256)))


def null_as_empty(c) -> Column:
    """F11 on keys: ISNULL(x, '')."""
    return F.coalesce(col(c), F.lit(""))


# ---------------------------------------------------------------- date parts
def days_crossed(start, end) -> Column:
    """DATEDIFF(DAY, start, end) = midnights crossed."""
    return F.datediff(col(end), col(start))


def hours_crossed(start, end) -> Column:
    """DATEDIFF(HOUR, start, end) = hour boundaries crossed."""
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", col(start)), F.date_trunc("HOUR", col(end)))


def months_crossed(start, end) -> Column:
    """DATEDIFF(MONTH, start, end) = month boundaries crossed."""
    s, e = col(start), col(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def month_end_after(d, months: int) -> Column:
    """F19 + F20: EOMONTH(DATEADD(month, n, d))."""
    return F.last_day(F.add_months(col(d), months))


def year_i(c) -> Column:
    return F.year(col(c)).cast("int")


def month_i(c) -> Column:
    return F.month(col(c)).cast("int")


def quarter_i(c) -> Column:
    return F.quarter(col(c)).cast("int")


def ts_lit(value) -> Column:
    """A timestamp literal read in the session time zone (UTC). A Python
    ``datetime`` passed to ``F.lit`` would be converted with the Python
    process's local zone instead, so the value goes through its text form."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
