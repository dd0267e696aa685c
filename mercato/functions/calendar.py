"""Calendar expressions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercato.schemas import FISCAL_YEAR_START_MONTH


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c) -> Column:
    """Timestamps (incl. timestamp_ntz) and dates to a date: one key per day."""
    return F.to_date(_c(c))


def date_key(c) -> Column:
    """yyyyMMdd as int (20240131)."""
    d = as_date(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def full_date(c) -> Column:
    return F.date_format(as_date(c), "yyyy-MM-dd")


def month_name(c) -> Column:
    """Full English month name (``monthname`` abbreviates)."""
    return F.date_format(as_date(c), "MMMM")


def day_name(c) -> Column:
    return F.date_format(as_date(c), "EEEE")


def weekday_num(c) -> Column:
    """Monday = 1 ... Sunday = 7 (``dayofweek`` starts on Sunday)."""
    return (F.weekday(as_date(c)) + 1).cast("int")


def is_weekend(c) -> Column:
    return (F.weekday(as_date(c)) >= 5).cast("int")


def fiscal_year(year_col, month_col, start_month: int = FISCAL_YEAR_START_MONTH) -> Column:
    y, m = _c(year_col), _c(month_col)
    return F.when(m >= start_month, y).otherwise(y - 1).cast("int")


def year_month_label(year_col, month_col) -> Column:
    """'2024-03'."""
    return F.concat_ws("-", _c(year_col).cast("string"), F.lpad(_c(month_col).cast("string"), 2, "0"))
