"""Date arithmetic with the rules the marts need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.numbers import as_col


def elapsed_days(start, end) -> Column:
    """Whole 24-hour periods between two timestamps, rounded down (also below zero)."""
    seconds = F.timestamp_diff("SECOND", as_col(start), as_col(end))
    return F.floor(seconds / 86400).cast("int")


def year_month(ts) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM")


def month_of(year_month_text) -> Column:
    return F.substring(as_col(year_month_text), 6, 2).cast("int")


def month_name(month) -> Column:
    return F.date_format(F.make_date(F.lit(2000), as_col(month), F.lit(1)), "MMMM")
