"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagewright.functions.numeric import as_col


def fiscal_year(year: Column | str, month: Column | str) -> Column:
    """April-to-March year as FY2025-26."""
    y, m = as_col(year), as_col(month)
    start = F.when(m >= 4, y).otherwise(y - 1)
    return F.concat(F.lit("FY"), start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def fiscal_quarter(year: Column | str, month: Column | str) -> Column:
    """Apr-Jun is Q1; Jan-Mar belongs to Q4 of the year before."""
    y, m = as_col(year), as_col(month)
    return (
        F.when(m.between(4, 6), F.concat(y.cast("string"), F.lit("-Q1")))
        .when(m.between(7, 9), F.concat(y.cast("string"), F.lit("-Q2")))
        .when(m.between(10, 12), F.concat(y.cast("string"), F.lit("-Q3")))
        .otherwise(F.concat((y - 1).cast("string"), F.lit("-Q4")))
    )


def month_key(year: Column | str, month: Column | str) -> Column:
    return as_col(year) * 10000 + as_col(month) * 100 + 1


def inclusive_days(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_col(end), as_col(start)) + 1


def tenure_years(as_of: str, joined: Column | str) -> Column:
    """Whole 365-day years, never negative; unknown without a date."""
    days = F.datediff(F.lit(as_of).cast("date"), as_col(joined))
    return F.when(days < 0, F.lit(0)).otherwise(F.floor(days / 365))


def is_weekend(c: Column | str) -> Column:
    return F.weekday(as_col(c)) >= 5
