"""Validation rules: each gives an error text, or NULL where the value passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagewright.functions.numeric import as_col
from wagewright.functions.text import is_blank

# Accepted formats and enumerations.
PAN_PATTERN = "^[A-Z]{5}[0-9]{4}[A-Z]$"
EMAIL_PATTERN = r"^[\w.+-]+@[\w-]+\.[a-zA-Z]{2,}$"
PAY_STATUSES = ["Draft", "Approved", "Paid", "Cancelled", "Revised"]
REQUIRED = ["emp_id", "emp_code", "basic", "gross", "net", "period"]


def fails(bad: Column, field: str, text: str) -> Column:
    return F.when(bad, F.lit(f"[{field}] {text}"))


def required(field: str) -> Column:
    return fails(is_blank(field), field, "required")


def _number(field: str) -> Column:
    return as_col(field).cast("string").try_cast("double")


def positive_number(field: str) -> Column:
    n = _number(field)
    return F.coalesce(fails(n.isNull(), field, "not a number"), fails(n < 0, field, "negative"))


def in_range(field: str, low: float, high: float) -> Column:
    return F.coalesce(positive_number(field), fails(~_number(field).between(low, high), field, f"outside {low}-{high}"))


def matches(field: str, pattern: str, upper: bool = False) -> Column:
    value = F.coalesce(as_col(field).cast("string"), F.lit(""))
    value = F.upper(value) if upper else value
    return fails(~value.rlike(pattern), field, "bad format")


def pan(field: str) -> Column:
    return matches(field, PAN_PATTERN, upper=True)


def email(field: str) -> Column:
    return matches(field, EMAIL_PATTERN)


def iso_date(field: str, fmt: str = "yyyy-MM-dd") -> Column:
    return fails(F.try_to_timestamp(as_col(field), F.lit(fmt)).isNull(), field, "bad date")


def one_of(field: str, choices: list[str]) -> Column:
    return fails(~F.coalesce(as_col(field).isin(choices), F.lit(False)), field, "not allowed")


def salary_consistency(basic: str, gross: str) -> Column:
    """Gross must be 1 to 3 times basic; no test without a positive basic."""
    share = F.try_divide(as_col(gross).cast("double"), as_col(basic).cast("double"))
    return fails((as_col(basic) > 0) & ~share.between(1.0, 3.0), "salary", "gross/basic outside 1-3")


def net_within_gross(net: str, gross: str) -> Column:
    return fails(as_col(net) > as_col(gross), "net", "above gross")


def errors(*rules: Column) -> Column:
    """All failing rules of a row, in order."""
    return F.array_compact(F.array(*rules))


def record_errors() -> Column:
    """The rule list for a payroll record."""
    return errors(
        *[required(f) for f in REQUIRED],
        *[positive_number(f) for f in ("basic", "gross", "net")],
        salary_consistency("basic", "gross"),
        net_within_gross("net", "gross"),
    )


def register_errors() -> Column:
    """The shorter rule list applied before KPIs are computed."""
    zero = F.lit(0)
    return errors(
        F.when(is_blank("emp_code"), "missing emp_code"),
        F.when(F.coalesce("net", zero) < 0, "negative net"),
        F.when(F.coalesce("gross", zero) == 0, "zero gross"),
        F.when(F.coalesce("net", zero) > F.coalesce(F.nullif("gross", zero), F.lit(1)), "net > gross"),
    )


def ingest_row_errors() -> Column:
    """Rules for a landed employee row whose salary is still text; blank salary counts as 0."""
    salary = F.coalesce(F.nullif(F.trim("basic_salary"), F.lit("")), F.lit("0")).try_cast("double")
    return errors(
        F.when(is_blank("emp_code"), "missing emp_code"),
        F.when(salary.isNull(), "invalid salary"),
        F.when(salary < 0, "negative salary"),
    )


def all_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)
