"""Cleaning of dirty text records, with a log entry per fix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.functions.numeric import safe_number, safe_whole
from wagewright.functions.text import default_email, employee_code, is_blank

MONEY = "decimal(18,2)"


def _fill(df: DataFrame, fixes: dict[str, tuple[Column, str]]) -> DataFrame:
    """Replace blanks column by column, in order, and list what was fixed."""
    logged = F.array_compact(F.array(*[F.when(is_blank(c), F.lit(note)) for c, (_, note) in fixes.items()]))
    out = df.withColumn("issues", logged)
    for name, (value, _) in fixes.items():
        out = out.withColumn(name, F.when(is_blank(name), value).otherwise(F.col(name)))
    return out


def amount(c: str) -> Column:
    """Text to money; blanks and junk give 0."""
    return F.coalesce(F.trim(F.col(c)).try_cast(MONEY), F.lit(0).cast(MONEY))


def clean_employees(df: DataFrame) -> DataFrame:
    filled = _fill(df, {
        "emp_code": (employee_code("emp_id"), "generated emp_code"),
        "basic_salary": (F.lit("0"), "basic_salary set to 0"),
        "status": (F.lit("Unknown"), "status set to Unknown"),
        "dob": (F.lit("1990-01-01"), "dob placeholder"),
        "email": (default_email("first_name", "last_name"), "generated email"),
    })
    return filled.withColumn("basic_salary", safe_number("basic_salary"))


def clean_payroll(df: DataFrame) -> DataFrame:
    """Net is filled from tds before a blank tds becomes 0; the order matters for the log only."""
    gross = F.round(amount("basic") * F.lit("1.55").cast("decimal(4,2)"), 2).cast(MONEY).cast("string")
    net = (amount("gross") - amount("pf") - amount("tds")).cast(MONEY).cast("string")
    filled = _fill(df, {
        "days_present": (F.col("working_days"), "days_present set to working_days"),
        "gross": (gross, "gross from basic"),
        "net": (net, "net from gross, pf and tds"),
    })
    filled = filled.withColumn("tds", F.when(is_blank("tds"), "0").otherwise(F.col("tds")))
    whole = {c: safe_whole(c) for c in ("emp_id", "working_days", "days_present")}
    return filled.withColumns({**whole, **{c: amount(c) for c in ("basic", "gross", "pf", "tds", "net")}})


def clean_attendance(df: DataFrame) -> DataFrame:
    zero = F.lit("0")
    logged = F.array_compact(F.array(F.when(is_blank("days_present"), "days_present set to 0")))
    out = df.withColumn("issues", logged)
    for c in ("days_present", "overtime_hrs", "late_arrivals"):
        out = out.withColumn(c, F.when(is_blank(c), zero).otherwise(F.col(c)))
    whole = {c: safe_whole(c) for c in ("emp_id", "days_present", "days_absent", "leave_days")}
    return out.withColumns({**whole, **{c: safe_number(c) for c in ("overtime_hrs", "late_arrivals")}})
