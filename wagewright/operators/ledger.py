"""Loan balances as deductions arrive: the order counts, and a closed loan takes no more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.operators.history import micros
from wagewright.operators.joins import asof_join
from wagewright.operators.ordering import ranked

MONEY = "decimal(18,2)"


def running_deductions(deductions: DataFrame, key: str = "emp_id", at: str = "paid_at", tie: str = "deduction_id", amount: str = "amount") -> DataFrame:
    """``key``, ``tie``, ``nth`` (from 1) and ``total`` (all deductions so far) of each deduction, in order of ``at`` and ``tie``.

    Deductions that aren't above 0 are none. Totals come from slices of time, so an employee with very many meets in no task.
    """
    paid = deductions.filter(F.col(amount) > 0).select(key, tie, F.col(amount).cast(MONEY).alias("amount"), micros(at, dict(deductions.dtypes)[at] == "timestamp").alias("_at"))
    rows = ranked(paid, "_at", tie, [key], want=("row_number",), running="amount")
    return rows.select(key, tie, F.col("row_number").alias("nth"), F.col("running_total").cast(MONEY).alias("total"))


def _cents(c: str):
    return (F.col(c).cast(MONEY) * 100).cast("bigint")


def settle_loans(loans: DataFrame, ledger: DataFrame, loan_id: str, key: str = "emp_id", tie: str = "deduction_id") -> DataFrame:
    """``loans`` with ``new_outstanding``, ``new_emis_paid``, ``new_status`` and ``closed_by`` after all deductions of the ledger.

    Each deduction of an employee lowers each active loan of theirs, until the first that brings it to 0 or below closes it. That is
    the first whose running total reaches the balance: an as-of lookup on amounts, counted down from the balance, so loans and
    deductions are never paired. What stays open is lowered by the employee's whole total. ``loan_id`` is a unique number.
    """
    falling = ledger.select(key, tie, "nth", "total", (-_cents("total")).alias("_at"))
    active = loans.filter("status = 'Active'").withColumn("_owed", -F.greatest(_cents("outstanding"), F.lit(1)))
    met = asof_join(active, falling, [key], "_owed", loan_id, "_at", tie, ["nth", "total", tie])
    whole = ledger.groupBy(key).agg(F.max("nth").alias("_n"), F.max("total").alias("_all"))
    after = met.join(whole, key, "left")
    paid, times = F.coalesce("total", "_all", F.lit(0).cast(MONEY)), F.coalesce("nth", "_n", F.lit(0))
    done = after.withColumns({
        "new_outstanding": (F.col("outstanding") - paid).cast(MONEY), "new_emis_paid": F.col("emis_paid") + times,
        "new_status": F.when(F.col("nth").isNotNull(), "Closed").otherwise(F.col("status")), "closed_by": F.col(tie),
    })
    others = loans.filter(~F.col("status").eqNullSafe("Active")).withColumns({
        "new_outstanding": F.col("outstanding").cast(MONEY), "new_emis_paid": F.col("emis_paid"), "new_status": F.col("status"), "closed_by": F.lit(None).cast(dict(ledger.dtypes)[tie]),
    })
    columns = [*loans.columns, "new_outstanding", "new_emis_paid", "new_status", "closed_by"]
    return done.select(*columns).unionByName(others.select(*columns))
