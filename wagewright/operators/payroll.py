"""Payroll and income tax as column arithmetic.

The slab tables have a handful of fixed rows, so a tax is a sum over slabs in
one projection: no range join, no shuffle. Amounts are DECIMAL and each step is
rounded where the payslip rounds it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.functions.numeric import as_col, rounded, zero

MONEY = "decimal(18,2)"

# Fixed values: (income from, income to, rate %). The last slab is open-ended.
NEW_SLABS = [
    (0, 400000, 0),
    (400000, 800000, 5),
    (800000, 1200000, 10),
    (1200000, 1600000, 15),
    (1600000, 2000000, 20),
    (2000000, 2400000, 25),
    (2400000, None, 30),
]
OLD_SLABS = [
    (0, 250000, 0),
    (250000, 500000, 5),
    (500000, 1000000, 20),
    (1000000, None, 30),
]


@dataclass(frozen=True)
class TaxRule:
    """A slab table with its rebate and cess.

    ``rebate_limit`` is the highest income that gets the rebate, None for every income.
    """

    slabs: list
    rebate: int
    rebate_limit: int | None
    cess: str


SERVICE_TAX = TaxRule(NEW_SLABS, 60000, 1200000, "0.04")
SEED_TAX = TaxRule(NEW_SLABS, 12500, None, "0.00")
WEB_NEW = TaxRule(NEW_SLABS, 60000, 1200000, "0.04")
WEB_OLD = TaxRule(OLD_SLABS, 60000, 500000, "0.04")


def dec(value: str | int, kind: str = MONEY) -> Column:
    return F.lit(str(value)).cast(kind)


def slab_amount(income: Column, low: int, high: int | None) -> Column:
    """The part of the income that falls into one slab."""
    top = income if high is None else F.least(income, dec(high))
    return F.greatest(top - dec(low), dec(0))


def slab_tax(income: Column | str, slabs: list) -> Column:
    income = as_col(income).cast(MONEY)
    parts = [slab_amount(income, lo, hi) * dec(f"{rate / 100:.2f}", "decimal(4,2)") for lo, hi, rate in slabs if rate]
    return F.when(income.isNotNull(), reduce(lambda a, b: a + b, parts)).cast("decimal(24,4)")  # least() would skip a null


def tax_before_cess(income: Column | str, rule: TaxRule) -> Column:
    income = as_col(income).cast(MONEY)
    tax = slab_tax(income, rule.slabs)
    reduced = F.greatest(tax - dec(rule.rebate), dec(0)).cast("decimal(24,4)")
    return reduced if rule.rebate_limit is None else F.when(income <= dec(rule.rebate_limit), reduced).otherwise(tax)


def annual_tax(income: Column | str, rule: TaxRule = SERVICE_TAX) -> Column:
    """Tax with cess, rounded to two digits; the variant without cess stays unrounded."""
    tax = tax_before_cess(income, rule)
    if float(rule.cess) == 0:
        return tax
    return F.round(tax * (dec(1, "decimal(4,2)") + dec(rule.cess, "decimal(4,2)")), 2).cast(MONEY)


def slab_breakdown(df: DataFrame, income: str, slabs: list) -> DataFrame:
    """One row per reached slab: range, rate, taxable amount, tax."""
    inc = F.col(income).cast(MONEY)
    entries = []
    for lo, hi, rate in slabs:
        part = slab_amount(inc, lo, hi)
        entries.append(
            F.when(
                inc > dec(lo),
                F.struct(
                    F.lit(lo).cast("bigint").alias("slab_from"), F.lit(rate).cast("bigint").alias("rate"), part.alias("taxable"),
                    F.round(part * dec(f"{rate / 100:.2f}", "decimal(4,2)"), 2).cast(MONEY).alias("slab_tax"),
                ),
            )
        )
    return df.select("*", F.inline(F.array_compact(F.array(*entries))))


def regimes(df: DataFrame, income: str) -> DataFrame:
    """New against old regime: total, monthly deduction, rate, the better one and the saving."""
    out = df
    for name, rule in (("new", WEB_NEW), ("old", WEB_OLD)):
        tax = tax_before_cess(income, rule)
        cess = F.round(tax * dec(rule.cess, "decimal(4,2)"), 2)
        total = F.round(tax + cess, 2).cast(MONEY)
        out = out.withColumns({f"{name}_cess": cess.cast(MONEY), f"{name}_tax": total}).withColumns({
            f"{name}_monthly": rounded(F.col(f"{name}_tax").cast("double") / 12),
            f"{name}_rate": rounded(F.coalesce(F.try_divide(F.col(f"{name}_tax").cast("double"), F.col(income).cast("double")) * 100, F.lit(0.0))),
        })
    return out.withColumns({
        "better": F.when(F.col("new_tax") <= F.col("old_tax"), "New Regime").otherwise("Old Regime"),
        "saving": F.abs(F.col("new_tax") - F.col("old_tax")),
    })


def _statutory(gross: Column) -> dict[str, Column]:
    small = gross <= dec(21000)
    return {
        "esi_emp": F.when(small, F.round(gross * dec("0.0075", "decimal(6,4)"), 2)).otherwise(dec(0)).cast(MONEY),
        "esi_er": F.when(small, F.round(gross * dec("0.0325", "decimal(6,4)"), 2)).otherwise(dec(0)).cast(MONEY),
        "pt": F.when(gross > dec(10000), dec(200)).otherwise(dec(0)),
    }


def _share(amount: Column, pct: str) -> Column:
    return F.round(amount * F.col(pct) * dec("0.01", "decimal(4,2)"), 2).cast(MONEY)


def payslips(df: DataFrame) -> DataFrame:
    """Components of a payslip, every amount rounded as it is computed.

    Needs basic, hra_pct, da_pct, ta_flat, working_days, absent, emi. No
    attendance at all means fully present, which is ``absent`` = 0.
    """
    basic, days = F.col("basic").cast("double"), F.col("working_days").cast("double")
    effective = rounded(basic - F.col("absent") * (basic / days)).cast(MONEY)
    half = F.col("absent") < days * 0.5
    eff = F.col("effective_basic")
    out = (
        df.withColumn("effective_basic", effective)
        .withColumns({"hra": _share(eff, "hra_pct"), "da": _share(eff, "da_pct"), "ta": F.when(half, F.col("ta_flat")).otherwise(dec(0))})
        .withColumn("gross", (eff + F.col("hra") + F.col("da") + F.col("ta")).cast(MONEY))
    )
    pf = F.round(F.least(eff, dec(15000)) * dec("0.12", "decimal(4,2)"), 2).cast(MONEY)
    out = out.withColumns({"pf": pf, **_statutory(F.col("gross"))})
    tds = rounded(annual_tax(F.col("gross") * 12).cast("double") / 12).cast(MONEY)
    out = out.withColumn("tds", tds).withColumn("loan", zero("emi").cast(MONEY))
    total = F.col("pf") + F.col("esi_emp") + F.col("pt") + F.col("tds") + F.col("loan")
    return out.withColumn("total_deductions", total.cast(MONEY)).withColumn(
        "net", (F.col("gross") - F.col("total_deductions")).cast(MONEY)
    )


def payslips_seed(df: DataFrame) -> DataFrame:
    """The variant of the sample data: effective basic and tax stay unrounded until output."""
    basic, days = F.col("basic").cast("double"), F.col("working_days").cast("double")
    eff = F.col("_eff")
    out = df.withColumn("_eff", basic - F.col("absent") * (basic / days))
    ta = F.when(F.col("absent") < days * 0.5, F.col("ta_flat").cast("double")).otherwise(F.lit(0.0))
    out = out.withColumns({
        "hra": rounded(eff * F.col("hra_pct").cast("double") / 100), "da": rounded(eff * F.col("da_pct").cast("double") / 100), "ta": ta,
    })
    out = out.withColumn("gross", rounded(eff + F.col("hra") + F.col("da") + F.col("ta")))
    gross = F.col("gross").cast(MONEY)
    out = out.withColumns({"pf": rounded(F.least(eff, F.lit(15000.0)) * 0.12), **_statutory(gross)})
    out = out.withColumn("_tds", annual_tax(gross * 12, SEED_TAX).cast("double") / 12)
    total = F.col("pf") + F.col("esi_emp").cast("double") + F.col("pt").cast("double") + F.col("_tds")
    out = out.withColumn("total_deductions", rounded(total)).withColumn("net", rounded(F.col("gross") - F.col("total_deductions")))
    return out.withColumns({"effective_basic": rounded("_eff"), "tds": rounded("_tds")}).drop("_eff", "_tds")


def payslips_simple(df: DataFrame) -> DataFrame:
    """The short form: no attendance, no loan, 5 % on the yearly gross above 400,000."""
    hra, da = F.coalesce("hra_pct", dec(35, "decimal(5,2)")), F.coalesce("da_pct", dec(17, "decimal(5,2)"))
    ta = F.coalesce("ta_flat", dec(1200))
    basic = F.col("basic").cast(MONEY)
    factor = dec(1, "decimal(6,4)") + (hra + da) * dec("0.01", "decimal(4,2)")
    out = df.withColumn("gross", (F.round(basic * factor, 2) + ta).cast(MONEY))
    gross = F.col("gross")
    above = F.greatest(gross * 12 - dec(400000), dec(0)).cast(MONEY) * dec("0.05", "decimal(4,2)")
    out = out.withColumns({
        "pf": F.round(F.least(basic, dec(15000)) * dec("0.12", "decimal(4,2)"), 2).cast(MONEY),
        **_statutory(gross),
        "tds": rounded(above.cast("double") / 12).cast(MONEY),
    })
    total = F.col("pf") + F.col("esi_emp") + F.col("pt") + F.col("tds")
    return out.withColumn("total_deductions", total.cast(MONEY)).withColumn(
        "net", (gross - F.col("total_deductions")).cast(MONEY)
    )


def advance_status(df: DataFrame, in_period: Column, start: str, to: str, payment_date: str | None = None) -> DataFrame:
    """Move the records of a period from one status to the next."""
    moved = in_period & (F.col("status") == start)
    out = df.withColumn("new_status", F.when(moved, to).otherwise(F.col("status")))
    return out.withColumn("payment_date", F.when(moved, F.lit(payment_date)).otherwise(F.lit(None).cast("string")))


def repay_loans(loans: DataFrame, deductions: DataFrame) -> DataFrame:
    """Balance after one run's loan deductions; ``deductions`` is (emp_id, amount).

    Deductions are summed per employee first, so the join is one row per employee.
    """
    per_emp = deductions.groupBy("emp_id").agg(F.sum("amount").alias("deducted"), F.count("*").alias("paid_now"))
    hit = (F.col("status") == "Active") & F.col("deducted").isNotNull()
    left = F.when(hit, F.col("outstanding") - F.col("deducted")).otherwise(F.col("outstanding"))
    joined = loans.join(per_emp, "emp_id", "left").withColumn("new_outstanding", left)
    return joined.withColumns({
        "new_emis_paid": F.col("emis_paid") + F.when(hit, F.col("paid_now")).otherwise(F.lit(0)),
        "new_status": F.when(hit & (F.col("new_outstanding") <= 0), "Closed").otherwise(F.col("status")),
    })


# Salary bands (from, name), tax brackets by yearly basic (below, name).
SALARY_BANDS = [(200000, "Senior"), (100000, "Lead"), (50000, "Mid")]
TAX_BRACKETS = [
    (400000, "0-4L (No Tax)"),
    (800000, "4L-8L (5%)"),
    (1200000, "8L-12L (10%)"),
    (1600000, "12L-16L (15%)"),
]


def salary_band(basic: Column) -> Column:
    band = F.lit("Junior")
    for low, name in reversed(SALARY_BANDS):
        band = F.when(basic >= low, name).otherwise(band)
    return band


def tax_bracket(annual: Column) -> Column:
    out = F.lit("Above 16L (20%+)")
    for below, name in reversed(TAX_BRACKETS):
        out = F.when(annual < below, name).otherwise(out)
    return out
