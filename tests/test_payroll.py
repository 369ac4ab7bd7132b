"""Published payslips and tax cases."""

import pytest
from pyspark.sql import functions as F

from wagewright.operators import payroll as p

SLIP = "basic decimal(18,2), hra_pct decimal(5,2), da_pct decimal(5,2), ta_flat decimal(18,2), working_days int, absent bigint, emi decimal(18,2)"


def slip(spark, *row):
    names = [c.split()[0] for c in SLIP.split(", ")]
    df = spark.createDataFrame([tuple(float(v) for v in row)], ", ".join(f"{n} double" for n in names))
    return df.select(*[F.col(n).cast(c.split(" ", 1)[1]).alias(n) for n, c in zip(names, SLIP.split(", "))])


# Two lines of the published payroll register.
PUBLISHED = [
    ((45000, 30, 17, 1200, 27, 1, 0), dict(effective_basic=43333.33, hra=13000.0, da=7366.67, gross=64900.0, pf=1800.0, pt=200.0, tds=536.67, total_deductions=2536.67, net=62363.33)),
    ((125000, 40, 22, 2500, 27, 1, 0), dict(effective_basic=120370.37, hra=48148.15, da=26481.48, gross=197500.0, pf=1800.0, tds=23333.33, total_deductions=25333.33, net=172166.67)),
]


@pytest.mark.parametrize("given,want", PUBLISHED)
def test_published_payslip(spark, given, want):
    got = p.payslips_seed(slip(spark, *given)).first()
    assert {k: round(float(got[k]), 2) for k in want} == want


def test_service_payslip_rounds_each_step(spark):
    got = p.payslips(slip(spark, 45000, 30, 17, 1200, 27, 1, 500)).first()
    assert float(got["effective_basic"]) == 43333.33 and float(got["hra"]) == 13000.0 and float(got["da"]) == 7366.67
    assert float(got["gross"]) == 64900.0 and float(got["tds"]) == 0.0  # 778,800 a year is inside the rebate
    assert float(got["total_deductions"]) == 2500.0 and float(got["net"]) == 62400.0


def test_half_absent_loses_transport(spark):
    assert float(p.payslips(slip(spark, 30000, 30, 17, 1200, 26, 13, 0)).first()["ta"]) == 0.0
    assert float(p.payslips(slip(spark, 30000, 30, 17, 1200, 26, 12, 0)).first()["ta"]) == 1200.0


def test_small_gross_pays_esi(spark):
    got = p.payslips(slip(spark, 12000, 10, 10, 500, 26, 0, 0)).first()
    assert float(got["gross"]) == 14900.0 and float(got["esi_emp"]) == 111.75 and float(got["esi_er"]) == 484.25


def loop_tax(income, slabs):
    """The rule written as a loop over slabs."""
    tax = 0.0
    for lo, hi, rate in slabs:
        if income > lo:
            tax += (min(income, hi) if hi else income) * rate / 100 - lo * rate / 100
    return tax


@pytest.mark.parametrize("income", [0, 399999, 400000, 400001, 800000, 1200000, 1200001, 1999999.99, 2400000, 2400000.01, 9000000])
def test_slab_tax(spark, income):
    got = spark.range(1).select(
        p.slab_tax(F.lit(str(income)), p.NEW_SLABS).alias("new"), p.slab_tax(F.lit(str(income)), p.OLD_SLABS).alias("old"),
        p.annual_tax(F.lit(str(income))).alias("annual"), p.annual_tax(F.lit(str(income)), p.SEED_TAX).alias("seed"),
    ).first()
    new, old = loop_tax(income, p.NEW_SLABS), loop_tax(income, p.OLD_SLABS)
    assert abs(float(got["new"]) - new) < 0.001 and abs(float(got["old"]) - old) < 0.001
    reduced = max(new - 60000, 0) if income <= 1200000 else new
    assert abs(float(got["annual"]) - reduced * 1.04) < 0.011
    assert abs(float(got["seed"]) - max(new - 12500, 0)) < 0.001


def test_breakdown_adds_up(spark):
    df = spark.createDataFrame([(1, 1750000.0), (2, 0.0)], "id bigint, income double")
    rows = p.slab_breakdown(df, "income", p.NEW_SLABS).collect()
    assert [int(r["rate"]) for r in rows] == [0, 5, 10, 15, 20] and {r["id"] for r in rows} == {1}
    assert sum(float(r["slab_tax"]) for r in rows) == loop_tax(1750000, p.NEW_SLABS)


def test_old_regime_rebate_cap(spark):
    df = spark.createDataFrame([(500000.0,), (500001.0,)], "income double").withColumn("income", F.col("income").cast("decimal(18,2)"))
    low, high = p.regimes(df, "income").orderBy("income").collect()
    assert float(low["old_tax"]) == 0.0 and float(high["old_tax"]) == 13000.21
    assert low["better"] == "New Regime" and float(high["saving"]) == 13000.21


def test_repay_closes_loan(spark):
    loans = spark.sql("SELECT * FROM VALUES (1, 100.0, 3L, 'Active'), (1, 900.0, 0L, 'Active'), (2, 50.0, 1L, 'Closed') AS t(emp_id, outstanding, emis_paid, status)")
    runs = spark.sql("SELECT * FROM VALUES (1, 100.0), (2, 10.0) AS t(emp_id, amount)")
    got = sorted((r["emp_id"], float(r["new_outstanding"]), r["new_emis_paid"], r["new_status"]) for r in p.repay_loans(loans, runs).collect())
    assert got == [(1, 0.0, 4, "Closed"), (1, 800.0, 1, "Active"), (2, 50.0, 1, "Closed")]


def test_status_moves_one_step(spark):
    df = spark.sql("SELECT * FROM VALUES ('Draft', 1), ('Approved', 1), ('Draft', 2) AS t(status, m)")
    got = [(r["status"], r["m"], r["new_status"], r["payment_date"]) for r in p.advance_status(df, F.col("m") == 1, "Approved", "Paid", "2026-03-31").collect()]
    assert got == [("Draft", 1, "Draft", None), ("Approved", 1, "Paid", "2026-03-31"), ("Draft", 2, "Draft", None)]
