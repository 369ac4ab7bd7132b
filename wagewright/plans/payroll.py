"""Payslips, taxes, status workflow, loans and revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions.numeric import mean, ratio, rounded
from wagewright.operators import payroll as pay
from wagewright.operators.joins import first_per_key
from wagewright.registry import query
from wagewright.session import settled
from wagewright.sources import roles
from wagewright.sources.role_sql import avg, pct, r
from wagewright.sources.tables import table

WORKING_DAYS = 26


def staff_with_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = roles.grade_of(F.col("pay_basic"))
    people = roles.employees(spark, sf_dir).filter("status = 'Active'")
    return people.withColumn("_g", grade).select(
        "emp_id", "emp_code", "dept_name", F.col("pay_basic").alias("basic"),
        F.col("_g.grade_code").alias("grade_code"), F.col("_g.hra_pct").alias("hra_pct"),
        F.col("_g.da_pct").alias("da_pct"), F.col("_g.ta_flat").alias("ta_flat"),
    )


def payslip_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staff, grade, attendance of January 2024 and the first active loan, one row per employee."""
    days = roles.attendance(spark, sf_dir).filter("ts >= '2024-01-01' AND ts < '2024-02-01'").groupBy("emp_id").agg(
        F.count_if(F.col("status") == "Absent").alias("absent")
    )
    active = roles.loans(spark, sf_dir).filter("status = 'Active'")
    loan = first_per_key(active, ["emp_id"], [F.col(c) for c in ("loan_key", "line_no", "part_key", "supp_key")]).select("emp_id", "emi")
    return (
        staff_with_grade(spark, sf_dir).join(days, "emp_id", "left").join(loan, "emp_id", "left")
        .withColumn("working_days", F.lit(WORKING_DAYS)).fillna(0, ["absent"])
    )


def slab_sql(inc: str, slabs: list) -> str:
    terms = []
    for lo, hi, rate in slabs:
        if rate:
            top = inc if hi is None else f"least({inc},{hi})"
            terms.append(f"greatest({top}-{lo},0)*CAST({rate / 100:.2f} AS DECIMAL(4,2))")
    return "(" + "+".join(terms) + ")"


def _tax_sql(inc: str, rule: pay.TaxRule) -> str:
    inc = f"CAST({inc} AS DECIMAL(18,2))"
    tax = slab_sql(inc, rule.slabs)
    cut = f"greatest({tax}-{rule.rebate},0)"
    return cut if rule.rebate_limit is None else f"(CASE WHEN {inc}<={rule.rebate_limit} THEN {cut} ELSE {tax} END)"


def _annual_sql(inc: str, rule: pay.TaxRule) -> str:
    return f"round({_tax_sql(inc, rule)}*CAST(1.04 AS DECIMAL(4,2)),2)" if rule.cess != "0.00" else _tax_sql(inc, rule)


ESI = "CASE WHEN gross<=21000 THEN round(gross*CAST({} AS DECIMAL(6,4)),2) ELSE 0 END"
STAFF_SQL = """SELECT e.emp_id, emp_code, dept_name, CAST(pay_basic AS DECIMAL(18,2)) AS basic, grade_code, hra_pct, da_pct, ta_flat, 26 AS working_days, coalesce(absent,0) AS absent, coalesce(emi,0) AS emi
  FROM r_emp e JOIN r_grade ON (pay_basic>=basic_min AND pay_basic<basic_max)
  LEFT JOIN (SELECT emp_id, count(*) FILTER (WHERE status='Absent') AS absent FROM r_att WHERE ts>=TIMESTAMP '2024-01-01' AND ts<TIMESTAMP '2024-02-01' GROUP BY 1) a ON a.emp_id=e.emp_id
  LEFT JOIN (SELECT emp_id, emi FROM r_loan WHERE status='Active' QUALIFY row_number() OVER (PARTITION BY emp_id ORDER BY loan_key, line_no, part_key, supp_key)=1) l ON l.emp_id=e.emp_id
  WHERE e.status='Active'"""
EFF = "CAST(basic AS DOUBLE)-absent*(CAST(basic AS DOUBLE)/26)"
SLIP_SQL = f"""SELECT *, pf+esi_emp+pt+tds+emi AS total_deductions, gross-(pf+esi_emp+pt+tds+emi) AS net FROM (
  SELECT *, round(least(eff,CAST(15000 AS DECIMAL(18,2)))*CAST(0.12 AS DECIMAL(4,2)),2) AS pf, {ESI.format('0.0075')} AS esi_emp, {ESI.format('0.0325')} AS esi_er, CASE WHEN gross>10000 THEN 200 ELSE 0 END AS pt,
    round(CAST(CAST({_annual_sql('gross*12', pay.SERVICE_TAX)} AS DOUBLE)/12 AS DECIMAL(28,8)),2) AS tds FROM (
  SELECT *, CAST(eff+hra+da+ta AS DECIMAL(18,2)) AS gross FROM (SELECT *, round(eff*hra_pct*CAST(0.01 AS DECIMAL(4,2)),2) AS hra, round(eff*da_pct*CAST(0.01 AS DECIMAL(4,2)),2) AS da,
    CASE WHEN absent<13 THEN ta_flat ELSE 0 END AS ta FROM (SELECT *, CAST(round(CAST({EFF} AS DECIMAL(28,8)),2) AS DECIMAL(18,2)) AS eff FROM ({STAFF_SQL})))))"""
SLIP_COLS = "emp_id:l grade_code:s absent:l effective_basic:d hra:d da:d ta:d gross:d pf:d esi_emp:d esi_er:d pt:d tds:d loan:d total_deductions:d net:d"


@query("payroll_components", SLIP_COLS,
       f"SELECT emp_id, grade_code, absent, eff AS effective_basic, hra, da, ta, gross, pf, esi_emp, esi_er, pt, tds, emi AS loan, total_deductions, net FROM ({SLIP_SQL})")
def payroll_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay.payslips(payslip_input(spark, sf_dir))


SEED_SQL = f"""SELECT *, {r('gross-td')} AS net FROM (SELECT *, {r('pf+CAST(esi_emp AS DOUBLE)+CAST(pt AS DOUBLE)+tds0')} AS td FROM (
  SELECT *, {r('least(eff,15000.0::DOUBLE)*0.12::DOUBLE')} AS pf, {ESI.format('0.0075').replace('gross','CAST(gross AS DECIMAL(18,2))')} AS esi_emp, CASE WHEN gross>10000 THEN 200 ELSE 0 END AS pt,
  CAST({_tax_sql('CAST(gross AS DECIMAL(18,2))*12', pay.SEED_TAX)} AS DOUBLE)/12 AS tds0 FROM (
  SELECT *, {r('eff+hra+da+ta')} AS gross FROM (SELECT *, {r('eff*CAST(hra_pct AS DOUBLE)/100')} AS hra, {r('eff*CAST(da_pct AS DOUBLE)/100')} AS da,
  CASE WHEN absent<13 THEN CAST(ta_flat AS DOUBLE) ELSE 0 END AS ta FROM (SELECT *, {EFF} AS eff FROM ({STAFF_SQL}))))))"""


@query("payroll_components_seed", "emp_id:l effective_basic:d hra:d da:d ta:d gross:d pf:d esi_emp:d pt:d tds:d total_deductions:d net:d",
       f"SELECT emp_id, {r('eff')} AS effective_basic, hra, da, ta, gross, pf, esi_emp, pt, {r('tds0')} AS tds, td AS total_deductions, net FROM ({SEED_SQL})")
def payroll_components_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay.payslips_seed(payslip_input(spark, sf_dir))


SIMPLE_SQL = f"""SELECT *, pf+esi_emp+pt+tds AS total_deductions, gross-(pf+esi_emp+pt+tds) AS net FROM (SELECT *, round(least(basic,CAST(15000 AS DECIMAL(18,2)))*CAST(0.12 AS DECIMAL(4,2)),2) AS pf, {ESI.format('0.0075')} AS esi_emp,
  CASE WHEN gross>10000 THEN 200 ELSE 0 END AS pt, round(CAST(CAST(CAST(greatest(gross*12-400000,0) AS DECIMAL(18,2))*CAST(0.05 AS DECIMAL(4,2)) AS DOUBLE)/12 AS DECIMAL(28,8)),2) AS tds FROM
  (SELECT e.emp_id, CAST(pay_basic AS DECIMAL(18,2)) AS basic, CAST(round(CAST(pay_basic AS DECIMAL(18,2))*(1+(coalesce(hra_pct,35)+coalesce(da_pct,17))*CAST(0.01 AS DECIMAL(4,2))),2)+coalesce(ta_flat,1200) AS DECIMAL(18,2)) AS gross
   FROM r_emp e LEFT JOIN (SELECT * FROM r_grade WHERE grade_code<>'G9') ON (pay_basic>=basic_min AND pay_basic<basic_max) WHERE status='Active'))"""


@query("payroll_components_simple", "emp_id:l basic:d gross:d pf:d esi_emp:d pt:d tds:d total_deductions:d net:d", SIMPLE_SQL)
def payroll_components_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay.payslips_simple(staff_with_grade(spark, sf_dir))


BATCH_MONTH = "2001-03"


@query("generate_payroll_batch", "emp_id:l outcome:s net:d status:s",
       f"""SELECT s.emp_id, CASE WHEN p.was='Paid' THEN 'skipped: paid' WHEN net<0 THEN 'failed: negative net' WHEN p.was IS NOT NULL THEN 'replaced' ELSE 'inserted' END AS outcome, net,
           CASE WHEN p.was='Paid' THEN 'Paid' WHEN net<0 THEN coalesce(p.was,'') ELSE 'Draft' END AS status
           FROM ({SLIP_SQL}) s LEFT JOIN (SELECT emp_id, max(status) AS was FROM r_ord WHERE period='{BATCH_MONTH}' GROUP BY 1) p ON p.emp_id=s.emp_id""")
def generate_payroll_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run for every active employee; records already paid stay, others are replaced."""
    month = roles.payroll_headers(spark, sf_dir).filter(roles.in_month(2001, 3))
    flags = month.groupBy("emp_id").agg(
        F.max(F.col("status") == "Paid").alias("any_paid"), F.max(F.col("status") == "Draft").alias("any_draft")
    )
    was = F.when(F.col("any_paid"), "Paid").when(F.col("any_draft"), "Draft").otherwise("Approved")
    existing = flags.select("emp_id", was.alias("was"))
    rows = pay.payslips(payslip_input(spark, sf_dir)).join(existing, "emp_id", "left")
    paid, refused = F.col("was") == "Paid", F.col("net") < 0
    return rows.withColumns({
        "outcome": F.when(paid, "skipped: paid").when(refused, "failed: negative net").when(F.col("was").isNotNull(), "replaced").otherwise("inserted"),
        "status": F.when(paid, "Paid").when(refused, F.coalesce("was", F.lit(""))).otherwise("Draft"),
    })


def incomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.employees(spark, sf_dir).filter("status = 'Active'").select(
        "emp_id", (F.col("pay_basic") * 12).cast("decimal(18,2)").alias("income")
    )


INCOME_SQL = "(SELECT emp_id, CAST(pay_basic*12 AS DECIMAL(18,2)) AS income FROM r_emp WHERE status='Active')"


@query("tax_new_regime", "emp_id:l income:d slab_tax:d annual_tax:d",
       f"SELECT emp_id, income, {slab_sql('income', pay.NEW_SLABS)} AS slab_tax, {_annual_sql('income', pay.SERVICE_TAX)} AS annual_tax FROM {INCOME_SQL}")
def tax_new_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incomes(spark, sf_dir).withColumns({
        "slab_tax": pay.slab_tax("income", pay.NEW_SLABS), "annual_tax": pay.annual_tax("income", pay.SERVICE_TAX)
    })


@query("tax_seed_variant", "emp_id:l income:d annual_tax:d", f"SELECT emp_id, income, {_annual_sql('income', pay.SEED_TAX)} AS annual_tax FROM {INCOME_SQL}")
def tax_seed_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incomes(spark, sf_dir).withColumn("annual_tax", pay.annual_tax("income", pay.SEED_TAX))


def _regime_sql(name: str, rule: pay.TaxRule) -> str:
    t = _tax_sql("income", rule)
    return f"round({t}*CAST(0.04 AS DECIMAL(4,2)),2) AS {name}_cess, round({t}+round({t}*CAST(0.04 AS DECIMAL(4,2)),2),2) AS {name}_tax"


@query("tax_regime_compare", "emp_id:l income:d new_cess:d new_tax:d new_monthly:d new_rate:d old_cess:d old_tax:d old_monthly:d old_rate:d better:s saving:d",
       f"""SELECT *, {r('CAST(new_tax AS DOUBLE)/12')} AS new_monthly, {r(pct('new_tax','income'))} AS new_rate, {r('CAST(old_tax AS DOUBLE)/12')} AS old_monthly, {r(pct('old_tax','income'))} AS old_rate,
           CASE WHEN new_tax<=old_tax THEN 'New Regime' ELSE 'Old Regime' END AS better, abs(new_tax-old_tax) AS saving
           FROM (SELECT emp_id, income, {_regime_sql('new', pay.WEB_NEW)}, {_regime_sql('old', pay.WEB_OLD)} FROM {INCOME_SQL})""")
def tax_regime_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay.regimes(incomes(spark, sf_dir), "income")


def _breakdown_sql(name: str, slabs: list) -> str:
    rows = []
    for lo, hi, rate in slabs:
        part = f"greatest({'income' if hi is None else f'least(income,{hi})'}-{lo},0)"
        rows.append(f"SELECT emp_id, '{name}' AS regime, {lo} AS slab_from, {rate} AS rate, {part} AS taxable, round({part}*CAST({rate / 100:.2f} AS DECIMAL(4,2)),2) AS slab_tax FROM {INCOME_SQL} WHERE income>{lo}")
    return " UNION ALL ".join(rows)


@query("tax_slab_breakdown", "emp_id:l regime:s slab_from:l rate:l taxable:d slab_tax:d",
       _breakdown_sql("new", pay.NEW_SLABS) + " UNION ALL " + _breakdown_sql("old", pay.OLD_SLABS))
def tax_slab_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = incomes(spark, sf_dir)
    new = pay.slab_breakdown(base, "income", pay.NEW_SLABS).withColumn("regime", F.lit("new"))
    return new.unionByName(pay.slab_breakdown(base, "income", pay.OLD_SLABS).withColumn("regime", F.lit("old")))


@query("status_transition", "status:s new_status:s payment_date:s records:l total_net:d",
       """SELECT status, new_status, CASE WHEN new_status='Paid' AND status='Approved' THEN '1998-12-31' END AS payment_date, count(*) AS records, sum(gross) AS total_net FROM
       (SELECT *, CASE WHEN pay_year=1998 AND status='Draft' THEN 'Approved' WHEN pay_year=1998 AND status='Approved' THEN 'Paid' ELSE status END AS new_status FROM r_ord) GROUP BY 1,2,3""")
def status_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paying comes first, so a record moves one step per run."""
    heads = roles.payroll_headers(spark, sf_dir)
    year = F.col("pay_year") == 1998
    paid = pay.advance_status(heads, year, "Approved", "Paid", "1998-12-31").withColumnRenamed("new_status", "_paid").withColumnRenamed("payment_date", "_date")
    moved = pay.advance_status(paid, year, "Draft", "Approved").withColumn(
        "new_status", F.when(F.col("_paid") != F.col("status"), F.col("_paid")).otherwise(F.col("new_status"))
    )
    return moved.groupBy("status", "new_status", F.col("_date").alias("payment_date")).agg(
        F.count("*").alias("records"), F.sum("gross").alias("total_net")
    )


@query("loan_balance_update", "loan_key:l line_no:l part_key:l outstanding:d new_outstanding:d new_emis_paid:l new_status:s",
       """SELECT loan_key, line_no, part_key, outstanding, CASE WHEN hit THEN outstanding-deducted ELSE outstanding END AS new_outstanding, emis_paid + CASE WHEN hit THEN paid_now ELSE 0 END AS new_emis_paid,
       CASE WHEN hit AND outstanding-deducted<=0 THEN 'Closed' ELSE status END AS new_status FROM (SELECT l.*, deducted, paid_now, status='Active' AND deducted IS NOT NULL AS hit FROM r_loan l LEFT JOIN
       (SELECT emp_id, sum(round(gross*CAST(0.05 AS DECIMAL(4,2)),2)) AS deducted, count(*) AS paid_now FROM r_ord WHERE pay_year=2000 AND status='Paid' GROUP BY 1) d ON l.emp_id=d.emp_id)""")
def loan_balance_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = roles.payroll_headers(spark, sf_dir).filter(roles.in_year(2000) & (F.col("status") == "Paid")).select(
        "emp_id", F.round(F.col("gross") * F.lit("0.05").cast("decimal(4,2)"), 2).alias("amount")
    )
    return pay.repay_loans(roles.loans(spark, sf_dir), run)


@query("loan_status", "loan_key:l line_no:l part_key:l emp_code:s dept_name:s amount:d emi:d total_emis:l emis_paid:l emis_remaining:l progress_pct:d outstanding:d status:s loan_date:s",
       f"""SELECT loan_key, line_no, part_key, emp_code, dept_name, amount, emi, total_emis, emis_paid, total_emis-emis_paid AS emis_remaining, {r(pct('emis_paid','total_emis'),0)} AS progress_pct, outstanding, l.status, strftime(loan_date,'%Y-%m-%d') AS loan_date
           FROM r_loan l JOIN r_emp e ON l.emp_id=e.emp_id""")
def loan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = roles.employees(spark, sf_dir).select("emp_id", "emp_code", "dept_name")
    return roles.loans(spark, sf_dir).join(people, "emp_id").withColumns({
        "emis_remaining": F.col("total_emis") - F.col("emis_paid"),
        "progress_pct": rounded(ratio("emis_paid", "total_emis", 100), 0),
        "loan_date": F.date_format("loan_date", "yyyy-MM-dd"),
    })


@query("loan_outstanding_total", "dept_name:s loans:l outstanding:d",
       "SELECT coalesce(dept_name,'TOTAL') AS dept_name, count(*) AS loans, sum(outstanding) AS outstanding FROM r_loan l JOIN r_emp e ON l.emp_id=e.emp_id WHERE l.status='Active' GROUP BY ROLLUP(dept_name)")
def loan_outstanding_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_emp = roles.loans(spark, sf_dir).filter("status = 'Active'").groupBy("emp_id").agg(
        F.count("*").alias("n"), F.sum("outstanding").alias("o")
    )
    people = roles.employees(spark, sf_dir).select("emp_id", "dept_name")
    return per_emp.join(people, "emp_id").rollup("dept_name").agg(
        F.sum("n").alias("loans"), F.sum("o").alias("outstanding")
    ).fillna("TOTAL", ["dept_name"])


@query("apply_revisions", "emp_id:l old_basic:d new_basic:d revised_on:s",
       """SELECT e.emp_id, basic AS old_basic, coalesce(v.new_basic, basic) AS new_basic, strftime(effective,'%Y-%m-%d') AS revised_on FROM r_emp e
       LEFT JOIN (SELECT emp_id, max_by(new_basic, (effective, revision_id)) AS new_basic, max(effective) AS effective FROM r_rev GROUP BY 1) v ON v.emp_id=e.emp_id""")
def apply_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest revision of each employee becomes the current basic."""
    latest = roles.revisions(spark, sf_dir).groupBy("emp_id").agg(
        F.max(F.struct("effective", "revision_id", "new_basic")).alias("v")
    )
    return roles.employees(spark, sf_dir).join(latest, "emp_id", "left").select(
        "emp_id", F.col("basic").alias("old_basic"), F.coalesce("v.new_basic", "basic").alias("new_basic"),
        F.date_format("v.effective", "yyyy-MM-dd").alias("revised_on"),
    )


BRACKET_SQL = "CASE " + " ".join(f"WHEN pay_basic*12<{b} THEN '{n}'" for b, n in pay.TAX_BRACKETS) + " ELSE 'Above 16L (20%+)' END"


@query("tds_bracket_analysis", "bracket:s employees:l avg_annual_tds:d period_tds:d tds_rate:d",
       f"""SELECT {BRACKET_SQL} AS bracket, count(*) AS employees, {r(avg('tds') + '*12', 0)} AS avg_annual_tds, sum(tds) AS period_tds, {r(pct('sum(tds)','sum(gross)'),1)} AS tds_rate
           FROM r_wide WHERE pay_year=2000 GROUP BY 1""")
def tds_bracket_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = roles.wide_payroll(spark, sf_dir, roles.payroll(spark, sf_dir).filter(roles.in_year(2000)))
    return wide.groupBy(pay.tax_bracket(F.col("pay_basic") * 12).alias("bracket")).agg(
        F.count("*").alias("employees"), rounded(mean("tds") * 12, 0).alias("avg_annual_tds"), F.sum("tds").alias("period_tds"),
        rounded(ratio(F.sum("tds"), F.sum("gross"), 100), 1).alias("tds_rate"),
    )


@query("employee_tax_table", "payroll_id:l name:s dept_name:s gross:d annual:d tds:d annual_tds:d rate:d bracket:s",
       f"""SELECT payroll_id, name, dept_name, gross, gross*12 AS annual, tds, tds*12 AS annual_tds, {r(pct('tds','gross'),1)} AS rate, {BRACKET_SQL.replace('pay_basic','gross')} AS bracket FROM r_wide WHERE period='{BATCH_MONTH}'
           UNION ALL SELECT -1, 'TOTAL', '', sum(gross), sum(gross)*12, sum(tds), sum(tds)*12, {r(pct('sum(tds)','sum(gross)'),1)}, '' FROM r_wide WHERE period='{BATCH_MONTH}'""")
def employee_tax_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = roles.payroll(spark, sf_dir).filter(roles.in_month(2001, 3))
    rows = settled(roles.wide_payroll(spark, sf_dir, month).select(
        "payroll_id", "name", "dept_name", "gross", (F.col("gross") * 12).alias("annual"), "tds", (F.col("tds") * 12).alias("annual_tds"),
        rounded(ratio("tds", "gross", 100), 1).alias("rate"), pay.tax_bracket(F.col("gross") * 12).alias("bracket"),
    ))
    sums = rows.agg(F.sum("gross").alias("gross"), F.sum("tds").alias("tds")).select(
        F.lit(-1).cast("bigint").alias("payroll_id"), F.lit("TOTAL").alias("name"), F.lit("").alias("dept_name"), "gross",
        (F.col("gross") * 12).alias("annual"), "tds", (F.col("tds") * 12).alias("annual_tds"),
        rounded(ratio("tds", "gross", 100), 1).alias("rate"), F.lit("").alias("bracket"),
    )
    return rows.unionByName(sums)


BAND_SQL = "CASE " + " ".join(f"WHEN pay_basic>={b} THEN '{n}'" for b, n in pay.SALARY_BANDS) + " ELSE 'Junior' END"


@query("salary_band_distribution", "salary_band:s employees:l avg_net:d total_net:d",
       f"SELECT {BAND_SQL} AS salary_band, count(DISTINCT emp_id) AS employees, {r(avg('net'))} AS avg_net, sum(net) AS total_net FROM r_wide WHERE status='Paid' GROUP BY 1")
def salary_band_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per employee first: the distinct count needs no second pass over the records."""
    paid = roles.payroll(spark, sf_dir).filter("status = 'Paid'").groupBy("emp_id").agg(F.sum("net").alias("n"), F.count("*").alias("c"))
    people = roles.employees(spark, sf_dir).select("emp_id", pay.salary_band(F.col("pay_basic")).alias("salary_band"))
    return paid.join(people, "emp_id").groupBy("salary_band").agg(
        F.count("*").alias("employees"),
        rounded(F.sum("n").cast("double") / F.sum("c").cast("double")).alias("avg_net"),
        F.sum("n").alias("total_net"),
    )


@query("employment_type_stats", "employment_type:s employees:l avg_net:d min_net:d max_net:d",
       f"SELECT gender AS employment_type, count(DISTINCT emp_id) AS employees, {r(avg('net'))} AS avg_net, min(net) AS min_net, max(net) AS max_net FROM r_wide WHERE status='Paid' GROUP BY 1")
def employment_type_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = roles.payroll(spark, sf_dir).filter("status = 'Paid'").groupBy("emp_id").agg(
        F.sum("net").alias("n"), F.count("*").alias("c"), F.min("net").alias("lo"), F.max("net").alias("hi")
    )
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("emp_id"), F.col("c_mktsegment").alias("employment_type"))
    return paid.join(people, "emp_id").groupBy("employment_type").agg(
        F.count("*").alias("employees"), rounded(F.sum("n").cast("double") / F.sum("c").cast("double")).alias("avg_net"),
        F.min("lo").alias("min_net"), F.max("hi").alias("max_net"),
    )
