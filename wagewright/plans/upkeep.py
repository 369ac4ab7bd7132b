"""Tables that are kept up as changes arrive, and layouts that save work: type-2 loads, cubes, ledgers, indexes, retention."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions import calendar as cal
from wagewright.functions.numeric import stored_money
from wagewright.operators import cube, ledger, loading, search, snapshots, sweep, warehouse
from wagewright.operators import payroll as pay
from wagewright.operators.joins import first_per_key
from wagewright.operators.slabs import tax_by_slabs
from wagewright.plans.payroll import BATCH_MONTH, SLIP_SQL, payslip_input, slab_sql
from wagewright.registry import query
from wagewright.session import scratch, settled
from wagewright.sources import roles
from wagewright.sources.tables import table
from wagewright.streaming import jobs

MONEY = "decimal(18,2)"


# ---- type 2 ---------------------------------------------------------------------
STATES = "SELECT emp_id, pay_date AS f, max_by(priority, payroll_id) AS priority FROM r_ord WHERE payroll_id%3{} GROUP BY 1,2"
LATE = STATES.format("=0")
VERSIONS = f"SELECT emp_id, f, priority FROM (SELECT *, lag(priority) OVER (PARTITION BY emp_id ORDER BY f) AS was FROM ({STATES.format('<>0')})) WHERE was IS NULL OR was<>priority"


@query("scd2_backdated_load", "emp_id:l priority:s effective_from:s effective_to:s is_current:l",
       f"""SELECT emp_id, priority, strftime(f,'%Y-%m-%d') AS effective_from, strftime(t,'%Y-%m-%d') AS effective_to, CASE WHEN t IS NULL THEN 1 ELSE 0 END AS is_current FROM
           (SELECT *, lead(f) OVER (PARTITION BY emp_id ORDER BY f) AS t FROM (SELECT *, lag(priority) OVER (PARTITION BY emp_id ORDER BY f) AS was FROM
             (SELECT * FROM ({LATE}) UNION ALL SELECT o.* FROM ({VERSIONS}) o ANTI JOIN ({LATE}) i ON i.emp_id=o.emp_id AND i.f=o.f)) WHERE was IS NULL OR was<>priority)""")
def scd2_backdated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the states arrives after all others, each twice: late, repeated and on dates that exist."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("emp_id"), F.col("o_orderkey").alias("version_id"), F.col("o_orderpriority").alias("priority"), "o_orderdate"
    )
    last = [F.desc("version_id")]
    early = first_per_key(rows.filter("version_id % 3 <> 0"), ["emp_id", "o_orderdate"], last)
    current = settled(warehouse.type2_history(early, "emp_id", "o_orderdate", "version_id", ["priority"]).drop("version_id"), "dimension")
    late = rows.filter("version_id % 3 = 0").withColumnRenamed("o_orderdate", "effective_from")
    out = warehouse.type2_load(current, late.unionByName(late), "emp_id", ["priority"], last)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("effective_from", "effective_to")})


@query("retention_versions", "emp_id:l version_id:l priority:s effective_from:s",
       """SELECT emp_id, payroll_id AS version_id, priority, strftime(pay_date,'%Y-%m-%d') AS effective_from FROM r_ord
          QUALIFY pay_date>TIMESTAMP '1997-06-30' OR row_number() OVER (PARTITION BY emp_id, pay_date>TIMESTAMP '1997-06-30' ORDER BY pay_date DESC, payroll_id DESC)=1""")
def retention_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What may still be asked for from a horizon on; the state that held at the horizon stays."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("emp_id"), F.col("o_orderkey").alias("version_id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("effective_from")
    )
    kept = warehouse.retained_changes(rows, ["emp_id"], "effective_from", "version_id", "1997-06-30")
    return kept.withColumn("effective_from", F.date_format("effective_from", "yyyy-MM-dd"))


# ---- tax slabs as data ------------------------------------------------------------
FIRST_NEW = "FY1997-98"
FY_SQL = "'FY' || y || '-' || lpad(CAST((y+1)%100 AS VARCHAR),2,'0')"
FY_INCOME = f"(SELECT emp_id, {FY_SQL} AS fiscal_year, sum(gross) AS income FROM (SELECT *, CASE WHEN pay_month>=4 THEN pay_year ELSE pay_year-1 END AS y FROM r_ord) GROUP BY 1,2)"


def _reached(slabs: list) -> str:
    return "1" + "".join(f"+CASE WHEN income>{lo} THEN 1 ELSE 0 END" for lo, _, _ in slabs if lo)


def _rate(slabs: list) -> str:
    return "CASE " + " ".join(f"WHEN income>{lo} THEN {rate}" for lo, _, rate in reversed(slabs) if lo) + f" ELSE {slabs[0][2]} END"


def slab_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slabs in force in each fiscal year with records: the old ones before ``FIRST_NEW``; the top slab bears a surcharge."""
    def rows(slabs: list):
        return F.array(*[F.struct(
            F.lit(lo).cast(MONEY).alias("income_from"), F.lit(hi).cast(MONEY).alias("income_to"), F.lit(rate).alias("tax_rate_pct"), F.lit(10 if hi is None else 0).alias("surcharge_pct")
        ) for lo, hi, rate in slabs])

    years = roles.payroll_headers(spark, sf_dir).select(cal.fiscal_year(F.col("pay_year"), F.col("pay_month")).alias("fiscal_year")).distinct()
    return years.select("fiscal_year", F.inline(F.when(F.col("fiscal_year") < FIRST_NEW, rows(pay.OLD_SLABS)).otherwise(rows(pay.NEW_SLABS))))


@query("tax_from_slab_table", "emp_id:l fiscal_year:s income:d slab_no:l marginal_rate:d slab_tax:d surcharge:d",
       " UNION ALL ".join(
           f"""SELECT emp_id, fiscal_year, income, slab_no, marginal_rate, slab_tax, CASE WHEN slab_no={len(slabs)} THEN round(slab_tax*CAST(0.10 AS DECIMAL(4,2)),2) ELSE 0 END AS surcharge FROM
           (SELECT *, {_reached(slabs)} AS slab_no, {_rate(slabs)} AS marginal_rate, {slab_sql('income', slabs)} AS slab_tax FROM (SELECT emp_id, fiscal_year, CAST(income AS DECIMAL(18,2)) AS income FROM {FY_INCOME}) WHERE fiscal_year{when}'{FIRST_NEW}')"""
           for slabs, when in ((pay.OLD_SLABS, "<"), (pay.NEW_SLABS, ">="))))
def tax_from_slab_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly income of each employee, taxed by the slabs of its fiscal year."""
    fiscal_year = cal.fiscal_year(F.col("pay_year"), F.col("pay_month"))
    incomes = roles.payroll_headers(spark, sf_dir).groupBy("emp_id", fiscal_year.alias("fiscal_year")).agg(F.sum("gross").cast(MONEY).alias("income"))
    return tax_by_slabs(incomes, "income", "fiscal_year", slab_rows(spark, sf_dir))


# ---- cubes --------------------------------------------------------------------------
CELL = ["dept_name", "pay_year", "pay_month"]
TRACKED = [*CELL, "gross", "net"]
AFTER = """SELECT dept_name, pay_year, pay_month, net, CASE WHEN pay_year>=1997 AND payroll_id%37=0 THEN gross+1000 ELSE gross END AS gross FROM r_wide
   WHERE (status='Paid' AND NOT (pay_year>=1997 AND payroll_id%41=0)) OR (status='Approved' AND pay_year>=1997 AND payroll_id%2=0)"""


@query("cube_delta_refresh", "dept_name:s pay_year:l pay_month:l n:l sum_gross:d sum_net:d min_net:d max_net:d min_gross:d max_gross:d",
       f"SELECT dept_name, pay_year, pay_month, count(*) AS n, sum(gross) AS sum_gross, sum(net) AS sum_net, min(net) AS min_net, max(net) AS max_net, min(gross) AS min_gross, max(gross) AS max_gross FROM ({AFTER}) GROUP BY 1,2,3")
def cube_delta_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored department and month cube after inserts, updates and deletes, out of the change rows alone."""
    rows = settled(roles.wide_payroll(spark, sf_dir).select("payroll_id", *TRACKED, "status"), "records")
    late, number = F.col("pay_year") >= 1997, F.col("payroll_id")
    old = rows.filter("status = 'Paid'").drop("status")
    stays = (F.col("status") == "Paid") & ~(late & (number % 41 == 0))
    comes = (F.col("status") == "Approved") & late & (number % 2 == 0)
    raised = F.when(late & (number % 37 == 0), F.col("gross") + 1000).otherwise(F.col("gross")).cast(MONEY)
    new = settled(rows.filter(stays | comes).drop("status").withColumn("gross", raised), "records-after")
    stored = settled(cube.build(old, CELL, ["gross", "net"], ["net", "gross"]), "cube")
    schema = ", ".join(f"{c} {dict(old.dtypes)[c]}" for c in TRACKED)
    signed = cube.signed_rows(snapshots.changes(old, new, "payroll_id", TRACKED, "payroll_records"), schema)
    return cube.refresh(stored, signed, new, CELL, ["gross", "net"], ["net", "gross"])


@query("headcount_rollup", "dept_name:s pay_year:l level:l headcount:l within_error:l",
       "SELECT dept_name, pay_year, GROUPING(dept_name, pay_year) AS level, count(DISTINCT emp_id) AS headcount, 1 AS within_error FROM r_wide GROUP BY ROLLUP(dept_name, pay_year)")
def headcount_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees paid by department and year, by department, and in all: exact, and by sketches stored per department and year."""
    staff = roles.employees(spark, sf_dir).select("emp_id", "dept_name")
    rows = roles.payroll_headers(spark, sf_dir).select("emp_id", "pay_year").join(staff, "emp_id")
    cells = settled(cube.headcount_cells(rows, ["dept_name", "pay_year"], "emp_id"), "headcounts")
    return cube.headcount_rollup(cells, rows, ["dept_name", "pay_year"], "emp_id")


# ---- loan ledger -----------------------------------------------------------------------
LOAN = "loan_id:l emp_id:l outstanding:d new_outstanding:d new_emis_paid:l new_status:s closed_by:l"
PAID_SQL = "(SELECT emp_id, payroll_id, row_number() OVER w AS nth, sum(amount) OVER w AS total FROM (SELECT emp_id, payroll_id, pay_date, round(gross*CAST(0.05 AS DECIMAL(4,2)),2) AS amount FROM r_ord WHERE status='Paid') WHERE amount>0 WINDOW w AS (PARTITION BY emp_id ORDER BY pay_date, payroll_id))"
LOAN_SQL = f"""SELECT loan_id, emp_id, outstanding, outstanding-CASE WHEN status='Active' THEN coalesce(closing, whole, 0) ELSE 0 END AS new_outstanding, emis_paid+CASE WHEN status='Active' THEN coalesce(nth, n, 0) ELSE 0 END AS new_emis_paid,
   CASE WHEN closing IS NOT NULL THEN 'Closed' ELSE status END AS new_status, closed_by FROM (SELECT l.*, c.nth, c.closing, c.closed_by, n, whole FROM (SELECT *, loan_key*8+line_no AS loan_id FROM r_loan) l
   LEFT JOIN (SELECT loan_key, line_no, part_key, supp_key, min(nth) AS nth, min_by(total, nth) AS closing, min_by(payroll_id, nth) AS closed_by FROM r_loan l JOIN {PAID_SQL} d ON d.emp_id=l.emp_id AND total>=greatest(outstanding,0.01) WHERE status='Active' GROUP BY 1,2,3,4) c
     ON c.loan_key=l.loan_key AND c.line_no=l.line_no AND c.part_key=l.part_key AND c.supp_key=l.supp_key
   LEFT JOIN (SELECT emp_id, max(nth) AS n, max(total) AS whole FROM {PAID_SQL} GROUP BY 1) w ON w.emp_id=l.emp_id)"""


def numbered_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = roles.loans(spark, sf_dir).withColumn("loan_id", F.col("loan_key") * 8 + F.col("line_no"))
    return loans.select("loan_id", "emp_id", "outstanding", "emis_paid", "status")


def loan_deductions(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.round(F.col("gross") * F.lit("0.05").cast("decimal(4,2)"), 2).cast(MONEY)
    return roles.payroll_headers(spark, sf_dir).filter("status = 'Paid'").select("emp_id", F.col("payroll_id").alias("deduction_id"), F.col("pay_date").alias("paid_at"), share.alias("amount"))


@query("loan_ledger", LOAN, LOAN_SQL)
def loan_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deductions of all runs in their order: each loan is lowered until one closes it."""
    running = settled(ledger.running_deductions(loan_deductions(spark, sf_dir)), "ledger")
    return ledger.settle_loans(numbered_loans(spark, sf_dir), running, "loan_id")


@query("loan_ledger_stream", LOAN, LOAN_SQL)
def loan_ledger_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with deductions that land in two files' worth, the stream stopped in between; a third start finds nothing new."""
    landing, out, check = (scratch(spark, n) for n in ("landing", "ledger", "checkpoint"))
    paid = loan_deductions(spark, sf_dir).filter("amount > 0").withColumn("units", (F.col("amount") * 100).cast("bigint"))
    own = jobs.stream_session(spark)
    for batch in (paid.filter("paid_at < '1998-01-01'"), paid.filter("paid_at >= '1998-01-01'"), None):
        if batch is not None:
            jobs.stage_files(batch.select("emp_id", "deduction_id", "paid_at", "units"), landing)
        rows = own.readStream.schema("emp_id bigint, deduction_id bigint, paid_at timestamp_ntz, units bigint").parquet(landing)
        jobs.append_to(jobs.running_by_key(rows, "emp_id", "paid_at", "deduction_id", "units"), out, check)
    cent = F.lit("0.01").cast("decimal(3,2)")
    running = spark.read.parquet(out).withColumn("total", (F.col("total").cast("decimal(16,0)") * cent).cast(MONEY))
    return ledger.settle_loans(numbered_loans(spark, sf_dir), running, "loan_id")


# ---- the month's table after a batch -----------------------------------------------------
@query("payroll_month_table", "emp_id:l payroll_id:l period:s net:d status:s",
       f"""SELECT p.emp_id, payroll_id, period, gross AS net, status FROM r_ord p LEFT JOIN (SELECT emp_id, net FROM ({SLIP_SQL})) s ON s.emp_id=p.emp_id
             LEFT JOIN (SELECT emp_id, max(CASE WHEN status='Paid' THEN 1 ELSE 0 END) AS paid FROM r_ord WHERE period='{BATCH_MONTH}' GROUP BY 1) m ON m.emp_id=p.emp_id WHERE period='{BATCH_MONTH}' AND (s.emp_id IS NULL OR s.net<0 OR paid=1)
           UNION ALL SELECT s.emp_id, NULL, '{BATCH_MONTH}', net, 'Draft' FROM ({SLIP_SQL}) s LEFT JOIN (SELECT DISTINCT emp_id FROM r_ord WHERE period='{BATCH_MONTH}' AND status='Paid') m ON m.emp_id=s.emp_id WHERE net>=0 AND m.emp_id IS NULL""")
def payroll_month_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored records, the month's slips put in by a run, and by the same run again; the month as it stands then."""
    path = stored_records(spark, sf_dir)
    slips = settled(pay.payslips(payslip_input(spark, sf_dir)).select("emp_id", "net"), "slips")
    for _ in range(2):
        run_month(spark, path, slips, BATCH_MONTH)
    return read_records(spark, path).filter(F.col("period") == BATCH_MONTH)


RECORDS = "emp_id bigint, payroll_id bigint, net decimal(18,2), status string, period string"


def stored_records(spark: SparkSession, sf_dir: str) -> str:
    """All payroll records as a table with a partition per month."""
    path = scratch(spark, "records")
    rows = roles.payroll_headers(spark, sf_dir).select("emp_id", "payroll_id", F.col("gross").alias("net"), "status", "period")
    loading.write_partitioned(rows, path, ["period"])
    return path


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORDS).parquet(path)


def run_month(spark: SparkSession, path: str, slips: DataFrame, month: str) -> None:
    """Put a run's slips into the month: paid employees stay as they are, slips below 0 are refused, others replace what the employee had."""
    old = read_records(spark, path).filter(F.col("period") == month)
    paid = old.filter("status = 'Paid'").select("emp_id").distinct()
    fresh = settled(slips.filter("net >= 0").join(paid, "emp_id", "left_anti"), "fresh")
    put = fresh.select("emp_id", F.lit(None).cast("bigint").alias("payroll_id"), F.col("net").cast(MONEY).alias("net"), F.lit("Draft").alias("status"), F.lit(month).alias("period"))
    after = old.join(fresh.select("emp_id"), "emp_id", "left_anti").unionByName(put)
    loading.replace_partitions(settled(after, "month"), path, ["period"])


# ---- search, calendar load, layout --------------------------------------------------------
SEARCHED = ["name", "emp_code", "email"]
PATTERNS = ["7", "42", "042", "P042", "#0000", "r.0000", "EMP1234", "00012@co", "zzz"]


@query("employee_search_indexed", "pattern:s emp_id:l emp_code:s name:s email:s dept_name:s",
       " UNION ALL ".join(f"SELECT '{p}' AS pattern, emp_id, emp_code, name, email, dept_name FROM r_emp WHERE name LIKE '%{p}%' OR emp_code LIKE '%{p}%' OR email LIKE '%{p}%'" for p in PATTERNS))
def employee_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches for parts of one to eight characters by a stored trigram index; the two shortest fall back to the scan."""
    people = settled(roles.employees(spark, sf_dir).select("emp_id", *SEARCHED, "dept_name"), "people")
    index = search.store_index(search.trigram_index(people, "emp_id", SEARCHED), "emp_id", scratch(spark, "trigrams"))
    found = [search.find(people, index, "emp_id", SEARCHED, p).withColumn("pattern", F.lit(p)) for p in PATTERNS]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


DAYS = "SELECT dept_name, l.emp_id, CAST(unnest(generate_series(from_date, to_date, INTERVAL 1 DAY)) AS DATE) AS day FROM r_leave l JOIN r_emp e ON e.emp_id=l.emp_id WHERE l.status<>'Rejected'"


@query("leave_load_by_day", "dept_name:s day:s requests:l away:l overlapping:l peak:l",
       f"""SELECT dept_name, strftime(day,'%Y-%m-%d') AS day, sum(n) AS requests, count(*) AS away, count(*) FILTER (WHERE n>1) AS overlapping, CASE WHEN count(*)=max(count(*)) OVER (PARTITION BY dept_name) THEN 1 ELSE 0 END AS peak
           FROM (SELECT dept_name, emp_id, day, count(*) AS n FROM ({DAYS}) GROUP BY 1,2,3) GROUP BY dept_name, day""")
def leave_load_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is away when: requests that hold on a day, employees away, those with two requests at once, and the department's worst days."""
    staff = roles.employees(spark, sf_dir).select("emp_id", "dept_name")
    asked = roles.leave_requests(spark, sf_dir).filter("status <> 'Rejected'").join(staff, "emp_id")
    return sweep.load_by_day(asked, "dept_name", "emp_id", "from_date", "to_date").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """A stored table whose rows are dealt by a hash of the key and sorted by it, in the shared folder."""
    spark = df.sparkSession
    full = f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", scratch(spark, name)).saveAsTable(full)
    return spark.table(full)


@query("bucketed_payroll_join", "emp_id:l name:s dept_name:s records:l gross:d",
       "SELECT emp_id, name, dept_name, count(*) AS records, sum(gross) AS gross FROM r_wide GROUP BY 1,2,3")
def bucketed_payroll_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and staff stored by a hash of the employee: joins and sums by employee then shuffle neither."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("emp_id"), stored_money("o_totalprice").alias("gross"))
    facts = bucketed(heads, "payroll_facts", "emp_id", n)
    staff = bucketed(roles.employees(spark, sf_dir).select("emp_id", "name", "dept_name"), "payroll_staff", "emp_id", n)
    sums = facts.groupBy("emp_id").agg(F.count("*").alias("records"), F.sum("gross").alias("gross"))
    return sums.join(staff, "emp_id").select("emp_id", "name", "dept_name", "records", "gross")
