"""Scans, projections, filters, joins and set operations."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagewright.functions.numeric import mean, ratio, rounded, stored_money, zero
from wagewright.operators.history import latest_n
from wagewright.operators.joins import asof_join, interval_join, lookup_join
from wagewright.operators.ordering import ranked
from wagewright.registry import query
from wagewright.session import scratch, settled
from wagewright.sources import roles
from wagewright.sources.role_sql import avg, pct, r
from wagewright.sources.tables import TABLES, read_csv, read_csv_folder, run_sql, table, write_csv


@query(
    "scan_projection", "dept_id:l dept_name:s suppliers:l balance:d",
    """SELECT n_nationkey AS dept_id, n_name AS dept_name, count(s_suppkey) AS suppliers,
       coalesce(sum(CAST(s_acctbal AS DECIMAL(18,2))),0) AS balance
       FROM nation LEFT JOIN supplier ON s_nationkey=n_nationkey AND s_acctbal > -500 GROUP BY 1,2""",
)
def scan_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(
        spark, sf_dir,
        """SELECT n_nationkey AS dept_id, n_name AS dept_name, count(s_suppkey) AS suppliers,
                  coalesce(sum(cast(s_acctbal AS decimal(18,2))), 0) AS balance
           FROM {nation} n LEFT JOIN {supplier} s ON s.s_nationkey = n.n_nationkey AND s.s_acctbal > :floor
           GROUP BY n_nationkey, n_name""",
        floor=-500,
    )


ORDER_FIELDS = ["payroll_id", "emp_id", "period", "gross", "status", "note"]


@query(
    "csv_roundtrip_scan", "payroll_id:l period:s gross:d status:s blank_note:l note:s",
    """SELECT payroll_id, period, gross, status, CASE WHEN payroll_id%7=0 THEN 1 ELSE 0 END AS blank_note,
       CASE WHEN payroll_id%7=0 THEN '' ELSE 'due "' || chr(10) || priority || '", net' END AS note FROM r_ord""",
)
def csv_roundtrip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.payroll_headers(spark, sf_dir).withColumn(
        "note", roles.blank_every("payroll_id", 7, F.concat(F.lit('due "\n'), "priority", F.lit('", net')))
    )
    path = scratch(spark, "csv")
    write_csv(rows.select(*ORDER_FIELDS), path)
    back = read_csv(spark, path, ORDER_FIELDS)
    return back.select(
        F.col("payroll_id").try_cast("bigint").alias("payroll_id"),
        "period",
        F.col("gross").try_cast("decimal(18,2)").alias("gross"),
        "status",
        (F.col("note") == "").cast("int").alias("blank_note"), "note",
    )


@query(
    "ingest_multi_source", "source:s records:l",
    """SELECT 'payroll' AS source, count(*) AS records FROM r_wide WHERE status='Paid'
       UNION ALL SELECT 'attendance', count(*) FROM r_att UNION ALL SELECT 'loans', count(*) FROM r_loan WHERE status='Active'
       UNION ALL SELECT 'leave', count(*) FROM r_leave WHERE status='Pending'
       UNION ALL SELECT 'periods', count(DISTINCT period) FROM r_ord
       UNION ALL SELECT 'csv:departments', count(*) FROM nation UNION ALL SELECT 'csv:suppliers', count(*) FROM supplier""",
)
def ingest_multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide payroll extract, the side extracts and a folder of CSV datasets."""
    root = scratch(spark, "landing")
    folder = {
        "departments": table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")),
        "suppliers": table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
    }
    for stem, df in folder.items():
        write_csv(df, f"{root}/{stem}.csv")
    landed = read_csv_folder(spark, root, ["name"]).filter("name <> ''").select(F.concat(F.lit("csv:"), "dataset").alias("source"))
    extracts = {
        "payroll": roles.wide_payroll(spark, sf_dir).filter("status = 'Paid'"),
        "attendance": roles.attendance(spark, sf_dir),
        "loans": roles.loans(spark, sf_dir).filter("status = 'Active'"),
        "leave": roles.leave_requests(spark, sf_dir).filter("status = 'Pending'"),
        "periods": roles.payroll_headers(spark, sf_dir).select("period").distinct(),
    }
    # Counted per source first: only one row per source reaches the union.
    counts = [df.agg(F.count("*").alias("records")).select(F.lit(n).alias("source"), "records") for n, df in extracts.items()]
    return functools.reduce(DataFrame.unionByName, counts).unionByName(
        landed.groupBy("source").agg(F.count("*").alias("records"))
    )


@query(
    "text_line_stats", "lang:s lines:l blank_lines:l characters:l longest:l",
    """SELECT lang, count(*) AS lines, count(*) FILTER (WHERE trim(line)='') AS blank_lines, sum(length(line)) AS characters, max(length(line)) AS longest
       FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY lang""",
)
def text_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("lang", F.explode(F.split("text", "\n", -1)).alias("line"))
    return lines.groupBy("lang").agg(
        F.count("*").alias("lines"),
        F.count_if(F.trim("line") == "").alias("blank_lines"),
        F.sum(F.length("line")).alias("characters"),
        F.max(F.length("line")).alias("longest"),
    )


WIDE = "payroll_id:l emp_code:s name:s dept_name:s location:s gender:s period:s gross:d net:d tds:d pf:d deductions:d days_present:l"


@query(
    "wide_payroll_frame", WIDE,
    """SELECT payroll_id, emp_code, name, dept_name, location, gender, period, gross, net, tds, pf, deductions, days_present
       FROM r_wide WHERE status='Paid'""",
)
def wide_payroll_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.wide_payroll(spark, sf_dir, location=True).filter("status = 'Paid'")


@query(
    "table_counts", "table_name:s records:l",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS records FROM {t}" for t in TABLES)
    + " UNION ALL SELECT 'TOTAL', " + "+".join(f"(SELECT count(*) FROM {t})" for t in TABLES),
)
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("t"), "n") for t in TABLES
    ]
    return functools.reduce(DataFrame.unionByName, counts).rollup("t").agg(F.sum("n").alias("records")).select(
        F.coalesce("t", F.lit("TOTAL")).alias("table_name"), "records"
    )


@query(
    "derived_columns", "payroll_id:l name:s net:d annual_net:d tax_pct:d",
    f"""SELECT payroll_id, name, net, net*12 AS annual_net, {r(pct('tds','gross'))} AS tax_pct FROM r_wide WHERE net>50000""",
)
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        roles.wide_payroll(spark, sf_dir)
        .withColumn("annual_net", F.round(zero("net") * 12, 2))
        .withColumn("tax_pct", rounded(ratio("tds", "gross", 100)))
        .filter(zero("net") > 50000)
        .orderBy(zero("net").desc(), "payroll_id")
    )


@query(
    "filter_and_like", "emp_code:s name:s dept_name:s basic:d",
    "SELECT emp_code, name, dept_name, basic FROM r_emp WHERE basic > 7000 AND dept_name LIKE '%ATION_1%'",
)
def filter_and_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.employees(spark, sf_dir).filter((F.col("basic") > 7000) & F.col("dept_name").like("%ATION_1%"))


@query(
    "filter_between_in", "emp_code:s dept_name:s basic:d gender:s",
    """SELECT emp_code, dept_name, basic, gender FROM r_emp
       WHERE basic BETWEEN 3000 AND 9000 AND dept_name IN ('NATION_3','NATION_7','NATION_11')""",
)
def filter_between_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.employees(spark, sf_dir).filter(
        F.col("basic").between(3000, 9000) & F.col("dept_name").isin("NATION_3", "NATION_7", "NATION_11")
    )


def search_employees(people: DataFrame, text: str = "", dept: int | None = None, status: str = "") -> DataFrame:
    """Predicates are added only for the filters that are set."""
    tests: list[Column] = [F.lit(True)]
    if text:
        tests.append(F.col("name").contains(text) | F.col("emp_code").contains(text) | F.col("email").contains(text))
    if dept is not None:
        tests.append(F.col("dept_id") == dept)
    if status:
        tests.append(F.col("status") == status)
    return people.filter(functools.reduce(operator.and_, tests))


@query(
    "employee_search", "emp_id:l emp_code:s name:s email:s dept_name:s status:s",
    """SELECT emp_id, emp_code, name, email, dept_name, status FROM r_emp
       WHERE (name LIKE '%42%' OR emp_code LIKE '%42%' OR email LIKE '%42%') AND status='Active'""",
)
def employee_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_employees(roles.employees(spark, sf_dir), text="42", status="Active")


@query(
    "left_join_missing", "emp_code:s dept_name:s status:s payroll_status:s",
    """SELECT emp_code, dept_name, e.status, CASE WHEN p.emp_id IS NULL THEN 'NO PAYROLL' ELSE 'Has Payroll' END AS payroll_status
       FROM r_emp e LEFT JOIN (SELECT DISTINCT emp_id FROM r_ord WHERE period='1997-03') p ON e.emp_id=p.emp_id""",
)
def left_join_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The period filter belongs to the right side, before the join."""
    paid = roles.payroll_headers(spark, sf_dir).filter(roles.in_month(1997, 3)).select("emp_id").distinct()
    paid = paid.withColumn("has_payroll", F.lit(True))
    return roles.employees(spark, sf_dir).join(paid, "emp_id", "left").withColumn(
        "payroll_status", F.when(F.col("has_payroll").isNull(), "NO PAYROLL").otherwise("Has Payroll")
    )


@query(
    "top_n_earners", "emp_code:s name:s dept_name:s basic:d annual:d",
    "SELECT emp_code, name, dept_name, basic, basic*12 AS annual FROM r_emp ORDER BY basic DESC, emp_id LIMIT 10",
)
def top_n_earners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        roles.employees(spark, sf_dir)
        .withColumn("annual", F.round(F.col("basic") * 12, 2))
        .orderBy(F.col("basic").desc(), "emp_id")
        .limit(10)
    )


def enrich(pay: DataFrame) -> DataFrame:
    """Annual amounts and ratios; a zero denominator gives 0."""
    return pay.withColumns({
        "annual_gross": F.round(zero("gross") * 12, 2),
        "annual_net": F.round(zero("net") * 12, 2),
        "take_home_pct": rounded(ratio("net", "gross", 100)),
        "tds_pct": rounded(ratio("tds", "gross", 100)),
        "deduction_pct": rounded(ratio("deductions", "gross", 100)),
        "pf_pct": rounded(ratio("pf", "gross", 100), 1),
        "attendance_pct": rounded(ratio("days_present", "working_days", 100), 1),
    })


ENRICH_SQL = (
    f"gross*12 AS annual_gross, net*12 AS annual_net, {r(pct('net','gross'))} AS take_home_pct, {r(pct('tds','gross'))} AS tds_pct, "
    f"{r(pct('deductions','gross'))} AS deduction_pct, {r(pct('pf','gross'),1)} AS pf_pct, {r(pct('days_present','working_days'),1)} AS attendance_pct"
)


@query(
    "enrich_ratios",
    "payroll_id:l annual_gross:d annual_net:d take_home_pct:d tds_pct:d deduction_pct:d pf_pct:d attendance_pct:d",
    f"SELECT payroll_id, {ENRICH_SQL} FROM r_pay",
)
def enrich_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(roles.payroll(spark, sf_dir))


@query(
    "join_five_way", "payroll_id:l period:s emp_code:s name:s dept_name:s location:s grade_code:s gross:d net:d status:s",
    """SELECT payroll_id, period, emp_code, name, dept_name, location, grade_code, gross, net, status
       FROM r_wide JOIN r_grade ON (pay_basic >= basic_min AND pay_basic < basic_max) WHERE pay_year=1997""",
)
def join_five_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, lines, employee, department, region; the grade is a value lookup."""
    pay = roles.payroll(spark, sf_dir).filter(roles.in_year(1997))
    return roles.wide_payroll(spark, sf_dir, pay, location=True).withColumn("grade_code", roles.grade_of(F.col("pay_basic"))["grade_code"])


@query(
    "left_join_group_counts", "dept_name:s employees:l active:l inactive:l suppliers:l",
    """SELECT n_name AS dept_name, count(emp_id) AS employees, count(*) FILTER (WHERE status='Active') AS active,
       count(*) FILTER (WHERE status='Inactive') AS inactive,
       (SELECT count(*) FROM supplier WHERE s_nationkey=n_nationkey) AS suppliers
       FROM nation LEFT JOIN r_emp ON dept_id=n_nationkey GROUP BY n_nationkey, n_name""",
)
def left_join_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides are counted per department before the join keeps the empty ones."""
    people = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("bigint").alias("dept_id")).agg(
        F.count("*").alias("employees"),
        F.count_if(F.col("c_acctbal") >= 0).alias("active"),
        F.count_if(F.col("c_acctbal") < 0).alias("inactive"),
    )
    firms = (
        table(spark, sf_dir, "supplier")
        .groupBy(F.col("s_nationkey").cast("bigint").alias("dept_id")).agg(F.count("*").alias("suppliers"))
    )
    return roles.departments_base(spark, sf_dir).join(people, "dept_id", "left").join(firms, "dept_id", "left").fillna(0)


@query(
    "self_join_manager", "emp_code:s name:s dept_name:s basic:d manager_name:s manager_basic:d pct_of_manager:d",
    f"""SELECT e.emp_code, e.name, e.dept_name, e.basic, m.name AS manager_name, m.basic AS manager_basic,
        {r(pct('e.basic','m.basic'),1)} AS pct_of_manager
        FROM r_emp e JOIN r_dept d ON e.dept_id=d.dept_id JOIN r_emp m ON d.manager_id=m.emp_id WHERE e.emp_id<>d.manager_id""",
)
def self_join_manager(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = roles.employees(spark, sf_dir)
    managers = people.select(
        F.col("emp_id").alias("manager_id"), F.col("name").alias("manager_name"), F.col("basic").alias("manager_basic")
    )
    heads = settled(roles.departments(spark, sf_dir).select("dept_id", "manager_id").join(managers, "manager_id"))
    return (
        people.join(heads, "dept_id")
        .filter(F.col("emp_id") != F.col("manager_id"))
        .withColumn("pct_of_manager", rounded(ratio("basic", "manager_basic", 100), 1))
    )


@query(
    "above_group_avg", "emp_code:s dept_name:s basic:d dept_avg:d pct_above:d",
    f"""SELECT emp_code, dept_name, basic, dept_avg, {r('(CAST(basic AS DOUBLE)-dept_avg)/dept_avg*100',1)} AS pct_above FROM r_emp e JOIN
        (SELECT dept_id, {r(avg('basic'))} AS dept_avg FROM r_emp WHERE status='Active' GROUP BY 1) a ON e.dept_id=a.dept_id
        WHERE status='Active' AND CAST(basic AS DOUBLE) > dept_avg""",
)
def above_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = roles.employees(spark, sf_dir).filter("status = 'Active'")
    means = settled(active.groupBy("dept_id").agg(rounded(mean("basic")).alias("dept_avg")))
    basic = F.col("basic").cast("double")
    return (
        active.join(means, "dept_id")
        .filter(basic > F.col("dept_avg"))
        .withColumn("pct_above", rounded((basic - F.col("dept_avg")) / F.col("dept_avg") * 100, 1))
    )


@query(
    "vs_company_avg", "emp_code:s basic:d company_avg:d vs_avg:d",
    f"""SELECT emp_code, basic, {r('a')} AS company_avg, {r('CAST(basic AS DOUBLE)-a')} AS vs_avg
        FROM r_emp, (SELECT {avg('basic')} AS a FROM r_emp WHERE status='Active') WHERE status='Active'""",
)
def vs_company_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company average is a scalar subquery: one value, no join."""
    active = roles.employees(spark, sf_dir).filter("status = 'Active'")
    company = table(spark, sf_dir, "customer").filter("c_acctbal >= 0").agg(mean(stored_money("c_acctbal")).alias("a")).scalar()
    return active.withColumn("_avg", company).withColumns({
        "company_avg": rounded("_avg"),
        "vs_avg": rounded(F.col("basic").cast("double") - F.col("_avg")),
    })


def active_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.loans(spark, sf_dir).filter("status = 'Active'")


@query(
    "correlated_loans", "emp_code:s dept_name:s basic:d total_outstanding:d active_loans:l",
    """SELECT emp_code, dept_name, basic,
       (SELECT sum(outstanding) FROM r_loan l WHERE l.emp_id=e.emp_id AND l.status='Active') AS total_outstanding,
       (SELECT count(*) FROM r_loan l WHERE l.emp_id=e.emp_id AND l.status='Active') AS active_loans FROM r_emp e""",
)
def correlated_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-employee scalar subqueries written as one pre-aggregate and a left join."""
    per_emp = active_loans(spark, sf_dir).groupBy("emp_id").agg(
        F.sum("outstanding").alias("total_outstanding"), F.count("*").alias("active_loans")
    )
    return roles.employees(spark, sf_dir).join(per_emp, "emp_id", "left").fillna({"active_loans": 0})


@query(
    "semi_join_exists", "emp_code:s dept_name:s basic:d",
    "SELECT emp_code, dept_name, basic FROM r_emp e WHERE EXISTS (SELECT 1 FROM r_loan l WHERE l.emp_id=e.emp_id AND l.status='Active')",
)
def semi_join_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.employees(spark, sf_dir).join(active_loans(spark, sf_dir).select("emp_id").distinct(), "emp_id", "left_semi")


@query(
    "semi_join_in_having", "dept_name:s budget:d annual_cost:d over_budget:d",
    """SELECT d.dept_name, budget, sum(basic)*12 AS annual_cost, sum(basic)*12-budget AS over_budget
       FROM r_dept d JOIN r_emp e ON d.dept_id=e.dept_id WHERE status='Active' AND d.dept_id IN
       (SELECT dept_id FROM r_emp WHERE status='Active' GROUP BY 1 HAVING sum(basic)*12>0)
       GROUP BY d.dept_id, d.dept_name, budget HAVING sum(basic)*12 > budget*0.10""",
)
def semi_join_in_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = roles.employees(spark, sf_dir).filter("status = 'Active'")
    cost = active.groupBy("dept_id").agg((F.sum("basic") * 12).alias("annual_cost"))
    funded = cost.filter("annual_cost > 0").select("dept_id")
    return (
        roles.departments(spark, sf_dir)
        .join(cost, "dept_id")
        .join(funded, "dept_id", "left_semi")
        .filter(F.col("annual_cost") > F.col("budget") * F.lit("0.10").cast("decimal(4,2)"))
        .withColumn("over_budget", F.col("annual_cost") - F.col("budget"))
    )


@query(
    "anti_join_no_payroll", "emp_id:l emp_code:s dept_name:s",
    "SELECT emp_id, emp_code, dept_name FROM r_emp e WHERE NOT EXISTS (SELECT 1 FROM r_ord p WHERE p.emp_id=e.emp_id AND pay_year=1998 AND pay_month<=6)",
)
def anti_join_no_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = roles.payroll_headers(spark, sf_dir).filter(roles.in_year(1998) & (F.col("pay_month") <= 6)).select("emp_id").distinct()
    return roles.employees(spark, sf_dir).join(paid, "emp_id", "left_anti")


@query(
    "broadcast_lookup_join", "payroll_id:l dept_id:l supplier:s supplier_balance:d",
    """SELECT payroll_id, e.dept_id, coalesce(s_name,'') AS supplier, coalesce(s_acctbal,0) AS supplier_balance
       FROM r_ord p JOIN r_emp e ON p.emp_id=e.emp_id LEFT JOIN
       (SELECT s_nationkey, s_name, s_acctbal FROM supplier
        QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC)=1) s ON s_nationkey=e.dept_id""",
)
def broadcast_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last supplier per department as the lookup value; misses take the defaults."""
    firms = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("bigint").alias("dept_id"), "s_suppkey",
        F.col("s_name").alias("supplier"), F.col("s_acctbal").alias("supplier_balance"),
    )
    depts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("emp_id"), F.col("c_nationkey").cast("bigint").alias("dept_id")
    )
    records = roles.payroll_headers(spark, sf_dir).select("payroll_id", "emp_id").join(depts, "emp_id")
    return lookup_join(
        records, firms, "dept_id", [F.col("s_suppkey").desc()], defaults={"supplier": "", "supplier_balance": 0.0}
    )


@query(
    "merge_three_datasets",
    "payroll_id:l emp_code:s full_name:s dept_name:s location:s gross:d net:d days_absent:l overtime:d take_home_pct:d attendance_pct:d",
    f"""SELECT payroll_id, coalesce(emp_code,'') AS emp_code, coalesce(name,'') AS full_name, coalesce(dept_name,'') AS dept_name,
        coalesce(location,'') AS location, gross, net, coalesce(days_absent,0) AS days_absent, coalesce(overtime,0) AS overtime,
        {r(pct('net','gross'),1)} AS take_home_pct, {r(pct('days_present','working_days'),1)} AS attendance_pct
        FROM r_pay p LEFT JOIN r_emp e ON p.emp_id=e.emp_id LEFT JOIN
        (SELECT emp_id, count(*) FILTER (WHERE status='Absent') AS days_absent, sum(greatest(hours-8,0)) AS overtime FROM r_att GROUP BY 1) a ON p.emp_id=a.emp_id""",
)
def merge_three_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = roles.employees(spark, sf_dir, location=True).select(
        "emp_id", "emp_code", F.col("name").alias("full_name"), "dept_name", "location"
    )
    present = roles.attendance(spark, sf_dir).groupBy("emp_id").agg(
        F.count_if(F.col("status") == "Absent").alias("days_absent"),
        F.sum(F.greatest(F.col("hours") - 8, F.lit(0))).alias("overtime"),
    )
    # Staff and attendance meet first and are stored: one join meets the records, and a hot employee's can be split.
    known = people.join(present, "emp_id", "full")
    merged = roles.payroll(spark, sf_dir).join(settled(known, "staff-attendance"), "emp_id", "left")
    return merged.fillna("", ["emp_code", "full_name", "dept_name", "location"]).fillna(0, ["days_absent", "overtime"]).withColumns({
        "take_home_pct": rounded(ratio("net", "gross", 100), 1),
        "attendance_pct": rounded(ratio("days_present", "working_days", 100), 1),
    })


@query(
    "period_interval_join", "emp_id:l period:s days_present:l days_absent:l half_days:d leave_days:l",
    """SELECT emp_id, period, count(*) FILTER (WHERE status='Present') AS days_present, count(*) FILTER (WHERE status='Absent') AS days_absent,
       count(*) FILTER (WHERE status='Half-Day')*0.5 AS half_days, count(*) FILTER (WHERE status='On-Leave') AS leave_days
       FROM r_att JOIN (SELECT DISTINCT strftime(ts,'%Y-%m') AS period, CAST(date_trunc('month',ts) AS DATE)+9 AS s,
         CAST(date_trunc('month',ts)+INTERVAL 1 MONTH AS DATE)+8 AS e FROM events
         UNION SELECT strftime(ts - INTERVAL 1 MONTH,'%Y-%m'), CAST(date_trunc('month',ts-INTERVAL 1 MONTH) AS DATE)+9, CAST(date_trunc('month',ts) AS DATE)+8 FROM events) p
       ON att_date BETWEEN s AND e GROUP BY 1,2""",
)
def period_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance to pay periods that run from the 10th to the 9th of the next month."""
    first = F.trunc("att_date", "month")
    days = roles.attendance(spark, sf_dir)
    months = days.select(F.explode(F.array(first, F.add_months(first, -1))).alias("m")).distinct()
    periods = months.select(
        F.date_format("m", "yyyy-MM").alias("period"),
        F.date_add("m", 9).alias("start_date"),
        F.date_add(F.add_months("m", 1), 8).alias("end_date"),
    )
    found = interval_join(days.select("emp_id", "att_date", "status"), "att_date", periods, "start_date", "end_date")
    return found.groupBy("emp_id", "period").agg(
        F.count_if(F.col("status") == "Present").alias("days_present"),
        F.count_if(F.col("status") == "Absent").alias("days_absent"),
        (F.count_if(F.col("status") == "Half-Day") * 0.5).alias("half_days"),
        F.count_if(F.col("status") == "On-Leave").alias("leave_days"),
    )


@query(
    "scd2_asof_lookup", "loan_key:l part_key:l shipped:s priority:s version_id:l",
    """SELECT l.l_orderkey*1 AS loan_key, l.l_partkey AS part_key, strftime(l.l_shipdate,'%Y-%m-%d') AS shipped, v.o_orderpriority AS priority, v.o_orderkey AS version_id
       FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey ASOF JOIN
       (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1,2) v
       ON v.o_custkey=o.o_custkey AND l.l_shipdate >= v.o_orderdate""",
)
def scd2_asof_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employee's priority version that was current on the day a line shipped."""
    heads = table(spark, sf_dir, "orders")
    versions = heads.select(
        F.col("o_custkey").alias("emp_id"), F.col("o_orderdate").alias("effective_from"),
        F.col("o_orderkey").alias("version_id"), F.col("o_orderpriority").alias("priority"),
    )
    facts = roles.loans(spark, sf_dir).select("emp_id", "loan_key", "part_key", "loan_date")
    out = asof_join(
        facts, versions, ["emp_id"], "loan_date", "loan_key", "effective_from", "version_id", ["version_id", "priority"]
    )
    return out.filter(F.col("version_id").isNotNull()).withColumn("shipped", F.date_format("loan_date", "yyyy-MM-dd"))


@query(
    "union_schema_widen", "record_id:l kind:s gross:d hours:d period:s",
    """SELECT payroll_id AS record_id, 'payroll' AS kind, gross, NULL AS hours, period FROM r_ord
       UNION ALL SELECT att_id, 'attendance', NULL, hours, NULL FROM r_att""",
)
def union_schema_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append of rows whose columns differ: the schema grows to the union."""
    pay = roles.payroll_headers(spark, sf_dir).select(
        F.col("payroll_id").alias("record_id"), F.lit("payroll").alias("kind"), "gross", "period"
    )
    days = roles.attendance(spark, sf_dir).select(F.col("att_id").alias("record_id"), F.lit("attendance").alias("kind"), "hours")
    return pay.unionByName(days, allowMissingColumns=True)


CHUNK = 100


@query(
    "flatten_and_chunk", "chunk:l words:l first_id:l last_id:l",
    f"""SELECT chunk, sum(words) AS words, min(doc_id) AS first_id, max(doc_id) AS last_id FROM
        (SELECT doc_id, len(list_filter(string_split_regex(text, '[ \\n]+'), lambda x: x <> '')) AS words,
         (row_number() OVER (ORDER BY doc_id)-1)//{CHUNK} AS chunk FROM documents) GROUP BY 1""",
)
def flatten_and_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of words are flattened; documents are cut into chunks of 100 in id order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    place = ranked(docs.select("doc_id"), "doc_id", "doc_id").select(
        "doc_id", F.floor((F.col("row_number") - 1) / CHUNK).alias("chunk")
    )
    lines = F.transform(F.split("text", "\n"), lambda line: F.filter(F.split(line, " +"), lambda w: w != ""))
    counted = docs.select("doc_id", F.size(F.flatten(lines)).alias("n"))
    return counted.join(place, "doc_id").groupBy("chunk").agg(
        F.sum("n").alias("words"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )


def deep_merge(base: Column, override: Column, kind: T.StructType, over: T.StructType, present: bool = False) -> Column:
    """Struct merge, at every depth: a field of the override wins, fields it lacks stay, its new fields are added.

    A null field of the override leaves the base's, unless ``present``: then every
    field the override's type has wins, null too. A null override changes nothing.
    """
    names = kind.fieldNames() + [n for n in over.fieldNames() if n not in kind.fieldNames()]
    parts = []
    for n in names:
        if n not in over.fieldNames():
            part = base[n]
        elif n not in kind.fieldNames():
            part = override[n]
        elif isinstance(kind[n].dataType, T.StructType) and isinstance(over[n].dataType, T.StructType):
            part = deep_merge(base[n], override[n], kind[n].dataType, over[n].dataType, present)
        elif present:
            part = F.when(override.isNull(), base[n]).otherwise(override[n])
        else:
            part = F.coalesce(override[n], base[n])
        parts.append(part.alias(n))
    return F.when(base.isNull() & override.isNull(), F.lit(None)).otherwise(F.struct(*parts))


def merged_documents(df: DataFrame, base: str, override: str, out: str, present: bool = False) -> DataFrame:
    kinds = df.schema
    return df.withColumn(out, deep_merge(F.col(base), F.col(override), kinds[base].dataType, kinds[override].dataType, present))


@query(
    "nested_override_merge", "emp_id:l basic:d location:s gender:s bonus:d",
    """SELECT c_custkey AS emp_id, coalesce(CASE WHEN c_acctbal<0 THEN 0 END, CAST(c_acctbal AS DECIMAL(18,2))) AS basic, n_name AS location,
       coalesce(CASE WHEN c_mktsegment='BUILDING' THEN 'SITE' END, c_mktsegment) AS gender,
       coalesce(CASE WHEN c_acctbal>9000 THEN 500.0 END, 100.0) AS bonus FROM customer JOIN nation ON c_nationkey=n_nationkey""",
)
def nested_override_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested settings with an override document: structs and maps, override wins."""
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    blank = F.lit(None).cast("string")
    docs = people.select(
        F.col("c_custkey").alias("emp_id"),
        F.struct(
            stored_money("c_acctbal").alias("basic"),
            F.struct(F.col("n_name").alias("location"), F.struct(F.col("c_mktsegment").alias("gender")).alias("person")).alias("home"),
        ).alias("base"),
        F.struct(
            F.when(F.col("c_acctbal") < 0, F.lit(0).cast("decimal(18,2)")).alias("basic"),
            F.struct(blank.alias("location"), F.struct(F.when(F.col("c_mktsegment") == "BUILDING", "SITE").alias("gender")).alias("person")).alias("home"),
        ).alias("override"),
        F.create_map(F.lit("bonus"), F.lit(100.0)).alias("extra"),
        F.create_map(F.lit("bonus"), F.when(F.col("c_acctbal") > 9000, 500.0)).alias("extra_override"),
    )
    merged = merged_documents(docs, "base", "override", "doc").withColumn(
        "extra", F.map_zip_with("extra", "extra_override", lambda _k, a, b: F.coalesce(b, a))
    )
    return merged.select("emp_id", "doc.basic", "doc.home.location", "doc.home.person.gender", F.col("extra")["bonus"].alias("bonus"))


@query(
    "latest_n_per_entity", "emp_id:l position:l payroll_id:l period:s gross:d",
    """SELECT emp_id, position, payroll_id, period, gross FROM (SELECT *, row_number() OVER (PARTITION BY emp_id ORDER BY pay_date DESC, payroll_id DESC) AS position
       FROM r_ord) WHERE position<=6""",
)
def latest_n_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_n(
        roles.payroll_headers(spark, sf_dir), ["emp_id"], [F.col("pay_date").desc(), F.col("payroll_id").desc()], 6
    )
