"""Grouped, global and ordered aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions.numeric import mean, ratio, rounded, stored_money, total
from wagewright.operators.aggregate import (
    aggregate_fields,
    column_stats,
    grouped_lists,
    named_agg,
    percent_of_total,
    pivot_table,
)
from wagewright.operators.joins import first_per_key
from wagewright.operators.ordering import gini, lower_quarter, upper_quarter
from wagewright.operators.selection import at_positions
from wagewright.registry import query
from wagewright.session import settled
from wagewright.sources import roles
from wagewright.sources.role_sql import avg, r, std
from wagewright.sources.tables import table


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.employees(spark, sf_dir).filter("status = 'Active'")


@query(
    "group_basic_stats", "gender:s employees:l avg_salary:d total_salary:d max_salary:d min_salary:d",
    f"""SELECT gender, count(*) AS employees, {r(avg('basic'))} AS avg_salary, sum(basic) AS total_salary,
        max(basic) AS max_salary, min(basic) AS min_salary FROM r_emp WHERE status='Active' GROUP BY 1""",
)
def group_basic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    basic = stored_money("c_acctbal")
    return people.groupBy(F.col("c_mktsegment").alias("gender")).agg(
        F.count("*").alias("employees"), rounded(mean(basic)).alias("avg_salary"), F.sum(basic).alias("total_salary"),
        F.max(basic).alias("max_salary"), F.min(basic).alias("min_salary"),
    )


@query(
    "having_filter", "dept_name:s headcount:l avg_salary:d max_salary:d min_salary:d",
    f"""SELECT dept_name, count(*) AS headcount, {r(avg('basic'))} AS avg_salary, max(basic) AS max_salary, min(basic) AS min_salary
        FROM r_emp WHERE status='Active' GROUP BY dept_id, dept_name HAVING {r(avg('basic'))} > 4900""",
)
def having_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        active(spark, sf_dir).groupBy("dept_id", "dept_name")
        .agg(
            F.count("*").alias("headcount"), rounded(mean("basic")).alias("avg_salary"),
            F.max("basic").alias("max_salary"), F.min("basic").alias("min_salary"),
        )
        .filter("avg_salary > 4900")
    )


ATT_SUMS = """count(*) AS total_records, count(*) FILTER (WHERE a.status='Present') AS days_present,
   count(*) FILTER (WHERE a.status='Absent') AS days_absent, count(*) FILTER (WHERE a.status='Half-Day')*0.5 AS half_days,
   count(*) FILTER (WHERE a.status='On-Leave') AS leave_days, sum(hours) AS total_hours"""


@query(
    "attendance_summary",
    "emp_id:l emp_code:s period:s total_records:l days_present:l days_absent:l half_days:d leave_days:l total_hours:d avg_hours:d",
    f"""SELECT a.emp_id, emp_code, strftime(att_date,'%Y-%m') AS period, {ATT_SUMS},
        {r("CAST(sum(CASE WHEN a.status='Present' THEN hours END) AS DOUBLE)/count(CASE WHEN a.status='Present' THEN 1 END)")} AS avg_hours
        FROM r_att a JOIN r_emp e ON a.emp_id=e.emp_id GROUP BY 1,2,3""",
)
def attendance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregated per employee and month first; the names are joined to the result."""
    status = F.col("status")
    monthly = roles.attendance(spark, sf_dir).groupBy("emp_id", F.date_format("att_date", "yyyy-MM").alias("period")).agg(
        F.count("*").alias("total_records"),
        F.count_if(status == "Present").alias("days_present"),
        F.count_if(status == "Absent").alias("days_absent"),
        (F.count_if(status == "Half-Day") * 0.5).alias("half_days"),
        F.count_if(status == "On-Leave").alias("leave_days"),
        F.sum("hours").alias("total_hours"),
        rounded(mean(F.when(status == "Present", F.col("hours")))).alias("avg_hours"),
    )
    return monthly.join(roles.employees(spark, sf_dir).select("emp_id", "emp_code"), "emp_id")


@query(
    "agg_multi_function",
    "dept_name:s record_count:l net_sum:d net_mean:d net_median:d net_min:d net_max:d net_std:d net_range:d net_pct_25:d net_pct_75:d days_present_mean:d",
    f"""SELECT dept_name, any_value(c) AS record_count, sum(net) AS net_sum, {r(avg('net'))} AS net_mean,
        {r('(CAST(max(CASE WHEN i=(c+1)//2 THEN net END) AS DOUBLE)+CAST(max(CASE WHEN i=c//2+1 THEN net END) AS DOUBLE))/2')} AS net_median,
        min(net) AS net_min, max(net) AS net_max, {r(std('net', True))} AS net_std, max(net)-min(net) AS net_range,
        max(CASE WHEN i=c//4+1 THEN net END) AS net_pct_25, max(CASE WHEN i=3*c//4+1 THEN net END) AS net_pct_75,
        {r(avg('CAST(days_present AS DECIMAL(18,2))'))} AS days_present_mean
        FROM (SELECT *, row_number() OVER (PARTITION BY dept_name ORDER BY net, payroll_id) AS i, count(*) OVER (PARTITION BY dept_name) AS c FROM r_wide) GROUP BY 1""",
)
def agg_multi_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_fields(
        roles.wide_payroll(spark, sf_dir), "dept_name",
        {"net": ["sum", "mean", "median", "min", "max", "std", "range", "pct_25", "pct_75"], "days_present": ["mean"]},
    )


@query(
    "nearest_rank_percentiles", "dept_name:s pct_25:d pct_75:d",
    """SELECT dept_name, max(CASE WHEN i=c//4+1 THEN gross END) AS pct_25, max(CASE WHEN i=3*c//4+1 THEN gross END) AS pct_75
       FROM (SELECT dept_name, gross, row_number() OVER (PARTITION BY dept_name ORDER BY gross, payroll_id) AS i,
       count(*) OVER (PARTITION BY dept_name) AS c FROM r_wide) GROUP BY 1""",
)
def nearest_rank_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = settled(roles.wide_payroll(spark, sf_dir, roles.payroll_headers(spark, sf_dir)).select("dept_name", "gross"))
    return at_positions(wide, "gross", {"pct_25": lower_quarter(), "pct_75": upper_quarter()}, ["dept_name"])


@query(
    "pivot_sum", "dept_name:s paid:d approved:d draft:d",
    """SELECT dept_name, coalesce(sum(gross) FILTER (WHERE status='Paid'),0) AS paid, coalesce(sum(gross) FILTER (WHERE status='Approved'),0) AS approved,
       coalesce(sum(gross) FILTER (WHERE status='Draft'),0) AS draft FROM (SELECT o.*, dept_name FROM r_ord o JOIN r_emp e ON o.emp_id=e.emp_id) GROUP BY 1""",
)
def pivot_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = roles.wide_payroll(spark, sf_dir, roles.payroll_headers(spark, sf_dir))
    return pivot_table(wide, "dept_name", "status", "gross", ["Paid", "Approved", "Draft"]).withColumnsRenamed(
        {"Paid": "paid", "Approved": "approved", "Draft": "draft"}
    )


@query(
    "percent_of_total", "payroll_id:l gross:d gross_pct_of_total:d",
    f"SELECT payroll_id, gross, {r('CAST(gross AS DOUBLE)*100/t',4)} AS gross_pct_of_total FROM r_ord, (SELECT CAST(sum(gross) AS DOUBLE) AS t FROM r_ord)",
)
def percent_of_total_gross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return percent_of_total(roles.payroll_headers(spark, sf_dir).select("payroll_id", "gross"), "gross")


@query(
    "group_named_agg", "dept_name:s headcount:l total_gross:d avg_net:d max_net:d min_net:d std_net:d total_tds:d",
    f"""SELECT dept_name, count(*) AS headcount, sum(gross) AS total_gross, {r(avg('net'))} AS avg_net, max(net) AS max_net, min(net) AS min_net,
        {r(std('net'))} AS std_net, sum(tds) AS total_tds FROM r_wide GROUP BY 1""",
)
def group_named_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_agg(
        roles.wide_payroll(spark, sf_dir), ["dept_name"],
        headcount=("payroll_id", "count"), total_gross=("gross", "sum"), avg_net=("net", "mean"),
        max_net=("net", "max"), min_net=("net", "min"), std_net=("net", "std"), total_tds=("tds", "sum"),
    )


@query(
    "dept_period_payroll", "dept_name:s period:s employees:l net_payroll:d avg_salary:d",
    f"""SELECT dept_name, period, count(*) AS employees, sum(net) AS net_payroll, {r(avg('net'))} AS avg_salary FROM r_wide GROUP BY 1,2""",
)
def dept_period_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_agg(
        roles.wide_payroll(spark, sf_dir), ["dept_name", "period"],
        employees=("payroll_id", "count"), net_payroll=("net", "sum"), avg_salary=("net", "mean"),
    )


@query("reduce_by_key_counts", "status:s n:l", "SELECT status, count(*) AS n FROM r_ord GROUP BY 1")
def reduce_by_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = roles.payroll_headers(spark, sf_dir).select("status", F.lit(1).alias("one"))
    return pairs.groupBy("status").agg(F.sum("one").alias("n"))


@query(
    "group_by_key_lists", "priority:s chunk:l n:l payroll_ids:s",
    """SELECT priority, (i-1)//1000 AS chunk, count(*) AS n, string_agg(CAST(payroll_id AS VARCHAR), ',' ORDER BY payroll_id) AS payroll_ids
       FROM (SELECT priority, payroll_id, row_number() OVER (PARTITION BY priority ORDER BY payroll_id) AS i FROM r_ord) GROUP BY 1,2""",
)
def group_by_key_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.payroll_headers(spark, sf_dir).select("priority", "payroll_id", F.col("payroll_id").alias("_id"))
    lists = grouped_lists(rows, "priority", "payroll_id", "_id")
    return lists.select(
        "priority", "chunk", F.size("values").alias("n"),
        F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("payroll_ids"),
    )


@query(
    "column_stats", "count:l mean:d min:d max:d std:d sum:d",
    f"""SELECT count(*) AS count, {r(avg('net'),4)} AS mean, min(net) AS min, max(net) AS max, {r(std('net'),4)} AS std, sum(net) AS sum FROM r_pay""",
)
def net_column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_stats(roles.payroll(spark, sf_dir), "net")


@query("distinct_values", "gender:s status:s", "SELECT DISTINCT gender, status FROM r_emp")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.employees(spark, sf_dir).select("gender", "status").distinct()


@query(
    "dedup_keep_first", "emp_id:l period:s payroll_id:l gross:d",
    "SELECT emp_id, period, payroll_id, gross FROM r_ord QUALIFY row_number() OVER (PARTITION BY emp_id, period ORDER BY pay_date, payroll_id)=1",
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(
        roles.payroll_headers(spark, sf_dir), ["emp_id", "period"], [F.col("pay_date"), F.col("payroll_id")]
    )


@query(
    "summary_positive_stats", "total_employees:l total_gross:d total_net:d avg_gross:d avg_net:d avg_attendance_pct:d",
    f"""SELECT count(*) AS total_employees, sum(CASE WHEN gross>0 THEN gross END) AS total_gross, sum(CASE WHEN net>0 THEN net END) AS total_net,
        {r(avg('CASE WHEN gross>0 THEN gross END'))} AS avg_gross, {r(avg('CASE WHEN net>0 THEN net END'))} AS avg_net,
        {r(f"CAST(sum(CAST({r('days_present*100.0/working_days',1)} AS DECIMAL(18,2))) AS DOUBLE)/count(*)",1)} AS avg_attendance_pct FROM r_pay""",
)
def summary_positive_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    gross, net = (F.when(F.col(c) > 0, F.col(c)) for c in ("gross", "net"))
    share = rounded(ratio("days_present", "working_days", 100), 1)
    return roles.payroll(spark, sf_dir).agg(
        F.count("*").alias("total_employees"), total(gross).alias("total_gross"), total(net).alias("total_net"),
        rounded(mean(gross)).alias("avg_gross"), rounded(mean(net)).alias("avg_net"),
        rounded(mean(share), 1).alias("avg_attendance_pct"),
    )


@query(
    "dept_positive_avg", "dept_name:s records:l avg_net:d",
    f"SELECT dept_name, count(*) AS records, {r(avg('net'))} AS avg_net FROM r_wide GROUP BY 1",
)
def dept_positive_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.wide_payroll(spark, sf_dir).groupBy("dept_name").agg(
        F.count("*").alias("records"), rounded(mean("net")).alias("avg_net")
    )


DEPT_SUMS = f"count(*) AS headcount, sum(gross) AS total_gross, sum(pf) AS pf_emp, sum(tds) AS tds, sum(net) AS total_net, {r(avg('net'))} AS avg_net"


@query(
    "dept_summary_rollup", "dept_name:s is_total:l headcount:l total_gross:d pf_emp:d tds:d total_net:d avg_net:d",
    f"SELECT coalesce(dept_name,'TOTAL') AS dept_name, grouping(dept_name) AS is_total, {DEPT_SUMS} FROM r_wide GROUP BY ROLLUP(dept_name)",
)
def dept_summary_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.wide_payroll(spark, sf_dir).rollup("dept_name").agg(
        F.grouping("dept_name").alias("is_total"), F.count("*").alias("headcount"), F.sum("gross").alias("total_gross"),
        F.sum("pf").alias("pf_emp"), F.sum("tds").alias("tds"), F.sum("net").alias("total_net"),
        rounded(mean("net")).alias("avg_net"),
    ).fillna("TOTAL", ["dept_name"])


@query(
    "rollup_dept_grade", "dept_name:s grade_code:s level:l headcount:l total_salary:d avg_salary:d",
    f"""SELECT dept_name, grade_code, grouping(dept_name)*2+grouping(grade_code) AS level, count(*) AS headcount, sum(basic) AS total_salary, {r(avg('basic'))} AS avg_salary
        FROM r_emp JOIN r_grade ON (pay_basic>=basic_min AND pay_basic<basic_max) WHERE status='Active' GROUP BY ROLLUP(dept_name, grade_code)""",
)
def rollup_dept_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = active(spark, sf_dir).withColumn("grade_code", roles.grade_of(F.col("pay_basic"))["grade_code"])
    return people.rollup("dept_name", "grade_code").agg(
        F.grouping_id().alias("level"), F.count("*").alias("headcount"), F.sum("basic").alias("total_salary"),
        rounded(mean("basic")).alias("avg_salary"),
    )


@query(
    "loan_repayment_by_status",
    "status:s loan_count:l total_sanctioned:d total_outstanding:d avg_emi:d repaid_pct:d",
    f"""SELECT status, count(*) AS loan_count, sum(amount) AS total_sanctioned, sum(outstanding) AS total_outstanding, {r(avg('emi'))} AS avg_emi,
        {r('(1-CAST(sum(outstanding) AS DOUBLE)/CAST(sum(amount) AS DOUBLE))*100',1)} AS repaid_pct FROM r_loan GROUP BY 1""",
)
def loan_repayment_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = F.try_divide(total("outstanding"), total("amount"))
    return roles.loans(spark, sf_dir).groupBy("status").agg(
        F.count("*").alias("loan_count"), F.sum("amount").alias("total_sanctioned"),
        F.sum("outstanding").alias("total_outstanding"), rounded(mean("emi")).alias("avg_emi"),
        rounded((1 - left) * 100, 1).alias("repaid_pct"),
    )


@query(
    "gini_index", "records:l total:d gini:d",
    f"""SELECT count(*) AS records, sum(gross) AS total, CAST(sum(CAST(2*i-n-1 AS DECIMAL(18,0))*gross) AS DOUBLE)/(CAST(count(*) AS DOUBLE)*CAST(sum(gross) AS DOUBLE)) AS gini
        FROM (SELECT gross, row_number() OVER (ORDER BY gross, payroll_id) AS i, count(*) OVER () AS n FROM r_ord)""",
)
def gini_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gini(roles.payroll_headers(spark, sf_dir), "gross", "payroll_id")


@query("partition_profile", "dept_name:s records:l share_pct:d",
       f"SELECT dept_name, count(*) AS records, {r('count(*)*100.0/(SELECT count(*) FROM r_ord)',2)} AS share_pct FROM r_ord o JOIN r_emp e ON o.emp_id=e.emp_id GROUP BY 1")
def partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per would-be partition key: what a repartition by department would give."""
    records = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("emp_id")).agg(F.count("*").alias("n"))
    every = table(spark, sf_dir, "orders").agg(F.count("*").alias("n")).scalar()
    per_dept = records.join(roles.employees(spark, sf_dir), "emp_id").groupBy("dept_name").agg(F.sum("n").alias("records"))
    return per_dept.withColumn("share_pct", rounded(F.col("records") * 100.0 / every))
