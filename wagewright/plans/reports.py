"""Reporting views over the payroll roles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions import calendar as cal
from wagewright.functions.numeric import mean, ratio, rounded
from wagewright.registry import query
from wagewright.session import settled
from wagewright.sources import roles
from wagewright.sources.role_sql import avg, r
from wagewright.sources.tables import table

AS_OF = "2002-01-01"


@query(
    "dept_payroll_cost", "dept_id:l dept_name:s period:s headcount:l total_gross:d total_net:d avg_net:d employer_pf:d employer_esi:d total_tds:d total_cost:d",
    f"""SELECT dept_id, dept_name, period, count(*) AS headcount, sum(gross) AS total_gross, sum(net) AS total_net, {r(avg('net'))} AS avg_net, sum(pf) AS employer_pf,
        sum(esi_er) AS employer_esi, sum(tds) AS total_tds, sum(gross)+sum(pf)+sum(esi_er) AS total_cost FROM r_wide GROUP BY 1,2,3""",
)
def dept_payroll_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.wide_payroll(spark, sf_dir).groupBy("dept_id", "dept_name", "period").agg(
        F.count("*").alias("headcount"), F.sum("gross").alias("total_gross"), F.sum("net").alias("total_net"),
        rounded(mean("net")).alias("avg_net"), F.sum("pf").alias("employer_pf"), F.sum("esi_er").alias("employer_esi"),
        F.sum("tds").alias("total_tds"), (F.sum("gross") + F.sum("pf") + F.sum("esi_er")).alias("total_cost"),
    )


@query(
    "employee_profile", "emp_id:l emp_code:s name:s email:s dept_name:s grade_code:s basic:d hra:d da:d ta:d ctc:d joined:s years:l",
    f"""SELECT emp_id, emp_code, name, email, dept_name, grade_code, pay_basic AS basic, round(pay_basic*hra_pct*CAST(0.01 AS DECIMAL(4,2)),2) AS hra, round(pay_basic*da_pct*CAST(0.01 AS DECIMAL(4,2)),2) AS da, ta_flat AS ta,
        round(pay_basic*(1+(hra_pct+da_pct)*CAST(0.01 AS DECIMAL(4,2)))+ta_flat,2) AS ctc, strftime(j,'%Y-%m-%d') AS joined, date_diff('day', j, DATE '{AS_OF}')//365 AS years
        FROM r_emp JOIN r_grade ON (pay_basic>=basic_min AND pay_basic<basic_max) LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS j FROM orders GROUP BY 1) ON o_custkey=emp_id""",
)
def employee_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("emp_id")).agg(F.to_date(F.min("o_orderdate")).alias("j"))
    hundredth = F.lit("0.01").cast("decimal(4,2)")
    people = roles.employees(spark, sf_dir).withColumn("g", roles.grade_of(F.col("pay_basic"))).join(joined, "emp_id", "left")
    basic, hra, da = F.col("pay_basic"), F.col("g.hra_pct"), F.col("g.da_pct")
    return people.select(
        "emp_id", "emp_code", "name", "email", "dept_name", F.col("g.grade_code").alias("grade_code"), basic.alias("basic"),
        F.round(basic * hra * hundredth, 2).alias("hra"), F.round(basic * da * hundredth, 2).alias("da"), F.col("g.ta_flat").alias("ta"),
        F.round(basic * (F.lit(1) + (hra + da) * hundredth) + F.col("g.ta_flat"), 2).alias("ctc"),
        F.date_format("j", "yyyy-MM-dd").alias("joined"), cal.tenure_years(AS_OF, "j").alias("years"),
    )


@query(
    "ytd_salary", "emp_id:l emp_code:s name:s pay_year:l months:l ytd_gross:d ytd_deductions:d ytd_net:d ytd_tds:d ytd_pf:d",
    """SELECT emp_id, emp_code, name, pay_year, count(*) AS months, sum(gross) AS ytd_gross, sum(deductions) AS ytd_deductions, sum(net) AS ytd_net, sum(tds) AS ytd_tds, sum(pf) AS ytd_pf
       FROM r_wide WHERE status IN ('Approved','Paid') GROUP BY 1,2,3,4""",
)
def ytd_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = roles.payroll(spark, sf_dir).filter(F.col("status").isin("Approved", "Paid")).groupBy("emp_id", "pay_year").agg(
        F.count("*").alias("months"), F.sum("gross").alias("ytd_gross"), F.sum("deductions").alias("ytd_deductions"),
        F.sum("net").alias("ytd_net"), F.sum("tds").alias("ytd_tds"), F.sum("pf").alias("ytd_pf"),
    )
    return sums.join(roles.employees(spark, sf_dir).select("emp_id", "emp_code", "name"), "emp_id")


@query(
    "payslips", "payroll_id:l emp_code:s name:s dept_name:s grade_code:s period:s days_present:l working_days:l gross:d pf:d tds:d deductions:d net:d status:s",
    """SELECT payroll_id, emp_code, name, dept_name, grade_code, period, days_present, working_days, gross, pf, tds, deductions, net, status
       FROM r_wide JOIN r_grade ON (pay_basic>=basic_min AND pay_basic<basic_max)""",
)
def payslips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.wide_payroll(spark, sf_dir).withColumn("grade_code", roles.grade_of(F.col("pay_basic"))["grade_code"])


@query(
    "period_records", "period:s records:l total_net:d",
    """SELECT m.period, count(payroll_id) AS records, sum(net) AS total_net FROM (SELECT DISTINCT period FROM r_ord) m
       LEFT JOIN r_pay p ON p.period=m.period GROUP BY 1""",
)
def period_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every period with its records and their total."""
    months = roles.payroll_headers(spark, sf_dir).select("period").distinct()
    sums = roles.payroll(spark, sf_dir).groupBy("period").agg(
        F.count("*").alias("records"), F.sum("net").alias("total_net")
    )
    return months.join(sums, "period", "left").fillna(0, ["records"])


def pct_hike(new: str, old: str) -> Column:
    return rounded(ratio(F.col(new) - F.col(old), F.col(old), 100), 1)


HIKE = r("CAST(new_basic-old_basic AS DOUBLE)/nullif(CAST(old_basic AS DOUBLE),0)*100.0", 1)


@query(
    "revision_history", "revision_id:l emp_code:s dept_name:s old_basic:d new_basic:d pct_hike:d effective:s reason:s",
    f"""SELECT revision_id, emp_code, dept_name, old_basic, new_basic, {HIKE} AS pct_hike, strftime(effective,'%Y-%m-%d') AS effective, reason FROM r_rev v JOIN r_emp e ON v.emp_id=e.emp_id""",
)
def revision_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = roles.employees(spark, sf_dir).select("emp_id", "emp_code", "dept_name")
    return roles.revisions(spark, sf_dir).join(people, "emp_id").withColumns({
        "pct_hike": pct_hike("new_basic", "old_basic"), "effective": F.date_format("effective", "yyyy-MM-dd"),
    })


@query(
    "revision_top_hikes", "revision_id:l name:s pct_hike:d band:s",
    f"""SELECT revision_id, name, h AS pct_hike, CASE WHEN h>=15 THEN 'green' WHEN h>=10 THEN 'gold' WHEN h>=5 THEN 'blue' ELSE 'grey' END AS band FROM
        (SELECT revision_id, name, {HIKE} AS h FROM r_rev v JOIN r_emp e ON v.emp_id=e.emp_id) ORDER BY h DESC, revision_id LIMIT 10""",
)
def revision_top_hikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    hike = F.col("pct_hike")
    top = roles.revisions(spark, sf_dir).withColumn("pct_hike", pct_hike("new_basic", "old_basic")).orderBy(hike.desc(), "revision_id").limit(10)
    band = F.when(hike >= 15, "green").when(hike >= 10, "gold").when(hike >= 5, "blue").otherwise("grey")
    return top.join(roles.employees(spark, sf_dir).select("emp_id", "name"), "emp_id").withColumn("band", band)


@query(
    "leave_stats", "leave_type:s requests:l pending:l approved:l rejected:l total_days:l",
    """SELECT leave_type, count(*) AS requests, count(*) FILTER (WHERE status='Pending') AS pending, count(*) FILTER (WHERE status='Approved') AS approved,
       count(*) FILTER (WHERE status='Rejected') AS rejected, sum(date_diff('day',from_date,to_date)+1) AS total_days FROM r_leave GROUP BY 1""",
)
def leave_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.leave_requests(spark, sf_dir).groupBy("leave_type").agg(
        F.count("*").alias("requests"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("Pending", "Approved", "Rejected")],
        F.sum(cal.inclusive_days("from_date", "to_date")).alias("total_days"),
    )


@query(
    "leave_calendar", "leave_id:l emp_code:s leave_type:s from_date:s to_date:s days:l status:s",
    """SELECT leave_id, emp_code, leave_type, strftime(from_date,'%Y-%m-%d') AS from_date, strftime(to_date,'%Y-%m-%d') AS to_date, date_diff('day',from_date,to_date)+1 AS days, l.status
       FROM r_leave l JOIN r_emp e ON l.emp_id=e.emp_id WHERE to_date>=DATE '1998-06-01' AND from_date<=DATE '1998-06-30'""",
)
def leave_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves that overlap June 1998; the start bound also prunes the order scan."""
    first, last = F.lit("1998-06-01").cast("date"), F.lit("1998-06-30").cast("date")
    leaves = roles.leave_requests(spark, sf_dir).filter((F.col("to_date") >= first) & (F.col("from_date") <= last))
    days = cal.inclusive_days("from_date", "to_date")
    return leaves.join(roles.employees(spark, sf_dir).select("emp_id", "emp_code"), "emp_id").withColumn("days", days).withColumns({
        "from_date": F.date_format("from_date", "yyyy-MM-dd"), "to_date": F.date_format("to_date", "yyyy-MM-dd"),
    })


# Budget status labels.
OVER, ON_TRACK, UNDER = "🔴 Over Budget", "🟡 On Track", "🟢 Under Budget"


@query(
    "budget_variance", "dept_name:s location:s headcount:l monthly_gross:d employer_burden:d projected_annual:d approved_budget:d variance:d budget_status:s",
    f"""SELECT dept_name, location, headcount, g AS monthly_gross, burden AS employer_burden, g*12 AS projected_annual, b AS approved_budget, g*12-b AS variance,
        CASE WHEN g*12 > b*CAST(1.05 AS DECIMAL(4,2)) THEN '{OVER}' WHEN g*12 > b*CAST(0.90 AS DECIMAL(4,2)) THEN '{ON_TRACK}' ELSE '{UNDER}' END AS budget_status
        FROM (SELECT dept_id AS k, count(DISTINCT emp_id) AS headcount, sum(gross) AS g, sum(pf)+sum(esi_er) AS burden FROM r_wide WHERE period='2000-03' GROUP BY 1)
        JOIN (SELECT dept_id, dept_name, location, budget*700 AS b FROM r_dept) d ON k=dept_id""",
)
def budget_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = roles.payroll(spark, sf_dir).filter(roles.in_month(2000, 3))
    per_emp = month.groupBy("emp_id").agg(F.sum("gross").alias("g"), F.sum(F.col("pf") + F.col("esi_er")).alias("b"))
    people = roles.employees(spark, sf_dir).select("emp_id", "dept_id")
    cost = per_emp.join(people, "emp_id").groupBy("dept_id").agg(
        F.count("*").alias("headcount"), F.sum("g").alias("monthly_gross"), F.sum("b").alias("employer_burden")
    )
    yearly, budget = F.col("monthly_gross") * 12, F.col("approved_budget")
    status = (
        F.when(yearly > budget * F.lit("1.05").cast("decimal(4,2)"), OVER)
        .when(yearly > budget * F.lit("0.90").cast("decimal(4,2)"), ON_TRACK)
        .otherwise(UNDER)
    )
    depts = roles.departments(spark, sf_dir).withColumn("approved_budget", F.col("budget") * 700)
    return depts.join(cost, "dept_id").withColumns({
        "projected_annual": yearly, "variance": yearly - budget, "budget_status": status
    })


@query(
    "dashboard_stats", "section:s name:s value:d",
    """WITH p AS (SELECT * FROM r_wide WHERE period=(SELECT max(period) FROM r_ord WHERE status='Paid'))
       SELECT 'kpi' AS section, 'emp_active' AS name, count(*) AS value FROM r_emp WHERE status='Active' UNION ALL SELECT 'kpi','emp_total',count(*) FROM r_emp
       UNION ALL SELECT 'kpi','dept_count',count(*) FROM nation UNION ALL SELECT 'kpi','gross_payroll',coalesce(sum(gross),0) FROM p WHERE status='Paid'
       UNION ALL SELECT 'kpi','net_payroll',coalesce(sum(net),0) FROM p WHERE status='Paid' UNION ALL SELECT 'kpi','payroll_headcount',count(*) FROM p WHERE status='Paid'
       UNION ALL SELECT 'kpi','loan_outstanding',sum(outstanding) FROM r_loan WHERE status='Active' UNION ALL SELECT 'kpi','leave_pending',count(*) FROM r_leave WHERE status='Pending'
       UNION ALL SELECT 'dept_costs', dept_name, n FROM (SELECT dept_name, sum(net) AS n FROM p GROUP BY 1 ORDER BY n DESC, dept_name LIMIT 8)
       UNION ALL SELECT 'top_earners', name, net FROM (SELECT name, net FROM p ORDER BY net DESC, payroll_id LIMIT 5)
       UNION ALL SELECT 'gender_split', gender, count(*) FROM r_emp WHERE status='Active' GROUP BY 2""",
)
def dashboard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs, top departments and earners of the latest paid month, and the staff split."""
    heads = roles.payroll_headers(spark, sf_dir)
    first_day = F.trunc(F.max("pay_date"), "month")
    month_of = F.struct(first_day.cast("timestamp_ntz").alias("start"), F.add_months(first_day, 1).cast("timestamp_ntz").alias("stop"))
    last = heads.filter("status = 'Paid'").agg(month_of).scalar()
    in_last = (F.col("pay_date") >= last["start"]) & (F.col("pay_date") < last["stop"])
    month = settled(roles.wide_payroll(spark, sf_dir, roles.payroll(spark, sf_dir).filter(in_last)))
    staff = table(spark, sf_dir, "customer").agg(F.count_if(F.col("c_acctbal") >= 0).alias("emp_active"), F.count("*").alias("emp_total"))
    paid = month.filter("status = 'Paid'").agg(
        F.coalesce(F.sum("gross"), F.lit(0)).alias("gross_payroll"), F.coalesce(F.sum("net"), F.lit(0)).alias("net_payroll"),
        F.count("*").alias("payroll_headcount"),
    )

    def kpis(df: DataFrame) -> DataFrame:
        doubles = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
        return doubles.unpivot([], doubles.columns, "name", "value").withColumn("section", F.lit("kpi"))

    def named(df: DataFrame, section: str) -> DataFrame:
        return df.select("name", F.col("value").cast("double").alias("value"), F.lit(section).alias("section"))

    parts = [
        kpis(staff),
        kpis(table(spark, sf_dir, "nation").agg(F.count("*").alias("dept_count"))),
        kpis(paid),
        kpis(roles.loans(spark, sf_dir).filter("status = 'Active'").agg(F.sum("outstanding").alias("loan_outstanding"))),
        kpis(roles.leave_requests(spark, sf_dir).filter("status = 'Pending'").agg(F.count("*").alias("leave_pending"))),
        named(month.groupBy(F.col("dept_name").alias("name")).agg(F.sum("net").alias("value")).orderBy(F.col("value").desc(), "name").limit(8), "dept_costs"),
        named(month.select("name", F.col("net").alias("value"), "payroll_id").orderBy(F.col("value").desc(), "payroll_id").limit(5), "top_earners"),
        named(table(spark, sf_dir, "customer").filter("c_acctbal >= 0").groupBy(F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("value")), "gender_split"),
    ]
    return reduce(DataFrame.unionByName, parts)


# ---- run, request and usage logs ---------------------------------------------
@query(
    "run_log_summary", "job:s total_runs:l successful:l failed:l success_rate_pct:d avg_duration:d max_duration:d sla_breaches:l",
    f"""SELECT CASE WHEN event_id%4=0 THEN 'monthly' ELSE 'daily' END AS job, count(*) AS total_runs, count(*) FILTER (WHERE event_type<>'error') AS successful, count(*) FILTER (WHERE event_type='error') AS failed,
        {r("count(*) FILTER (WHERE event_type<>'error')*100.0/count(*)",1)} AS success_rate_pct, {r(avg('CAST(value AS DECIMAL(18,2))'))} AS avg_duration, max(value) AS max_duration,
        count(*) FILTER (WHERE value>30 AND event_id%4=0) AS sla_breaches FROM events GROUP BY 1""",
)
def run_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the monthly job has an SLA (30 s)."""
    ok, monthly = F.col("event_type") != "error", F.col("event_id") % 4 == 0
    return table(spark, sf_dir, "events").groupBy(F.when(monthly, "monthly").otherwise("daily").alias("job")).agg(
        F.count("*").alias("total_runs"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"),
        rounded(F.count_if(ok) * 100.0 / F.count("*"), 1).alias("success_rate_pct"), rounded(mean("value")).alias("avg_duration"),
        F.max("value").alias("max_duration"), F.count_if(monthly & (F.col("value") > 30)).alias("sla_breaches"),
    )


# Limits per job (longest run, lowest success rate in %).
SLA_LIMITS = [("daily", 400.0, 90.0), ("monthly", 500.0, 70.0)]


@query(
    "sla_violations", "job:s sla_met:l violations:s",
    """SELECT job, CASE WHEN v='' THEN 1 ELSE 0 END AS sla_met, v AS violations FROM (SELECT job, concat_ws('; ', CASE WHEN mx>l THEN 'run too long' END, CASE WHEN ok*100.0/n<s THEN 'success rate too low' END, CASE WHEN n>ok THEN (n-ok) || ' run(s) failed' END) AS v FROM
       (SELECT CASE WHEN event_id%4=0 THEN 'monthly' ELSE 'daily' END AS job, max(value) AS mx, count(*) AS n, count(*) FILTER (WHERE event_type<>'error') AS ok FROM events GROUP BY 1) JOIN (VALUES ('daily',400.0,90.0),('monthly',500.0,70.0)) s(j,l,s) ON j=job)""",
)
def sla_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = spark.createDataFrame(SLA_LIMITS, "job string, longest double, least_pct double")
    stats = run_log_summary(spark, sf_dir).join(limits, "job")
    found = F.array_compact(F.array(
        F.when(F.col("max_duration") > F.col("longest"), "run too long"),
        F.when(F.col("successful") * 100.0 / F.col("total_runs") < F.col("least_pct"), "success rate too low"),
        F.when(F.col("failed") > 0, F.concat(F.col("failed").cast("string"), F.lit(" run(s) failed"))),
    ))
    return stats.withColumn("found", found).select(
        "job", (F.size("found") == 0).cast("int").alias("sla_met"), F.array_join("found", "; ").alias("violations")
    )


@query(
    "request_log_summary", "protocol:s host:s requests:l bytes:l avg_bytes:d max_bytes:l",
    f"""SELECT regexp_extract(url,'^([a-z]+)://',1) AS protocol, regexp_extract(url,'^[a-z]+://([^/]+)',1) AS host, count(*) AS requests, sum(length(html)) AS bytes,
        {r('CAST(sum(length(html)) AS DOUBLE)/count(*)')} AS avg_bytes, max(length(html)) AS max_bytes FROM pages GROUP BY 1,2""",
)
def request_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.length("html")
    return table(spark, sf_dir, "pages").groupBy(
        F.regexp_extract("url", "^([a-z]+)://", 1).alias("protocol"), F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host")
    ).agg(
        F.count("*").alias("requests"), F.sum(size).alias("bytes"),
        rounded(F.sum(size).cast("double") / F.count("*")).alias("avg_bytes"), F.max(size).alias("max_bytes"),
    )


@query(
    "usage_ledger", "query_name:s queries:l bytes_tb:d cost_usd:d avg_ms:d",
    f"""SELECT event_type AS query_name, count(*) AS queries, {r('CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)*1000000.0/1e12',6)} AS bytes_tb,
        {r('CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)*1000000.0/1e12*5',4)} AS cost_usd, {r(avg('CAST(value AS DECIMAL(18,2))'))} AS avg_ms FROM events GROUP BY 1""",
)
def usage_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 USD per terabyte; a value of 1 stands for a megabyte scanned."""
    tb = F.sum(F.col("value").cast("decimal(18,2)")).cast("double") * 1000000.0 / 1e12
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("query_name")).agg(
        F.count("*").alias("queries"), rounded(tb, 6).alias("bytes_tb"), rounded(tb * 5, 4).alias("cost_usd"), rounded(mean("value")).alias("avg_ms")
    )
