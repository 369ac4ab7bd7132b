"""Ranks, running totals, neighbours and other ordered reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wagewright.functions.numeric import cents, mean, ratio, rounded, total
from wagewright.operators.history import over_history
from wagewright.operators.joins import first_per_key
from wagewright.operators.ordering import ntile, percent_rank, ranked
from wagewright.plans.aggregates import active
from wagewright.registry import query
from wagewright.session import settled
from wagewright.sources import roles
from wagewright.sources.role_sql import avg, pct, r
from wagewright.sources.tables import table


@query(
    "row_number_in_group", "emp_code:s dept_name:s basic:d rank_in_dept:l dept_total:d dept_avg:d",
    f"""SELECT emp_code, dept_name, basic, row_number() OVER (PARTITION BY dept_name ORDER BY basic DESC, emp_id) AS rank_in_dept,
        sum(basic) OVER (PARTITION BY dept_name) AS dept_total,
        {r('CAST(sum(basic) OVER (PARTITION BY dept_name) AS DOUBLE)/count(*) OVER (PARTITION BY dept_name)')} AS dept_avg FROM r_emp WHERE status='Active'""",
)
def row_number_in_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = active(spark, sf_dir).select("emp_id", "emp_code", "dept_name", "basic")
    sums = settled(people.groupBy("dept_name").agg(F.sum("basic").alias("dept_total"), rounded(mean("basic")).alias("dept_avg")))
    rows = ranked(people, "basic", "emp_id", ["dept_name"], descending=True)
    return rows.withColumnRenamed("row_number", "rank_in_dept").join(sums, "dept_name")


@query(
    "rank_dense_rank", "emp_code:s basic:d company_rank:l company_dense_rank:l dept_rank:l percentile:d",
    f"""SELECT emp_code, basic, rank() OVER (ORDER BY basic DESC) AS company_rank, dense_rank() OVER (ORDER BY basic DESC) AS company_dense_rank,
        rank() OVER (PARTITION BY dept_name ORDER BY basic DESC) AS dept_rank,
        {r('percent_rank() OVER (ORDER BY basic)*100',1)} AS percentile FROM r_emp WHERE status='Active'""",
)
def rank_dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = active(spark, sf_dir).select("emp_id", "emp_code", "dept_name", "basic")
    company = settled(ranked(people, "basic", "emp_id", descending=True, want=("rank", "dense_rank", "group_rows")).withColumnsRenamed(
        {"rank": "company_rank", "dense_rank": "company_dense_rank", "group_rows": "company_rows"}
    ))
    rows = ranked(company, "basic", "emp_id", ["dept_name"], descending=True, want=("rank",)).withColumnRenamed("rank", "dept_rank")
    # Rows below a value: all rows, less those above it, less the ones that share it.
    ties = company.groupBy("basic").agg(F.count("*").alias("ties"))
    from_below = F.col("company_rows") - (F.col("company_rank") - 1) - F.col("ties") + 1
    return rows.join(ties, "basic").withColumn("percentile", rounded(percent_rank(from_below, "company_rows") * 100, 1))


@query(
    "percent_rank_top", "emp_code:s dept_name:s basic:d percentile:d",
    f"""SELECT * FROM (SELECT emp_code, dept_name, basic, {r('percent_rank() OVER (ORDER BY basic)*100',1)} AS percentile FROM r_emp WHERE status='Active') WHERE percentile>=90""",
)
def percent_rank_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = active(spark, sf_dir).select("emp_id", "emp_code", "dept_name", "basic")
    rows = ranked(people, "basic", "emp_id", want=("rank", "group_rows"))
    return rows.withColumn("percentile", rounded(percent_rank("rank", "group_rows") * 100, 1)).filter("percentile >= 90")


def monthly_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per month: the ordered windows below run over tens of rows."""
    return roles.payroll(spark, sf_dir).filter("status = 'Paid'").groupBy("period").agg(F.sum("net").alias("total_net"))


MONTHLY = "(SELECT period, sum(net) AS total_net FROM r_pay WHERE status='Paid' GROUP BY 1)"


@query(
    "mom_lag_lead", "period:s total_net:d prev_net:d next_net:d mom_change:d mom_pct:d",
    f"""SELECT period, total_net, lag(total_net) OVER w AS prev_net, lead(total_net) OVER w AS next_net, total_net-lag(total_net) OVER w AS mom_change,
        {r('CAST(total_net-lag(total_net) OVER w AS DOUBLE)/CAST(lag(total_net) OVER w AS DOUBLE)*100')} AS mom_pct FROM {MONTHLY} WINDOW w AS (ORDER BY period)""",
)
def mom_lag_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.orderBy("period")
    prev, change = F.lag("total_net").over(w), F.col("total_net") - F.lag("total_net").over(w)
    return monthly_net(spark, sf_dir).withColumns({
        "prev_net": prev, "next_net": F.lead("total_net").over(w), "mom_change": change,
        "mom_pct": rounded(F.try_divide(change.cast("double"), prev.cast("double")) * 100),
    })


@query(
    "running_total_moving_avg", "period:s total_net:d running_total:d moving_avg_3m:d",
    f"""SELECT period, total_net, sum(total_net) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total,
        {r('CAST(sum(total_net) OVER w3 AS DOUBLE)/count(*) OVER w3')} AS moving_avg_3m FROM {MONTHLY} WINDOW w3 AS (ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def running_total_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = Window.orderBy("period")
    three = months.rowsBetween(-2, 0)
    moving = F.sum("total_net").over(three).cast("double") / F.count("*").over(three)
    return monthly_net(spark, sf_dir).withColumns({
        "running_total": F.sum("total_net").over(months.rowsBetween(Window.unboundedPreceding, 0)),
        "moving_avg_3m": rounded(moving),
    })


# Quartile labels.
QUARTILES = {1: "Q1 (Bottom 25%)", 2: "Q2 (25-50%)", 3: "Q3 (50-75%)", 4: "Q4 (Top 25%)"}


def quartile_label(q: Column) -> Column:
    label = F.when(q == 1, QUARTILES[1])
    for n in (2, 3, 4):
        label = label.when(q == n, QUARTILES[n])
    return label


@query(
    "ntile_quartiles", "emp_code:s dept_name:s basic:d quartile:l label:s percentile:d",
    f"""SELECT emp_code, dept_name, basic, q AS quartile, CASE q {' '.join(f"WHEN {k} THEN '{v}'" for k, v in QUARTILES.items())} END AS label, percentile FROM
        (SELECT *, ntile(4) OVER (ORDER BY basic, emp_id) AS q, {r('percent_rank() OVER (ORDER BY basic)*100',1)} AS percentile FROM r_emp WHERE status='Active')""",
)
def ntile_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = active(spark, sf_dir).select("emp_id", "emp_code", "dept_name", "basic")
    rows = ranked(people, "basic", "emp_id", want=("row_number", "rank", "group_rows"))
    return rows.withColumn("quartile", ntile(4, "row_number", "group_rows")).withColumns({
        "label": quartile_label(F.col("quartile")),
        "percentile": rounded(percent_rank("rank", "group_rows") * 100, 1),
    })


@query(
    "first_value_high_low", "emp_code:s dept_name:s basic:d highest_earner:s lowest_earner:s dept_avg:d",
    f"""SELECT emp_code, dept_name, basic, first_value(name) OVER (PARTITION BY dept_name ORDER BY basic DESC, emp_id) AS highest_earner,
        first_value(name) OVER (PARTITION BY dept_name ORDER BY basic, emp_id) AS lowest_earner,
        {r('CAST(sum(basic) OVER (PARTITION BY dept_name) AS DOUBLE)/count(*) OVER (PARTITION BY dept_name)')} AS dept_avg FROM r_emp WHERE status='Active'""",
)
def first_value_high_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end values come from a hash aggregate; only rows at an end compete for its name."""
    people = active(spark, sf_dir).select("emp_id", "emp_code", "name", "dept_name", "basic")
    ends = settled(people.groupBy("dept_name").agg(
        F.max("basic").alias("hi"), F.min("basic").alias("lo"), rounded(mean("basic")).alias("dept_avg")
    ))
    at_end = people.join(ends, "dept_name").filter((F.col("basic") == F.col("hi")) | (F.col("basic") == F.col("lo")))
    first = F.struct("emp_id", "name")
    names = settled(at_end.groupBy("dept_name", "dept_avg").agg(
        F.min(F.when(F.col("basic") == F.col("hi"), first))["name"].alias("highest_earner"),
        F.min(F.when(F.col("basic") == F.col("lo"), first))["name"].alias("lowest_earner"),
    ))
    return people.join(names, "dept_name")


@query(
    "global_rank_bucketed", "payroll_id:l gross:d row_number:l rank:l dense_rank:l",
    """SELECT payroll_id, gross, row_number() OVER (ORDER BY gross DESC, payroll_id) AS row_number, rank() OVER (ORDER BY gross DESC) AS rank,
       dense_rank() OVER (ORDER BY gross DESC) AS dense_rank FROM r_ord""",
)
def global_rank_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.payroll_headers(spark, sf_dir).select("payroll_id", "gross")
    return ranked(rows, "gross", "payroll_id", descending=True, want=("row_number", "rank", "dense_rank"))


def ytd(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    pay = roles.payroll(spark, sf_dir).filter(roles.in_year(year) & (F.col("status") == "Paid"))
    return pay.groupBy("emp_id").agg(
        F.count("*").alias("months"), F.sum("gross").alias("ytd_gross"), F.sum("net").alias("ytd_net"),
        F.sum("tds").alias("ytd_tds"), rounded(mean("net")).alias("avg_net"), F.max("net").alias("max_net"), F.min("net").alias("min_net"),
    )


YTD = f"""(SELECT emp_id, count(*) AS months, sum(gross) AS ytd_gross, sum(net) AS ytd_net, sum(tds) AS ytd_tds, {r(avg('net'))} AS avg_net, max(net) AS max_net, min(net) AS min_net
    FROM r_pay WHERE pay_year=1998 AND status='Paid' GROUP BY 1)"""


@query(
    "ytd_running_total", "emp_code:s dept_name:s months:l ytd_gross:d ytd_net:d ytd_tds:d running_total:d effective_tax_pct:d",
    f"""SELECT emp_code, dept_name, months, ytd_gross, ytd_net, ytd_tds, sum(ytd_net) OVER (ORDER BY ytd_net DESC, y.emp_id ROWS UNBOUNDED PRECEDING) AS running_total,
        {r(pct('ytd_tds','ytd_gross'))} AS effective_tax_pct FROM {YTD} y JOIN r_emp e ON y.emp_id=e.emp_id""",
)
def ytd_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running total over all employees: prefix sums per slice plus a local sum."""
    rows = ranked(settled(ytd(spark, sf_dir, 1998)), "ytd_net", "emp_id", descending=True, want=(), running="ytd_net")
    names = roles.employees(spark, sf_dir).select("emp_id", "emp_code", "dept_name")
    return rows.join(names, "emp_id").withColumn("effective_tax_pct", rounded(ratio("ytd_tds", "ytd_gross", 100)))


@query(
    "cumulative_column", "payroll_id:l gross:d gross_cumulative:d",
    "SELECT payroll_id, gross, sum(gross) OVER (ORDER BY payroll_id ROWS UNBOUNDED PRECEDING) AS gross_cumulative FROM r_ord",
)
def cumulative_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.payroll_headers(spark, sf_dir).select("payroll_id", "gross")
    return ranked(rows, "payroll_id", "payroll_id", want=(), running="gross").withColumnRenamed("running_total", "gross_cumulative")


@query(
    "ytd_rank_stats",
    "emp_code:s dept_name:s months:l ytd_net:d ytd_tds:d avg_net:d max_net:d min_net:d effective_tax_pct:d ytd_rank:l",
    f"""SELECT emp_code, dept_name, months, ytd_net, ytd_tds, avg_net, max_net, min_net, {r(pct('ytd_tds','ytd_net'))} AS effective_tax_pct, ytd_rank
        FROM (SELECT *, rank() OVER (ORDER BY ytd_net DESC) AS ytd_rank FROM {YTD}) y JOIN r_emp e ON y.emp_id=e.emp_id ORDER BY ytd_net DESC, y.emp_id LIMIT 10""",
)
def ytd_rank_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10: a rank among them needs no row below them, so the limit comes first."""
    top = ytd(spark, sf_dir, 1998).orderBy(F.col("ytd_net").desc(), "emp_id").limit(10)
    rows = top.withColumn("ytd_rank", F.rank().over(Window.orderBy(F.col("ytd_net").desc())))
    names = roles.employees(spark, sf_dir).select("emp_id", "emp_code", "dept_name")
    return rows.join(names, "emp_id").withColumn("effective_tax_pct", rounded(ratio("ytd_tds", "ytd_net", 100)))


ROLLING_COLS = "event_id:l user_id:l value:d rolling_mean:d"
ROLLING = f"""SELECT event_id, user_id, value, {r('CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE)/count(*) OVER w',4)} AS rolling_mean FROM events
   WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)"""


def rolling_mean(spark: SparkSession, sf_dir: str, **limits) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")

    def rolling(w):
        frame = w.rowsBetween(-49, 0)
        return rounded(F.sum(cents("value")).over(frame) / 100.0 / F.count("*").over(frame), 4)

    return over_history(events, ["user_id"], "ts", "event_id", {"rolling_mean": rolling}, back=49, **limits)


@query("rolling_mean_50", ROLLING_COLS, ROLLING)
def rolling_mean_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_mean(spark, sf_dir)


@query("rolling_mean_50_chunked", ROLLING_COLS, ROLLING)
def rolling_mean_50_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for users with histories too long for one task: each is cut into chunks that borrow the 49 rows before them."""
    return rolling_mean(spark, sf_dir, chunk_rows=5000)


@query(
    "top_earner_per_dept", "dept_name:s emp_code:s name:s basic:d",
    "SELECT dept_name, emp_code, name, basic FROM r_emp QUALIFY row_number() OVER (PARTITION BY dept_name ORDER BY basic DESC, emp_id)=1",
)
def top_earner_per_dept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(roles.employees(spark, sf_dir), ["dept_name"], [F.col("basic").desc(), F.col("emp_id")])


@query(
    "monthly_trend", "period:s employees_paid:l total_gross:d total_net:d total_tds:d avg_net:d gross_k:d net_k:d",
    f"""SELECT period, count(*) AS employees_paid, sum(gross) AS total_gross, sum(net) AS total_net, sum(tds) AS total_tds, {r(avg('net'))} AS avg_net,
        {r('CAST(sum(gross) AS DOUBLE)/1000',1)} AS gross_k, {r('CAST(sum(net) AS DOUBLE)/1000',1)} AS net_k FROM r_pay WHERE status='Paid' GROUP BY 1 ORDER BY period DESC LIMIT 12""",
)
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = roles.payroll(spark, sf_dir).filter("status = 'Paid'")
    return paid.groupBy("period").agg(
        F.count("*").alias("employees_paid"), F.sum("gross").alias("total_gross"), F.sum("net").alias("total_net"),
        F.sum("tds").alias("total_tds"), rounded(mean("net")).alias("avg_net"),
        rounded(total("gross") / 1000, 1).alias("gross_k"), rounded(total("net") / 1000, 1).alias("net_k"),
    ).orderBy(F.col("period").desc()).limit(12)
