"""Scalar expressions, dates and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions import calendar as cal
from wagewright.functions.numeric import mean, rounded, stored_money
from wagewright.functions.scaling import normalise
from wagewright.functions.text import compact_amount, employee_code, row_hash
from wagewright.registry import query
from wagewright.sources import roles
from wagewright.sources.role_sql import avg, r, std
from wagewright.sources.tables import table

AS_OF = "2002-01-01"


def _fmt_sql(x: str) -> str:
    def part(unit: int, digits: int, suffix: str) -> str:
        return (f"'₹' || CAST(CAST(round(CAST(CAST({x} AS DOUBLE)/{unit} AS DECIMAL(28,8)),{digits}) AS DECIMAL(18,{digits})) AS VARCHAR) || '{suffix}'")

    return (f"CASE WHEN {x}>=10000000 THEN {part(10000000,2,'Cr')} WHEN {x}>=100000 THEN {part(100000,2,'L')} "
            f"WHEN {x}>=1000 THEN {part(1000,1,'K')} ELSE {part(1,0,'')} END")


@query(
    "scalar_strings", "emp_id:l code:s padded:s full_name:s lowered:s swapped:s starts:l annual_text:s month_text:s",
    f"""SELECT emp_id, emp_code AS code, lpad(CAST(dept_id AS VARCHAR),2,'0') AS padded, name || ' of ' || dept_name AS full_name,
        lower(trim('  ' || name || ' ')) AS lowered, replace(upper(dept_name),'_','-') AS swapped,
        CASE WHEN starts_with(name,'Customer') THEN 1 ELSE 0 END AS starts, {_fmt_sql('(pay_basic*240)')} AS annual_text, {_fmt_sql('basic')} AS month_text FROM r_emp""",
)
def scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.employees(spark, sf_dir).select(
        "emp_id",
        employee_code("emp_id").alias("code"),
        F.lpad(F.col("dept_id").cast("string"), 2, "0").alias("padded"),
        F.concat("name", F.lit(" of "), "dept_name").alias("full_name"),
        F.lower(F.trim(F.concat(F.lit("  "), "name", F.lit(" ")))).alias("lowered"),
        F.replace(F.upper("dept_name"), F.lit("_"), F.lit("-")).alias("swapped"),
        F.startswith("name", F.lit("Customer")).cast("int").alias("starts"),
        compact_amount(F.col("pay_basic") * 240).alias("annual_text"),
        compact_amount("basic").alias("month_text"),
    )


HASHED = "concat_ws('|', CAST(basic AS VARCHAR), CAST(dept_id AS VARCHAR), gender, status)"


@query(
    "row_hash", "emp_id:l md5_hash:s sha_hash:s",
    f"SELECT emp_id, md5({HASHED}) AS md5_hash, sha256(name || '|' || dept_name) AS sha_hash FROM r_emp",
)
def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.employees(spark, sf_dir).select(
        "emp_id", row_hash("basic", "dept_id", "gender", "status").alias("md5_hash"),
        F.sha2(F.concat_ws("|", "name", "dept_name"), 256).alias("sha_hash"),
    )


@query(
    "join_year_experience", "join_year:s employees:l avg_salary:d avg_exp_years:d avg_tenure:d",
    f"""SELECT strftime(joined,'%Y') AS join_year, count(*) AS employees, {r(avg('basic'))} AS avg_salary,
        {r(f"CAST(sum(date_diff('day', joined, DATE '{AS_OF}')) AS DOUBLE)/count(*)/365.25",1)} AS avg_exp_years,
        CAST(sum(date_diff('day', joined, DATE '{AS_OF}')//365) AS DOUBLE)/count(*) AS avg_tenure
        FROM r_emp e JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS joined FROM orders GROUP BY 1) j ON o_custkey=emp_id WHERE status='Active' GROUP BY 1""",
)
def join_year_experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("emp_id")).agg(
        F.to_date(F.min("o_orderdate")).alias("joined")
    )
    days = F.datediff(F.lit(AS_OF).cast("date"), "joined")
    people = table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("emp_id"), stored_money("c_acctbal").alias("basic")
    )
    return people.join(joined, "emp_id").groupBy(F.date_format("joined", "yyyy").alias("join_year")).agg(
        F.count("*").alias("employees"), rounded(mean("basic")).alias("avg_salary"),
        rounded(F.sum(days).cast("double") / F.count("*") / 365.25, 1).alias("avg_exp_years"),
        (F.sum(cal.tenure_years(AS_OF, "joined")).cast("double") / F.count("*")).alias("avg_tenure"),
    )


@query(
    "leave_days", "leave_id:l from_date:s to_date:s days:l",
    "SELECT leave_id, strftime(from_date,'%Y-%m-%d') AS from_date, strftime(to_date,'%Y-%m-%d') AS to_date, date_diff('day',from_date,to_date)+1 AS days FROM r_leave",
)
def leave_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.leave_requests(spark, sf_dir).select(
        "leave_id", F.date_format("from_date", "yyyy-MM-dd").alias("from_date"),
        F.date_format("to_date", "yyyy-MM-dd").alias("to_date"), cal.inclusive_days("from_date", "to_date").alias("days"),
    )


FY_SQL = "'FY' || CASE WHEN month(d)>=4 THEN year(d) ELSE year(d)-1 END || '-' || lpad(CAST((CASE WHEN month(d)>=4 THEN year(d)+1 ELSE year(d) END)%100 AS VARCHAR),2,'0')"


@query(
    "dim_calendar",
    "date_key:l full_date:s day:l week:l month:l quarter:l year:l month_name:s day_name:s is_weekend:l fiscal_year:s working_day_num:l",
    f"""SELECT year(d)*10000+month(d)*100+day(d) AS date_key, strftime(d,'%Y-%m-%d') AS full_date, day(d) AS day, week(d) AS week, month(d) AS month, quarter(d) AS quarter, year(d) AS year,
        strftime(d,'%B') AS month_name, strftime(d,'%A') AS day_name, CASE WHEN isodow(d)>=6 THEN 1 ELSE 0 END AS is_weekend, {FY_SQL} AS fiscal_year,
        sum(CASE WHEN isodow(d)<6 THEN 1 ELSE 0 END) OVER (PARTITION BY year(d), month(d) ORDER BY d) AS working_day_num
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (SELECT date_trunc('month',min(o_orderdate)) AS lo, date_trunc('month',max(o_orderdate))+INTERVAL 1 MONTH-INTERVAL 1 DAY AS hi FROM orders))""",
)
def dim_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wagewright.operators.warehouse import calendar_dimension

    return calendar_dimension(table(spark, sf_dir, "orders"), "o_orderdate")


FQ_SQL = "CASE WHEN pay_month BETWEEN 4 AND 6 THEN pay_year||'-Q1' WHEN pay_month BETWEEN 7 AND 9 THEN pay_year||'-Q2' WHEN pay_month BETWEEN 10 AND 12 THEN pay_year||'-Q3' ELSE (pay_year-1)||'-Q4' END"


@query(
    "fiscal_quarter_trend", "fiscal_quarter:s headcount:l gross_k:d net_k:d",
    f"""SELECT {FQ_SQL} AS fiscal_quarter, count(DISTINCT emp_id) AS headcount, {r('CAST(sum(gross) AS DOUBLE)/1000',1)} AS gross_k, {r('CAST(sum(net) AS DOUBLE)/1000',1)} AS net_k
        FROM r_pay WHERE status='Paid' GROUP BY 1""",
)
def fiscal_quarter_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per (quarter, employee) first, then per quarter: no distinct pass over rows."""
    paid = roles.payroll(spark, sf_dir).filter("status = 'Paid'")
    per_emp = paid.groupBy(cal.fiscal_quarter("pay_year", "pay_month").alias("fiscal_quarter"), "emp_id").agg(
        F.sum("gross").alias("g"), F.sum("net").alias("n")
    )
    return per_emp.groupBy("fiscal_quarter").agg(
        F.count("*").alias("headcount"), rounded(F.sum("g").cast("double") / 1000, 1).alias("gross_k"),
        rounded(F.sum("n").cast("double") / 1000, 1).alias("net_k"),
    )


@query(
    "scalar_math", "emp_id:l rounded_tenth:d smaller:d larger:d magnitude:d root:d logged:d digits:l",
    f"""SELECT emp_id, round(basic,1) AS rounded_tenth, least(basic,3000) AS smaller, greatest(basic,3000) AS larger, abs(basic) AS magnitude,
        {r('sqrt(CAST(abs(basic) AS DOUBLE))',6)} AS root, {r('ln(1+CAST(greatest(basic,0) AS DOUBLE))',6)} AS logged, ceil(log10(CAST(abs(basic) AS DOUBLE)+1)) AS digits FROM r_emp""",
)
def scalar_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    basic, size = F.col("basic"), F.abs(F.col("basic")).cast("double")
    return roles.employees(spark, sf_dir).select(
        "emp_id", F.round(basic, 1).alias("rounded_tenth"), F.least(basic, F.lit(3000)).alias("smaller"),
        F.greatest(basic, F.lit(3000)).alias("larger"), F.abs(basic).alias("magnitude"),
        rounded(F.sqrt(size), 6).alias("root"), rounded(F.log1p(F.greatest(basic, F.lit(0)).cast("double")), 6).alias("logged"),
        F.ceil(F.log10(size + 1)).alias("digits"),
    )


@query(
    "json_props", "event_type:s events:l k_sum:l k_default_sum:l missing:l",
    """SELECT event_type, count(*) AS events, sum(CAST(json_extract_string(props,'$.k') AS BIGINT)) AS k_sum,
       sum(coalesce(CAST(json_extract_string(props,'$.bonus') AS BIGINT),10)) AS k_default_sum, count(*) FILTER (WHERE json_extract(props,'$.bonus') IS NULL) AS missing FROM events GROUP BY 1""",
)
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload text parsed once against a declared schema; absent keys take a default."""
    parsed = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint, bonus bigint").alias("p"))
    return parsed.groupBy("event_type").agg(
        F.count("*").alias("events"), F.sum("p.k").alias("k_sum"),
        F.sum(F.coalesce("p.bonus", F.lit(10))).alias("k_default_sum"), F.count_if(F.col("p.bonus").isNull()).alias("missing"),
    )


def _norm(key: str, method: str, sql: str) -> None:
    name = f"gross_norm_{method}"

    @query(key, f"payroll_id:l gross:d {name}:d", f"SELECT payroll_id, gross, {sql} AS {name} FROM r_ord")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalise(roles.payroll_headers(spark, sf_dir).select("payroll_id", "gross"), "gross", method)


G = "CAST(gross AS DOUBLE)"
_norm("norm_min_max", "min_max", r(f"({G}-(SELECT min({G}) FROM r_ord))/((SELECT max({G}) FROM r_ord)-(SELECT min({G}) FROM r_ord))", 6))
_norm("norm_z_score", "z_score", r(f"({G}-(SELECT {avg('gross')} FROM r_ord))/(SELECT {std('gross', True)} FROM r_ord)", 6))
_norm("norm_decimal_scaling", "decimal", r(f"{G}/(SELECT pow(10,ceil(log10(max(abs({G}))+1))) FROM r_ord)", 6))
_norm("norm_log", "log", r(f"ln(1+greatest({G},0))", 6))
