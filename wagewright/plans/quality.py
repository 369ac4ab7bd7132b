"""Cleaning, validation, quality suites and anomaly reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions import rules
from wagewright.functions.numeric import ratio, rounded
from wagewright.operators import quality as dq
from wagewright.operators.cleaning import clean_attendance, clean_employees, clean_payroll
from wagewright.registry import query
from wagewright.session import scratch, settled
from wagewright.sources import roles
from wagewright.sources.role_sql import avg, pct, r, std
from wagewright.sources.tables import table, write_csv

SAL = "CASE WHEN trim(basic_salary)='' THEN '0' ELSE basic_salary END"


@query(
    "clean_employees", "emp_id:l emp_code:s basic_salary:d status:s dob:s email:s fixes:l",
    f"""SELECT emp_id, CASE WHEN emp_code='' THEN printf('EMP%03d',emp_id) ELSE emp_code END AS emp_code, coalesce(TRY_CAST({SAL} AS DOUBLE),0) AS basic_salary,
        CASE WHEN status='' THEN 'Unknown' ELSE status END AS status, CASE WHEN dob='' THEN '1990-01-01' ELSE dob END AS dob,
        CASE WHEN email='' THEN lower(first_name)||'.'||lower(last_name)||'@company.example' ELSE email END AS email,
        CAST(emp_code='' AS INT)+CAST(basic_salary='' AS INT)+CAST(status='' AS INT)+CAST(dob='' AS INT)+CAST(email='' AS INT) AS fixes FROM r_dirty_emp""",
)
def cleaned_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_employees(roles.dirty_employees(spark, sf_dir)).withColumn("fixes", F.size("issues"))


@query(
    "clean_issue_log", "emp_id:l issue:s",
    """SELECT emp_id, 'generated emp_code' AS issue FROM r_dirty_emp WHERE emp_code='' UNION ALL SELECT emp_id,'basic_salary set to 0' FROM r_dirty_emp WHERE basic_salary=''
       UNION ALL SELECT emp_id,'status set to Unknown' FROM r_dirty_emp WHERE status='' UNION ALL SELECT emp_id,'dob placeholder' FROM r_dirty_emp WHERE dob=''
       UNION ALL SELECT emp_id,'generated email' FROM r_dirty_emp WHERE email=''""",
)
def clean_issue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = clean_employees(roles.dirty_employees(spark, sf_dir))
    return fixed.select("emp_id", F.explode("issues").alias("issue"))


def _money_sql(c: str) -> str:
    return f"coalesce(TRY_CAST(trim({c}) AS DECIMAL(18,2)),0)"


@query(
    "clean_payroll", "payroll_id:l emp_id:l days_present:l basic:d gross:d pf:d tds:d net:d fixes:l",
    f"""SELECT payroll_id, CAST(emp_id AS BIGINT) AS emp_id, CAST(CASE WHEN days_present='' THEN working_days ELSE days_present END AS BIGINT) AS days_present, b AS basic, g AS gross, p AS pf, t AS tds,
        CASE WHEN net='' THEN g-p-t ELSE CAST(net AS DECIMAL(18,2)) END AS net, CAST(days_present='' AS INT)+CAST(gross='' AS INT)+CAST(net='' AS INT) AS fixes
        FROM (SELECT *, CASE WHEN gross='' THEN round(b*CAST(1.55 AS DECIMAL(4,2)),2) ELSE CAST(gross AS DECIMAL(18,2)) END AS g FROM
        (SELECT *, {_money_sql('basic')} AS b, {_money_sql('pf')} AS p, {_money_sql('tds')} AS t FROM r_dirty_pay))""",
)
def cleaned_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_payroll(roles.dirty_payroll(spark, sf_dir)).withColumn("fixes", F.size("issues"))


DIRTY_ATT = """(SELECT emp_id, CASE WHEN emp_id%3=0 THEN '' ELSE CAST(count(*) FILTER (WHERE status='Present') AS VARCHAR) END AS days_present,
   CAST(count(*) FILTER (WHERE status='Absent') AS VARCHAR) AS days_absent, CASE WHEN emp_id%7=0 THEN 'x' ELSE CAST(count(*) FILTER (WHERE status='On-Leave') AS VARCHAR) END AS leave_days,
   CASE WHEN emp_id%5=0 THEN '' ELSE CAST(sum(greatest(hours-8,0)) AS VARCHAR) END AS overtime_hrs, CASE WHEN emp_id%11=0 THEN '' ELSE CAST(count(*) FILTER (WHERE hours<1) AS VARCHAR) END AS late_arrivals
   FROM r_att GROUP BY 1)"""


@query(
    "clean_attendance", "emp_id:l days_present:l days_absent:l leave_days:l overtime_hrs:d late_arrivals:d fixes:l",
    f"""SELECT emp_id, coalesce(TRY_CAST(days_present AS BIGINT),0) AS days_present, CAST(days_absent AS BIGINT) AS days_absent, coalesce(TRY_CAST(leave_days AS BIGINT),0) AS leave_days,
        coalesce(TRY_CAST(overtime_hrs AS DOUBLE),0) AS overtime_hrs, coalesce(TRY_CAST(late_arrivals AS DOUBLE),0) AS late_arrivals, CAST(days_present='' AS INT) AS fixes FROM {DIRTY_ATT}""",
)
def cleaned_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, hours = F.col("status"), F.col("hours")
    sums = roles.attendance(spark, sf_dir).groupBy("emp_id").agg(
        F.count_if(status == "Present").alias("present"), F.count_if(status == "Absent").alias("absent"),
        F.count_if(status == "On-Leave").alias("leave"), F.sum(F.greatest(hours - 8, F.lit(0))).alias("over"),
        F.count_if(hours < 1).alias("late"),
    )
    dirty = sums.select(
        F.col("emp_id").cast("string").alias("emp_id"), F.col("emp_id").alias("_id"),
        *[F.col(c).cast("string").alias(c) for c in ("present", "absent", "leave", "over", "late")],
    ).select(
        "emp_id",
        roles.blank_every("_id", 3, F.col("present")).alias("days_present"), F.col("absent").alias("days_absent"),
        roles.blank_every("_id", 7, F.col("leave"), "x").alias("leave_days"),
        roles.blank_every("_id", 5, F.col("over")).alias("overtime_hrs"),
        roles.blank_every("_id", 11, F.col("late")).alias("late_arrivals"),
    )
    return clean_attendance(dirty).withColumn("fixes", F.size("issues"))


PAN_SQL = "CASE WHEN emp_id%9=0 THEN 'AB12' ELSE 'abcde' || lpad(CAST(emp_id%10000 AS VARCHAR),4,'0') || 'f' END"
DOB_SQL = "CASE WHEN emp_id%23=0 THEN '1985-13-45' ELSE dob END"


@query(
    "validate_formats", "emp_id:l bad_pan:l bad_email:l bad_date:l bad_status:l bad_salary:l bad_code:l",
    f"""SELECT emp_id, CASE WHEN regexp_matches(upper({PAN_SQL}),'^[A-Z]{{5}}[0-9]{{4}}[A-Z]$') THEN 0 ELSE 1 END AS bad_pan,
        CASE WHEN regexp_matches(email,'^[\\w.+-]+@[\\w-]+\\.[a-zA-Z]{{2,}}$') THEN 0 ELSE 1 END AS bad_email,
        CASE WHEN try_strptime({DOB_SQL},'%Y-%m-%d') IS NULL THEN 1 ELSE 0 END AS bad_date, CASE WHEN status IN ('Active','Inactive') THEN 0 ELSE 1 END AS bad_status,
        CASE WHEN TRY_CAST(basic_salary AS DOUBLE) BETWEEN 0 AND 9000 THEN 0 ELSE 1 END AS bad_salary, CASE WHEN trim(emp_code)='' THEN 1 ELSE 0 END AS bad_code FROM r_dirty_emp""",
)
def validate_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.lpad((F.col("emp_id") % 10000).cast("string"), 4, "0")
    people = roles.dirty_employees(spark, sf_dir).withColumns({
        "pan": F.when(F.col("emp_id") % 9 == 0, "AB12").otherwise(F.concat(F.lit("abcde"), digits, F.lit("f"))),
        "dob": roles.blank_every("emp_id", 23, F.col("dob"), "1985-13-45"),
    })
    tests = {
        "bad_pan": rules.pan("pan"), "bad_email": rules.email("email"), "bad_date": rules.iso_date("dob"),
        "bad_status": rules.one_of("status", ["Active", "Inactive"]), "bad_salary": rules.in_range("basic_salary", 0, 9000),
        "bad_code": rules.required("emp_code"),
    }
    return people.select("emp_id", *[t.isNotNull().cast("int").alias(n) for n, t in tests.items()])


def _errors_sql(pairs: list[tuple[str, str]]) -> str:
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {bad} THEN '{text}' END" for bad, text in pairs) + ")"


RECORD_RULES = [("emp_code=''", "[emp_code] required"), ("basic IS NULL", "[basic] required"), ("basic IS NULL", "[basic] not a number"), ("net<0", "[net] negative"),
    ("basic>0 AND NOT (CAST(gross AS DOUBLE)/CAST(basic AS DOUBLE) BETWEEN 1 AND 3)", "[salary] gross/basic outside 1-3"), ("net>gross", "[net] above gross")]


@query("validate_records", "payroll_id:l is_valid:l errors:s",
       f"SELECT payroll_id, CASE WHEN e='' THEN 1 ELSE 0 END AS is_valid, e AS errors FROM (SELECT payroll_id, {_errors_sql(RECORD_RULES)} AS e FROM r_bad_pay)")
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = roles.defective_payroll(spark, sf_dir).withColumn("found", rules.record_errors())
    return checked.select(
        "payroll_id", (F.size("found") == 0).cast("int").alias("is_valid"), F.array_join("found", "; ").alias("errors")
    )


@query("validate_batch_summary", "total:l valid:l invalid:l pass_rate:d",
       f"""SELECT count(*) AS total, count(*) FILTER (WHERE e='') AS valid, count(*) FILTER (WHERE e<>'') AS invalid,
           {r("count(*) FILTER (WHERE e='')*100.0/count(*)",1)} AS pass_rate FROM (SELECT {_errors_sql(RECORD_RULES)} AS e FROM r_bad_pay)""")
def validate_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.size(rules.record_errors()) == 0
    return roles.defective_payroll(spark, sf_dir).agg(
        F.count("*").alias("total"), F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid")
    ).withColumn("pass_rate", rounded(ratio("valid", "total", 100), 1))


REGISTER_RULES = [("emp_code=''", "missing emp_code"), ("net<0", "negative net"), ("gross=0", "zero gross"), ("net>coalesce(nullif(gross,0),1)", "net > gross")]


@query("register_clean_validate", "payroll_id:l is_clean:l errors:s",
       f"SELECT payroll_id, CASE WHEN e='' THEN 1 ELSE 0 END AS is_clean, e AS errors FROM (SELECT payroll_id, {_errors_sql(REGISTER_RULES)} AS e FROM r_bad_pay)")
def register_clean_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = roles.defective_payroll(spark, sf_dir).withColumn("found", rules.register_errors())
    return checked.select(
        "payroll_id", (F.size("found") == 0).cast("int").alias("is_clean"), F.array_join("found", "; ").alias("errors")
    )


@query("ingest_errors", "emp_id:l emp_code:s errors:s",
       f"""SELECT emp_id, emp_code, e AS errors FROM (SELECT emp_id, emp_code, {_errors_sql([("emp_code=''","missing emp_code"),(f"TRY_CAST({SAL} AS DOUBLE) IS NULL","invalid salary"),(f"TRY_CAST({SAL} AS DOUBLE)<0","negative salary")])} AS e FROM r_dirty_emp) WHERE e<>''""")
def ingest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows go to an error table with their reasons and the load time."""
    bad = roles.dirty_employees(spark, sf_dir).withColumn("found", rules.ingest_row_errors()).filter(F.size("found") > 0)
    path = scratch(spark, "ingest-errors")
    bad.select("emp_id", "emp_code", "found", F.current_timestamp().alias("logged_at")).write.parquet(path)
    return spark.read.parquet(path).select("emp_id", "emp_code", F.array_join("found", "; ").alias("errors"))


@query("quarantine_split", "zone:s records:l total_gross:d",
       """SELECT CASE WHEN payroll_id%17=0 THEN 'quarantine' ELSE 'cleaned' END AS zone, count(*) AS records, sum(CASE WHEN payroll_id%17=0 THEN 0 ELSE gross END) AS total_gross FROM r_ord GROUP BY 1""")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed CSV read keeps unreadable lines in a corrupt-record column; the two sorts of rows part there."""
    landing, clean_zone, bad_zone = (scratch(spark, n) for n in ("landing", "cleaned", "quarantine"))
    text = roles.payroll_headers(spark, sf_dir).select(
        "payroll_id", roles.blank_every("payroll_id", 17, F.col("gross").cast("string"), "n/a").alias("gross")
    )
    write_csv(text, landing)
    landed = (
        spark.read.schema("payroll_id bigint, gross decimal(18,2), _bad string")
        .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").csv(landing)
    )
    landed.filter(F.col("_bad").isNull()).drop("_bad").write.parquet(clean_zone)
    # Every column stays selected: a pruned column is not parsed, so its errors would go unseen.
    landed.filter(F.col("_bad").isNotNull()).withColumnRenamed("_bad", "line").write.parquet(bad_zone)
    good = spark.read.parquet(clean_zone).agg(F.count("*").alias("records"), F.sum("gross").alias("total_gross"))
    bad = spark.read.parquet(bad_zone).agg(F.count("*").alias("records")).withColumn("total_gross", F.lit(0).cast("decimal(28,2)"))
    return good.withColumn("zone", F.lit("cleaned")).unionByName(bad.withColumn("zone", F.lit("quarantine")))


@query("constraint_audit", "rule:s violations:l",
       """SELECT 'not null employees.emp_code' AS rule, count(*) AS violations FROM r_dirty_emp WHERE emp_code='' UNION ALL
       SELECT 'check employees.status', count(*) FROM r_dirty_emp WHERE status NOT IN ('Active','Inactive','Terminated','On-Leave') UNION ALL
       SELECT 'unique payroll(emp_id, period)', count(*) FROM (SELECT 1 FROM r_ord GROUP BY emp_id, period HAVING count(*)>1) UNION ALL
       SELECT 'unique lines(order, line)', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*)>1) UNION ALL
       SELECT 'unique events.event_id', count(*) FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*)>1) UNION ALL
       SELECT 'fk payroll.emp_id', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL
       SELECT 'fk payroll without lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, heads = roles.dirty_employees(spark, sf_dir), roles.payroll_headers(spark, sf_dir)
    lines, events = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "events")

    def duplicates(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).count().filter("count > 1")

    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("emp_id"))
    line_keys = lines.select(F.col("l_orderkey").alias("payroll_id"))
    audits = {
        "not null employees.emp_code": people.filter(F.trim("emp_code") == ""),
        "check employees.status": people.filter(~F.col("status").isin("Active", "Inactive", "Terminated", "On-Leave")),
        "unique payroll(emp_id, period)": duplicates(heads, "emp_id", "period"),
        "unique lines(order, line)": duplicates(lines, "l_orderkey", "l_linenumber"),
        "unique events.event_id": duplicates(events, "event_id"),
        "fk payroll.emp_id": heads.join(customers, "emp_id", "left_anti"),
        "fk payroll without lines": heads.join(line_keys, "payroll_id", "left_anti"),
    }
    counted = [df.agg(F.count("*").alias("violations")).withColumn("rule", F.lit(n)) for n, df in audits.items()]
    return reduce(DataFrame.unionByName, counted)


@query("load_guards", "payroll_id:l outcome:s reason:s",
       """SELECT payroll_id, CASE WHEN gross-deductions<0 OR e.status='Inactive' OR b.status='Paid' THEN 'rejected' ELSE 'accepted' END AS outcome,
          CASE WHEN gross-deductions<0 THEN 'net would be negative' WHEN e.status='Inactive' THEN 'employee not active' WHEN b.status='Paid' THEN 'paid record is locked' ELSE '' END AS reason
          FROM r_bad_pay b JOIN r_emp e ON b.emp_id=e.emp_id""")
def load_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("emp_id"), (F.col("c_acctbal") < 0).alias("inactive"))
    reason = (
        F.when(F.col("gross") - F.col("deductions") < 0, "net would be negative")
        .when(F.col("inactive"), "employee not active")
        .when(F.col("status") == "Paid", "paid record is locked")
        .otherwise("")
    )
    rows = roles.defective_payroll(spark, sf_dir).join(staff, "emp_id").withColumn("reason", reason)
    return rows.withColumn("outcome", F.when(F.col("reason") == "", "accepted").otherwise("rejected"))


# ---- suites -----------------------------------------------------------------
# The checks of each suite, with their enumerations, limits and formats.
EMP_SUITE = [dq.complete("emp_code"), dq.complete("email"), dq.complete("dob", 90.0), dq.complete("basic_salary", 80.0),
    dq.unique("emp_code"), dq.unique("email"), dq.unique("last_name"), dq.within("salary", -1000, 9000),
    ("valid_status", "status IN ('Active','Inactive','Terminated','On-Leave')"),
    ("valid_gender", "gender IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY')"), ("emp_code_format", "emp_code LIKE 'EMP%'")]
PAY_SUITE = [dq.complete("emp_id"), dq.complete("period"), dq.complete("gross"), dq.complete("net"), dq.unique("payroll_id"),
    dq.within("gross", 0, 5000000), dq.within("net", 0, 5000000), dq.within("pf", 0, 1800), dq.within("days_present", 0, 31),
    ("net_le_gross", "coalesce(net,0) <= coalesce(nullif(gross,0),1)"),
    ("positive_values", "coalesce(gross,0)>=0 AND coalesce(net,0)>=0 AND coalesce(pf,0)>=0"),
    ("valid_status", "status IN ('Draft','Approved','Paid','Cancelled','Revised')")]
ATT_SUITE = [dq.complete("emp_id"), dq.complete("att_date"), dq.complete("status"), dq.unique("att_id"), dq.within("hours", 0, 16),
    ("valid_att_status", "status IN ('Present','Absent','Half-Day','Holiday','Weekend','On-Leave')"),
    ("hours_when_present", "NOT (status='Present' AND coalesce(hours,0)<4)")]


def suite(spec: list) -> list[dq.Check]:
    return [dq.consistent(*c) if isinstance(c, tuple) else c for c in spec]


def check_sql(view: str, spec: list) -> str:
    """The suite as SQL, one SELECT per check."""
    parts = []
    for c in spec:
        if isinstance(c, tuple):
            parts.append(f"SELECT '{c[0]}' AS check_name, count(*) AS total, count(*) FILTER (WHERE NOT coalesce({c[1]},false)) AS violations, NULL AS low, NULL AS high, -1 AS thr FROM {view}")
        elif c.kind == "completeness":
            parts.append(f"SELECT '{c.name}', count(*), count(*) FILTER (WHERE {c.field} IS NULL OR trim(CAST({c.field} AS VARCHAR))=''), NULL, NULL, {c.threshold} FROM {view}")
        elif c.kind == "range":
            parts.append(f"SELECT '{c.name}', count(*), count(*) FILTER (WHERE NOT coalesce({c.field},0) BETWEEN {c.low} AND {c.high}), min(coalesce({c.field},0)), max(coalesce({c.field},0)), -1 FROM {view}")
        else:
            parts.append(f"SELECT '{c.name}', coalesce(sum(n),0), count(*) FILTER (WHERE n>1), NULL, NULL, -1 FROM (SELECT {c.field}, count(*) AS n FROM {view} WHERE {c.field} IS NOT NULL AND CAST({c.field} AS VARCHAR) NOT IN ('','0') GROUP BY 1)")
    head = "SELECT NULL AS check_name, 0 AS total, 0 AS violations, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, CAST(0 AS DOUBLE) AS thr WHERE false"
    body = " UNION ALL ".join([head, *parts])
    return f"SELECT check_name, total, violations, CASE WHEN thr>=0 THEN CAST((total-violations)*100.0/total >= thr AS INT) ELSE CAST(violations=0 AS INT) END AS passed, low, high FROM ({body})"


EMP_VIEW = "(SELECT *, TRY_CAST(basic_salary AS DECIMAL(18,2)) AS salary FROM r_dirty_emp)"
CHECK_COLS = "check_name:s total:l violations:l passed:l low:d high:d"


def employee_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.dirty_employees(spark, sf_dir).withColumn("salary", F.col("basic_salary").try_cast("decimal(18,2)"))


def _by_kind(key: str, kind: str) -> None:
    spec = [c for c in PAY_SUITE if not isinstance(c, tuple) and c.kind == kind] if kind != "consistency" else [c for c in PAY_SUITE if isinstance(c, tuple)]
    extra = [c for c in EMP_SUITE if not isinstance(c, tuple) and c.kind == kind] if kind != "consistency" else [c for c in EMP_SUITE if isinstance(c, tuple)]

    @query(key, "dataset:s " + CHECK_COLS,
           f"SELECT 'payroll_records' AS dataset, * FROM ({check_sql('r_bad_pay', spec)}) UNION ALL SELECT 'employees', * FROM ({check_sql(EMP_VIEW, extra)})")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        pay = dq.run_checks(roles.defective_payroll(spark, sf_dir), suite(spec)).withColumn("dataset", F.lit("payroll_records"))
        emp = dq.run_checks(employee_frame(spark, sf_dir), suite(extra)).withColumn("dataset", F.lit("employees"))
        return pay.unionByName(emp)


for _kind in ("completeness", "uniqueness", "range", "consistency"):
    _by_kind(f"dq_{_kind}", _kind)


@query("dq_report", CHECK_COLS, check_sql("r_bad_pay", PAY_SUITE))
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.run_suite(roles.defective_payroll(spark, sf_dir), suite(PAY_SUITE))


@query("dq_examples", "check_name:s example:s times:l",
       f"""SELECT * FROM (SELECT 'uniqueness_emp_code' AS check_name, emp_code AS example, count(*) AS times FROM (SELECT *, 1 FROM r_bad_pay) WHERE emp_code<>'' GROUP BY 2 HAVING count(*)>1 ORDER BY times DESC, example LIMIT 5)
           UNION ALL SELECT * FROM (SELECT 'range_net', CAST(payroll_id AS VARCHAR), 1 FROM r_bad_pay WHERE net<0 ORDER BY payroll_id LIMIT 5)
           UNION ALL SELECT * FROM (SELECT 'completeness_basic', CAST(payroll_id AS VARCHAR), 1 FROM r_bad_pay WHERE basic IS NULL ORDER BY payroll_id LIMIT 5)
           UNION ALL SELECT * FROM (SELECT 'net_le_gross', CAST(payroll_id AS VARCHAR), 1 FROM r_bad_pay WHERE net>gross ORDER BY payroll_id LIMIT 5)""")
def dq_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = settled(roles.defective_payroll(spark, sf_dir))
    checks = [dq.unique("emp_code"), dq.within("net", 0, 1e12), dq.complete("basic"), dq.consistent("net_le_gross", "net <= gross")]
    return reduce(DataFrame.unionByName, [dq.examples(rows, c, "payroll_id", 5) for c in checks])


def _score_sql(name: str, view: str, spec: list) -> str:
    return f"SELECT '{name}' AS dataset, count(*) AS total_checks, sum(passed) AS passed, {r('sum(passed)*100.0/count(*)',1)} AS score FROM ({check_sql(view, spec)})"


SCORES = " UNION ALL ".join([_score_sql("employees", EMP_VIEW, EMP_SUITE), _score_sql("payroll_records", "r_bad_pay", PAY_SUITE), _score_sql("attendance", "r_att", ATT_SUITE)])


@query("dq_scoreboard", "dataset:s total_checks:l passed:l score:d status:s",
       f"""WITH s AS ({SCORES}), a AS (SELECT * FROM s UNION ALL SELECT 'OVERALL', sum(total_checks), sum(passed), {r('sum(score)/count(*)',1)} FROM s)
           SELECT *, CASE WHEN score>=80 THEN 'PASS' WHEN score>=60 THEN 'WARN' ELSE 'FAIL' END AS status FROM a""")
def dq_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    suites = [
        ("employees", employee_frame(spark, sf_dir), EMP_SUITE),
        ("payroll_records", settled(roles.defective_payroll(spark, sf_dir), "records"), PAY_SUITE),  # read for rows and for keys
        ("attendance", roles.attendance(spark, sf_dir), ATT_SUITE),
    ]
    scores = reduce(DataFrame.unionByName, [dq.score(dq.run_checks(df, suite(spec)), n) for n, df, spec in suites])
    board = scores.rollup("dataset").agg(
        F.sum("total_checks").alias("total_checks"), F.sum("passed").alias("passed"),
        rounded(F.sum("score") / F.count("score"), 1).alias("score"),
    ).fillna("OVERALL", ["dataset"])
    return board.withColumn(
        "status", F.when(F.col("score") >= 80, "PASS").when(F.col("score") >= 60, "WARN").otherwise("FAIL")
    )


V = "CAST(value AS DECIMAL(18,2))"
MU, SD = f"(SELECT {avg(V)} FROM events)", f"(SELECT {std(V)} FROM events)"
FENCE = f"""(SELECT q1-1.5*(q3-q1) AS lo, q3+1.5*(q3-q1) AS hi FROM (SELECT max(CASE WHEN i=n//4+1 THEN v END) AS q1, max(CASE WHEN i=3*n//4+1 THEN v END) AS q3
   FROM (SELECT {V} AS v, row_number() OVER (ORDER BY value, event_id) AS i, count(*) OVER () AS n FROM events)))"""


@query("zscore_outliers", "event_id:l value:d z:d",
       f"SELECT event_id, value, {r('z',4)} AS z FROM (SELECT event_id, value, abs((CAST({V} AS DOUBLE)-{MU})/{SD}) AS z FROM events) WHERE z>3")
def zscore_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = dq.z_scores(table(spark, sf_dir, "events").select("event_id", "value"), "value")
    return scored.filter("z > 3").withColumn("z", rounded("z", 4))


@query("iqr_outliers", "event_id:l value:d", f"SELECT event_id, value FROM events, {FENCE} WHERE NOT {V} BETWEEN lo AND hi")
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.iqr_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value")


@query("salary_anomaly_profile", "total_records:l mean:d std_dev:d cv_pct:d z_outliers:l iqr_outliers:l normal_low:d normal_high:d",
       f"""SELECT count(*) AS total_records, {r('any_value(mu)')} AS mean, {r('any_value(sd)')} AS std_dev, {r('any_value(sd)/any_value(mu)*100')} AS cv_pct,
           count(*) FILTER (WHERE abs((CAST({V} AS DOUBLE)-mu)/sd)>3) AS z_outliers, count(*) FILTER (WHERE NOT {V} BETWEEN lo AND hi) AS iqr_outliers,
           {r('any_value(mu)-2*any_value(sd)')} AS normal_low, {r('any_value(mu)+2*any_value(sd)')} AS normal_high
           FROM events, (SELECT {avg(V)} AS mu, {std(V)} AS sd FROM events), {FENCE}""")
def salary_anomaly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.anomaly_profile(table(spark, sf_dir, "events"), "value")


@query("low_attendance", "payroll_id:l emp_id:l days_present:l attendance_pct:d flag:s",
       f"SELECT payroll_id, emp_id, days_present, {r(pct('days_present','working_days'),1)} AS attendance_pct, 'LOW_ATTENDANCE' AS flag FROM r_pay WHERE days_present*100.0/working_days<50")
def low_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.low_attendance(roles.payroll(spark, sf_dir))


@query("payroll_spikes", "emp_id:l payroll_id:l prev:d net:d change_pct:d flag:s",
       f"""SELECT emp_id, payroll_id, prev, net, {r('c',1)} AS change_pct, 'SALARY_SPIKE' AS flag FROM (SELECT *, CAST(abs(net-prev) AS DOUBLE)/CAST(prev AS DOUBLE)*100 AS c FROM
           (SELECT *, lag(net) OVER (PARTITION BY emp_id ORDER BY period, payroll_id) AS prev FROM r_pay) WHERE prev>0) WHERE c>30""")
def payroll_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pay = roles.payroll(spark, sf_dir).select("emp_id", "payroll_id", "net", (F.col("pay_year") * 12 + F.col("pay_month")).alias("month_no"))
    return dq.spikes(pay, "emp_id", "month_no", "payroll_id", "net")
