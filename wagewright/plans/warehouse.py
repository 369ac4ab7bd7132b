"""ETL, ELT, keyed loads, star schema, type-2 history, exports and the full run."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from wagewright.functions import calendar as cal
from wagewright.functions import rules
from wagewright.functions.numeric import mean, ratio, rounded, total
from wagewright.functions.text import row_hash
from wagewright.operators import loading, warehouse
from wagewright.operators.daily_run import daily_run
from wagewright.operators.payroll import salary_band
from wagewright.plans.relational import enrich
from wagewright.registry import query
from wagewright.session import scratch, settled
from wagewright.sources import roles
from wagewright.sources.role_sql import avg, pct, r
from wagewright.sources.tables import read_csv, table, write_csv, write_json

RAW = ["emp_id", "emp_code", "first_name", "last_name", "dept", "basic_salary", "gender", "dob", "email", "status"]
RAW_SQL = "(SELECT *, coalesce(TRY_CAST(nullif(trim(basic_salary),'') AS DECIMAL(18,2)),0) AS basic FROM r_dirty_emp)"


def landed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employee file as it lands: CSV, every column text."""
    path = scratch(spark, "employees-csv")
    write_csv(roles.dirty_employees(spark, sf_dir).select(*RAW), path)
    return read_csv(spark, path, RAW)


PF = "round(least(basic,CAST(15000 AS DECIMAL(18,2)))*CAST(0.12 AS DECIMAL(4,2)),2)"
ETL = f"""SELECT emp_id, emp_code, trim(first_name||' '||last_name) AS full_name, dept, basic, hra, da, basic+hra+da+1200 AS gross, pf, basic+hra+da+1200-pf AS net, status FROM
   (SELECT *, round(basic*CAST(0.35 AS DECIMAL(4,2)),2) AS hra, round(basic*CAST(0.17 AS DECIMAL(4,2)),2) AS da, {PF} AS pf FROM {RAW_SQL} WHERE basic>0)"""
ELT = f"""SELECT emp_id, emp_code, first_name||' '||last_name AS full_name, dept, basic, round(basic*CAST(0.35 AS DECIMAL(4,2)),2) AS hra, round(basic*CAST(0.17 AS DECIMAL(4,2)),2) AS da,
   round(basic*CAST(1.52 AS DECIMAL(4,2))+1200,2) AS gross, {PF} AS pf, CASE WHEN status='' THEN 'Unknown' ELSE status END AS status FROM {RAW_SQL} WHERE basic>0"""


@query("etl_transform", "emp_id:l emp_code:s full_name:s dept:s basic:d hra:d da:d gross:d pf:d net:d status:s", ETL)
def etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "etl")
    loading.etl_transform(landed_csv(spark, sf_dir)).write.parquet(out)
    return spark.read.parquet(out)


@query("elt_transform", "emp_id:l emp_code:s full_name:s dept:s basic:d hra:d da:d gross:d pf:d status:s", ELT)
def elt(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, out = scratch(spark, "elt-raw"), scratch(spark, "elt")
    landed_csv(spark, sf_dir).write.parquet(raw)
    loading.elt_transform(spark, spark.read.parquet(raw)).write.parquet(out)
    return spark.read.parquet(out)


@query("etl_elt_reconcile", "step:s etl_value:d elt_value:d difference:d",
       f"""SELECT 'extracted' AS step, count(*) AS etl_value, count(*) AS elt_value, 0 AS difference FROM r_dirty_emp UNION ALL
           SELECT 'loaded', a, b, a-b FROM (SELECT count(*) AS a FROM ({ETL})), (SELECT count(*) AS b FROM ({ELT})) UNION ALL
           SELECT 'gross', a, b, a-b FROM (SELECT sum(gross) AS a FROM ({ETL})), (SELECT sum(gross) AS b FROM ({ELT}))""")
def etl_elt_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both loads end in one metric row each; the two rows are compared."""
    raw = landed_csv(spark, sf_dir)
    stats = [F.count("*").alias("loaded"), F.sum("gross").alias("gross")]
    source = raw.agg(F.count("*").alias("extracted")).scalar()

    def metrics(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(*stats).select(
            source.cast("decimal(28,2)").alias("extracted"), F.col("loaded").cast("decimal(28,2)").alias("loaded"),
            F.col("gross").cast("decimal(28,2)").alias("gross"),
        )
        return one.unpivot([], ["extracted", "loaded", "gross"], "step", name)

    both = metrics(loading.etl_transform(raw), "etl_value").join(metrics(loading.elt_transform(spark, raw), "elt_value"), "step")
    return both.withColumn("difference", F.col("etl_value") - F.col("elt_value"))


INGEST_BAD = "(emp_code='' OR TRY_CAST(CASE WHEN trim(basic_salary)='' THEN '0' ELSE basic_salary END AS DOUBLE) IS NULL OR TRY_CAST(basic_salary AS DOUBLE)<0)"


@query("ingest_batches", "total:l loaded:l failed:l replaced:l table_rows:l net:d",
       f"""SELECT count(*) AS total, count(*) FILTER (WHERE NOT bad) AS loaded, count(*) FILTER (WHERE bad) AS failed, (SELECT count(*) FROM {RAW_SQL} WHERE NOT coalesce({INGEST_BAD},false) AND emp_id%3=0) AS replaced,
           count(DISTINCT CASE WHEN NOT bad OR emp_id%3=0 THEN emp_id END) AS table_rows,
           (SELECT sum(round(basic*CAST(1.52 AS DECIMAL(4,2))+1200-least(basic,CAST(15000 AS DECIMAL(18,2)))*CAST(0.12 AS DECIMAL(4,2)),2)) FROM {RAW_SQL} WHERE NOT coalesce({INGEST_BAD},false)) AS net
           FROM (SELECT emp_id, coalesce({INGEST_BAD},false) AS bad FROM r_dirty_emp UNION ALL SELECT emp_id, coalesce({INGEST_BAD},false) FROM r_dirty_emp WHERE emp_id%50=0)""")
def ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load over a table that holds every third employee without pay: validate, split, replace by key, error table.

    Some rows are sent twice. The sent rows are parsed once and written in one
    pass, parted by outcome; totals are observed in that pass.
    """
    rows = roles.dirty_employees(spark, sf_dir)
    good, bad = loading.split_ingest(rows.unionByName(rows.filter("emp_id % 50 = 0")))
    landed, seen = scratch(spark, "ingested"), Observation()
    both = good.withColumn("outcome", F.lit("loaded")).unionByName(bad.withColumn("outcome", F.lit("failed")), allowMissingColumns=True)
    loaded = F.col("outcome") == "loaded"
    counted = both.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(loaded).alias("loaded"), F.count_if(~loaded).alias("failed"))
    counted.write.partitionBy("outcome").parquet(landed)
    accepted = spark.read.schema(both.schema).parquet(landed).filter(loaded).select(*good.columns)
    held = rows.filter("emp_id % 3 = 0").select(
        "emp_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema.fields if f.name not in ("emp_id", "net")],
        F.lit(0).cast("decimal(18,2)").alias("net"),
    ).select(*good.columns)
    table_now = loading.upsert(held, accepted, ["emp_id"], [F.col("emp_code")])
    replaced = accepted.select("emp_id").distinct().join(held.select("emp_id"), "emp_id", "left_semi").agg(F.count("*").alias("replaced"))
    now = table_now.agg(F.count("*").alias("table_rows"), F.sum("net").alias("net"))
    counts = seen.get
    return now.withColumns({n: F.lit(counts[n]) for n in ("total", "loaded", "failed")}).withColumn("replaced", replaced.scalar())


KEYED = "emp_id:l period:s payroll_id:l gross:d status:s"


def keyed_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = roles.payroll_headers(spark, sf_dir).filter(roles.paid_before(1999))
    latest = Window.partitionBy("emp_id", "period").orderBy(F.col("payroll_id").desc())
    return old.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").select("emp_id", "period", "payroll_id", "gross", "status")


TARGET = "(SELECT emp_id, period, payroll_id, gross, status FROM r_ord WHERE pay_year<1999 QUALIFY row_number() OVER (PARTITION BY emp_id, period ORDER BY payroll_id DESC)=1)"
SOURCE = "(SELECT emp_id, period, payroll_id, gross, status FROM r_ord WHERE pay_year>=1998 QUALIFY row_number() OVER (PARTITION BY emp_id, period ORDER BY payroll_id)=1)"


@query("upsert_replace", KEYED, f"SELECT * FROM {SOURCE} UNION ALL SELECT * FROM {TARGET} t WHERE NOT EXISTS (SELECT 1 FROM {SOURCE} s WHERE s.emp_id=t.emp_id AND s.period=t.period)")
def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = roles.payroll_headers(spark, sf_dir).filter(roles.paid_from(1998))
    return loading.upsert(keyed_target(spark, sf_dir), source, ["emp_id", "period"], [F.col("payroll_id")])


@query("insert_ignore", KEYED, f"SELECT * FROM {TARGET} UNION ALL SELECT * FROM {SOURCE} s WHERE NOT EXISTS (SELECT 1 FROM {TARGET} t WHERE s.emp_id=t.emp_id AND s.period=t.period)")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = roles.payroll_headers(spark, sf_dir).filter(roles.paid_from(1998))
    return loading.insert_ignore(keyed_target(spark, sf_dir), source, ["emp_id", "period"], [F.col("payroll_id")])


# ---- star schema --------------------------------------------------------------
FY = "'FY' || CASE WHEN month(d)>=4 THEN year(d) ELSE year(d)-1 END || '-' || lpad(CAST((CASE WHEN month(d)>=4 THEN year(d)+1 ELSE year(d) END)%100 AS VARCHAR),2,'0')"


@query("star_dim_period", "period_key:l period:s year:l month:l start_date:s end_date:s quarter:s fiscal_year:s",
       f"""SELECT year(d)*10000+month(d)*100+1 AS period_key, strftime(d,'%Y-%m') AS period, year(d) AS year, month(d) AS month, strftime(d,'%Y-%m-%d') AS start_date, strftime(last_day(d),'%Y-%m-%d') AS end_date,
           'Q' || quarter(d) AS quarter, {FY} AS fiscal_year FROM (SELECT DISTINCT date_trunc('month',o_orderdate) AS d FROM orders)""")
def star_dim_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.period_dimension(table(spark, sf_dir, "orders"), "o_orderdate")


def dim_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surrogate key is a function of the natural key alone, so a new department renumbers none; 0 stays free."""
    return roles.departments_base(spark, sf_dir).withColumn("dept_key", (F.col("dept_id") + 1).cast("bigint"))


def dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate key by hash of the natural key: no ordering over all employees."""
    people = roles.employees(spark, sf_dir)
    return people.select(
        F.xxhash64("emp_id").alias("emp_key"), "emp_id", "emp_code", "name", "dept_id", "gender", "status", "pay_basic",
        salary_band(F.col("pay_basic")).alias("salary_band"), row_hash("basic", "dept_id", "gender").alias("row_hash"),
    )


FACT = f"""(SELECT payroll_id, emp_id, dept_id+1 AS dept_key, pay_year*10000+pay_month*100+1 AS period_key, dept_name, emp_code, name, period, pay_year, pay_month, gender, pay_basic, gross, net, tds, pf, esi_er, days_present, working_days,
   {r(pct('tds','gross'))} AS effective_tax_rate, {r(pct('net','gross'))} AS take_home_ratio FROM r_wide WHERE status='Paid')"""


TITLE = "CASE WHEN pay_basic>=200000 THEN 4 WHEN pay_basic>=100000 THEN 3 WHEN pay_basic>=50000 THEN 2 ELSE 1 END"


def level_of(basic: str) -> Column:
    """Rank of the salary band, 1 to 4, read from the label so that the limits stand in one place."""
    band = salary_band(F.col(basic))
    return F.when(band == "Senior", 4).when(band == "Lead", 3).when(band == "Mid", 2).otherwise(1).cast("bigint")


@query("star_dim_designation", "desig_key:l dept_key:l title:s level:l staff:l",
       f"""SELECT (dept_id+1)*10+lv AS desig_key, dept_id+1 AS dept_key, ['Junior','Mid','Lead','Senior'][lv] || ' ' || dept_name AS title, lv AS level, count(*) AS staff
           FROM (SELECT dept_id, dept_name, {TITLE} AS lv FROM r_emp) GROUP BY dept_id, dept_name, lv""")
def star_dim_designation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Designations in use: a band within a department, keyed by both, so none is renumbered."""
    return designations(roles.employees(spark, sf_dir))


def designations(staff: DataFrame) -> DataFrame:
    people = staff.select("dept_id", "dept_name", salary_band(F.col("pay_basic")).alias("band"), level_of("pay_basic").alias("level"))
    used = people.groupBy("dept_id", "dept_name", "band", "level").agg(F.count("*").alias("staff"))
    dept_key = F.col("dept_id") + 1
    return used.select(
        (dept_key * 10 + F.col("level")).alias("desig_key"), dept_key.alias("dept_key"),
        F.concat_ws(" ", "band", "dept_name").alias("title"), "level", "staff",
    )


@query("star_dim_grade", "grade_key:l grade_code:s hra_pct:d da_pct:d staff:l",
       "SELECT grade_id AS grade_key, grade_code, hra_pct, da_pct, count(*) AS staff FROM r_emp JOIN r_grade ON pay_basic>=basic_min AND pay_basic<basic_max GROUP BY 1,2,3,4")
def star_dim_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades in use with the staff in each."""
    return grades(roles.employees(spark, sf_dir))


def grades(staff: DataFrame) -> DataFrame:
    graded = staff.select(roles.grade_of(F.col("pay_basic")).alias("g")).select("g.*")
    return graded.groupBy(F.col("grade_id").cast("bigint").alias("grade_key"), "grade_code", "hra_pct", "da_pct").agg(F.count("*").alias("staff"))


def fact_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid records with employee, department and period; the period's columns follow from its own month."""
    paid = roles.payroll(spark, sf_dir).filter("status = 'Paid'")
    people = dim_employee(spark, sf_dir).select("emp_key", "emp_id", "emp_code", "name", "dept_id", "gender", "pay_basic", "salary_band")
    depts = dim_department(spark, sf_dir).select("dept_key", "dept_id", "dept_name")
    year, month = F.col("pay_year"), F.col("pay_month")
    return paid.join(people, "emp_id").join(depts, "dept_id").withColumns({
        "period_key": cal.month_key(year, month).cast("bigint"), "fiscal_year": cal.fiscal_year(year, month),
        "quarter": F.concat(F.lit("Q"), F.ceil(month / 3).cast("string")),
        "effective_tax_rate": rounded(ratio("tds", "gross", 100)), "take_home_ratio": rounded(ratio("net", "gross", 100)),
    })


@query("star_fact_payroll", "payroll_id:l emp_id:l dept_key:l desig_key:l grade_key:l period_key:l gross:d net:d tds:d effective_tax_rate:d take_home_ratio:d",
       f"""SELECT payroll_id, emp_id, dept_key, dept_key*10+{TITLE} AS desig_key, grade_id AS grade_key, period_key, gross, net, tds, effective_tax_rate, take_home_ratio
           FROM {FACT} f JOIN r_grade g ON f.pay_basic>=g.basic_min AND f.pay_basic<g.basic_max""")
def star_fact_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five surrogate keys resolved against their dimensions; rows that miss one are dropped.

    The keys that hang on the employee are resolved once for each employee, against dimensions made from the same stored staff; the records then meet
    staff and periods only.
    """
    def stored(dim: DataFrame, label: str, *names: str) -> DataFrame:
        return settled(dim.select(*names), label)  # the file size decides whether it is broadcast

    people = roles.employees(spark, sf_dir).select("emp_id", "dept_id", "dept_name", "pay_basic")
    staff = settled(people, "staff")
    keyed = staff.select(
        "emp_id", (F.col("dept_id") + 1).cast("bigint").alias("dept_key"), level_of("pay_basic").alias("level"), roles.grade_of(F.col("pay_basic"))["grade_code"].alias("grade_code")
    )
    desigs = stored(designations(staff), "dim-designation", "desig_key", "dept_key", "level")
    ranks = stored(grades(staff), "dim-grade", "grade_key", "grade_code")
    depts = stored(dim_department(spark, sf_dir), "dim-department", "dept_key")
    keys = keyed.join(depts, "dept_key", "left_semi").join(desigs, ["dept_key", "level"]).join(ranks, "grade_code")
    keys = settled(keys.select("emp_id", "dept_key", "desig_key", "grade_key"), "staff-keys")
    periods = stored(star_dim_period(spark, sf_dir), "dim-period", "period_key")
    paid = roles.payroll(spark, sf_dir).filter("status = 'Paid'").select(
        "payroll_id", "emp_id", cal.month_key(F.col("pay_year"), F.col("pay_month")).cast("bigint").alias("period_key"), "gross", "net", "tds",
        rounded(ratio("tds", "gross", 100)).alias("effective_tax_rate"), rounded(ratio("net", "gross", 100)).alias("take_home_ratio"),
    )
    return paid.join(keys, "emp_id").join(periods, "period_key", "left_semi")


@query("star_fact_attendance", "att_id:l emp_id:l dept_key:l period_key:l att_date:s att_status:s hours:d is_present:l is_late:l",
       """SELECT att_id, a.emp_id, dept_id+1 AS dept_key, year(att_date)*10000+month(att_date)*100+1 AS period_key, strftime(att_date,'%Y-%m-%d') AS att_date, a.status AS att_status, hours,
          CASE WHEN a.status='Present' THEN 1 ELSE 0 END AS is_present, CASE WHEN a.status='Present' AND hours<8 THEN 1 ELSE 0 END AS is_late FROM r_att a JOIN r_emp e ON a.emp_id=e.emp_id""")
def star_fact_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = dim_employee(spark, sf_dir).select("emp_key", "emp_id", "dept_id")
    depts = dim_department(spark, sf_dir).select("dept_key", "dept_id")
    present = F.col("status") == "Present"
    return roles.attendance(spark, sf_dir).join(people, "emp_id").join(depts, "dept_id").select(
        "att_id", "emp_id", "dept_key", cal.month_key(F.year("att_date"), F.month("att_date")).alias("period_key"),
        F.date_format("att_date", "yyyy-MM-dd").alias("att_date"), F.col("status").alias("att_status"), "hours",
        present.cast("int").alias("is_present"), (present & (F.col("hours") < 8)).cast("int").alias("is_late"),
    )


BAND = "CASE WHEN pay_basic>=200000 THEN 'Senior' WHEN pay_basic>=100000 THEN 'Lead' WHEN pay_basic>=50000 THEN 'Mid' ELSE 'Junior' END"


@query("olap_fact_payroll", "payroll_id:l emp_id:l date_key:l salary_band:s attendance_pct:d take_home_pct:d tax_rate_pct:d employer_cost:d annual_ctc:d",
       f"""SELECT payroll_id, emp_id, period_key AS date_key, {BAND} AS salary_band, {r(pct('days_present','working_days'),1)} AS attendance_pct, take_home_ratio AS take_home_pct, effective_tax_rate AS tax_rate_pct,
           gross+pf+esi_er AS employer_cost, gross*12+pf*12 AS annual_ctc FROM {FACT}""")
def olap_fact_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_payroll(spark, sf_dir).withColumns({
        "date_key": F.col("period_key"), "attendance_pct": rounded(ratio("days_present", "working_days", 100), 1),
        "take_home_pct": F.col("take_home_ratio"), "tax_rate_pct": F.col("effective_tax_rate"),
        "employer_cost": F.col("gross") + F.col("pf") + F.col("esi_er"), "annual_ctc": F.col("gross") * 12 + F.col("pf") * 12,
    })


@query("dw_dept_cost_by_period", "dept_name:s period:s headcount:l gross:d net:d tds:d",
       f"SELECT dept_name, period, count(*) AS headcount, sum(gross) AS gross, sum(net) AS net, sum(tds) AS tds FROM {FACT} WHERE pay_year=1999 GROUP BY 1,2")
def dw_dept_cost_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_payroll(spark, sf_dir).filter(roles.in_year(1999)).groupBy("dept_name", "period").agg(
        F.count("*").alias("headcount"), F.sum("gross").alias("gross"), F.sum("net").alias("net"), F.sum("tds").alias("tds")
    )


@query("dw_ytd_by_employee", "emp_code:s name:s ytd_net:d avg_take_home:d",
       f"SELECT emp_code, name, sum(net) AS ytd_net, {r('CAST(sum(CAST(take_home_ratio AS DECIMAL(18,2))) AS DOUBLE)/count(*)',4)} AS avg_take_home FROM {FACT} WHERE pay_year=1999 GROUP BY emp_id, 1, 2 ORDER BY ytd_net DESC, emp_id LIMIT 10")
def dw_ytd_by_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_payroll(spark, sf_dir).filter(roles.in_year(1999)).groupBy("emp_id", "emp_code", "name").agg(
        F.sum("net").alias("ytd_net"), rounded(mean("take_home_ratio"), 4).alias("avg_take_home")
    ).orderBy(F.col("ytd_net").desc(), "emp_id").limit(10)


CUBE = f"""(SELECT dept_name, pay_year, pay_month, 'Q' || ((pay_month-1)//3+1) AS quarter, count(*) AS headcount, sum(gross) AS total_gross, sum(net) AS total_net, sum(tds) AS total_tds, sum(pf) AS total_pf,
   sum(gross+pf+esi_er) AS employer_cost, {r(avg('net'))} AS avg_net, max(net) AS max_net, min(net) AS min_net FROM {FACT} GROUP BY 1,2,3)"""
CUBE_COLS = "dept_name:s pay_year:l pay_month:l quarter:s headcount:l total_gross:d total_net:d total_tds:d total_pf:d employer_cost:d avg_net:d max_net:d min_net:d"


def dept_month_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pre-aggregate as a stored table, partitioned by year."""
    path = scratch(spark, "cube")
    cube = fact_payroll(spark, sf_dir).groupBy("dept_name", "pay_year", "pay_month", "quarter").agg(
        F.count("*").alias("headcount"), F.sum("gross").alias("total_gross"), F.sum("net").alias("total_net"), F.sum("tds").alias("total_tds"),
        F.sum("pf").alias("total_pf"), F.sum(F.col("gross") + F.col("pf") + F.col("esi_er")).alias("employer_cost"),
        rounded(mean("net")).alias("avg_net"), F.max("net").alias("max_net"), F.min("net").alias("min_net"),
    )
    loading.write_partitioned(cube, path, ["pay_year"])
    return spark.read.parquet(path)


@query("agg_dept_month", CUBE_COLS, f"SELECT * FROM {CUBE}")
def agg_dept_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dept_month_cube(spark, sf_dir)


@query("oltp_vs_cube", "dept_name:s joined_net:d cube_net:d same:l",
       "SELECT dept_name, sum(net) AS joined_net, sum(net) AS cube_net, 1 AS same FROM r_wide WHERE status='Paid' GROUP BY 1")
def oltp_vs_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised join and the stored pre-aggregate must give the same answer."""
    paid = roles.payroll(spark, sf_dir).filter("status = 'Paid'")
    joined = roles.wide_payroll(spark, sf_dir, paid).groupBy("dept_name").agg(F.sum("net").alias("joined_net"))
    cube = dept_month_cube(spark, sf_dir).groupBy("dept_name").agg(F.sum("total_net").alias("cube_net"))
    return joined.join(cube, "dept_name", "full").withColumn("same", F.col("joined_net").eqNullSafe(F.col("cube_net")).cast("int"))


@query("scd2_dim_employee", "emp_id:l version_id:l priority:s effective_from:s effective_to:s is_current:l",
       """SELECT emp_id, version_id, priority, strftime(f,'%Y-%m-%d') AS effective_from, strftime(t,'%Y-%m-%d') AS effective_to, CASE WHEN t IS NULL THEN 1 ELSE 0 END AS is_current FROM
          (SELECT *, lead(f) OVER (PARTITION BY emp_id ORDER BY f, version_id) AS t FROM (SELECT emp_id, payroll_id AS version_id, priority, pay_date AS f, lag(priority) OVER (PARTITION BY emp_id ORDER BY pay_date, payroll_id) AS p FROM r_ord) WHERE p IS NULL OR p<>priority)""")
def scd2_dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("emp_id"), F.col("o_orderkey").alias("version_id"), F.col("o_orderpriority").alias("priority"), "o_orderdate"
    )
    dim = warehouse.type2_history(history, "emp_id", "o_orderdate", "version_id", ["priority"])
    return dim.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("effective_from", "effective_to")})


@query("scd2_load", "emp_id:l basic:d dept_id:l effective_from:s effective_to:s is_current:l",
       """SELECT emp_id, basic, dept_id, '1995-01-01' AS effective_from, CASE WHEN nb<>basic THEN '2002-01-01' END AS effective_to, CASE WHEN nb<>basic THEN 0 ELSE 1 END AS is_current FROM n WHERE status='Active' UNION ALL
          SELECT emp_id, nb, dept_id, '2002-01-01', NULL, 1 FROM n WHERE status='Inactive' OR nb<>basic""".replace("FROM n", """FROM (SELECT e.emp_id, basic, dept_id, status, coalesce(v.nb, basic) AS nb FROM r_emp e LEFT JOIN
          (SELECT emp_id, max_by(new_basic,(effective,revision_id)) AS nb FROM r_rev WHERE effective>=TIMESTAMP '2001-06-01' GROUP BY 1) v ON v.emp_id=e.emp_id) n"""))
def scd2_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type-2 load: revised employees close and reopen, unknown ones are added."""
    people = roles.employees(spark, sf_dir).select("emp_id", "basic", "dept_id", "status")
    current = people.filter("status = 'Active'").select(
        "emp_id", "basic", "dept_id", row_hash("basic", "dept_id").alias("row_hash"), F.lit("1995-01-01").cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"), F.lit(1).alias("is_current"),
    )
    late = roles.revisions(spark, sf_dir).filter("effective >= '2001-06-01'").groupBy("emp_id").agg(
        F.max(F.struct("effective", "revision_id", "new_basic"))["new_basic"].alias("nb")
    )
    incoming = people.join(late, "emp_id", "left").select("emp_id", F.coalesce("nb", "basic").alias("basic"), "dept_id")
    out = warehouse.type2_apply(current, incoming, "emp_id", ["basic", "dept_id"], "2002-01-01")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("effective_from", "effective_to")})


# ---- exports and layouts --------------------------------------------------------
REGISTER = ["period", "payroll_id", "emp_code", "name", "dept_name", "gross", "pf", "tds", "deductions", "net", "status"]


@query("export_register", "period:s payroll_id:l emp_code:s name:s dept_name:s gross:d pf:d tds:d deductions:d net:d status:s", f"SELECT {', '.join(REGISTER)} FROM r_wide")
def export_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register as CSV with one folder per year, sorted inside each file."""
    path = scratch(spark, "register")
    rows = roles.wide_payroll(spark, sf_dir).select("pay_year", *REGISTER)
    ordered = rows.repartitionByRange("pay_year", "dept_name", "name", "payroll_id").sortWithinPartitions("pay_year", "dept_name", "name")
    write_csv(ordered, path, ("pay_year",))
    return read_csv(spark, path, REGISTER).withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("gross", "pf", "tds", "deductions", "net")})


@query("partitioned_write_manifest", "status:s pay_year:l added_rows:l", "SELECT status, pay_year, count(*) AS added_rows FROM r_ord GROUP BY 1,2")
def partitioned_write_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "partitioned")
    loading.write_partitioned(roles.payroll_headers(spark, sf_dir), path, ["status", "pay_year"])
    return loading.manifest(spark, path, ["status", "pay_year"])


@query("partition_pruned_read", "pay_month:l records:l gross:d", "SELECT pay_month, count(*) AS records, sum(gross) AS gross FROM r_ord WHERE status='Paid' AND pay_year=1999 GROUP BY 1")
def partition_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the folder status=Paid/pay_year=1999 is read."""
    path = scratch(spark, "pruned")
    loading.write_partitioned(roles.payroll_headers(spark, sf_dir), path, ["status", "pay_year"])
    found = spark.read.parquet(path).filter("status = 'Paid' AND pay_year = 1999")
    return found.groupBy("pay_month").agg(F.count("*").alias("records"), F.sum("gross").alias("gross"))


@query("archive_by_month", "year:l month:l records:l gross:d checksums:l",
       "SELECT pay_year AS year, pay_month AS month, count(*) AS records, sum(gross) AS gross, count(DISTINCT sha256(payroll_id || '|' || gross)) AS checksums FROM r_ord GROUP BY 1,2")
def archive_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archive")
    rows = roles.payroll_headers(spark, sf_dir).select(
        "payroll_id", "emp_id", "gross", F.col("pay_year").alias("year"), F.col("pay_month").alias("month"),
        F.sha2(F.concat_ws("|", F.col("payroll_id").cast("string"), F.col("gross").cast("string")), 256).alias("checksum"),
    )
    loading.write_partitioned(rows, path, ["year", "month"])
    return spark.read.parquet(path).groupBy("year", "month").agg(
        F.count("*").alias("records"), F.sum("gross").alias("gross"), F.countDistinct("checksum").alias("checksums")
    )


# Storage price per class, USD per GB and month.
STORAGE_RATES = [("STANDARD", 0.023), ("IA", 0.0125), ("GLACIER", 0.004), ("DEEP_ARCHIVE", 0.00099)]


@query("object_inventory", "prefix:s objects:l total_bytes:l " + " ".join(f"cost_{n.lower()}:d" for n, _ in STORAGE_RATES),
       "SELECT source AS prefix, count(*) AS objects, sum(n_chars) AS total_bytes, " + ", ".join(f"{r(f'CAST(sum(n_chars) AS DOUBLE)/1073741824.0*{v}',6)} AS cost_{n.lower()}" for n, v in STORAGE_RATES) + " FROM documents GROUP BY 1")
def object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("prefix")).agg(
        F.count("*").alias("objects"), F.sum("n_chars").alias("total_bytes")
    )
    gb = F.col("total_bytes").cast("double") / 1073741824.0
    return size.withColumns({f"cost_{n.lower()}": rounded(gb * v, 6) for n, v in STORAGE_RATES})


# Lifecycle rules per prefix (days until archived, days until removed).
LIFECYCLE = [("1-URGENT", 1500, 2300), ("2-HIGH", 1000, 2000), ("3-MEDIUM", 700, 1500), ("5-LOW", 200, 900)]


@query("retention_actions", "prefix:s action:s objects:l oldest_days:l",
       f"""SELECT priority AS prefix, CASE WHEN age>=del THEN 'expire' WHEN age>=tr THEN 'transition' ELSE 'keep' END AS action, count(*) AS objects, max(age) AS oldest_days FROM
           (SELECT priority, date_diff('day', CAST(pay_date AS DATE), DATE '2002-01-01') AS age, tr, del FROM r_ord LEFT JOIN (VALUES {', '.join(f"('{p}',{a},{b})" for p, a, b in LIFECYCLE)}) l(p,tr,del) ON p=priority) GROUP BY 1,2""")
def retention_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prefix without a rule keeps everything."""
    age = F.datediff(F.lit("2002-01-01").cast("date"), F.to_date("pay_date"))
    rows = roles.payroll_headers(spark, sf_dir).select("priority", age.alias("age"))
    action = F.lit("keep")
    for prefix, archive, remove in LIFECYCLE:
        ruled = F.when(F.col("age") >= remove, "expire").when(F.col("age") >= archive, "transition").otherwise("keep")
        action = F.when(F.col("priority") == prefix, ruled).otherwise(action)
    return rows.groupBy(F.col("priority").alias("prefix"), action.alias("action")).agg(
        F.count("*").alias("objects"), F.max("age").alias("oldest_days")
    )


# ---- KPI document and the full run ----------------------------------------------
def kpi_document(clean: DataFrame) -> DataFrame:
    """Totals with a department and a gender map, one nested row.

    The maps hold one entry per department or gender, not per record.
    """
    def breakdown(key: str) -> DataFrame:
        sums = clean.groupBy(key).agg(
            F.count("*").alias("count"), total("gross").alias("gross"), total("net").alias("net"), rounded(mean("net")).alias("avg_net")
        )
        entry = F.struct(F.col(key).alias("key"), F.struct("count", "gross", "net", "avg_net").alias("value"))
        return sums.agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(f"{key}_breakdown"))

    top = clean.agg(
        F.count("*").alias("total_employees"), total("gross").alias("total_gross"), total("net").alias("total_net"), total("tds").alias("total_tds"),
        rounded(mean("net")).alias("avg_net"), F.max("net").cast("double").alias("max_net"),
        F.coalesce(F.min(F.when(F.col("net") > 0, F.col("net"))), F.lit(0)).cast("double").alias("min_net"),
        rounded(mean("take_home_pct")).alias("avg_take_home"), rounded(mean("attendance_pct")).alias("avg_attendance"),
    )
    maps = {f"{k}_breakdown": breakdown(k).scalar() for k in ("dept_name", "gender")}
    return top.withColumns(maps)


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll with planted defects, joined to staff, with the list of rule violations."""
    people = roles.employees(spark, sf_dir).select("emp_id", "name", "dept_name", "gender")
    return roles.defective_payroll(spark, sf_dir).join(people, "emp_id").withColumn("errors", rules.register_errors())


BAD = "(b.emp_code='' OR net<0 OR gross=0 OR net>coalesce(nullif(gross,0),1))"
CLEAN = f"""(SELECT b.*, e.name, e.dept_name, e.location, e.gender, {r(pct('net','gross'))} AS take_home_pct, {r(pct('days_present','working_days'),1)} AS attendance_pct FROM r_bad_pay b JOIN r_emp e ON b.emp_id=e.emp_id WHERE NOT {BAD})"""


@query("kpi_document", "section:s name:s records:l gross:d net:d avg_net:d",
       f"""SELECT 'total' AS section, 'all' AS name, count(*) AS records, sum(gross) AS gross, sum(net) AS net, {r(avg('net'))} AS avg_net FROM {CLEAN} UNION ALL
           SELECT 'dept', dept_name, count(*), sum(gross), sum(net), {r(avg('net'))} FROM {CLEAN} GROUP BY 2 UNION ALL SELECT 'gender', gender, count(*), sum(gross), sum(net), {r(avg('net'))} FROM {CLEAN} GROUP BY 2""")
def kpi_document_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested document is written as JSON, read back with a declared schema and unfolded."""
    clean = enrich(validated(spark, sf_dir).filter(F.size("errors") == 0))
    path = scratch(spark, "kpi")
    write_json(kpi_document(clean), path)
    entry = "map<string, struct<count: bigint, gross: double, net: double, avg_net: double>>"
    doc = spark.read.schema(
        f"total_employees bigint, total_gross double, total_net double, avg_net double, dept_name_breakdown {entry}, gender_breakdown {entry}"
    ).json(path)
    whole = doc.select(
        F.lit("total").alias("section"), F.lit("all").alias("name"), F.col("total_employees").alias("records"),
        F.col("total_gross").alias("gross"), F.col("total_net").alias("net"), "avg_net",
    )

    def unfold(column: str, section: str) -> DataFrame:
        rows = doc.select(F.explode(column).alias("name", "v"))
        return rows.select(F.lit(section).alias("section"), "name", F.col("v.count").alias("records"), "v.gross", "v.net", "v.avg_net")

    return reduce(DataFrame.unionByName, [whole, unfold("dept_name_breakdown", "dept"), unfold("gender_breakdown", "gender")])


GOOD_RUN = f"""SELECT 'good' AS run, 'ingested' AS stage, count(*) AS rows, 'success' AS status, 0 AS has_error FROM r_bad_pay UNION ALL SELECT 'good', 'clean', count(*), 'success', 0 FROM {CLEAN} UNION ALL SELECT 'good', 'stored', count(*), 'success', 0 FROM {CLEAN}
   UNION ALL SELECT 'good', 'issues', (SELECT count(*) FROM r_bad_pay)-(SELECT count(*) FROM {CLEAN}), 'success', 0 UNION ALL SELECT 'good', 'exported', count(DISTINCT dept_name), 'success', 0 FROM {CLEAN}"""


@query("run_stage_metrics", "run:s stage:s rows:l status:s has_error:l",
       f"""SELECT * FROM ({GOOD_RUN}) UNION ALL SELECT 'broken', stage, CASE WHEN stage<>'stored' THEN rows END, CASE WHEN stage='stored' THEN 'failed' ELSE 'success' END, CASE WHEN stage='stored' THEN 1 ELSE 0 END FROM ({GOOD_RUN}) WHERE stage<>'exported'
           UNION ALL SELECT run, 'whole run', rows, CASE WHEN run='good' THEN 'success' ELSE 'failed' END, CASE WHEN run='good' THEN 0 ELSE 1 END FROM (SELECT unnest(['good','broken']) AS run, (SELECT count(*) FROM r_bad_pay) AS rows)""")
def run_stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log and the summaries after a full run and after one whose enrichment fails."""
    root = scratch(spark, "run")
    records = validated(spark, sf_dir).drop("errors")

    def broken(clean: DataFrame) -> DataFrame:
        return clean.withColumn("rate", F.raise_error(F.lit("no rate for this period")))

    for name, step in (("good", enrich), ("broken", broken)):
        try:
            daily_run(spark, records, step, f"{root}/{name}", name)
        except PySparkException:
            if name == "good":
                raise
    stages = spark.read.parquet(f"{root}/*/run_log").select(
        F.col("run_ts").alias("run"), "stage", "rows", "status", F.col("error").isNotNull().cast("int").alias("has_error")
    )
    runs = spark.read.parquet(f"{root}/*/run_summary").select(
        F.col("run_ts").alias("run"), F.lit("whole run").alias("stage"), F.col("rows_in").alias("rows"), "status",
        (F.col("failed") > 0).cast("int").alias("has_error"),
    )
    return stages.unionByName(runs)


@query("end_to_end_kpis", "dept_name:s records:l issues:l clean:l total_gross:d total_net:d total_tds:d total_pf:d avg_net:d max_net:d min_net:d avg_take_home:d avg_attendance:d",
       f"""SELECT dept_name, count(*) AS records, count(*) FILTER (WHERE bad) AS issues, count(*) FILTER (WHERE NOT bad) AS clean, sum(CASE WHEN NOT bad THEN gross END) AS total_gross, sum(CASE WHEN NOT bad THEN net END) AS total_net,
           sum(CASE WHEN NOT bad THEN tds END) AS total_tds, sum(CASE WHEN NOT bad THEN pf END) AS total_pf, {r(avg('CASE WHEN NOT bad THEN net END'))} AS avg_net, max(CASE WHEN NOT bad THEN net END) AS max_net,
           min(CASE WHEN NOT bad AND net>0 THEN net END) AS min_net, {r(avg('CASE WHEN NOT bad THEN CAST(take_home AS DECIMAL(18,2)) END'))} AS avg_take_home, {r(avg('CASE WHEN NOT bad THEN CAST(att AS DECIMAL(18,2)) END'))} AS avg_attendance
           FROM (SELECT b.*, e.dept_name, {BAD} AS bad, {r(pct('net','gross'))} AS take_home, {r(pct('days_present','working_days'),1)} AS att FROM r_bad_pay b JOIN r_emp e ON b.emp_id=e.emp_id) GROUP BY 1""")
def end_to_end_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, validate, enrich, aggregate per department in one lazy plan."""
    rows = enrich(validated(spark, sf_dir))
    ok = F.size("errors") == 0

    def kept(c: str):
        return F.when(ok, F.col(c))

    return rows.groupBy("dept_name").agg(
        F.count("*").alias("records"), F.count_if(~ok).alias("issues"), F.count_if(ok).alias("clean"),
        F.sum(kept("gross")).alias("total_gross"), F.sum(kept("net")).alias("total_net"), F.sum(kept("tds")).alias("total_tds"),
        F.sum(kept("pf")).alias("total_pf"), rounded(mean(kept("net"))).alias("avg_net"), F.max(kept("net")).alias("max_net"),
        F.min(F.when(ok & (F.col("net") > 0), F.col("net"))).alias("min_net"),
        rounded(mean(kept("take_home_pct"))).alias("avg_take_home"), rounded(mean(kept("attendance_pct"))).alias("avg_attendance"),
    )
