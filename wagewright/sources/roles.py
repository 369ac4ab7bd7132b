"""Payroll roles bound to the given tables.

Small dimensions carry no broadcast hint: the planner broadcasts them when their
files are below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions.numeric import cents, exact_sum, rounded, stored_money
from wagewright.functions.text import employee_code
from wagewright.sources.tables import table

# Salary grades (code, basic from, HRA %, DA %, flat transport allowance).
GRADES = [
    ("G1", 15000, 10, 10, 500),
    ("G2", 25000, 20, 15, 800),
    ("G3", 40000, 30, 17, 1200),
    ("G4", 60000, 35, 18, 1500),
    ("G5", 85000, 38, 20, 2000),
    ("G6", 120000, 40, 22, 2500),
    ("G7", 160000, 42, 23, 3000),
    ("G8", 200000, 44, 24, 3500),
    ("G9", 250000, 45, 25, 4000),
]


def grade_of(basic: Column) -> Column:
    """Grade struct of a monthly basic; below the lowest band the first grade holds."""
    structs = [
        F.struct(
            F.lit(i + 1).alias("grade_id"),
            F.lit(code).alias("grade_code"),
            F.lit(hra).cast("decimal(5,2)").alias("hra_pct"),
            F.lit(da).cast("decimal(5,2)").alias("da_pct"),
            F.lit(ta).cast("decimal(18,2)").alias("ta_flat"),
        )
        for i, (code, _, hra, da, ta) in enumerate(GRADES)
    ]
    picked = structs[0]
    for (_, low, *_rest), grade in list(zip(GRADES, structs))[1:]:
        picked = F.when(basic >= F.lit(low), grade).otherwise(picked)
    return picked


def departments_base(spark: SparkSession, sf_dir: str, location: bool = False) -> DataFrame:
    """Departments, with the region as location only where it is asked for."""
    nation = table(spark, sf_dir, "nation")
    names = [F.col("n_nationkey").cast("bigint").alias("dept_id"), F.col("n_name").alias("dept_name")]
    if not location:
        return nation.select(*names)
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(*names, F.col("r_name").alias("location"))


def employees(spark: SparkSession, sf_dir: str, location: bool = False) -> DataFrame:
    basic = stored_money("c_acctbal")
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("emp_id"),
        employee_code("c_custkey").alias("emp_code"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@company.example")).alias("email"),
        F.col("c_nationkey").cast("bigint").alias("dept_id"),
        F.col("c_mktsegment").alias("gender"),
        basic.alias("basic"),
        (basic * F.lit(25)).cast("decimal(18,2)").alias("pay_basic"),
        F.when(F.col("c_acctbal") < 0, "Inactive").otherwise("Active").alias("status"),
    )
    return people.join(departments_base(spark, sf_dir, location), "dept_id")


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a manager (lowest employee id) and a budget (supplier balances)."""
    manager = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("dept_id")).agg(
        F.min("c_custkey").alias("manager_id")
    )
    budget = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("dept_id")).agg(
        F.sum(stored_money("s_acctbal")).alias("budget")
    )
    return departments_base(spark, sf_dir, location=True).join(manager, "dept_id", "left").join(budget, "dept_id", "left")


def paid_before(year: int) -> Column:
    return F.col("pay_date") < F.lit(f"{year}-01-01").cast("timestamp_ntz")


def paid_from(year: int) -> Column:
    return F.col("pay_date") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")


def in_year(year: int, last: int | None = None) -> Column:
    """Pay dates of a year (or of a run of years) as a range the Parquet scan can skip by."""
    day = F.col("pay_date")
    return (day >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (day < F.lit(f"{(last or year) + 1}-01-01").cast("timestamp_ntz"))


def in_month(year: int, month: int) -> Column:
    day = F.col("pay_date")
    after = f"{year + month // 12}-{month % 12 + 1:02d}-01"
    return (day >= F.lit(f"{year}-{month:02d}-01").cast("timestamp_ntz")) & (day < F.lit(after).cast("timestamp_ntz"))


def payroll_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll records without the amounts that come from the lines."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("payroll_id"),
        F.col("o_custkey").alias("emp_id"),
        F.year("o_orderdate").alias("pay_year"),
        F.month("o_orderdate").alias("pay_month"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.col("o_orderdate").alias("pay_date"),
        F.col("o_orderpriority").alias("priority"),
        stored_money("o_totalprice").alias("gross"),
        F.when(F.col("o_orderstatus") == "F", "Paid")
        .when(F.col("o_orderstatus") == "P", "Approved")
        .otherwise("Draft")
        .alias("status"),
    )


def payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll records; the lines are pre-aggregated per record before the join."""
    ext, disc, tax = cents("l_extendedprice"), cents("l_discount"), cents("l_tax")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("payroll_id")).agg(
        F.round(exact_sum(ext * (F.lit(100) - disc), 4), 2).cast("decimal(18,2)").alias("net"),
        F.round(exact_sum(ext * tax, 4), 2).cast("decimal(18,2)").alias("tds"),
        F.count("*").alias("n_lines"),
    )
    nil = F.lit(0).cast("decimal(18,2)")
    pf = F.round(F.least("gross", F.lit(15000).cast("decimal(18,2)")) * F.lit("0.12").cast("decimal(4,2)"), 2)
    esi = F.when(F.col("gross") <= 21000, F.round(F.col("gross") * F.lit("0.0325").cast("decimal(6,4)"), 2)).otherwise(nil)
    return (
        payroll_headers(spark, sf_dir)
        .join(lines, "payroll_id", "left")
        .select(
            "payroll_id", "emp_id", "pay_year", "pay_month", "period", "pay_date", "priority", "gross", "status",
            F.coalesce("net", nil).alias("net"),
            F.coalesce("tds", nil).alias("tds"),
            F.coalesce("n_lines", F.lit(0)).alias("days_present"),
            F.lit(7).alias("working_days"),
            pf.cast("decimal(18,2)").alias("pf"),
            esi.cast("decimal(18,2)").alias("esi_er"),
        )
        .withColumn("deductions", (F.col("pf") + F.col("tds")).cast("decimal(18,2)"))
    )


def wide_payroll(spark: SparkSession, sf_dir: str, records: DataFrame | None = None, location: bool = False) -> DataFrame:
    """Payroll records with the employee and department columns."""
    people = employees(spark, sf_dir, location).withColumnRenamed("status", "emp_status").drop("email")
    records = payroll(spark, sf_dir) if records is None else records
    return records.join(people, "emp_id")


def attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("att_id"),
        F.col("user_id").alias("emp_id"),
        F.to_date("ts").alias("att_date"),
        "ts",
        stored_money("value").alias("hours"),
        F.when(kind == "view", "Present")
        .when(kind == "error", "Absent")
        .when(kind == "click", "Half-Day")
        .when(kind == "signup", "On-Leave")
        .otherwise("Holiday")
        .alias("status"),
    )


def _half_up_cents(units: Column) -> Column:
    """Units of 1e-4 to money, rounded half up."""
    whole = F.call_function("div", units + F.when(units < 0, F.lit(-50)).otherwise(F.lit(50)), F.lit(100))
    return (whole.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    ext = stored_money("l_extendedprice")
    part = cents("l_extendedprice") * (F.lit(100) - cents("l_discount"))
    return lines.join(heads, lines.l_orderkey == heads.o_orderkey).select(
        F.col("l_orderkey").alias("loan_key"),
        F.col("l_linenumber").cast("bigint").alias("line_no"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.col("o_custkey").alias("emp_id"),
        ext.alias("amount"),
        _half_up_cents(part).alias("outstanding"),
        F.col("l_quantity").cast("bigint").alias("total_emis"),
        F.floor(F.col("l_quantity") * F.col("l_discount")).cast("bigint").alias("emis_paid"),
        stored_money(rounded(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")))).alias("emi"),
        F.when(F.col("o_orderstatus") == "O", "Active").when(F.col("o_orderstatus") == "F", "Closed").otherwise("Pending").alias("status"),
        F.col("l_shipdate").alias("loan_date"),
        F.col("l_returnflag").alias("purpose"),
    )


def leave_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("leave_id")).agg(
        F.to_date(F.max("l_shipdate")).alias("to_date")
    )
    heads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("leave_id"),
        F.col("o_custkey").alias("emp_id"),
        F.to_date("o_orderdate").alias("from_date"),
        F.col("o_orderpriority").alias("leave_type"),
        F.when(F.col("o_orderstatus") == "O", "Pending").when(F.col("o_orderstatus") == "F", "Approved").otherwise("Rejected").alias("status"),
    )
    return heads.join(ends, "leave_id")


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive amounts of an employee read as salary revisions."""
    from wagewright.operators.history import over_history

    amounts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("revision_id"),
        F.col("o_custkey").alias("emp_id"),
        F.col("o_orderdate").alias("effective"),
        stored_money("o_totalprice").alias("new_basic"),
        F.col("o_orderpriority").alias("reason"),
    )
    out = over_history(
        amounts, ["emp_id"], "effective", "revision_id",
        {"old_basic": lambda w: F.lag("new_basic").over(w)}, back=1,
    )
    return out.filter(F.col("old_basic").isNotNull())


def blank_every(key: str, n: int, otherwise: Column, value: str | None = "") -> Column:
    """A defect planted in every n-th row, for the cleaning and quality jobs."""
    return F.when(F.col(key) % n == 0, F.lit(value)).otherwise(otherwise)


def dirty_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer")
    depts = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    salary = blank_every("c_custkey", 17, stored_money("c_acctbal").cast("string"), "n/a")
    return people.join(depts, people.c_nationkey == depts.n_nationkey).select(
        F.col("c_custkey").alias("emp_id"),
        blank_every("c_custkey", 11, employee_code("c_custkey")).alias("emp_code"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("n_name").alias("dept"),
        blank_every("c_custkey", 7, salary).alias("basic_salary"),
        blank_every("c_custkey", 13, F.when(F.col("c_acctbal") < 0, "Inactive").otherwise("Active")).alias("status"),
        blank_every("c_custkey", 19, F.lit("1985-06-15")).alias("dob"),
        blank_every(
            "c_custkey", 5,
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@company.example")),
        ).alias("email"),
        F.col("c_mktsegment").alias("gender"),
    )


def dirty_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll records as text with blanks and junk, the shape a CSV file has."""
    half = F.round(F.col("gross") * F.lit("0.5").cast("decimal(4,2)"), 2).cast("decimal(18,2)").cast("string")
    return payroll(spark, sf_dir).select(
        "payroll_id",
        F.col("emp_id").cast("string").alias("emp_id"),
        "period",
        F.lit("7").alias("working_days"),
        blank_every("payroll_id", 23, F.col("days_present").cast("string")).alias("days_present"),
        blank_every("payroll_id", 17, half, "n/a").alias("basic"),
        blank_every("payroll_id", 7, F.col("gross").cast("string")).alias("gross"),
        F.col("pf").cast("string").alias("pf"),
        blank_every("payroll_id", 29, F.col("tds").cast("string")).alias("tds"),
        blank_every("payroll_id", 31, F.col("net").cast("string")).alias("net"),
        "status",
    )


def defective_payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed payroll records with planted rule violations."""
    gross, net = F.col("gross"), F.col("net")
    bad_net = F.when(F.col("payroll_id") % 97 == 0, -net).when(F.col("payroll_id") % 101 == 0, gross + 1).otherwise(F.least(net, gross))
    return payroll(spark, sf_dir).select(
        "payroll_id", "emp_id",
        blank_every("payroll_id", 11, employee_code("emp_id")).alias("emp_code"),
        "period", "pay_year", "pay_month",
        bad_net.cast("decimal(18,2)").alias("net"),
        F.when(F.col("payroll_id") % 103 == 0, F.lit(0).cast("decimal(18,2)")).otherwise(gross).alias("gross"),
        F.when(F.col("payroll_id") % 7 != 0, F.round(gross * F.lit("0.6").cast("decimal(4,2)"), 2).cast("decimal(18,2)")).alias("basic"),
        blank_every("payroll_id", 13, F.col("status")).alias("status"),
        "tds", "pf", "deductions", "days_present", "working_days",
    )
