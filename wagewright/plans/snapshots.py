"""Updates, deletes, merges, earlier states and change capture."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.operators import snapshots as snap
from wagewright.registry import query
from wagewright.session import settled
from wagewright.sources import roles

COLS = ["payroll_id", "emp_id", "period", "gross", "status"]
OUT = "payroll_id:l emp_id:l period:s gross:d status:s"
BASE = "(SELECT payroll_id, emp_id, period, gross, status, priority, pay_year FROM r_ord)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.payroll_headers(spark, sf_dir).select(*COLS, "priority", "pay_year")


UPDATED = "(SELECT * REPLACE (CASE WHEN status='Draft' AND priority='1-URGENT' AND pay_year<1997 THEN 'Approved' ELSE status END AS status) FROM " + BASE + ")"


@query("snapshot_update", OUT, f"SELECT {', '.join(COLS)} FROM {UPDATED}")
def snapshot_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = "status = 'Draft' AND priority = '1-URGENT' AND pay_year < 1997"
    return snap.state(snap.update(records(spark, sf_dir), where, {"status": F.lit("Approved")}))


@query("snapshot_delete", OUT, f"SELECT {', '.join(COLS)} FROM {BASE} WHERE NOT (gross<5000)")
def snapshot_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.state(snap.delete(records(spark, sf_dir), "gross < 5000"))


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raised amounts for approved records of 1996 and every record of 2000 on; no priority column."""
    rows = records(spark, sf_dir).filter("(status = 'Approved' AND pay_year = 1996) OR pay_year >= 2000")
    return rows.select("payroll_id", "emp_id", "period", (F.col("gross") * 2).cast("decimal(18,2)").alias("gross"), F.lit("Revised").alias("status"))


@query("merge_upsert", OUT + " priority:s",
       f"""SELECT payroll_id, emp_id, period, CASE WHEN hit THEN gross*2 ELSE gross END AS gross, CASE WHEN hit THEN 'Revised' ELSE status END AS status, CASE WHEN pay_year<2000 THEN priority END AS priority
           FROM (SELECT *, (status='Approved' AND pay_year=1996) OR pay_year>=2000 AS hit FROM {BASE})""")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = records(spark, sf_dir).filter("pay_year < 2000")
    return snap.state(snap.merge(target, merge_source(spark, sf_dir), "payroll_id", [F.col("gross").desc()]))


@query("time_travel_read", "label:s records:l gross:d",
       f"""SELECT 'version 0' AS label, count(*) AS records, sum(gross) AS gross FROM {BASE} WHERE pay_year<1997 UNION ALL SELECT 'version 1', count(*), sum(gross) FROM {BASE} UNION ALL
           SELECT 'version 2', count(*), sum(gross) FROM {BASE} WHERE gross>=5000 UNION ALL SELECT 'on 2024-01-02', count(*), sum(gross) FROM {BASE} UNION ALL SELECT 'after rollback', count(*), sum(gross) FROM {BASE} WHERE pay_year<1997""")
def time_travel_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of one dated table: rows from 1997 on arrive a day later, small amounts leave the day after that."""
    held = records(spark, sf_dir).withColumns({
        "valid_from": F.when(F.col("pay_year") < 1997, "2024-01-01").otherwise("2024-01-02").cast("timestamp_ntz"),
        "valid_to": F.when(F.col("gross") < 5000, "2024-01-03").cast("timestamp_ntz"),
    })
    reads = {
        "version 0": "2024-01-01", "version 1": "2024-01-02", "version 2": "2024-01-03",
        "on 2024-01-02": "2024-01-02 12:00:00", "after rollback": "2024-01-01",
    }
    # All states in one scan: each row meets the instants asked for, summed before the shuffle.
    asked = F.array(*[F.struct(F.lit(n).alias("label"), F.lit(t).cast("timestamp_ntz").alias("at")) for n, t in reads.items()])
    seen = snap.valid_at(held.select("gross", "valid_from", "valid_to", F.inline(asked)), F.col("at"))
    found = seen.groupBy("label").agg(F.count("*").alias("records"), F.sum("gross").alias("gross"))
    labels = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in reads])).alias("label"))
    return labels.join(found, "label", "left").fillna(0, ["records"])


@query("schema_evolution", "payroll_id:l gross:d bonus:d note:s",
       f"SELECT payroll_id, gross, CASE WHEN pay_year<2000 THEN 25.5 ELSE NULL END AS bonus, CASE WHEN pay_year>=2000 THEN 'late' END AS note FROM {BASE}")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column added with a default, then an append that brings a column of its own."""
    rows = records(spark, sf_dir)
    early = snap.state(snap.add_column(rows.filter("pay_year < 2000"), "bonus", "double", "25.5"))
    late = rows.filter("pay_year >= 2000").withColumn("note", F.lit("late"))
    return snap.state(snap.append(early, late))


U = "count(*) FILTER (WHERE status='Draft' AND priority='1-URGENT')"
KEPT = "count(*) FILTER (WHERE gross>=5000)"
HIT = "gross>=5000 AND ((status='Approved' AND pay_year=1996) OR pay_year>=2000)"
INS = "gross<5000 AND pay_year>=2000"


@query("snapshot_history", "version:l operation:s rows:l added:l removed:l keys_complete:l",
       f"""SELECT 0 AS version, 'WRITE' AS operation, count(*) AS rows, count(*) AS added, 0 AS removed, 1 AS keys_complete FROM {BASE} WHERE pay_year<1997 UNION ALL
           SELECT 1, 'WRITE', count(*), count(*) FILTER (WHERE pay_year>=1997), 0, 1 FROM {BASE} UNION ALL
           SELECT 2, 'UPDATE', count(*), {U}, {U}, 1 FROM {BASE} UNION ALL
           SELECT 3, 'DELETE', {KEPT}, 0, count(*) FILTER (WHERE gross<5000), 1 FROM {BASE} UNION ALL
           SELECT 4, 'MERGE', {KEPT}+count(*) FILTER (WHERE {INS} OR (gross<5000 AND status0='Approved' AND pay_year=1996)), count(*) FILTER (WHERE (status0='Approved' AND pay_year=1996) OR pay_year>=2000),
             count(*) FILTER (WHERE gross>=5000 AND ((status0='Approved' AND pay_year=1996) OR pay_year>=2000)), 1 FROM (SELECT *, status AS status0 FROM {BASE}) UNION ALL
           SELECT 5, 'SCHEMA_CHANGE', {KEPT}+count(*) FILTER (WHERE {INS} OR (gross<5000 AND status='Approved' AND pay_year=1996)), 0, 0, 1 FROM {BASE} UNION ALL
           SELECT 6, 'ROLLBACK', count(*), 0, 0, 1 FROM {BASE}""")
def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, additions and removals of seven changes in a row; each is written once and counted from what was written."""
    rows = records(spark, sf_dir)
    steps: list[tuple[str, DataFrame]] = []

    def step(name: str, changed: DataFrame) -> DataFrame:
        stored = settled(changed, f"change-{len(steps)}")
        steps.append((name, stored))
        return snap.state(stored)

    now = step("WRITE", snap.append(None, rows.filter("pay_year < 1997")))
    now = second = step("WRITE", snap.append(now, rows.filter("pay_year >= 1997")))
    now = step("UPDATE", snap.update(now, "status = 'Draft' AND priority = '1-URGENT'", {"status": F.lit("Approved")}))
    now = step("DELETE", snap.delete(now, "gross < 5000"))
    now = step("MERGE", snap.merge(now, merge_source(spark, sf_dir), "payroll_id", [F.col("gross").desc()]))
    # A new column and a return to an earlier state change no row: nothing is written.
    steps += [("SCHEMA_CHANGE", snap.add_column(now, "bonus", "double", "0")), ("ROLLBACK", second.withColumn(snap.CHANGE, F.lit(snap.KEPT)))]
    counts = [
        snap.tally(changed, "payroll_id").select(F.lit(i).alias("version"), F.lit(name).alias("operation"), "rows", "added", "removed", "keys_complete")
        for i, (name, changed) in enumerate(steps)
    ]
    return reduce(DataFrame.unionByName, counts)


TRACKED = ["status", "gross_text", "dept_id"]
NEW_STATUS = "CASE WHEN pay_year=1998 AND status='Draft' THEN 'Approved' ELSE status END"
JSON = """'{"status":"' || %s || '","gross_text":"' || gross || '","dept_id":' || dept_id || '}'"""
DIFF_SQL = f"""SELECT 'payroll_records' AS table_name, payroll_id AS record_id, CASE WHEN pay_year>=2001 THEN 'INSERT' WHEN pay_year=1995 THEN 'DELETE' ELSE 'UPDATE' END AS action,
   CASE WHEN pay_year<2001 THEN {JSON % 'status'} END AS old_data, CASE WHEN pay_year<>1995 THEN {JSON % NEW_STATUS} END AS new_data,
   CASE WHEN pay_year BETWEEN 1996 AND 2000 THEN '2002-01-01' END AS updated_at, pay_date
   FROM (SELECT o.*, o.status AS s, e.dept_id FROM r_ord o JOIN r_emp e ON o.emp_id=e.emp_id) WHERE pay_year>=2001 OR pay_year=1995 OR (pay_year=1998 AND status='Draft')"""


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's table against today's: 1995 archived, 1998 approved, 2001 new."""
    staff = roles.employees(spark, sf_dir).select("emp_id", "dept_id")
    rows = roles.payroll_headers(spark, sf_dir).join(staff, "emp_id").withColumn("gross_text", F.col("gross").cast("string"))
    old = rows.filter("pay_year < 2001")
    approve = (F.col("pay_year") == 1998) & (F.col("status") == "Draft")
    new = rows.filter("pay_year <> 1995").withColumn("status", F.when(approve, "Approved").otherwise(F.col("status")))
    found = snap.changes(old, new, "payroll_id", TRACKED, "payroll_records")
    return found.withColumn("updated_at", F.when(F.col("action") == "UPDATE", "2002-01-01"))


@query("audit_snapshot_diff", "table_name:s record_id:l action:s old_data:s new_data:s updated_at:s",
       f"SELECT table_name, record_id, action, old_data, new_data, updated_at FROM ({DIFF_SQL})")
def audit_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(spark, sf_dir)


def audit_trail(log: DataFrame, table_name: str | None = None, limit: int = 50) -> DataFrame:
    """Newest entries first, optionally of one table."""
    rows = log if table_name is None else log.filter(F.col("table_name") == table_name)
    return rows.orderBy(F.col("performed_at").desc(), F.col("record_id").desc()).limit(limit)


@query("audit_trail", "table_name:s record_id:l action:s new_data:s performed_at:s",
       f"SELECT table_name, record_id, action, new_data, strftime(pay_date,'%Y-%m-%d') AS performed_at FROM ({DIFF_SQL}) ORDER BY pay_date DESC, record_id DESC LIMIT 50")
def audit_trail_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = roles.payroll_headers(spark, sf_dir).select(F.col("payroll_id").alias("record_id"), F.col("pay_date").alias("performed_at"))
    log = change_log(spark, sf_dir).join(days, "record_id")
    return audit_trail(log, "payroll_records").withColumn("performed_at", F.date_format("performed_at", "yyyy-MM-dd"))
