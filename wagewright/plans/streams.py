"""Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions.numeric import cents, exact_sum, rounded
from wagewright.registry import query
from wagewright.session import scratch
from wagewright.sources import roles
from wagewright.sources.role_sql import r
from wagewright.sources.tables import table
from wagewright.streaming import jobs

V = "CAST(value AS DECIMAL(18,2))"


@query("stream_event_counts", "event_type:s events:l amount:d", f"SELECT event_type, count(*) AS events, sum({V}) AS amount FROM events GROUP BY 1")
def stream_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, check = scratch(spark, "counts"), scratch(spark, "checkpoint")
    jobs.each_batch(jobs.running_totals(jobs.table_stream(jobs.stream_session(spark), sf_dir)), jobs.keep_latest(out), check, "complete")
    return jobs.latest_batch(spark, out)


WINDOW = "window_start:s window_end:s events:l amount:d view:l click:l purchase:l signup:l error:l"
TYPES = ", ".join(f"count(*) FILTER (WHERE event_type='{k}') AS {k}" for k in ("view", "click", "purchase", "signup", "error"))
WINDOW_SQL = f"SELECT strftime(date_trunc('day',ts),'%Y-%m-%d %H:%M') AS window_start, strftime(date_trunc('day',ts)+INTERVAL 1 DAY,'%Y-%m-%d %H:%M') AS window_end, count(*) AS events, sum({V}) AS amount, {TYPES} FROM events GROUP BY date_trunc('day',ts)"


@query("stream_tumbling_window", WINDOW, WINDOW_SQL)
def stream_tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, check = scratch(spark, "windows"), scratch(spark, "checkpoint")
    jobs.each_batch(jobs.tumbling(jobs.table_stream(jobs.stream_session(spark), sf_dir)), jobs.keep_latest(out), check, "complete")
    return jobs.latest_batch(spark, out)


CLOSED_SQL = f"{WINDOW_SQL} HAVING date_trunc('day',ts)+INTERVAL 1 DAY <= (SELECT max(ts)-INTERVAL 1 HOUR FROM events)"


@query("stream_watermark_closed_windows", WINDOW, CLOSED_SQL)
def stream_watermark_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode emits a window once the watermark (one hour behind) has passed its end."""
    out, check = scratch(spark, "closed"), scratch(spark, "checkpoint")
    jobs.append_to(jobs.tumbling(jobs.table_stream(jobs.stream_session(spark), sf_dir), delay="1 hour"), out, check)
    return spark.read.parquet(out)


@query("stream_late_rows", WINDOW, CLOSED_SQL)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals on one checkpoint; the last re-sends old days and must change nothing."""
    landing, out, check = (scratch(spark, n) for n in ("landing", "late", "checkpoint"))
    events = table(spark, sf_dir, "events")
    arrivals = [events.filter("ts < '2024-01-16'"), events.filter("ts >= '2024-01-16'"), events.filter("ts < '2024-01-05'")]
    for batch in arrivals:
        jobs.stage_files(batch, landing)
        jobs.append_to(jobs.tumbling(jobs.event_stream(jobs.stream_session(spark), landing), delay="1 hour"), out, check)
    return spark.read.parquet(out)


@query("stream_microbatch_dept", "dept_name:s events:l total:d avg_amount:d",
       f"SELECT dept_name, count(*) AS events, sum({V}) AS total, {r(f'CAST(sum({V}) AS DOUBLE)/count(*)')} AS avg_amount FROM events JOIN r_emp ON user_id=emp_id GROUP BY 1")
def stream_microbatch_dept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded micro-batches, each joined to the staff and summed per department."""
    landing, out, check = (scratch(spark, n) for n in ("landing", "micro", "checkpoint"))
    events = table(spark, sf_dir, "events")
    jobs.stage_files(events.withColumn("arrival", F.date_format("ts", "yyyy-MM-dd")), landing, by="arrival")
    staff = roles.employees(spark, sf_dir).select(F.col("emp_id").alias("user_id"), "dept_name")

    def work(df: DataFrame, batch_id: int) -> None:
        per_user = df.groupBy("user_id").agg(F.count("*").alias("n"), exact_sum(cents("value"), 2).alias("v"))
        sums = per_user.join(staff, "user_id").groupBy("dept_name").agg(F.sum("n").alias("events"), F.sum("v").alias("total"))
        sums.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    jobs.each_batch(jobs.event_stream(spark, landing, files_per_trigger=4 * jobs.files_per_batch(spark)), work, check)
    total = spark.read.parquet(out).groupBy("dept_name").agg(F.sum("events").alias("events"), F.sum("total").alias("total"))
    return total.withColumn("avg_amount", rounded(F.col("total").cast("double") / F.col("events")))


@query("stream_restart_exactly_once", "event_type:s events:l distinct_ids:l amount:d",
       f"SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS distinct_ids, sum({V}) AS amount FROM events GROUP BY 1")
def stream_restart_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped, restarted on the same checkpoint with more input, restarted with none."""
    landing, out, check = (scratch(spark, n) for n in ("landing", "once", "checkpoint"))
    events = table(spark, sf_dir, "events")
    for batch in (events.filter("ts < '2024-01-16'"), events.filter("ts >= '2024-01-16'"), None):
        if batch is not None:
            jobs.stage_files(batch, landing)
        jobs.append_to(jobs.event_stream(spark, landing, files_per_trigger=jobs.files_per_batch(spark)), out, check)
    return spark.read.parquet(out).groupBy("event_type").agg(
        F.count("*").alias("events"), F.countDistinct("event_id").alias("distinct_ids"),
        exact_sum(cents("value"), 2).alias("amount"),
    )


@query("ingest_file_stream", "emp_id:l records:l gross:d", "SELECT emp_id, count(*) AS records, sum(gross) AS gross FROM r_ord GROUP BY 1")
def ingest_file_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunked ingest: bounded micro-batches of landed files, every row loaded once."""
    landing, out, check = (scratch(spark, n) for n in ("landing", "chunks", "checkpoint"))
    rows = roles.payroll_headers(spark, sf_dir).select("payroll_id", "emp_id", "gross")
    jobs.stage_files(rows, landing)
    stream = spark.readStream.schema("payroll_id bigint, emp_id bigint, gross decimal(18,2)").option("maxFilesPerTrigger", jobs.files_per_batch(spark)).parquet(landing)
    jobs.append_to(stream, out, check)
    return spark.read.parquet(out).groupBy("emp_id").agg(F.count("*").alias("records"), F.sum("gross").alias("gross"))


# ---- progress of a stream over landed files -------------------------------------------
HALF = "2024-01-16"


@query("stream_partition_offsets", "event_id:l batch:l arrival:s",
       f"SELECT event_id, CASE WHEN ts<TIMESTAMP '{HALF}' THEN 0 ELSE 1 END AS batch, CASE WHEN ts<TIMESTAMP '{HALF}' THEN 'first' ELSE 'second' END AS arrival FROM events")
def stream_partition_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the micro-batch and the landed folder it came from; two arrivals on one checkpoint."""
    landing, out, check = (scratch(spark, n) for n in ("landing", "tagged", "checkpoint"))
    events = table(spark, sf_dir, "events")
    for name, batch in (("first", events.filter(f"ts < '{HALF}'")), ("second", events.filter(f"ts >= '{HALF}'"))):
        jobs.stage_files(batch, f"{landing}/{name}")
        stream = jobs.event_stream(jobs.stream_session(spark), f"{landing}/*", with_file=True)
        jobs.each_batch(stream, jobs.tagged(out), check)
    return spark.read.parquet(out).withColumn("arrival", F.regexp_extract("landed_file", "/(first|second)/[^/]+$", 1))


@query("consumer_lag", "event_type:s landed:l processed:l lag:l",
       f"SELECT event_type, count(*) AS landed, count(*) FILTER (WHERE ts<TIMESTAMP '{HALF}') AS processed, count(*) FILTER (WHERE NOT ts<TIMESTAMP '{HALF}') AS lag FROM events GROUP BY 1")
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that landed after a stream last ran and wait for its next run, per event type."""
    landing, out, check = (scratch(spark, n) for n in ("landing", "lag", "checkpoint"))
    events = table(spark, sf_dir, "events")
    jobs.stage_files(events.filter(f"ts < '{HALF}'"), landing)
    jobs.append_to(jobs.event_stream(jobs.stream_session(spark), landing), out, check)
    jobs.stage_files(events.filter(f"ts >= '{HALF}'"), landing)

    def per_type(folder: str, name: str) -> DataFrame:
        return spark.read.parquet(folder).groupBy("event_type").agg(F.count("*").alias(name))

    both = per_type(landing, "landed").join(per_type(out, "processed"), "event_type", "left").fillna(0, ["processed"])
    return both.withColumn("lag", F.col("landed") - F.col("processed"))


@query("replay_from_offset", "event_type:s replayed:l first_event:l last_event:l amount:d",
       f"SELECT event_type, count(*) AS replayed, min(event_id) AS first_event, max(event_id) AS last_event, sum({V}) AS amount FROM events WHERE ts>=TIMESTAMP '{HALF}' GROUP BY 1")
def replay_from_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A processed stream read again from a point in event time, on a checkpoint of its own."""
    session, out = jobs.stream_session(spark), scratch(spark, "replay")
    again = jobs.table_stream(session, sf_dir).filter(f"ts >= timestamp'{HALF}'")
    jobs.append_to(again, out, scratch(spark, "checkpoint"))
    return spark.read.parquet(out).groupBy("event_type").agg(
        F.count("*").alias("replayed"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"),
        exact_sum(cents("value"), 2).alias("amount"),
    )
