"""The full payroll run: validate, enrich, store, export, summarise, check limits."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field
from time import perf_counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wagewright.functions import rules
from wagewright.functions.numeric import mean, rounded
from wagewright.operators.loading import write_partitioned
from wagewright.sources.tables import write_csv

RUN_LOG = "run_ts string, stage string, rows bigint, status string, seconds double, error string"
RUN_SUMMARY = "run_ts string, stages bigint, failed bigint, rows_in bigint, rows_out bigint, seconds double, status string"


@dataclass
class Stage:
    """What one stage of a run did; ``rows`` stays null where it failed."""

    name: str
    rows: int | None = None
    status: str = "success"
    seconds: float = 0.0
    error: str | None = None


@dataclass
class Run:
    """Where a run wrote its tables, and what its stages saw."""

    root: str
    log: list[Stage] = field(default_factory=list)

    @property
    def stages(self) -> dict[str, int | None]:
        return {s.name: s.rows for s in self.log}

    @contextmanager
    def stage(self, name: str):
        """Time a stage; one that raises is logged as failed, and the error goes on."""
        step, began = Stage(name), perf_counter()
        self.log.append(step)
        try:
            yield step
        except Exception as e:
            step.status, step.error = "failed", (str(e).splitlines() or [""])[0]
            raise
        finally:
            step.seconds = perf_counter() - began

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def violations(self, least_pass_pct: float = 0.0) -> list[str]:
        """Limits the run broke."""
        seen, clean = self.stages.get("ingested"), self.stages.get("clean")
        found = []
        if seen and clean * 100.0 / seen < least_pass_pct:
            found.append(f"pass rate below {least_pass_pct:g} %")
        if self.stages.get("stored") != clean:
            found.append("stored rows differ from clean rows")
        return found


def daily_run(spark: SparkSession, records: DataFrame, enrich, root: str, run_ts: str) -> Run:
    """One run over payroll records already joined to staff.

    The checked records are written once; every later step reads that table, so
    nothing upstream is computed twice. Row counts are observed while the
    tables are written. A failing stage ends the run with its error, after the
    log and the summary have been written.
    """
    run = Run(root)
    try:
        _stages(spark, records, enrich, run)
    finally:
        log_run(spark, run, run_ts)
    return run


def _stages(spark: SparkSession, records: DataFrame, enrich, run: Run) -> None:
    checked = records.withColumn("errors", rules.register_errors()).withColumn("is_clean", F.size("errors") == 0)
    seen = Observation()
    with run.stage("ingested") as step:
        counted = checked.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_clean")).alias("clean"))
        counted.write.partitionBy("is_clean").parquet(run.path("checked"))
        step.rows = seen.get["n"]
    # Seen in the same pass, so they take no time of their own.
    run.log += [Stage("clean", seen.get["clean"]), Stage("issues", seen.get["n"] - seen.get["clean"])]

    with run.stage("stored") as step:
        stored = Observation()
        clean = spark.read.schema(checked.schema).parquet(run.path("checked")).filter("is_clean").drop("errors", "is_clean")
        write_partitioned(enrich(clean).observe(stored, F.count(F.lit(1)).alias("n")), run.path("fact"), ["pay_year"])
        step.rows = stored.get["n"]

    with run.stage("exported") as step:
        exported = Observation()
        by_dept = spark.read.parquet(run.path("fact")).groupBy("dept_name").agg(
            F.count("*").alias("records"), F.sum("gross").alias("gross"), F.sum("net").alias("net"), F.sum("tds").alias("tds"),
            F.sum("pf").alias("pf"), rounded(mean("net")).alias("avg_net"),
        )
        write_csv(by_dept.observe(exported, F.count(F.lit(1)).alias("n")), run.path("dept_summary"))
        step.rows = exported.get["n"]


def log_run(spark: SparkSession, run: Run, run_ts: str) -> None:
    """Append a row per stage to the run log and one row for the run to the summaries."""
    rows = [(run_ts, s.name, s.rows, s.status, s.seconds, s.error) for s in run.log]
    spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(run.path("run_log"))
    failed = sum(s.status == "failed" for s in run.log)
    broken = failed or run.violations()
    total = (
        run_ts, len(run.log), failed, run.stages.get("ingested"), run.stages.get("stored"),
        sum(s.seconds for s in run.log), "failed" if broken else "success",
    )
    spark.createDataFrame([total], RUN_SUMMARY).coalesce(1).write.mode("append").parquet(run.path("run_summary"))
