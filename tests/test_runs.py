"""Stored runs, folder reads, partitioned writes, caching and streams."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from wagewright.catalogue import REGISTRY
from wagewright.functions.numeric import zero
from wagewright.operators.daily_run import Run, Stage, daily_run
from wagewright.operators.loading import manifest, write_partitioned
from wagewright.plans.relational import merged_documents
from wagewright.session import dropped_after, kept, scratch, settled
from wagewright.sources.tables import csv_datasets, read_csv, read_csv_folder, run_sql, table, write_csv
from wagewright.streaming import jobs

SF = "/root/testdata/sf0.001"


def folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def records(spark):
    rows = [(1, "E1", "HR", 100.0, 80.0, 2026), (2, "", "HR", 100.0, 80.0, 2026), (3, "E3", "IT", 50.0, 60.0, 2026), (4, "E4", "IT", 70.0, 60.0, 2025)]
    df = spark.createDataFrame(rows, "payroll_id bigint, emp_code string, dept_name string, gross double, net double, pay_year int")
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("gross", "net")}).withColumns({"tds": F.col("gross") * 0, "pf": F.col("gross") * 0})


def test_daily_run(spark):
    run = daily_run(spark, records(spark), lambda df: df.withColumn("annual", zero("gross") * 12), folder() + "/run", "t0")
    assert run.stages == {"ingested": 4, "clean": 2, "issues": 2, "stored": 2, "exported": 2}
    assert run.violations() == [] and run.violations(60) == ["pass rate below 60 %"]
    assert spark.read.parquet(run.path("fact")).count() == 2
    log = spark.read.parquet(run.path("run_log"))
    assert log.count() == 5 and log.filter("status = 'success' AND seconds >= 0 AND error IS NULL").count() == 5
    broken = Run("x", [Stage("ingested", 2), Stage("clean", 2), Stage("stored", 1)])
    assert broken.violations() == ["stored rows differ from clean rows"]


def test_failed_stage_is_logged(spark):
    root = folder() + "/run"
    with pytest.raises(Exception, match="no rate"):
        daily_run(spark, records(spark), lambda df: df.withColumn("x", F.raise_error(F.lit("no rate"))), root, "t1")
    log = {r["stage"]: r for r in spark.read.parquet(f"{root}/run_log").collect()}
    assert set(log) == {"ingested", "clean", "issues", "stored"}
    assert log["stored"]["status"] == "failed" and log["stored"]["rows"] is None and log["stored"]["error"]
    assert {log[s]["status"] for s in ("ingested", "clean", "issues")} == {"success"}
    total = spark.read.parquet(f"{root}/run_summary").first()
    assert (total["status"], total["failed"], total["rows_in"], total["rows_out"]) == ("failed", 1, 4, None)


def test_csv_keeps_blanks_and_quotes(spark):
    path = folder() + "/x"
    df = spark.createDataFrame([("1", "", 'say "hi", ok'), ("2", None, "plain")], "id string, a string, b string")
    write_csv(df, path)
    assert sorted(map(tuple, read_csv(spark, path, ["id", "a", "b"]).collect())) == [("1", "", 'say "hi", ok'), ("2", "", "plain")]


def test_csv_folder_by_stem(spark):
    root = folder()
    write_csv(spark.createDataFrame([("a",), ("b",)], "name string"), f"{root}/written.csv")
    with open(f"{root}/single.csv", "w") as f:
        f.write("name\nz\n")
    got = sorted(map(tuple, read_csv_folder(spark, root, ["name"]).select("dataset", "name").collect()))
    assert got == [("single", "z"), ("written", "a"), ("written", "b")]


def test_csv_columns_by_header_and_line_breaks(spark):
    root = folder()
    for name, text in {"a": "name,city\nann,\"Ulm\nSüd\"\n", "b": "city,name\nBonn,bob\n", "c": "name,age\ncy,7\n"}.items():
        with open(f"{root}/{name}.csv", "w") as f:
            f.write(text)
    got = sorted(map(tuple, read_csv_folder(spark, root, ["name", "city"]).collect()))
    assert got == [("ann", "Ulm\nSüd", "a"), ("bob", "Bonn", "b"), ("cy", "", "c")]
    assert {k: df.columns for k, df in csv_datasets(spark, root).items()} == {"a": ["name", "city"], "b": ["city", "name"], "c": ["name", "age"]}
    assert read_csv_folder(spark, folder(), ["name"]).count() == 0


def test_deep_merge_at_every_depth(spark):
    docs = spark.sql("""SELECT named_struct('a', 1, 'b', named_struct('c', 2, 'd', named_struct('e', 3, 'f', 4))) AS base,
        named_struct('b', named_struct('d', named_struct('e', 30, 'f', CAST(NULL AS INT), 'g', 5)), 'z', 9) AS over""")
    kept_null = merged_documents(docs, "base", "over", "doc").select("doc.a", "doc.b.c", "doc.b.d.e", "doc.b.d.f", "doc.b.d.g", "doc.z").first()
    assert tuple(kept_null) == (1, 2, 30, 4, 5, 9)
    assert merged_documents(docs, "base", "over", "doc", present=True).select("doc.b.d.e", "doc.b.d.f").first() == (30, None)


def test_sql_with_arguments_raises_on_error(spark):
    assert run_sql(spark, SF, "SELECT count(*) AS n FROM {nation} WHERE n_nationkey < :k", k=5).first()["n"] == 5
    try:
        run_sql(spark, SF, "SELECT missing FROM {nation}")
        raise AssertionError("no error")
    except Exception as e:
        assert "missing" in str(e)


def test_partitioned_write(spark):
    path = folder() + "/p"
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))).alias("k"))
    write_partitioned(df, path, ["k"])
    got = {r["k"]: r["added_rows"] for r in manifest(spark, path, ["k"]).collect()}
    assert got["hot"] == 334 and sum(got.values()) == 1000


def test_kept_and_settled(spark):
    df = spark.range(10)
    with kept(df) as cached:
        assert cached.storageLevel.useMemory and cached.count() == 10
    assert not df.storageLevel.useMemory
    assert settled(df.withColumn("x", F.col("id") * 2)).agg(F.sum("x")).first()[0] == 90


def test_streams_read_a_folder_of_part_files(spark):
    root = folder()
    table(spark, SF, "events").repartition(4).write.parquet(f"{root}/events.parquet")
    zone = spark.conf.get("spark.sql.session.timeZone")
    for key in ("stream_event_counts", "stream_tumbling_window", "stream_watermark_closed_windows"):
        want = sorted(map(tuple, REGISTRY[key].run(spark, SF).collect()))
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        try:
            assert want and sorted(map(tuple, REGISTRY[key].run(spark, root).collect())) == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)


def test_late_rows_change_nothing(spark):
    landing, out, check = folder() + "/in", folder() + "/out", folder() + "/check"
    events = table(spark, SF, "events")
    small = jobs.stream_session(spark, 2)
    counts = []
    for batch in (events.filter("ts < '2024-01-16'"), events.filter("ts >= '2024-01-16'"), events.filter("ts < '2024-01-03'"), None):
        if batch is not None:
            jobs.stage_files(batch, landing)
        jobs.append_to(jobs.tumbling(jobs.event_stream(small, landing), delay="1 hour"), out, check)
        counts.append(spark.read.parquet(out).agg(F.sum("events")).first()[0])
    assert counts[1] == counts[2] == counts[3] and counts[0] < counts[1]
    assert spark.read.parquet(out).groupBy("window_start").count().filter("count > 1").count() == 0


def test_stored_frames_go_with_their_job(spark):
    def held(df):
        return df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]

    before = held(settled(spark.range(3)))
    with dropped_after(spark):
        outer = held(settled(spark.range(3)))
        with dropped_after(spark):
            inner = held(settled(spark.range(3)))
            assert os.path.isdir(inner)
        assert not os.path.isdir(inner) and os.path.isdir(outer)
    assert not os.path.isdir(outer) and os.path.isdir(before)
    with pytest.raises(ZeroDivisionError), dropped_after(spark):
        lost = held(settled(spark.range(3)))
        raise ZeroDivisionError
    assert not os.path.isdir(lost) and scratch(spark, "x").count("job-") == 0
