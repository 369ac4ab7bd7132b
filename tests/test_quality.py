from pyspark.sql import functions as F

from wagewright.operators import quality as q


def frame(spark):
    rows = [(1, "EMP1", 100.0, 120.0, "Paid"), (2, "EMP2", None, 50.0, "Paid"), (3, "", -5.0, 0.0, "Odd"), (4, "EMP1", 90.0, 80.0, None), (0, "EMP5", 1.0, 2.0, "Paid")]
    return spark.createDataFrame(rows, "id bigint, code string, net double, gross double, status string")


def test_checks(spark):
    checks = [
        q.complete("code"), q.complete("code", 80.0), q.complete("net", 81.0), q.unique("code"), q.unique("id"),
        q.within("net", 0, 1000), q.consistent("net_le_gross", "coalesce(net,0) <= gross"), q.consistent("status", F.col("status").isin("Paid")),
    ]
    got = [(r["check_name"], r["total"], r["violations"], r["passed"]) for r in q.run_checks(frame(spark), checks).collect()]
    assert got == [
        ("completeness_code", 5, 1, 0), ("completeness_code", 5, 1, 1), ("completeness_net", 5, 1, 0), ("range_net", 5, 1, 0),
        ("net_le_gross", 5, 1, 0), ("status", 5, 2, 0), ("uniqueness_code", 4, 1, 0), ("uniqueness_id", 4, 0, 1),
    ]


def test_an_erroring_check_fails_alone(spark):
    rows = frame(spark)
    wrong = [q.consistent("no_column", "missing > 1"), q.consistent("no_syntax", "net >>> ("), q.unique("absent"), q.within("absent", 0, 1)]
    fine = [q.complete("code"), q.unique("id")]
    got = {r["check_name"]: (r["total"], r["violations"], r["passed"]) for r in q.run_checks(rows, wrong + fine).collect()}
    none = (None, None, 0)
    want = {"no_column": none, "no_syntax": none, "uniqueness_absent": none, "range_absent": none, "completeness_code": (5, 1, 0), "uniqueness_id": (4, 0, 1)}
    assert got == want
    bad_cast = q.consistent("bad_cast", "cast(code AS int) > 0")
    got = {r["check_name"]: (r["total"], r["violations"], r["passed"]) for r in q.run_suite(rows, [bad_cast, *wrong, *fine]).collect()}
    assert got == {"bad_cast": none, **want}


def test_uniqueness_without_values(spark):
    rows = frame(spark).withColumn("empty", F.lit(None).cast("string"))
    got = {r["check_name"]: (r["total"], r["violations"], r["passed"]) for r in q.run_checks(rows, [q.unique("empty"), q.unique("net")]).collect()}
    assert got == {"uniqueness_empty": (0, 0, 1), "uniqueness_net": (4, 0, 1)}
    assert {r["total"] for r in q.run_checks(rows.limit(0), [q.unique("empty"), q.unique("net")]).collect()} == {0}


def test_score_levels(spark):
    for passed, status, points in ((12, "PASS", 100.0), (7, "FAIL", 58.3), (8, "WARN", 66.7)):
        rows = spark.createDataFrame([(int(i < passed),) for i in range(12)], "passed int")
        got = q.score(rows, "x").first()
        assert (got["status"], got["score"], got["failed"]) == (status, points, 12 - passed)


def test_no_rows(spark):
    got = q.run_checks(frame(spark).filter("id > 99"), [q.complete("code"), q.unique("code"), q.within("net", 0, 1)]).collect()
    assert [(r["total"], r["passed"]) for r in got] == [(0, 0), (0, 1), (0, 1)]


def test_outliers(spark):
    values = [10.0] * 30 + [11.0] * 30 + [500.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, v double")
    assert [r["v"] for r in q.z_scores(df, "v").filter("z > 3").collect()] == [500.0]
    assert [r["v"] for r in q.iqr_outliers(df, "v").collect()] == [500.0]
    got = q.anomaly_profile(df, "v").first()
    assert (got["total_records"], got["z_outliers"], got["iqr_outliers"]) == (61, 1, 1)


def test_constant_has_no_outliers(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(9)], "id bigint, v double")
    assert q.z_scores(df, "v").filter("z > 3").count() == 0 and q.iqr_outliers(df, "v").count() == 0


def test_attendance_and_spikes(spark):
    days = spark.createDataFrame([(1, 10, 26), (2, 13, 26), (3, 12, None), (4, None, 26)], "id int, days_present int, working_days int")
    assert sorted(r["id"] for r in q.low_attendance(days).collect()) == [1, 3, 4]
    pay = spark.createDataFrame([(1, 1, 1, 100.0), (1, 2, 2, 140.0), (1, 3, 3, 150.0), (2, 1, 4, 0.0), (2, 2, 5, 90.0)], "e int, m int, id int, net double")
    assert [(r["id"], r["change_pct"]) for r in q.spikes(pay, "e", "m", "id", "net").collect()] == [(2, 40.0)]
