"""Histories of hot entities must come out as from a plain window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from wagewright.operators.history import latest_n, over_history
from wagewright.operators.joins import asof_join, interval_join, lookup_join
from wagewright.operators.warehouse import type2_apply, type2_history


def events(spark, n=900):
    rnd = random.Random(3)
    rows = [(1 if i % 3 else i % 40, rnd.randint(0, 200), i, float(rnd.randint(0, 50))) for i in range(n)]
    df = spark.createDataFrame(rows, "k bigint, t bigint, id bigint, v double")
    return df.select("k", F.timestamp_seconds("t").alias("t"), "id", "v").repartition(4)


EXPRS = {
    "prev": lambda w: F.lag("v").over(w),
    "next": lambda w: F.lead("v").over(w),
    "roll": lambda w: F.sum("v").over(w.rowsBetween(-4, 0)),
}


def test_hot_entity_in_chunks(spark):
    df = events(spark)
    plain = df.withColumns({n: e(Window.partitionBy("k").orderBy("t", "id")) for n, e in EXPRS.items()})
    cut = over_history(df, ["k"], "t", "id", EXPRS, back=4, ahead=1, chunk_rows=37)
    assert sorted(map(tuple, cut.collect()), key=lambda r: r[2]) == sorted(map(tuple, plain.collect()), key=lambda r: r[2])


def test_chunk_smaller_than_the_frame(spark):
    """A chunk is never shorter than the rows it has to lend."""
    df = events(spark, 120)
    plain = df.withColumn("roll", EXPRS["roll"](Window.partitionBy("k").orderBy("t", "id")))
    cut = over_history(df, ["k"], "t", "id", {"roll": EXPRS["roll"]}, back=4, chunk_rows=2)
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_latest_n(spark):
    got = latest_n(events(spark), ["k"], [F.col("id").desc()], 2)
    assert got.filter("k = 1 AND position = 1").first()["id"] == events(spark).filter("k = 1").agg(F.max("id")).first()[0]
    assert got.groupBy("k").count().agg(F.max("count")).first()[0] == 2


def test_asof_hot_key(spark):
    rnd = random.Random(11)
    facts = spark.createDataFrame([(1 if i % 2 else 2, rnd.randint(0, 400), i) for i in range(600)], "k bigint, t bigint, f bigint")
    versions = spark.createDataFrame([(1 if i % 4 else 2, rnd.randint(0, 400), i, f"v{i}") for i in range(90)], "k bigint, t bigint, vid bigint, name string")
    facts = facts.select("k", F.timestamp_seconds("t").alias("at"), "f")
    versions = versions.select("k", F.timestamp_seconds("t").alias("since"), "vid", "name")
    want = {}
    known = [tuple(r) for r in versions.collect()]
    for r in facts.collect():
        past = [(v[1], v[2], v[3]) for v in known if v[0] == r["k"] and v[1] <= r["at"]]
        want[r["f"]] = max(past)[2] if past else None
    for slices in (None, 20):
        got = asof_join(facts, versions, ["k"], "at", "f", "since", "vid", ["vid", "name"], slices=slices)
        assert {r["f"]: r["name"] for r in got.collect()} == want


def test_interval_join_ends_included(spark):
    days = spark.sql("SELECT explode(sequence(date'2026-01-28', date'2026-03-05', interval 1 day)) AS d")
    spans = spark.sql("SELECT * FROM VALUES ('a', date'2026-01-30', date'2026-02-02'), ('b', date'2026-02-28', date'2026-03-01') AS t(n, s, e)")
    got = interval_join(days, "d", spans, "s", "e").groupBy("n").count()
    assert {r["n"]: r["count"] for r in got.collect()} == {"a": 4, "b": 2}


def test_interval_join_open_reversed_and_keyed(spark):
    days = spark.sql("SELECT k, explode(sequence(date'2026-01-28', date'2026-03-05', interval 1 day)) AS d FROM VALUES (1), (2) AS t(k)")
    spans = spark.sql("""SELECT * FROM VALUES ('open', 1, date'2026-03-01', CAST(NULL AS DATE)), ('turned', 1, date'2026-02-02', date'2026-01-30'),
        ('late', 2, date'2027-01-01', NULL), ('none', 2, NULL, date'2026-02-02'), ('one', 2, date'2026-02-02', date'2026-02-02') AS t(n, k, s, e)""")
    got = interval_join(days, "d", spans, "s", "e", on=("k",)).groupBy("k", "n").count()
    assert {(r["k"], r["n"]): r["count"] for r in got.collect()} == {(1, "open"): 5, (2, "one"): 1}
    assert interval_join(days, "d", spans.drop("k"), "s", "e").filter("n = 'open'").count() == 10


def test_lookup_last_wins_and_defaults(spark):
    left = spark.createDataFrame([(1,), (2,)], "k bigint")
    right = spark.createDataFrame([(1, 1, "old"), (1, 2, "new")], "k bigint, seq bigint, name string")
    got = lookup_join(left, right, "k", [F.col("seq").desc()], defaults={"name": ""})
    assert {r["k"]: r["name"] for r in got.collect()} == {1: "new", 2: ""}


def test_type2_history_and_load(spark):
    states = spark.sql("""SELECT * FROM VALUES (1, timestamp'2026-01-01', 1, 'A'), (1, timestamp'2026-02-01', 2, 'A'),
        (1, timestamp'2026-03-01', 3, 'B'), (1, timestamp'2026-04-01', 4, 'A') AS t(k, at, id, s)""")
    for limits in ({}, {"chunk_rows": 1}):
        dim = type2_history(states, "k", "at", "id", ["s"], **limits).orderBy("effective_from").collect()
        assert [(r["s"], r["is_current"]) for r in dim] == [("A", 0), ("B", 0), ("A", 1)]
        assert dim[0]["effective_to"] == dim[1]["effective_from"]
    current = type2_apply(
        spark.createDataFrame([], "k int, s string, row_hash string, effective_from date, effective_to date, is_current int"),
        spark.sql("SELECT * FROM VALUES (1,'A'), (2,'B') AS t(k, s)"), "k", ["s"], "2026-01-01",
    )
    later = type2_apply(current, spark.sql("SELECT * FROM VALUES (1,'A'), (2,'C'), (3,'D') AS t(k, s)"), "k", ["s"], "2026-02-01")
    assert sorted((r["k"], r["s"], r["is_current"]) for r in later.collect()) == [(1, "A", 1), (2, "B", 0), (2, "C", 1), (3, "D", 1)]
    again = type2_apply(later, spark.sql("SELECT * FROM VALUES (2,'C') AS t(k, s)"), "k", ["s"], "2026-03-01")
    assert again.count() == later.count()
