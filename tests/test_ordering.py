"""Sliced ranks against a plain sort, with ties, hot values and one large group."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wagewright.operators import ordering as o
from wagewright.operators.aggregate import aggregate_fields, grouped_lists

SCHEMA = "g string, v decimal(18,2), id bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, v double, id bigint").select("g", F.col("v").cast("decimal(18,2)").alias("v"), "id").repartition(5)


def hot_rows(n=3000, seed=7):
    """A third of the rows share one value; one group holds most rows."""
    rnd = random.Random(seed)
    return [
        ("big" if rnd.random() < 0.7 else f"g{i % 5}", 500.0 if i % 3 == 0 else float(rnd.randint(-900, 900)) / 4, i) for i in range(n)
    ]


def compare(spark, rows, by, desc, slices=16):
    df = frame(spark, rows)
    order = F.col("v").desc() if desc else F.col("v").asc()
    part = Window.partitionBy(*by)
    full = part.orderBy(order, "id")
    want = df.select(
        "id", F.row_number().over(full).alias("row_number"), F.rank().over(part.orderBy(order)).alias("rank"),
        F.dense_rank().over(part.orderBy(order)).alias("dense_rank"), F.count("*").over(part).alias("group_rows"),
        F.sum("v").over(full.rowsBetween(Window.unboundedPreceding, 0)).alias("running_total"),
    )
    got = o.ranked(df, "v", "id", by, desc, ("row_number", "rank", "dense_rank", "group_rows"), running="v", slices=slices)
    cols = ["id", "row_number", "rank", "dense_rank", "group_rows", "running_total"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("desc", [True, False])
def test_ranked_hot_values(spark, by, desc):
    compare(spark, hot_rows(), by, desc)


def test_hot_value_is_cut_along_the_tie(spark):
    """The hot value may not land in one slice."""
    cut = o.with_slices(frame(spark, hot_rows()), "v", "id", slices=16)
    biggest = cut.groupBy(o.SLICE, o.TIE).count().agg(F.max("count")).first()[0]
    assert cut.filter(o.HOT).count() == 1000
    assert biggest < 500


def test_null_group_is_a_group(spark):
    compare(spark, [(None if i % 2 else "a", float(i % 7), i) for i in range(200)], ["g"], False, slices=8)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-3, 3).map(float)), min_size=1, max_size=60))
def test_ranked_any_rows(spark, rows):
    compare(spark, [(g, v, i) for i, (g, v) in enumerate(rows)], ["g"], True, slices=8)


def test_ranked_empty(spark):
    assert o.ranked(frame(spark, hot_rows()).filter("id < 0"), "v", "id").count() == 0


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10, 23])
def test_ntile(spark, n):
    rows = spark.range(n).withColumn("r", F.col("id") + 1).withColumn("n", F.lit(n))
    want = rows.withColumn("t", F.ntile(4).over(Window.orderBy("r")))
    got = rows.withColumn("t", o.ntile(4, "r", "n"))
    assert [r["t"] for r in got.orderBy("r").collect()] == [r["t"] for r in want.orderBy("r").collect()]


def test_gini(spark):
    values = [1.0, 2.0, 3.0, 10.0, 10.0, 10.0]
    got = o.gini(frame(spark, [("a", v, i) for i, v in enumerate(values)]), "v", "id").first()["gini"]
    pairs = sum(abs(a - b) for a in values for b in values) / (2 * len(values) ** 2 * (sum(values) / len(values)))
    assert abs(got - pairs) < 1e-12


def test_named_aggregates(spark):
    """The published department sample: sums, means and a deviation of 0 for one record."""
    rows = [("HR", 65850.0, 1), ("HR", 175200.0, 2), ("Finance", 32400.0, 3), (None, 5.0, 4)]
    out = {r["g"]: r for r in aggregate_fields(frame(spark, rows), "g", {"v": ["sum", "mean", "median", "std", "range", "pct_25"]}).collect()}
    assert out["HR"]["v_sum"] == 241050.0 and out["HR"]["v_mean"] == 120525.0 and out["HR"]["v_median"] == 120525.0
    assert out["Finance"]["v_std"] == 0.0 and out["HR"]["v_range"] == 109350.0 and out["HR"]["v_pct_25"] == 65850.0
    assert out["Unknown"]["record_count"] == 1


def test_lists_stay_short_and_whole(spark):
    rows = grouped_lists(frame(spark, [("hot", float(i), i) for i in range(105)]), "g", "v", "id", size=20).collect()
    assert sorted(len(r["values"]) for r in rows) == [5, 20, 20, 20, 20, 20]
    assert sorted(float(v) for r in rows for v in r["values"]) == [float(i) for i in range(105)]
