"""Order statistics by histogram refinement against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from wagewright.operators import ordering as o
from wagewright.operators import selection
from wagewright.operators.aggregate import aggregate_fields

def spots():
    return {"q1": o.lower_quarter(), "q3": o.upper_quarter(), "lo": o.lower_middle(), "hi": o.upper_middle(), "least": F.lit(1), "most": F.col("group_rows")}


def check(got, values):
    s, n = sorted(values), len(values)
    want = {"q1": s[n // 4], "q3": s[3 * n // 4], "lo": s[(n + 1) // 2 - 1], "hi": s[n // 2], "least": s[0], "most": s[-1]}
    assert {k: got[k] for k in want} == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 100])
def test_positions(spark, n):
    values = [float((i * 37) % 101) for i in range(n)]
    check(selection.at_positions(spark.createDataFrame([(v,) for v in values], "v double"), "v", spots()).first(), values)


@pytest.mark.parametrize("parts", [2, 7, 65536])
def test_every_kind_of_number(spark, monkeypatch, parts):
    """Few parts take many rounds; the values are the same."""
    monkeypatch.setattr(selection, "PARTS", parts)
    draw = random.Random(parts)
    kinds = {
        "bigint": [draw.choice([2**53 + k for k in range(9)] + [-(2**62), 7, 7, 7]) for _ in range(90)],
        "double": [draw.choice([1.0, 1.0000000000000002, -1e300, 5e-324, 0.0, 1e16]) for _ in range(90)] + [draw.uniform(-2, 2) for _ in range(60)],
    }
    for kind, values in kinds.items():
        df = spark.createDataFrame([(draw.choice(["a", "b", None]), v) for v in values] + [("a", None)], f"g string, v {kind}").repartition(4)
        rows = df.collect()
        got = selection.at_positions(df, "v", spots(), ["g"]).collect()
        assert len(got) == 3
        for r in got:
            check(r, [x.v for x in rows if x.g == r.g and x.v is not None])


def test_hot_value_and_hot_group(spark):
    draw = random.Random(4)
    rows = [("big" if draw.random() < 0.7 else f"g{i % 5}", 500.0 if i % 3 == 0 else draw.randint(-90000, 90000) / 4) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double").select("g", F.col("v").cast("decimal(18,2)").alias("v"))
    values = {}
    for r in df.collect():
        values.setdefault(r.g, []).append(r.v)
    for r in selection.at_positions(df, "v", spots(), ["g"]).collect():
        check(r, values[r.g])


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert selection.at_positions(df, "v", spots(), ["g"]).collect() == []


def test_two_ranked_fields_and_none(spark):
    df = spark.createDataFrame([("a", i, 100 - i * i) for i in range(9)] + [(None, None, 3)], "g string, x int, y int")
    got = {r.g: r for r in aggregate_fields(df, "g", {"x": ["median", "sum", "std_pop"], "y": ["pct_25", "count", "max"]}).collect()}
    assert (got["a"].x_median, got["a"].x_sum, got["a"].y_pct_25, got["a"].y_count, got["a"].y_max) == (4.0, 36.0, 64.0, 9, 100.0)
    assert (got["Unknown"].x_median, got["Unknown"].x_std_pop) == (0.0, 0.0)
    assert {r.g: r.x_sum for r in aggregate_fields(df, "g", {"x": ["sum"]}).collect()} == {"a": 36.0, "Unknown": 0.0}
