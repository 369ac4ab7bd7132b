"""Results that must not change with the size of values."""

from pyspark.sql import functions as F

from wagewright.functions.numeric import rounded
from wagewright.operators.joins import asof_join
from wagewright.operators.ordering import ranked


def test_rounding_of_large_ties(spark):
    values = [8000001.4444445, 1.4444445, 8999.0000005, 9000.0000005, 123456789.125, 89999999.125]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(rounded("x", 6).alias("a"), rounded("x", 2).alias("b")).collect()
    assert [r.a for r in got[:4]] == [8000001.444445, 1.444445, 8999.000001, 9000.000001]
    assert [r.b for r in got[4:]] == [123456789.13, 89999999.13]


def test_large_ids_sort_after_their_versions(spark):
    """A version with a large id that begins at the instant of its facts, on a key that is cut into slices."""
    facts = spark.range(400).select(F.lit(1).alias("k"), F.col("id").alias("fact_id"), F.timestamp_seconds(F.lit(1000)).alias("at"))
    versions = spark.createDataFrame([(1, 7, 500, "old"), (1, 5 * 10**15, 1000, "new")], "k int, version_id long, s long, tag string")
    versions = versions.select("k", "version_id", F.timestamp_seconds("s").alias("since"), "tag")
    for slices in (None, 40):
        got = asof_join(facts, versions, ["k"], "at", "fact_id", "since", "version_id", ["tag"], slices=slices)
        assert [tuple(r) for r in got.groupBy("tag").count().collect()] == [("new", 400)]


def test_values_that_share_a_double(spark):
    """Whole numbers above 2^53 and long decimals are ranked by their own value, however crowded their double."""
    big = 2**53
    ids = spark.range(600).withColumn("v", big + F.col("id") % 3)
    for kind in ("bigint", "decimal(28,2)"):
        rows = ids.select("id", F.col("v").cast(kind).alias("v"))
        for descending in (False, True):
            got = ranked(rows, "v", "id", descending=descending, want=("row_number", "rank", "dense_rank")).collect()
            place = {big + i: (2 - i if descending else i) for i in range(3)}
            assert {(int(r.v), r["rank"], r["dense_rank"]) for r in got} == {(v, 200 * p + 1, p + 1) for v, p in place.items()}
            want = sorted(got, key=lambda r: (-r.v if descending else r.v, r.id))
            assert [r["row_number"] for r in want] == list(range(1, 601))
