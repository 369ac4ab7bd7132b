"""Exact order statistics by histogram refinement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.session import settled

#: Buckets in which a value is twice another, and parts that a bucket is cut into when it is looked at again.
PER_OCTAVE, PARTS = 1024, 65536


def coarse(value: Column) -> Column:
    """A bucket number that grows with the value: its logarithm in steps, mirrored below zero."""
    x = value.cast("double")
    return (F.signum(x) * F.floor(F.log2(F.abs(x) + 1) * PER_OCTAVE)).cast("int")


def _summed(histogram: DataFrame, by: list[str], bucket: str) -> DataFrame:
    upto = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    return histogram.withColumn("_upto", F.sum("_n").over(upto))


def _holding(at: Column) -> Column:
    return (at <= F.col("_upto")) & (at > F.col("_upto") - F.col("_n"))


def _first(histogram: DataFrame, by: list[str], spots: dict[str, Column]) -> DataFrame:
    """Of each spot of a group its bucket and the place in that."""
    rows = _summed(histogram, by, "_bucket").withColumn("group_rows", F.sum("_n").over(Window.partitionBy(*by)))
    named = F.array(*[F.struct(F.lit(n).alias("spot"), e.cast("bigint").alias("at")) for n, e in spots.items()])
    held = rows.select(*by, "_bucket", "_n", "_lo", "_hi", "_upto", F.inline(F.filter(named, lambda s: _holding(s["at"]))))
    return held.select(*by, "spot", (F.col("at") - F.col("_upto") + F.col("_n")).alias("at"), "_bucket", "_lo", "_hi")


def _within(histogram: DataFrame, by: list[str], spots: DataFrame) -> DataFrame:
    """The same for spots whose bucket was cut into parts."""
    rows = _summed(histogram, by, "_part")
    met = spots.join(rows, _equal(spots, rows, by)).filter(_holding(F.col("at")))
    return met.select(*[spots[b] for b in by], "spot", (F.col("at") - F.col("_upto") + F.col("_n")).alias("at"), rows["_lo"], rows["_hi"])


def _equal(a: DataFrame, b: DataFrame, by: list[str]) -> Column:
    """``by`` ends in the bucket, which is never null and gives the join its key."""
    cond = a[by[-1]] == b[by[-1]]
    for c in by[:-1]:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def positions_from(df: DataFrame, histogram: DataFrame, value: str, spots: dict[str, Column], by: list[str]) -> DataFrame:
    """The values at 1-based positions of each group of ``df``, given the stored ``histogram`` (``by``, ``_bucket``, ``_n``, ``_lo``, ``_hi``).

    ``spots`` are expressions over ``group_rows``. A bucket in which all values are equal answers at once. Of the others only the
    rows that lie in a bucket with a wanted position are read, cut into PARTS by value, and so on until every
    part holds one value: each round divides the range by PARTS, so money takes one. No rows are sorted; the windows
    run over histograms, whose size is bounded by the number of buckets.
    """
    open_ = settled(_first(histogram, by, spots), "wanted")
    keyed = df.select(*by, F.col(value).alias("_value"), coarse(F.col(value)).alias("_bucket"))
    found = open_.filter("_lo = _hi").select(*by, "spot", F.col("_lo").alias("_value"))
    while True:
        still = open_.filter("_lo <> _hi")
        if still.isEmpty():
            break
        ranges = settled(still.select(*by, "_bucket", "_lo", "_hi").distinct(), "ranges")
        cut = keyed.join(ranges, _equal(keyed, ranges, [*by, "_bucket"]) & keyed["_value"].between(ranges["_lo"], ranges["_hi"]))
        share = (F.col("_value") - F.col("_lo")).cast("double") / (F.col("_hi") - F.col("_lo")).cast("double")
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).cast("int")
        inner = cut.groupBy(*[keyed[b] for b in by], keyed["_bucket"], ranges["_lo"].alias("_from"), part.alias("_part")).agg(
            F.count("*").alias("_n"), F.min("_value").alias("_lo"), F.max("_value").alias("_hi")
        )
        spot = settled(still.select(*by, "spot", "at", "_bucket", F.col("_lo").alias("_from")), "spots")
        open_ = settled(_within(inner, [*by, "_bucket", "_from"], spot).drop("_from"), "wanted")
        found = found.unionByName(open_.filter("_lo = _hi").select(*by, "spot", F.col("_lo").alias("_value")))
    picks = [F.max(F.when(F.col("spot") == n, F.col("_value"))).alias(n) for n in spots]
    return found.groupBy(*by).agg(*picks)


def value_histogram(df: DataFrame, value: str, by: list[str], extra: list[Column] = ()) -> DataFrame:
    """Rows, least and greatest value of each group and coarse bucket, stored; ``extra`` are more partial aggregates."""
    counts = df.groupBy(*by, coarse(F.col(value)).alias("_bucket")).agg(
        F.count("*").alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), *extra
    )
    return settled(counts, "histogram")


def at_positions(df: DataFrame, value: str, spots: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """One row per group with the values at 1-based positions of the sorted group; null values are left out.

    ``spots`` maps a column name to an expression over ``group_rows``. ``df`` is read once whole and once
    filtered for each round, so it should be a stored table. Values are numbers; equal ones need no tie-break, since only values are returned.
    """
    by = list(by or [])
    rows = df.select(*by, value).filter(F.col(value).isNotNull())
    return positions_from(rows, value_histogram(rows, value, by), value, spots, by)
