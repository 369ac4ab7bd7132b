"""How many intervals hold on each day, by sweeping over their ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def active_steps(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """``keys``, ``day``, ``before`` and ``after``: the intervals that hold up to and from each day on which that number changes.

    An interval of whole days (both included) is +1 on its first day and -1 on the day after its last; the sum of all
    steps so far is what holds. Steps of one day are added up before they are ordered, so a window sees one row per key and
    day, whatever number of intervals. An interval without an end, or whose end lies before its start, is none.
    """
    whole = intervals.filter(F.col(start) <= F.col(end))
    steps = whole.select(*keys, F.inline(F.array(
        F.struct(F.col(start).alias("day"), F.lit(1).alias("step")), F.struct(F.date_add(end, 1).alias("day"), F.lit(-1).alias("step"))
    )))
    daily = steps.groupBy(*keys, "day").agg(F.sum("step").alias("step")).filter("step <> 0")
    upto = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("after", F.sum("step").over(upto)).select(*keys, "day", (F.col("after") - F.col("step")).alias("before"), "after")


def load_by_day(intervals: DataFrame, group: str, member: str, start: str, end: str) -> DataFrame:
    """Per ``group`` and day with any: ``requests`` that hold, ``away`` (members with one or more), ``overlapping`` (members with two or more) and ``peak`` (1 on the days with the group's most away).

    A member's own steps give the changes of the three numbers, which are added up by group and day and summed along the days: no interval is
    ever joined with another, or with a calendar. Days between two changes repeat the numbers.
    """
    def change(of) -> Column:
        return F.sum(of(F.col("after")) - of(F.col("before")))

    own = active_steps(intervals, [group, member], start, end)
    moves = own.groupBy(group, "day").agg(
        change(lambda n: n).alias("requests"), change(lambda n: (n > 0).cast("long")).alias("away"), change(lambda n: (n > 1).cast("long")).alias("overlapping")
    )
    along = Window.partitionBy(group).orderBy("day")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    totals = moves.select(group, "day", *[F.sum(c).over(upto).alias(c) for c in ("requests", "away", "overlapping")], F.lead("day").over(along).alias("next_day"))
    held = totals.filter("requests > 0").withColumn("peak", (F.col("away") == F.max("away").over(Window.partitionBy(group))).cast("int"))
    days = F.sequence(F.col("day"), F.date_sub("next_day", 1), F.expr("interval 1 day"))
    return held.select(group, F.explode(days).alias("day"), "requests", "away", "overlapping", "peak")
