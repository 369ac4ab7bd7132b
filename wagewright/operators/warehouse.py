"""Warehouse loads: calendar, star dimensions, type-2 history, ETL and ELT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.functions import calendar as cal
from wagewright.functions.text import row_hash
from wagewright.operators.history import over_history
from wagewright.operators.joins import first_per_key
from wagewright.session import settled


def calendar_dimension(df: DataFrame, day: str) -> DataFrame:
    """One row per day from the first to the last month seen in ``day``."""
    span = df.agg(F.trunc(F.min(day), "month").alias("lo"), F.last_day(F.max(day)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    y, m = F.year("d"), F.month("d")
    workday = (~cal.is_weekend("d")).cast("int")
    in_month = Window.partitionBy(y, m).orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return days.select(
        (y * 10000 + m * 100 + F.day("d")).alias("date_key"),
        F.date_format("d", "yyyy-MM-dd").alias("full_date"),
        F.day("d").alias("day"), F.weekofyear("d").alias("week"), m.alias("month"), F.quarter("d").alias("quarter"), y.alias("year"),
        F.date_format("d", "MMMM").alias("month_name"), F.date_format("d", "EEEE").alias("day_name"),
        cal.is_weekend("d").cast("int").alias("is_weekend"), cal.fiscal_year(y, m).alias("fiscal_year"),
        F.sum(workday).over(in_month).alias("working_day_num"),
    )


def period_dimension(df: DataFrame, day: str) -> DataFrame:
    """Pay periods: one row per month seen, with quarter and fiscal year."""
    months = df.select(F.trunc(day, "month").alias("start_date")).distinct()
    y, m = F.year("start_date"), F.month("start_date")
    return months.select(
        cal.month_key(y, m).cast("bigint").alias("period_key"), F.date_format("start_date", "yyyy-MM").alias("period"),
        y.alias("year"), m.alias("month"), F.date_format("start_date", "yyyy-MM-dd").alias("start_date"),
        F.date_format(F.last_day("start_date"), "yyyy-MM-dd").alias("end_date"),
        F.concat(F.lit("Q"), F.quarter("start_date").cast("string")).alias("quarter"), cal.fiscal_year(y, m).alias("fiscal_year"),
    )


def type2_history(df: DataFrame, key: str, changed_at: str, tie: str, tracked: list[str], **limits) -> DataFrame:
    """Type-2 versions out of a change history.

    Equal consecutive states collapse into one version; each version ends when
    the next one starts, and the last is current.
    """
    states = df.withColumn("row_hash", row_hash(*tracked))
    marked = over_history(states, [key], changed_at, tie, {"_before": lambda w: F.lag("row_hash").over(w)}, back=1, **limits)
    starts = marked.filter(F.col("_before").isNull() | (F.col("_before") != F.col("row_hash"))).drop("_before")
    closed = over_history(starts, [key], changed_at, tie, {"effective_to": lambda w: F.lead(changed_at).over(w)}, ahead=1, **limits)
    return closed.withColumnRenamed(changed_at, "effective_from").withColumn(
        "is_current", F.col("effective_to").isNull().cast("int")
    )


def type2_load(current: DataFrame, incoming: DataFrame, key: str, tracked: list[str], order: list[Column] | None = None, **limits) -> DataFrame:
    """Load dated states, late ones too, into a type-2 dimension.

    ``current`` holds key, tracked columns, row_hash, effective_from, effective_to and is_current; ``incoming`` key, tracked
    columns and effective_from. The versions of a key are a function of time that steps where a version starts, and to
    nothing where one ends and no other starts. An incoming state is one more step: it splits the version its date falls in
    and holds until the next step, so later versions stay as they are. On the date of an existing start it replaces that
    version. Of several incoming states of one key and date the first in ``order`` counts (by default the largest hash).
    In these keys equal neighbours become one version, so loading the same rows again changes nothing.

    Keys without incoming states pass through. Incoming rows without a key or date are left out. ``limits`` as in
    ``history.over_history``: ``chunk_rows`` cuts a long history into chunks.
    """
    kind = dict(current.dtypes)["effective_from"]
    fresh = incoming.filter(F.col(key).isNotNull() & F.col("effective_from").isNotNull())
    fresh = fresh.withColumn("effective_from", F.col("effective_from").cast(kind)).withColumn("row_hash", row_hash(*tracked))
    fresh = first_per_key(fresh, [key, "effective_from"], order or [F.desc("row_hash")])
    touched = settled(fresh.select(key).distinct(), "touched")  # its size decides how the old versions meet it
    own = current.join(touched, key, "left_semi")

    def steps(df: DataFrame, at: str, weight: int, empty: bool = False) -> DataFrame:
        kinds = dict(current.dtypes)
        state = [(F.lit(None) if empty else F.col(c)).cast(kinds[c]).alias(c) for c in [*tracked, "row_hash"]]
        return df.select(key, F.col(at).alias("_day"), F.lit(weight).alias("_weight"), F.struct(*state).alias("_state"))

    every = steps(own.filter("effective_to IS NOT NULL"), "effective_to", 0, empty=True)
    # A version that ends on the day it starts never held.
    every = every.unionByName(steps(own.filter("effective_to IS NULL OR effective_to > effective_from"), "effective_from", 1)).unionByName(steps(fresh, "effective_from", 2))
    one = every.groupBy(key, "_day").agg(F.max("_weight").alias("_weight"), F.max_by("_state", "_weight").alias("_state"))
    was = over_history(one, [key], "_day", "_weight", {"_was": lambda w: F.lag("_state.row_hash").over(w)}, back=1, **limits)
    changed = was.filter(~F.col("_was").eqNullSafe(F.col("_state.row_hash"))).drop("_was")
    closed = over_history(changed, [key], "_day", "_weight", {"effective_to": lambda w: F.lead("_day").over(w)}, ahead=1, **limits)
    loaded = closed.filter("_state.row_hash IS NOT NULL").select(
        key, "_state.*", F.col("_day").alias("effective_from"), "effective_to", F.col("effective_to").isNull().cast("int").alias("is_current")
    )
    return current.join(touched, key, "left_anti").unionByName(loaded.select(*current.columns))


def type2_apply(current: DataFrame, incoming: DataFrame, key: str, tracked: list[str], as_of: str, order: list[Column] | None = None, **limits) -> DataFrame:
    """``type2_load`` of undated states, all of the day ``as_of``."""
    dated = incoming.withColumn("effective_from", F.lit(as_of).cast("date"))
    return type2_load(current, dated, key, tracked, order, **limits)


def retained_versions(history: DataFrame, horizon: str | Column, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """The rows of a dated table that some instant from ``horizon`` on can see: open ones and those that end after it.

    ``snapshots.valid_at`` gives the same rows for every instant from the horizon on. A filter, so no sort and no shuffle.
    """
    at = (F.lit(horizon) if isinstance(horizon, str) else horizon).cast(dict(history.dtypes)[start])
    return history.filter(F.col(end).isNull() | ((F.col(end) > at) & (F.col(end) > F.col(start))))


def retained_changes(history: DataFrame, keys: list[str], at: str, tie: str, horizon: str | Column, gone: Column | None = None) -> DataFrame:
    """The same for rows that only say since when they hold: those after ``horizon``, and of each key the last one up to it.

    Of rows of one instant the largest ``tie`` is the last; ``gone`` tells rows that delete their key, which are dropped when
    they are the last up to the horizon. The last row of a key is an aggregate, combined before the shuffle; later rows aren't moved.
    """
    limit = (F.lit(horizon) if isinstance(horizon, str) else horizon).cast(dict(history.dtypes)[at])
    rest = [c for c in history.columns if c not in (*keys, at, tie)]
    last = history.filter(F.col(at) <= limit).groupBy(*keys).agg(F.max_by(F.struct(at, tie, *rest), F.struct(at, tie)).alias("_last"))
    seen = last.select(*keys, "_last.*")
    if gone is not None:
        seen = seen.filter(~F.coalesce(gone, F.lit(False)))
    return history.filter(F.col(at) > limit).unionByName(seen.select(*history.columns))
