"""Join shapes the payroll jobs need beyond a plain equi join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.operators.history import micros
from wagewright.operators.ordering import PART, join_parts, with_slices
from wagewright.session import settled


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order (the rest is cut map-side)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", rank).filter(F.col("_nth") == 1).drop("_nth")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    last_by: list[Column],
    how: str = "left",
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """At most one match per left row: the last right row by ``last_by`` wins.

    Misses of a left lookup take ``defaults``. The de-duplicated side is stored
    first: from its file size the planner decides for or against a broadcast,
    and only in the second case the left side is shuffled.
    """
    unique = settled(first_per_key(right, [on], last_by), "lookup")
    out = left.join(unique, on, how)
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def interval_join(facts: DataFrame, day: str, intervals: DataFrame, start: str, end: str, on: tuple[str, ...] = ()) -> DataFrame:
    """Facts to the date intervals that contain them (both ends included).

    Each interval is spread over the months it touches, which gives the join an
    equality key beside the columns ``on`` that both sides share; the exact range
    is the residual condition. The spread intervals are stored, so the planner
    knows their size. A null end is open: it reaches the last fact's day. An
    interval without a start, or whose end lies before its start, holds no day.
    """
    last = facts.agg(F.max(F.to_date(day)).alias("_last")).scalar()
    until = F.coalesce(F.col(end), last)
    months = F.sequence(F.trunc(F.col(start), "month"), F.trunc(until, "month"), F.expr("interval 1 month"))
    spread = intervals.withColumn("_month", F.explode(F.when(F.col(start) <= until, months)))
    spread = settled(spread.withColumnsRenamed({k: f"_on_{k}" for k in on}), "intervals")
    keyed = facts.withColumn("_fact_month", F.trunc(F.col(day), "month"))
    inside = (F.col(day) >= F.col(start)) & (F.col(end).isNull() | (F.col(day) <= F.col(end)))
    hit = (F.col("_fact_month") == F.col("_month")) & inside
    for k in on:
        hit = hit & (F.col(k) == F.col(f"_on_{k}"))
    return keyed.join(spread, hit).drop("_month", "_fact_month", *[f"_on_{k}" for k in on])


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    fact_time: str,
    fact_id: str,
    version_time: str,
    version_id: str,
    carry: list[str],
    slices: int | None = None,
) -> DataFrame:
    """The version valid at each fact's time: the last one starting at or before it.

    Facts and versions are merged into one ordered stream per key, so a key with
    many facts and many versions never multiplies the two. Facts older than
    every version get NULL. The stream is always cut into slices of time, whose
    number is ``slices`` or the session's shuffle partitions, and the last
    version of a key's earlier slices is carried in, so a hot key is spread.
    Versions and facts without a time are no match and match none. Whole numbers
    will do for times.
    """
    kinds = (dict(facts.dtypes)[fact_time], dict(versions.dtypes)[version_time])
    zoned = "timestamp" in kinds
    instant = (lambda c: F.col(c).cast("bigint")) if set(kinds) <= {"int", "bigint"} else (lambda c: micros(c, zoned))
    payload = F.struct(*[F.col(c) for c in carry])
    fact_cols = [c for c in facts.columns if c not in keys]
    old = versions.select(
        *keys, instant(version_time).alias("_at"), F.lit(0).alias("_kind"), F.col(version_id).cast("bigint").alias("_id"),
        payload.alias("_version"),
    )
    new = facts.select(
        *keys, instant(fact_time).alias("_at"), F.lit(1).alias("_kind"), F.col(fact_id).cast("bigint").alias("_id"),
        F.struct(*fact_cols).alias("_fact"),
    )
    both = old.unionByName(new, allowMissingColumns=True)
    order = ["_at", "_kind", "_id"]

    # At one instant versions come first, in one slice; facts after them in any order, so a hash spreads them.
    spread = 1 + F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    both = settled(both, "asof")  # read for the slices' bounds, for what is carried on and for the result
    timed = both.filter(F.col("_at").isNotNull()).withColumn("_tie_at", F.when(F.col("_kind") == 0, F.lit(0.0)).otherwise(spread))
    here = Window.partitionBy(*keys, *PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cut = with_slices(timed, "_at", "_tie_at", slices=slices).withColumn("_seen", F.last("_version", ignorenulls=True).over(here))
    last = cut.groupBy(*keys, *PART).agg(
        F.max(F.when(F.col("_version").isNotNull(), F.struct(*order, "_version"))).alias("_last")
    )
    earlier = Window.partitionBy(*keys).orderBy(*PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*keys, *PART, F.last("_last", ignorenulls=True).over(earlier)["_version"].alias("_carried"))
    seen = join_parts(cut, carried, list(keys)).withColumn("_seen", F.coalesce("_seen", "_carried"))
    untimed = both.filter(F.col("_at").isNull()).withColumn("_seen", F.lit(None).cast(both.schema["_version"].dataType))
    filled = seen.select(*both.columns, "_seen").unionByName(untimed)
    return filled.filter(F.col("_kind") == 1).select(
        *keys, *[F.col("_fact")[c].alias(c) for c in fact_cols], *[F.col("_seen")[c].alias(c) for c in carry]
    )
