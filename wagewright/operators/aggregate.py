"""Grouped aggregation by name, pivots, shares and summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.functions.numeric import mean, money, rounded, std, total, zero
from wagewright.operators.ordering import lower_middle, lower_quarter, ranked, upper_middle, upper_quarter
from wagewright.operators.selection import positions_from, value_histogram
from wagewright.session import settled


def _amount(c: str) -> Column:
    return zero(c).cast("decimal(18,2)")


# Aggregates that Spark combines map-side, by the name a caller uses.
AGGREGATES: dict[str, Callable[[str], Column]] = {
    "sum": lambda c: total(_amount(c)),
    "count": lambda c: F.count("*"),
    "mean": lambda c: rounded(mean(_amount(c))),
    "min": lambda c: F.min(_amount(c)).cast("double"),
    "max": lambda c: F.max(_amount(c)).cast("double"),
    "std": lambda c: rounded(std(_amount(c), sample=True)),
    "std_pop": lambda c: rounded(std(_amount(c))),
    "range": lambda c: (F.max(_amount(c)) - F.min(_amount(c))).cast("double"),
}
# Aggregates by position in the sorted group.
POSITIONS = {
    "median": ("_lo", "_hi"),
    "pct_25": ("_q1",),
    "pct_75": ("_q3",),
}
POSITION_EXPRS = {"_lo": lower_middle, "_hi": upper_middle, "_q1": lower_quarter, "_q3": upper_quarter}


#: Partial aggregates of a field, and the named aggregates out of them: the same exact sums in two steps.
PARTIALS: dict[str, Callable[[str], Column]] = {
    "sum": lambda c: F.sum(c), "squares": lambda c: F.sum(F.col(c) * F.col(c)), "least": lambda c: F.min(c), "most": lambda c: F.max(c),
}
NEEDS = {"sum": ("sum",), "mean": ("sum",), "std": ("sum", "squares"), "std_pop": ("sum", "squares"), "min": ("least",), "max": ("most",), "range": ("least", "most"), "count": ()}


def _finished(fn: str, f: str) -> Column:
    n = F.sum("_n").cast("double")
    whole = {k: (F.min if k == "least" else F.max if k == "most" else F.sum)(f"_{f}_{k}") for k in NEEDS[fn]}
    if fn == "count":
        return F.sum("_n")
    if fn == "sum":
        return whole["sum"].cast("double")
    if fn == "mean":
        return rounded(F.try_divide(whole["sum"].cast("double"), n))
    if fn in ("min", "max"):
        return whole["least" if fn == "min" else "most"].cast("double")
    if fn == "range":
        return (whole["most"] - whole["least"]).cast("double")
    s = whole["sum"].cast("double")
    centred = F.greatest(whole["squares"].cast("double") - F.try_divide(s * s, n), F.lit(0.0))
    if fn == "std_pop":
        return rounded(F.sqrt(F.try_divide(centred, n)))
    return rounded(F.coalesce(F.sqrt(F.try_divide(centred, n - F.lit(1.0))), F.lit(0.0)))


def aggregate_fields(df: DataFrame, key: str, fields: dict[str, list[str]]) -> DataFrame:
    """Named aggregates per group; a NULL value counts as 0, a missing key as "Unknown".

    Order statistics come from histograms (``selection``), so a group may be of any size. The first such field's
    histogram also carries the partial sums of all fields: one full read of the rows gives everything but the values
    inside the few buckets that hold a wanted position.
    """
    names = list(fields)
    base = df.select(F.coalesce(F.col(key), F.lit("Unknown")).alias(key), *[_amount(f).alias(f) for f in names])
    placed = [f for f in names if any(fn in POSITIONS for fn in fields[f])]
    plain = {f"{f}_{fn}": (f, fn) for f in names for fn in fields[f] if fn in NEEDS}
    partial = [PARTIALS[k](f).alias(f"_{f}_{k}") for f in names for k in PARTIALS if any(k in NEEDS[fn] for g, fn in plain.values() if g == f)]
    if placed:
        base = settled(base)
        histograms = {f: value_histogram(base, f, [key], partial if f == placed[0] else []) for f in placed}
        parts = histograms[placed[0]]
    else:
        parts = base.groupBy(key).agg(F.count("*").alias("_n"), *partial)
    out = parts.groupBy(key).agg(F.sum("_n").alias("record_count"), *[_finished(fn, f).alias(name) for name, (f, fn) in plain.items()])
    for f in placed:
        asked = [fn for fn in fields[f] if fn in POSITIONS]
        spots = {p: POSITION_EXPRS[p]() for fn in asked for p in POSITIONS[fn]}
        found = positions_from(base, histograms[f], f, spots, [key])
        for fn in asked:
            picks = [F.col(p).cast("double") for p in POSITIONS[fn]]
            found = found.withColumn(f"{f}_{fn}", rounded(sum(picks[1:], picks[0]) / len(picks)))
        out = out.join(found.drop(*spots), key)
    return out


def pivot_table(df: DataFrame, index: str, column: str, value: str, cells: list[str] | None = None, fn: str = "sum") -> DataFrame:
    """Cross table of a named aggregate, empty cells 0.

    With ``cells`` given no pass is spent on finding the column values.
    """
    return df.groupBy(index).pivot(column, cells).agg(AGGREGATES[fn](value)).na.fill(0)


def percent_of_total(df: DataFrame, value: str) -> DataFrame:
    """Share of each row in the grand total; the total is one scalar subquery."""
    whole = df.agg(F.sum(_amount(value)).cast("double").alias("t")).scalar()
    share = F.coalesce(F.try_divide(_amount(value).cast("double") * 100, whole), F.lit(0.0))
    return df.withColumn(f"{value}_pct_of_total", rounded(share, 4))


def named_agg(df: DataFrame, keys: list[str], **aggs: tuple[str, str]) -> DataFrame:
    """``alias=(column, function)`` grouped aggregation; "std" is the population one."""
    renamed = {"std": "std_pop"}
    return df.groupBy(*keys).agg(*[AGGREGATES[renamed.get(fn, fn)](c).alias(a) for a, (c, fn) in aggs.items()])


def column_stats(df: DataFrame, c: str) -> DataFrame:
    x = money(c)
    return df.filter(F.col(c).isNotNull()).agg(
        F.count("*").alias("count"), rounded(mean(x), 4).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
        rounded(std(x), 4).alias("std"), total(x).alias("sum"),
    )


def grouped_lists(df: DataFrame, key: str, value: str, tie: str, size: int = 1000) -> DataFrame:
    """Values per key in order, as lists of at most ``size`` values.

    A key with many values gets many rows (chunk 0, 1, ...), so no list grows
    with the data and nothing is dropped.
    """
    rows = ranked(df.select(key, value, tie), value, tie, [key])
    chunked = rows.withColumn("chunk", F.floor((F.col("row_number") - 1) / size))
    lists = chunked.groupBy(key, "chunk").agg(
        F.sort_array(F.collect_list(F.struct("row_number", value))).alias("_pairs")
    )
    return lists.select(key, "chunk", F.transform("_pairs", lambda p: p[value]).alias("values"))
