"""Exact ranks and running totals without a single-task window.

An ordered column is cut into slices at approximate quantiles. The slice of a
row depends only on its value, so every use of it agrees and a lost task can be
rerun. Ranks are taken inside (group, slice) and shifted by the totals of the
earlier slices, so neither one global ordering nor one large group has to pass
through one task. A value that fills whole slices by itself (a hot tie) gets a
part of its own, cut further along the tie-break column. Slices are found on
doubles, which keep the order of every numeric type; values that share a
crowded double are told apart by their own type.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.functions.numeric import money
from wagewright.session import parallelism

SLICE, EXACT, TIE, HOT, KEY = "_slice", "_exact", "_tie", "_hot", "_key"
PART = [SLICE, EXACT, TIE]


def _bucketed(df: DataFrame, col: str, cuts: list[float], out: str) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    splits = [-math.inf, *cuts, math.inf]
    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="error").transform(df)


def _quantiles(df: DataFrame, col: str, slices: int) -> list[float]:
    points = [i / slices for i in range(1, slices)]
    return df.approxQuantile(col, points, 0.25 / slices)


def with_slices(
    df: DataFrame, value: str, tie: str, descending: bool = False, slices: int | None = None
) -> DataFrame:
    """Add the columns PART, which grow with (value, tie); value and tie are numeric, not null.

    ``EXACT`` is the value itself where its double is crowded (``HOT``), else null: such a part
    holds one value, and only there ``TIE`` cuts further. A descending value has descending EXACT.
    """
    slices = slices or parallelism(df.sparkSession)
    key = F.col(value).cast("double")
    keyed = df.withColumn(KEY, -key if descending else key)
    found = _quantiles(keyed.select(KEY), KEY, slices)
    crowded = sorted({a for a, b in zip(found, found[1:]) if a == b})
    # One slice holds exactly the crowded double: [c, next double above it).
    cuts = sorted({*found, *(math.nextafter(c, math.inf) for c in crowded)})
    out = _bucketed(keyed, KEY, cuts, SLICE)
    kind = df.schema[value].dataType
    if not crowded:
        return out.withColumns({HOT: F.lit(False), EXACT: F.lit(None).cast(kind), TIE: F.lit(0.0)}).drop(KEY)
    is_hot = F.col(KEY).isin(crowded)
    out = out.withColumn(HOT, is_hot).withColumn(EXACT, F.when(is_hot, F.col(value))).withColumn("_tie_key", F.col(tie).cast("double"))
    ties = sorted(set(_quantiles(out.filter(HOT).select("_tie_key"), "_tie_key", slices)))
    out = _bucketed(out, "_tie_key", ties, "_tie_all")
    return out.withColumn(TIE, F.when(F.col(HOT), F.col("_tie_all")).otherwise(F.lit(0.0))).drop("_tie_key", "_tie_all", KEY)


def ranked(
    df: DataFrame,
    value: str,
    tie: str,
    by: list[str] | None = None,
    descending: bool = False,
    want: tuple[str, ...] = ("row_number",),
    running: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add exact ordered columns over (value, tie) within ``by`` (or over all rows).

    For few groups of any size (departments, partitions); the totals hold one
    row per group and slice. Many short histories belong to ``over_history``.

    ``want`` picks from row_number, rank, dense_rank and group_rows;
    ``running`` names a money column whose running total becomes running_total.
    ``tie`` must make the order unique.
    """
    by = list(by or [])
    cut = with_slices(df, value, tie, descending, slices)
    order = F.col(value).desc() if descending else F.col(value).asc()
    here = Window.partitionBy(*by, *PART)
    rows = here.orderBy(order, F.col(tie).asc())
    values = here.orderBy(order)
    exact = F.col(EXACT).desc() if descending else F.col(EXACT).asc()

    sums = [F.count("*").alias("_rows")]
    if running:
        sums.append(F.sum(money(running)).alias("_sum"))
    parts = cut.groupBy(*by, *PART).agg(*sums)
    # A few rows per slice and group: the ordering below is over totals, not rows.
    before = Window.partitionBy(*by).orderBy(SLICE, exact, TIE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = [
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*by)).alias("group_rows"),
    ]
    if running:
        shifts.append(F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"))
    shift = parts.select(*by, *PART, *shifts)
    if "rank" in want:
        shift = shift.withColumn("_before_value", F.min("_before").over(Window.partitionBy(*by, SLICE, EXACT)))

    local: dict[str, Column] = {"_row": F.row_number().over(rows)}
    if "rank" in want:
        local["_rank"] = F.rank().over(values)
    if "dense_rank" in want:
        local["_dense"] = F.dense_rank().over(values)
    if running:
        local["_run"] = F.sum(money(running)).over(rows.rowsBetween(Window.unboundedPreceding, 0))
    out = join_parts(cut.withColumns(local), shift, by)

    result: dict[str, Column] = {"row_number": F.col("_before") + F.col("_row")}
    if "rank" in want:
        # Inside a hot part all values are equal, whatever the tie slice.
        result["rank"] = F.when(F.col(HOT), F.col("_before_value") + 1).otherwise(F.col("_before") + F.col("_rank"))
    if running:
        result["running_total"] = (F.col("_sum_before") + F.col("_run")).cast("decimal(28,2)")
    if "dense_rank" in want:
        distinct = cut.select(*by, SLICE, EXACT, value).distinct().groupBy(*by, SLICE, EXACT).agg(F.count("*").alias("_values"))
        lower = Window.partitionBy(*by).orderBy(SLICE, exact).rowsBetween(Window.unboundedPreceding, -1)
        below = distinct.select(*by, SLICE, EXACT, F.coalesce(F.sum("_values").over(lower), F.lit(0)).alias("_values_before"))
        out = join_parts(out, below, by, [SLICE, EXACT])
        result["dense_rank"] = F.when(F.col(HOT), F.col("_values_before") + 1).otherwise(F.col("_values_before") + F.col("_dense"))
    keep = [c for c in ("row_number", "rank", "dense_rank", "group_rows") if c in want]
    keep += ["running_total"] if running else []
    out = out.withColumns(result)
    return out.select(*[F.col(c) for c in df.columns], *keep)


def join_parts(left: DataFrame, right: DataFrame, by: list[str], parts: list[str] | None = None) -> DataFrame:
    """Join on the group and part columns; a null group or EXACT equals a null one."""
    keys = by + (parts or PART)
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        one = left[k] == renamed[f"_r_{k}"] if k in (SLICE, TIE) else left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = one if cond is None else cond & one
    return left.join(renamed, cond).drop(*[f"_r_{k}" for k in keys])


def percent_rank(rank: Column | str, rows: Column | str) -> Column:
    rank, rows = (F.col(c) if isinstance(c, str) else c for c in (rank, rows))
    return F.coalesce(F.try_divide((rank - 1).cast("double"), (rows - 1).cast("double")), F.lit(0.0))


def ntile(tiles: int, row: Column | str, rows: Column | str) -> Column:
    """Tile of a row number: the first rows % tiles tiles hold one row more."""
    row, rows = (F.col(c) if isinstance(c, str) else c for c in (row, rows))
    small, extra = F.floor(rows / tiles), rows % tiles
    wide = extra * (small + 1)
    in_wide = F.floor((row - 1) / (small + 1)) + 1
    in_small = extra + F.floor(F.try_divide(row - wide - 1, small)) + 1
    return F.when(row <= wide, in_wide).otherwise(in_small).cast("bigint")


def lower_quarter() -> Column:
    return F.floor(F.col("group_rows") / 4) + 1


def upper_quarter() -> Column:
    return F.floor(F.col("group_rows") * 3 / 4) + 1


def lower_middle() -> Column:
    return F.floor((F.col("group_rows") + 1) / 2)


def upper_middle() -> Column:
    return F.floor(F.col("group_rows") / 2) + 1


def gini(df: DataFrame, value: str, tie: str) -> DataFrame:
    """Gini index over non-negative values: sum((2i - n - 1) x_i) / (n sum x)."""
    rows = ranked(df.select(value, tie), value, tie, want=("row_number", "group_rows"))
    weight = (2 * F.col("row_number") - F.col("group_rows") - 1).cast("decimal(18,0)")
    return rows.agg(
        F.count("*").alias("records"),
        F.sum(weight * money(value)).cast("double").alias("_weighted"),
        F.sum(money(value)).cast("double").alias("total"),
    ).select(
        "records", "total",
        F.try_divide(F.col("_weighted"), F.col("records").cast("double") * F.col("total")).alias("gini"),
    )
