"""Windows over the ordered history of an entity, safe for very long histories."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wagewright.operators.ordering import ranked


def micros(column: str, zoned: bool) -> Column:
    """A date or time as whole microseconds in its order; one without a zone doesn't depend on the session's."""
    if zoned:
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column).cast("timestamp_ntz"))


def over_history(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie: str,
    exprs: dict[str, Callable[[WindowSpec], Column]],
    back: int = 0,
    ahead: int = 0,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add window expressions that look at most ``back`` rows back and ``ahead`` rows forward.

    The caller, never the data, picks the plan. By default each key has one
    window, which streams over its sorted rows and spills. With ``chunk_rows``
    every history is numbered and cut into chunks of that many rows, and each
    chunk borrows the neighbouring rows it has to see: for entities whose
    history is too long for one task, at the price of two more shuffles.
    ``tie`` must be unique; ``order`` is a number, date or timestamp, not null with ``chunk_rows``.
    """
    if chunk_rows is None:
        plain = Window.partitionBy(*keys).orderBy(order, tie)
        return df.withColumns({n: e(plain) for n, e in exprs.items()})
    chunk_rows = max(chunk_rows, back, ahead, 1)
    kind = dict(df.dtypes)[order]
    number = micros(order, kind == "timestamp") if kind.startswith(("timestamp", "date")) else F.col(order)
    numbered = ranked(df.withColumn("_at", number), "_at", tie, keys, want=("row_number",))
    at = F.col("row_number") - 1
    chunk, offset = F.floor(at / chunk_rows), at % chunk_rows
    copies = F.array_compact(
        F.array(
            chunk,
            F.when(offset >= chunk_rows - back, chunk + 1) if back else F.lit(None).cast("bigint"),
            F.when((offset < ahead) & (chunk > 0), chunk - 1) if ahead else F.lit(None).cast("bigint"),
        )
    )
    spread = numbered.withColumn("_home", chunk).withColumn("_chunk", F.explode(copies))
    inside = Window.partitionBy(*keys, "_chunk").orderBy("row_number")
    filled = spread.withColumns({n: e(inside) for n, e in exprs.items()})
    return filled.filter(F.col("_chunk") == F.col("_home")).select(*df.columns, *exprs)


def latest_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows per key in the given order; the limit is applied before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("position", rank).filter(F.col("position") <= n)
