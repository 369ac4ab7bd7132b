"""Feature scaling of a numeric column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.functions.numeric import mean, money, rounded, std, zero


def _limits(df: DataFrame, x: Column, what: Column) -> Column:
    return df.select(x.alias("_x")).agg(what.alias("w")).scalar()


def normalise(df: DataFrame, field: str, method: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Add ``<field>_norm_<method>``; NULL counts as 0.

    The statistics are one scalar subquery each, so scaling adds no shuffle of
    the rows themselves.
    """
    x = zero(field).cast("double")
    c = F.col("_x")
    if method == "min_max":
        stats = _limits(df, x, F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")))
        lo, hi = stats["lo"], stats["hi"]
        scaled = F.lit(low) + F.try_divide((x - lo) * (high - low), hi - lo)
        value = F.coalesce(scaled, F.lit(low))
    elif method == "z_score":
        stats = _limits(df, x, F.struct(mean(money(c)).alias("mu"), std(c, sample=True).alias("sd")))
        value = F.coalesce(F.try_divide(x - stats["mu"], stats["sd"]), F.lit(0.0))
    elif method == "decimal":
        largest = _limits(df, x, F.max(F.abs(c)))
        value = x / F.pow(F.lit(10.0), F.ceil(F.log10(largest + 1)).cast("double"))
    elif method == "log":
        value = F.log1p(F.greatest(x, F.lit(0.0)))
    else:
        raise ValueError(f"unknown scaling {method}")
    return df.withColumn(f"{field}_norm_{method}", rounded(value, 6))
