"""Tax by a table of slabs: bounds, rates and surcharges per fiscal year as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.functions.numeric import as_col
from wagewright.session import settled

MONEY, TAX = "decimal(18,2)", "decimal(24,4)"


class SlabError(ValueError):
    """A slab table that isn't a partition of the incomes from 0 on."""


def slab_faults(slabs: DataFrame) -> DataFrame:
    """``fiscal_year`` and ``fault`` of each year whose slabs don't cover every income from 0 on exactly once.

    Columns: fiscal_year, income_from, income_to (null: no upper limit), tax_rate_pct, surcharge_pct.
    """
    order = Window.partitionBy("fiscal_year").orderBy(F.asc_nulls_first("income_from"), F.asc_nulls_last("income_to"))
    before, after = F.lag("income_to").over(order), F.lead("income_from").over(order)
    first = F.row_number().over(order) == 1
    fault = (
        F.when(F.col("fiscal_year").isNull() | F.col("income_from").isNull() | F.col("tax_rate_pct").isNull(), "a bound or rate is missing")
        .when(F.col("income_to") <= F.col("income_from"), "a slab ends before it starts")
        .when(first & (F.col("income_from") != 0), "the first slab doesn't start at 0")
        .when(~first & (before.isNull() | (before > F.col("income_from"))), "slabs overlap")
        .when(~first & (before < F.col("income_from")), "incomes between two slabs")
        .when(after.isNull() & F.col("income_to").isNotNull(), "the last slab has an upper limit")
    )
    return slabs.select("fiscal_year", fault.alias("fault")).filter("fault IS NOT NULL")


def slab_lookup(slabs: DataFrame) -> tuple[DataFrame, int]:
    """One stored row per fiscal year: sorted bounds, rates, surcharges and the tax due at each bound; and the most slabs of a year.

    Raises ``SlabError`` with the first faults found.
    """
    slabs = settled(slabs.select(
        F.col("fiscal_year").cast("string").alias("fiscal_year"), F.col("income_from").cast(MONEY).alias("income_from"), F.col("income_to").cast(MONEY).alias("income_to"),
        F.col("tax_rate_pct").cast("decimal(5,2)").alias("tax_rate_pct"), F.coalesce("surcharge_pct", F.lit(0)).cast("decimal(5,2)").alias("surcharge_pct"),
    ), "slabs")
    faults = slab_faults(slabs).orderBy("fiscal_year", "fault").limit(5).collect()
    if faults:
        raise SlabError("; ".join(f"{r.fiscal_year}: {r.fault}" for r in faults))
    earlier = Window.partitionBy("fiscal_year").orderBy("income_from").rowsBetween(Window.unboundedPreceding, -1)
    width = (F.col("income_to") - F.col("income_from")) * F.col("tax_rate_pct") * F.lit("0.01").cast("decimal(3,2)")
    due = slabs.withColumn("due", F.coalesce(F.sum(width).over(earlier), F.lit(0)).cast(TAX))
    rows = due.groupBy("fiscal_year").agg(F.sort_array(F.collect_list(F.struct("income_from", "due", "tax_rate_pct", "surcharge_pct"))).alias("slab"))
    lookup = settled(rows.select("fiscal_year", *[F.col(f"slab.{c}").alias(f"_{c}") for c in ("income_from", "due", "tax_rate_pct", "surcharge_pct")]), "slab-lookup")
    return lookup, int(lookup.agg(F.max(F.size("_due"))).first()[0] or 0)


def slab_place(bounds: Column, most: int, x: Column) -> Column:
    """Index from 0 of the last of the sorted ``bounds`` that isn't above ``x``, by binary search; ``most`` bounds at most."""
    steps = F.array(*[F.lit(1 << k) for k in range(max(most - 1, 1).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda i, step: F.when(F.get(bounds, i + step) <= x, i + step).otherwise(i))


def tax_by_slabs(df: DataFrame, income: Column | str, fiscal_year: Column | str, slabs: DataFrame) -> DataFrame:
    """``df`` with ``slab_no`` (from 1), ``marginal_rate``, ``slab_tax`` and ``surcharge`` by the slabs of each row's fiscal year.

    The slabs of a year are one row of sorted arrays, so the join is an equality on the year and a row's slab is
    found by binary search in it: no range join. The tax is what is due at the slab's lower bound plus the slab's own part. An income
    on a bound belongs to the slab below it, as in a sum over slabs; incomes below 0 count as 0. A year without slabs or a null
    income gives nulls. Of the slab reached, the surcharge rate holds for the whole tax.
    """
    lookup, most = slab_lookup(slabs)
    x = as_col(income).cast(MONEY)
    x = F.when(x < 0, F.lit(0).cast(MONEY)).otherwise(x)
    met = df.withColumns({"_x": x, "_year": as_col(fiscal_year).cast("string")}).join(lookup.withColumnRenamed("fiscal_year", "_year"), "_year", "left")
    # The last bound below the income, not the one it meets.
    below = F.col("_x") - F.lit("0.01").cast("decimal(3,2)")
    placed = met.withColumn("_i", F.when(F.col("_due").isNotNull() & F.col("_x").isNotNull(), slab_place(F.col("_income_from"), most, below)))
    at = lambda c: F.get(F.col(f"_{c}"), F.col("_i"))
    tax = (at("due") + (F.col("_x") - at("income_from")) * at("tax_rate_pct") * F.lit("0.01").cast("decimal(3,2)")).cast(TAX)
    out = placed.withColumns({"slab_no": F.col("_i") + 1, "marginal_rate": at("tax_rate_pct"), "slab_tax": tax})
    out = out.withColumn("surcharge", F.round(F.col("slab_tax") * at("surcharge_pct") * F.lit("0.01").cast("decimal(3,2)"), 2).cast(MONEY))
    return out.select(*df.columns, "slab_no", "marginal_rate", "slab_tax", "surcharge")
