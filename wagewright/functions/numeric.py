"""Money, ratios and moments.

Sums run over DECIMAL, so a result does not depend on the order in which tasks
finish; a value is turned into a double once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return as_col(c).cast("decimal(18,2)")


def zero(c: Column | str) -> Column:
    """NULL counts as 0, as in every aggregate of the payroll reports."""
    return F.coalesce(as_col(c), F.lit(0))


def total(c: Column | str) -> Column:
    """Exact sum of money, as a double."""
    return F.sum(money(c)).cast("double")


def mean(c: Column | str) -> Column:
    """Exact sum over the count of non-null values."""
    return F.try_divide(F.sum(money(c)).cast("double"), F.count(as_col(c)).cast("double"))


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def rounded(c: Column | str, digits: int = 2) -> Column:
    """Half-up rounding of the decimal value, so 0.285 gives 0.29.

    Done on whole units of 1e-8 (1e-12 from six digits on), which stays in
    generated code, where a double holds those units exactly; beyond that DECIMAL
    gives the same result.
    """
    x = as_col(c).cast("double")
    scale = 8 if digits < 6 else 12
    step = 10 ** (scale - digits)
    units = F.rint(x * F.lit(float(10**scale))).cast("bigint") + F.when(x < 0, F.lit(-(step // 2))).otherwise(F.lit(step // 2))
    quick = _div(units, step).cast("double") / F.lit(float(10**digits))
    exact = F.round(x.cast(f"decimal(28,{scale})"), digits).cast("double")
    return F.when(F.abs(x) < F.lit(9e15 / 10**scale), quick).otherwise(exact)


def cents(c: Column | str) -> Column:
    """Whole hundredths of a stored two-digit amount."""
    return F.rint(as_col(c) * 100).cast("bigint")


def stored_money(c: Column | str) -> Column:
    """A stored double with two digits as DECIMAL, without the detour over text a plain cast takes."""
    return (cents(c).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def exact_sum(units: Column, digits: int) -> Column:
    """Sum of whole units, each worth 10**-digits, as DECIMAL(38, digits).

    High and low bits are summed apart as longs: as fast as a plain long sum,
    and no group is large enough to overflow it.
    """
    low = (1 << 20) - 1
    high = F.sum(F.shiftright(units, 20)).cast("decimal(38,0)") * F.lit(1 << 20)
    whole = (high + F.sum(units.bitwiseAND(F.lit(low)))).cast("decimal(38,0)")
    unit = F.lit(f"{10 ** -digits:.{digits}f}").cast(f"decimal({digits + 1},{digits})")
    return (whole * unit).cast(f"decimal(38,{digits})")


def ratio(a: Column | str, b: Column | str, scale: float = 1.0) -> Column:
    """a / b * scale in doubles; 0 where b is 0 or missing."""
    quotient = F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))
    return F.coalesce(quotient * F.lit(float(scale)), F.lit(0.0))


def std(c: Column | str, sample: bool = False) -> Column:
    """Standard deviation from exact moments; 0 for a single value when sampled."""
    x = money(c)
    n = F.count(x).cast("double")
    s, s2 = F.sum(x).cast("double"), F.sum(x * x).cast("double")
    centred = F.greatest(s2 - F.try_divide(s * s, n), F.lit(0.0))
    if not sample:
        return F.sqrt(F.try_divide(centred, n))
    return F.coalesce(F.sqrt(F.try_divide(centred, n - F.lit(1.0))), F.lit(0.0))


def safe_number(c: Column | str, default: float = 0.0) -> Column:
    """Text to double; blanks and junk give the default."""
    return F.coalesce(F.trim(as_col(c)).try_cast("double"), F.lit(float(default)))


def safe_whole(c: Column | str) -> Column:
    """Text to a whole number, fraction cut off; blanks and junk give 0."""
    return safe_number(c).cast("bigint")
