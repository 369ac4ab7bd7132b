"""String expressions: codes, formatting, hashes, blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagewright.functions.numeric import as_col


def is_blank(c: Column | str) -> Column:
    c = as_col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def employee_code(c: Column | str) -> Column:
    """EMP plus the id, padded to three digits but never cut."""
    return F.format_string("EMP%03d", as_col(c).cast("bigint"))


def default_email(first: Column | str, last: Column | str, domain: str = "company.example") -> Column:
    return F.concat(F.lower(as_col(first)), F.lit("."), F.lower(as_col(last)), F.lit(f"@{domain}"))


def compact_amount(c: Column | str, symbol: str = "₹") -> Column:
    """Amount in crore, lakh or thousand; smaller amounts without decimals."""
    x = as_col(c).cast("decimal(18,2)")

    def scaled(unit: int, digits: int, suffix: str) -> Column:
        number = F.round((x / F.lit(unit)).cast("decimal(28,8)"), digits).cast(f"decimal(18,{digits})")
        return F.concat(F.lit(symbol), number.cast("string"), F.lit(suffix))

    return (
        F.when(x >= 10_000_000, scaled(10_000_000, 2, "Cr"))
        .when(x >= 100_000, scaled(100_000, 2, "L"))
        .when(x >= 1_000, scaled(1_000, 1, "K"))
        .otherwise(scaled(1, 0, ""))
    )


def row_hash(*cols: Column | str) -> Column:
    """Change fingerprint; the separator keeps ('1','23') and ('12','3') apart."""
    return F.md5(F.concat_ws("|", *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]))
