"""Keyed loads, ETL and ELT transforms, partitioned writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions.rules import ingest_row_errors
from wagewright.operators.joins import first_per_key

MONEY = "decimal(18,2)"


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """INSERT OR REPLACE: a source row replaces the target row with its key.

    Of several source rows with one key the first in ``order`` is kept. Only
    the keys of the source take part in the join against the target.
    """
    unique = first_per_key(source, keys, order)
    kept = target.join(unique.select(*keys), keys, "left_anti")
    return kept.unionByName(unique.select(*target.columns))


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """INSERT OR IGNORE: rows whose key exists are skipped; the first of a repeated key wins."""
    fresh = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(first_per_key(fresh, keys, order).select(*target.columns))


def _dec(value: str, kind: str = "decimal(4,2)") -> Column:
    return F.lit(value).cast(kind)


def etl_transform(raw: DataFrame) -> DataFrame:
    """Typed transform before the load; each component is rounded by itself.

    Rows with a salary that is blank, not a number, or not positive are skipped.
    """
    basic = F.trim("basic_salary").try_cast(MONEY)
    rows = raw.withColumn("basic", basic).filter(F.col("basic") > 0)
    b = F.col("basic")
    rows = rows.withColumns({
        "hra": F.round(b * _dec("0.35"), 2).cast(MONEY), "da": F.round(b * _dec("0.17"), 2).cast(MONEY),
        "pf": F.round(F.least(b, F.lit(15000).cast(MONEY)) * _dec("0.12"), 2).cast(MONEY),
        "full_name": F.trim(F.concat_ws(" ", "first_name", "last_name")),
    })
    gross = (b + F.col("hra") + F.col("da") + F.lit(1200)).cast(MONEY)
    return rows.withColumn("gross", gross).withColumn("net", (F.col("gross") - F.col("pf")).cast(MONEY)).select(
        "emp_id", "emp_code", "full_name", "dept", "basic", "hra", "da", "gross", "pf", "net", "status"
    )


# The same load done in SQL over the raw text table; the sum is rounded once.
ELT_SQL = """
SELECT emp_id, emp_code, concat(first_name, ' ', last_name) AS full_name, dept, basic,
       round(basic * 0.35BD, 2) AS hra,
       round(basic * 0.17BD, 2) AS da,
       round(basic * 1.52BD + 1200, 2) AS gross,
       round(least(basic, 15000BD) * 0.12BD, 2) AS pf,
       CASE WHEN status = '' THEN 'Unknown' ELSE status END AS status
FROM (SELECT *, coalesce(try_cast(nullif(trim(basic_salary), '') AS decimal(18,2)), 0) AS basic FROM {raw})
WHERE basic > 0
"""


def elt_transform(spark: SparkSession, raw: DataFrame) -> DataFrame:
    return spark.sql(ELT_SQL, raw=raw)


def split_ingest(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows with their derived amounts, and rejected rows with their reasons."""
    checked = raw.withColumn("errors", ingest_row_errors())
    amount = F.coalesce(F.trim("basic_salary").try_cast(MONEY), F.lit(0).cast(MONEY))
    good = checked.filter(F.size("errors") == 0).withColumn("basic", amount)
    b = F.col("basic")
    full = b * _dec("1.52") + F.lit(1200)
    good = good.select(
        "emp_id", "emp_code", F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "dept", "basic",
        F.round(full, 2).cast(MONEY).alias("gross"),
        F.round(full - F.least(b, F.lit(15000).cast(MONEY)) * _dec("0.12"), 2).cast(MONEY).alias("net"), "status",
    )
    return good, checked.filter(F.size("errors") > 0)


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """Partitioned Parquet with few files; a large partition value is split over tasks.

    The rebalance hint lets adaptive execution merge small and split big
    partitions, so one hot value does not become one task.
    """
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def replace_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write the partitions that ``df`` has rows of in place of the old ones; files of all other partitions stay as they are.

    The same rows again give the same table, so a job that failed or ran twice is simply run again. ``df`` must not read ``path`` itself:
    store it first.
    """
    df.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def manifest(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows and files per partition of a written table."""
    per_file = spark.read.parquet(path).groupBy(*columns, F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return per_file.groupBy(*columns).agg(F.sum("n").alias("added_rows"), F.count("*").alias("added_files"))
