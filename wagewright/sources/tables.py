"""Scans and writers over plain files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared schemas: a scan starts no job to look at file footers first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = list(SCHEMAS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, text: str, **args) -> DataFrame:
    """A parameterised SQL string over the tables it names; errors are raised."""
    frames = {n: table(spark, sf_dir, n) for n in TABLES if f"{{{n}}}" in text}
    return spark.sql(text, args=args or None, **frames)


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(spark: SparkSession, path: str, names: list[str], line_breaks: bool = True, **options) -> DataFrame:
    """Header CSV, every column text; blank fields come back as ''.

    With ``line_breaks`` a quoted field may hold them, and each file is read by one task; without,
    a large file is split. Writers here leave one file per task, so the default costs no parallelism.
    """
    raw = _csv(spark, line_breaks).schema(text_schema(names)).options(**options).csv(path)
    return raw.select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])


def _csv(spark: SparkSession, line_breaks: bool):
    return spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)


def write_csv(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def csv_datasets(spark: SparkSession, root: str, line_breaks: bool = True) -> dict[str, DataFrame]:
    """Every ``<root>/<stem>.csv`` (a file, or a folder Spark wrote) as a frame of the columns its own header names.

    The driver holds one name per dataset and reads one header of each; blank fields come back as ''.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root)
    stem = F.regexp_extract("path", r"/([^/]+)\.csv(?:/[^/]*)?$", 1)
    stems = sorted(r[0] for r in files.select(stem).distinct().collect())
    frames = {}
    for name in stems:
        raw = _csv(spark, line_breaks).csv(f"{root.rstrip('/')}/{name}.csv")
        frames[name] = raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])
    return frames


def read_csv_folder(spark: SparkSession, root: str, names: list[str], line_breaks: bool = True) -> DataFrame:
    """The named columns of every dataset below ``root``, by header name, tagged with the stem; one a file lacks is ''."""
    parts = [
        df.select(*[(F.col(f"`{n}`") if n in df.columns else F.lit("")).alias(n) for n in names], F.lit(stem).alias("dataset"))
        for stem, df in csv_datasets(spark, root, line_breaks).items()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], text_schema([*names, "dataset"]))
