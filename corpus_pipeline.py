"""The corpus pipeline: toxicity, shared lines, near duplicates, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.llm.common import stripped, text_hash
from wagewright.llm.decontaminate import contaminated
from wagewright.llm.line_dedup import drop_shared_lines
from wagewright.llm.near_dedup import near_duplicates
from wagewright.llm.packing import pack
from wagewright.llm.toxicity import toxicity
from wagewright.session import settled
from wagewright.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, gone: DataFrame, name: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose ``name`` and ``text_hash`` aren't among ``gone`` (these two columns); a null name equals a null name."""
    gone = gone.toDF("gone_id", "gone_hash").distinct()
    return docs.join(gone, docs[name].eqNullSafe(gone.gone_id) & docs.text_hash.eqNullSafe(gone.gone_hash), "left_anti")


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go; the scorer learns from the labelled rows still present."""
    scored = toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.filter("predicted = 0").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go; ``n_chars`` follows the text that is left."""
    out = drop_shared_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates stays, once.

    Rows are judged one by one: a row without an id, or whose id stands for several texts, goes only if its own text is a
    copy. It stays if its group has no row with an id of its own, and of equal texts the one with the smallest id.
    """
    docs = docs.select(*COLUMNS, text_hash("text"))
    several = docs.groupBy("doc_id").agg(F.min("text_hash").alias("x"), F.max("text_hash").alias("y")).filter("x <> y")
    several = settled(several.select(F.col("doc_id").alias("several_id")), "several")
    named = docs.join(several, F.col("doc_id") == F.col("several_id"), "left").withColumn("name", F.when(F.col("several_id").isNull(), F.col("doc_id")))
    found = near_duplicates(named, id_col="name", hashed=True)
    left = _without(named, found.filter("not kept").select("doc_id", "text_hash"), "name")
    # Texts without words are no copies of each other.
    blank = F.when(stripped(F.coalesce("text", F.lit(""))) == "", F.col("doc_id"))
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "lang", "source", "n_chars")
    best = left.groupBy("name", "text_hash", blank.alias("blank")).agg(F.min(row).alias("best"), F.first("text").alias("text"))
    return best.select("text", "best.*").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, row by row."""
    docs = docs.select(*COLUMNS, text_hash("text"))
    found = contaminated(docs, table(spark, sf_dir, "benchmark"), hashed=True)
    return _without(docs, found.select("doc_id", "text_hash")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of training sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", keep_civil),
    ("line_dedup", drop_lines),
    ("near_dedup", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: The stages learn, hash and tokenise; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
