"""Drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import ascii_lower, stripped
from wagewright.session import settled


def line_key(line: Column) -> Column:
    return ascii_lower(stripped(line))


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Keys (``h1``, ``h2``) found in ``min_docs`` documents or more, and the largest id that holds each.

    Rows without an id count as one document that comes before all others.
    """
    counted = lines.groupBy("h1", "h2").agg(
        (F.count_distinct("id") + F.max(F.col("id").isNull().cast("long"))).alias("n_docs"), F.max("id").alias("last")
    )
    return counted.filter(F.col("n_docs") >= min_docs)


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """The input's columns with shared lines gone from the text, and ``n_lines``, ``n_dropped``.

    Lines are exploded with their places and hashed to 128 bits; documents are counted per hash after a map-side
    step, so a line that all documents hold arrives as a few rows. The frequent keys are written, so that joining them back
    is broadcast while they are few and else splits the partition of a hot key. Only the places of dropped lines go back to the
    documents, which are put together again from the places that remain. A null text is one empty line and comes back
    as an empty text. Rows that repeat an id are one document; each loses its own lines. Input columns named like the
    two new ones are replaced; an empty table stays empty.
    """
    own = docs.drop("n_lines", "n_dropped").withColumn(text_col, F.coalesce(text_col, F.lit("")))
    rows = own.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("body"))
    lines = (
        rows.select("id", "row", F.posexplode(F.split("body", "\n")).alias("place", "line"))
        .select("id", "row", "place", line_key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select("id", "row", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    gone = (
        lines.join(settled(frequent_lines(lines, min_docs), "lines"), ["h1", "h2"])
        .filter(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy(F.col("id").alias("gone_id"), F.col("row").alias("gone_row"))
        .agg(F.collect_set("place").alias("gone_places"))
    )
    met = own.join(gone, own[id_col].eqNullSafe(gone.gone_id) & (F.xxhash64(own[text_col]) == gone.gone_row), "left")
    line = F.split(text_col, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(line) - 1), F.col("gone_places"))
    kept = F.array_join(F.transform(left, lambda p: F.get(F.col("all_lines"), p)), "\n")
    out = met.withColumns({
        "all_lines": line,
        "n_lines": F.size(line).cast("long"),
        "n_dropped": F.coalesce(F.size("gone_places"), F.lit(0)).cast("long"),
    })
    return out.withColumn(text_col, F.when(F.col("n_dropped") > 0, kept).otherwise(F.col(text_col))).select(
        *own.columns, "n_lines", "n_dropped"
    )
