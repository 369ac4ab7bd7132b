"""Substring search over a large table by a stored index of trigrams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.session import settled

SIZE = 3


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a text; none for shorter ones."""
    places = F.sequence(F.lit(1), F.greatest(F.char_length(text) - (SIZE - 1), F.lit(0)))
    return F.when(F.char_length(text) >= SIZE, F.array_distinct(F.transform(places, lambda i: F.substr(text, i, F.lit(SIZE)))))


def trigram_index(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Posting rows (``gram``, ``key``) of the columns' trigrams; no trigram reaches over two columns. To be stored in the order of ``gram``."""
    grams = F.array_distinct(F.flatten(F.array_compact(F.array(*[trigrams(F.col(c)) for c in columns]))))
    return rows.select(F.explode(grams).alias("gram"), key)


def store_index(index: DataFrame, key: str, path: str) -> DataFrame:
    """Write posting rows sorted by trigram: a lookup of a few trigrams reads the few files and row groups that hold them."""
    index.repartitionByRange("gram", key).sortWithinPartitions("gram", key).write.parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def contains_any(columns: list[str], text: str) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.col(c), F.lit(text)), F.lit(False)) for c in columns])


def find(rows: DataFrame, index: DataFrame, key: str, columns: list[str], text: str, probes: int = 3) -> DataFrame:
    """The rows one of whose ``columns`` contains ``text``, letter for letter.

    The text's ``probes`` rarest trigrams are looked up, the rarest first, and their postings intersected; only rows named by all are fetched,
    and ``contains`` confirms them. A text under three characters has no trigram: then the rows are scanned. A trigram without postings
    means that nothing is found. The driver sees one count per trigram of the text.
    """
    grams = sorted({text[i : i + SIZE] for i in range(len(text) - SIZE + 1)})
    if not grams:
        return rows.filter(contains_any(columns, text))
    counts = dict(index.filter(F.col("gram").isin(grams)).groupBy("gram").count().collect())
    rarest = sorted(grams, key=lambda g: (counts.get(g, 0), g))[:probes]
    named = index.filter(F.col("gram") == rarest[0]).select(key)
    for gram in rarest[1:]:
        named = named.join(index.filter(F.col("gram") == gram).select(key), key, "left_semi")
    return rows.join(settled(named, "named"), key, "left_semi").filter(contains_any(columns, text))
