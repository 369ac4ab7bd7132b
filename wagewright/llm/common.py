"""Column helpers the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that part words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def text_hash(text: str) -> Column:
    """Tells rows of one id, or without an id, apart by their text."""
    return F.xxhash64(F.lit(7), F.col(text)).alias("text_hash")


def words(text: Column) -> Column:
    """Runs of characters other than white space; none for a null or blank text."""
    return F.filter(F.split(stripped(F.coalesce(text, F.lit(""))), SPACE_RUN), lambda w: w != "")


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once for an application: they needn't have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}-code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))  # Spark's own file service hands it out
    _shipped.add(app)


def give_back() -> None:
    """Hand freed memory back to the system: a worker lives on for the tasks of other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries keep what they keep
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def by_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str, done: Callable[[], None] | None = None) -> DataFrame:
    """``mapInArrow`` with a function of one batch; ``done`` is called when a task ends, to drop what it remembered."""
    ship_code(df.sparkSession)

    def run(batches):
        try:
            for batch in batches:
                if batch.num_rows:
                    yield from work(batch)
        finally:
            if done:
                done()
            give_back()

    return df.mapInArrow(run, schema)


def slices(texts: list, limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` characters; a longer text stands alone, whole."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        more = len(text) if text else 0
        if size and size + more > limit:
            yield first, i
            first, size = i, 0
        size += more
    if first < len(texts):
        yield first, len(texts)
