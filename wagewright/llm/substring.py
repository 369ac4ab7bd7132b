"""Passages that occur again, found by hashing content-cut paragraphs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagewright.llm.common import by_arrow, slices, text_hash
from wagewright.llm.words import hashed_words, mixed, points
from wagewright.session import settled

FACTOR = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(FACTOR), -1, 2**64))


def stretches(ends: np.ndarray, first: np.ndarray, least: int, min_words: int, back: bool):
    """First and end words of the units whose paragraphs stop at ``ends``, ``least`` or more of them in a row.

    A unit goes on over following paragraphs until it has ``min_words``; ``back``: a short paragraph also has a unit that
    reaches back. Near the end of a text units reach back, so that every word lies in one. A text with fewer words is one unit.
    """
    starts = np.concatenate([[0], ends[:-1]])
    low = first[np.searchsorted(first, starts, side="right") - 1]
    stop = first[np.searchsorted(first, starts, side="right")]
    last = np.searchsorted(ends, stop)
    reach = np.maximum(np.arange(len(ends)) + least - 1, np.searchsorted(ends, starts + min_words))
    end = ends[np.minimum(reach, last)]
    tail = reach > last
    backward = lambda to: np.maximum(starts[np.searchsorted(starts, to - min_words, side="right") - 1], low)
    begin = np.where(tail, np.minimum(starts, np.where(stop - low < min_words, low, backward(np.maximum(stop, min_words)))), starts)
    if back:
        short = (ends - starts < min_words) & (ends - low >= min_words)
        begin = np.concatenate([begin, backward(np.maximum(ends, min_words))[short]])
        end = np.concatenate([end, ends[short]])
    return begin, end


def cuts(w, every: int, window: int) -> np.ndarray:
    """Whether a paragraph ends after each word.

    It does where the word's hash is a multiple of ``every``; in ``window`` words of a text without one, at the smallest
    hash (the last of equal ones). Both depend on the words of a passage alone, and no passage of ``window`` words is uncut.
    """
    cut = (w.hash >> np.uint64(11)) % np.uint64(every) == 0
    edge = np.unique(np.concatenate([[0], np.flatnonzero(cut) + 1, w.first[1:]]))
    for k in np.flatnonzero(np.diff(edge) > window):
        lo, hi = edge[k], edge[k + 1]
        view = np.lib.stride_tricks.sliding_window_view(w.hash[lo:hi][::-1], window)
        for a in range(0, len(view), 65_536):
            least = view[a : a + 65_536].argmin(1)
            cut[hi - 1 - a - np.arange(len(least)) - least] = True
    return cut


def units(texts: list[str | None], every: int, min_words: int, window: int = 20):
    """For each text: digests, first and end code points of its units.

    A paragraph ends at a word its neighbourhood tells (``cuts``), so the same passage is cut at the same words wherever
    it stands, in a line of its own or inside another. A unit is two paragraphs in a row, and overlaps its neighbours by
    one. Whole lines, and paragraphs between blank lines, are units too. None is left out for its length: short ones
    are extended. Case, punctuation and white space don't count.
    """
    for a, b in slices(texts):
        w = hashed_words(texts[a:b], plain=True)
        n = len(w.hash)
        if not n:
            yield from [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))] * (b - a)
            continue
        cp, at = points(texts[a:b])
        line = np.searchsorted(np.flatnonzero(cp == 10), w.start + at[w.text])
        # A line without a letter or digit is blank.
        step = np.append(np.diff(line), 2)
        end_of_text = np.zeros(n, dtype=bool)
        end_of_text[w.first[1:][w.first[1:] > 0] - 1] = True
        first = np.unique(w.first)
        found = [
            stretches(np.flatnonzero(stops | end_of_text) + 1, first, least, min_words, back)
            for stops, least, back in ((cuts(w, every, window), 2, False), (step > 0, 1, True), (step > 1, 1, True))
        ]
        key = np.unique(np.stack([np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])], axis=1), axis=0)
        begin, end = key[:, 0], key[:, 1]
        # Sums of hash * factor ** place, taken back to place 0, so that equal words have equal digests at any place.
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, FACTOR)]))
        inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, INVERSE)]))
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(w.hash) * power)])
        digest = mixed(mixed((total[end] - total[begin]) * inverse[begin]) + (end - begin).astype(np.uint64))
        bounds = np.searchsorted(begin, w.first)
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            yield digest[lo:hi], w.start[begin[lo:hi]], w.end[end[lo:hi] - 1]


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 5, min_words: int = 6, min_chars: int = 100, bridge: int = 40
) -> DataFrame:
    """Passages to remove: ``doc_id``, ``start``, ``end`` (code points, end exclusive), ``n_chars``, ``first_doc_id``, ``text_hash``.

    Units are grouped by a 64-bit digest over all documents; the occurrence with the smallest (id, offset) stays and
    all others are marked. Marked units that touch are one passage. Passages no more than ``bridge`` apart form a run, and those
    of runs with at least ``min_chars`` marked are returned, without what lies between them: a unit or two can be
    shared by chance. ``first_doc_id`` holds the earliest occurrence of the units that begin in the passage's first one.
    A unit that all documents hold is counted map-side and joined back, with the join's large partitions split; offsets of one document only meet in its own group.

    Null and blank texts have no units. Rows that repeat an id and text are one occurrence. Rows without an id, and rows with one id and
    different texts, are told apart by their text: ``text_hash`` names theirs and is null for all others. Ids are of any type that
    can be ordered; a null id ranks before all others. Other columns are left out, and an empty table gives no rows.
    """

    def work(batch):
        found = list(units(batch.column(2).to_pylist(), every, min_words))
        sizes = np.fromiter((len(d) for d, _, _ in found), np.int64, len(found))
        at = pa.array(np.repeat(np.arange(len(found)), sizes))
        digest = np.concatenate([d for d, _, _ in found]).view(np.int64)
        start = np.concatenate([s for _, s, _ in found]).astype(np.int64)
        end = np.concatenate([e for _, _, e in found]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(digest), batch.column(0).take(at), batch.column(1).take(at), pa.array(start), pa.array((end - start).astype(np.int32))],
            names=["digest", "id", "twin", "start", "size"],
        )

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), text_hash(text_col))
    several = given.filter("id IS NOT NULL").groupBy("id").agg(F.min("text_hash").alias("x"), F.max("text_hash").alias("y")).filter("x <> y")
    several = settled(several.select(F.col("id").alias("several_id")), "several")  # its size decides how texts meet it
    named = given.join(several, given.id == several.several_id, "left")
    twin = F.when(F.col("id").isNull() | F.col("several_id").isNotNull(), F.col("text_hash")).alias("twin")
    kind = given.schema["id"].dataType.simpleString()
    rows = by_arrow(named.select("id", twin, "body"), work, f"digest long, id {kind}, twin long, start long, size int")
    place, row = F.struct("id", "twin", "start"), ["id", "twin"]
    known = rows.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    again = settled(known.filter(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first"), "digests")
    marked = rows.join(again, "digest").filter(~place.eqNullSafe(F.col("first")))
    spans = marked.groupBy(*row, "start").agg(
        F.max(F.col("start") + F.col("size")).alias("end"), F.min(F.struct("first.id")).alias("source")
    )
    in_order = Window.partitionBy(*row).orderBy("start")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.coalesce(F.col("start") > F.max("end").over(before) + 1, F.lit(True))
    runs = spans.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(upto))
    # Near its edges a passage's cuts can follow what stands beside it, so its first unit alone may not be a unit everywhere.
    runs = runs.withColumn("head", F.first("end").over(Window.partitionBy(*row, "run").orderBy("start")))
    source = F.min(F.when(F.col("start") < F.col("head"), F.col("source")))
    parts = runs.groupBy(*row, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), source.getField("id").alias("first_doc_id"))
    apart = F.coalesce(F.col("start") - F.lag("end").over(in_order) > bridge, F.lit(True))
    chains = parts.withColumn("apart", apart.cast("int")).withColumn("chain", F.sum("apart").over(in_order))
    marked_chars = F.sum(F.col("end") - F.col("start")).over(Window.partitionBy(*row, "chain"))
    return (
        chains.withColumn("marked", marked_chars)
        .filter(F.col("marked") >= min_chars)
        .select(F.col("id").alias("doc_id"), "start", "end", (F.col("end") - F.col("start")).alias("n_chars"), "first_doc_id", F.col("twin").alias("text_hash"))
    )


def without_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their passages cut out, and ``removed``: the original offsets, in order.

    A passage is cut from the rows with its id and, where it names one, its text. All rows and columns stay; a null text and one without passages
    stay as they are, with no offsets. A column called ``removed`` is replaced. No documents: no rows.
    """
    spans = passages.groupBy(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash")).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("cuts")
    )
    met = docs.drop("removed").withColumn("_hash", text_hash(text_col))
    own = F.col(id_col).eqNullSafe(F.col("cut_id")) & (F.col("cut_hash").isNull() | (F.col("cut_hash") == F.col("_hash")))
    met = met.join(spans, own, "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    met = met.withColumn("removed", F.coalesce("cuts", none))
    size = F.char_length(text_col).cast("long")
    stops = F.concat(F.transform("removed", lambda c: c.start), F.array(size))
    goes_on = F.concat(F.array(F.lit(0).cast("long")), F.transform("removed", lambda c: c.end))
    kept = F.zip_with(goes_on, stops, lambda a, b: F.substring(F.col(text_col), (a + 1).cast("int"), (b - a).cast("int")))
    return met.withColumn(text_col, F.when(F.size("removed") > 0, F.array_join(kept, "")).otherwise(F.col(text_col))).select(
        *[c for c in docs.columns if c != "removed"], "removed"
    )
