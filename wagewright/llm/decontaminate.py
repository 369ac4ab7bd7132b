"""Benchmark passages in documents, by counting shared q-grams in diagonal bands."""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import by_arrow, slices, text_hash
from wagewright.llm.words import alnum, lowered, mixed, points

MULTIPLIER = 0x5851F42D4C957F2D


def letters(texts: list[str | None]):
    """Lower-case letters and digits of all texts: values, text numbers and places in the text."""
    cp, first = points(texts)
    at = np.flatnonzero(alnum(cp))
    text = np.searchsorted(first, at, side="right") - 1
    return lowered(cp[at]), text, at - first[text]


def grams(values: np.ndarray, text: np.ndarray, q: int):
    """Hash of the q-gram at each place, and the places whose q-gram lies in one text. Built by doubling."""
    n = len(values) - q + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    power, width, whole, done = MULTIPLIER, 1, None, 0
    block = values.astype(np.uint64) + np.uint64(1)
    while True:  # block[i] covers width values from i; whole covers the done values that q's lower bits ask for
        if q & width:
            whole = block if whole is None else whole[: len(block) - done] * np.uint64(power % 2**64) + block[done:]
            done += width
        if done == q:
            return mixed(whole[:n]), np.flatnonzero(text[:n] == text[q - 1 :])
        block = block[:-width] * np.uint64(power % 2**64) + block[width:]
        width, power = 2 * width, power * power % 2**64


def distance(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int, int]:
    """Fewest edits that turn ``item`` into a part of ``region``, and that part's bounds; edits beyond ``most`` don't count.

    One row of the table is kept; the region is no longer than the band around the diagonal asks for.
    """
    n = len(region)
    cost = np.zeros(n + 1, dtype=np.int64)
    origin = np.arange(n + 1)
    step = np.arange(n + 1)
    for c in item:
        diagonal = cost[:-1] + (region != c)
        skip = cost + 1
        new = skip.copy()
        new[1:] = np.minimum(diagonal, skip[1:])
        begun = origin.copy()
        begun[1:] = np.where(diagonal <= skip[1:], origin[:-1], origin[1:])
        # Insertions run along the row: the best earlier cell, less its place.
        lead = np.minimum.accumulate(new - step)
        source = np.maximum.accumulate(np.where(new - step == lead, step, 0))
        cost, origin = lead + step, begun[source]
        if cost.min() > most:
            return most + 1, 0, 0
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


class Index:
    """q-grams of the items of one block, sorted by hash."""

    def __init__(self, ids: list[int], texts: list[str | None], q: int, budget: float):
        self.q, self.ids = q, ids
        values, text, _ = letters(texts)
        bounds = np.searchsorted(text, np.arange(len(ids) + 1))
        self.items = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        size = np.array([len(x) for x in self.items], dtype=np.int64)
        self.edits = np.floor(budget * size).astype(np.int64)
        # Each edit spoils q of the size - q + 1 q-grams; indexes() picks a q that leaves one at least.
        self.least = np.maximum(size - q + 1 - q * self.edits, 1)
        hash_, at = grams(values, text, q)
        hash_ = hash_[at]
        order = np.argsort(hash_, kind="stable")
        self.hash, self.item = hash_[order], text[at][order]
        self.place = (at - bounds[text[at]])[order]
        self.bits = np.zeros(1 << 22, dtype=bool)
        self.bits[(self.hash >> np.uint64(42)).astype(np.int64)] = True

    def found(self, texts: list[str | None]):
        """(text number, item number, edits, start, end) of each passage, offsets in code points of the text."""
        if not len(self.hash):
            return
        values, text, offset = letters(texts)
        hash_, at = grams(values, text, self.q)
        at = at[self.bits[(hash_[at] >> np.uint64(42)).astype(np.int64)]]
        low = np.searchsorted(self.hash, hash_[at], side="left")
        count = np.searchsorted(self.hash, hash_[at], side="right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        # Texts with fewer shared q-grams than any item asks for can't hold one.
        enough = np.bincount(text[at], minlength=len(texts)) >= self.least.min()
        has = enough[text[at]]
        at, low, count = at[has], low[has], count[has]
        if not len(at):
            return
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        seen = {}
        for a, b in pieces(count, 2_000_000):
            self._bands(at[a:b], low[a:b], count[a:b], text, bounds, seen)
        for (t, i), bands in sorted(seen.items()):
            item, most, best = self.items[i], int(self.edits[i]), []
            own = values[bounds[t] : bounds[t + 1]]
            width = int(most) + 1
            for band, grams_in in sorted(bands.items()):
                if grams_in < self.least[i]:
                    continue
                # Diagonals of a band and an edit budget on both sides.
                left = max(0, band * width - most)
                region = own[left : max(0, (band + 2) * width + most + len(item))]
                edits, start, end = distance(item, region, most)
                if edits <= most:
                    best.append((left + start, left + end, edits))
            for start, end, edits in apart(best):
                yield t, i, edits, int(offset[bounds[t] + start]), int(offset[bounds[t] + end - 1]) + 1

    def _bands(self, at, low, count, text, bounds, seen):
        """Add to ``seen`` how many places of a text share a q-gram with an item, band by band of diagonals."""
        hit = np.repeat(np.arange(len(at)), count)
        entry = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        where, item = at[hit], self.item[entry]
        t = text[where]
        diagonal = where - bounds[t] - self.place[entry]
        # Bands are two widths wide and begin every width, so that budget + 1 diagonals in a row lie in one.
        upper = diagonal // (self.edits[item] + 1)
        key = np.concatenate([np.stack([t, item, b, where], axis=1) for b in (upper, upper - 1)])
        order = np.lexsort(key.T[::-1])
        key = key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]).any(axis=1)
        key = key[new][:, :3]
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        size = np.diff(np.append(edge, len(key)))
        for (a, b, c), n in zip(key[edge].tolist(), size.tolist(), strict=True):
            bands = seen.setdefault((a, b), {})
            bands[c] = bands.get(c, 0) + n


def indexes(ids: list[int], texts: list[str | None], q: int, budget: float) -> list[Index]:
    """An index for each length of q-grams: the largest up to ``q`` of which a find within budget keeps one whole."""
    _, text, _ = letters(texts)
    size = np.bincount(text, minlength=len(ids))
    fit = np.minimum(q, size // (np.floor(budget * size).astype(np.int64) + 1))
    # Items with fewer than q letters and digits aren't searched.
    groups = [(int(own), np.flatnonzero((fit == own) & (size >= q))) for own in np.unique(fit[size >= q])]
    return [Index([ids[k] for k in at], [texts[k] for k in at], own, budget) for own, at in groups]


def pieces(count: np.ndarray, limit: int):
    """Ranges of rows whose counts sum to about ``limit``."""
    group = np.cumsum(count) // limit
    edge = np.flatnonzero(np.diff(group)) + 1
    yield from zip(np.concatenate([[0], edge]), np.append(edge, len(count)), strict=True)


def apart(found: list[tuple[int, int, int]]):
    """Of overlapping finds the one with the fewest edits."""
    kept: list[tuple[int, int, int]] = []
    for start, end, edits in sorted(found, key=lambda x: (x[2], x[0])):
        if all(end <= s or start >= e for s, e, _ in kept):
            kept.append((start, end, edits))
    return kept


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> list[tuple[list, list]]:
    """The items in blocks of about ``block_chars``: each block is collected and shipped by itself."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body")).distinct()
    total = items.agg(F.sum(F.char_length("body"))).first()[0] or 0
    n = max(1, ceil(total / block_chars))
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("id", "body"), F.lit(n)) == k).orderBy("id", "body").collect()
        if own:
            yield [r.id for r in own], [r.body for r in own]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = 10,
    budget: float = 0.08,
    block_chars: int = 1_000_000,
    hashed: bool = False,
) -> DataFrame:
    """Benchmark items found in documents: ``doc_id``, ``item_id``, ``n_edits``, ``start``, ``end`` (code points); with ``hashed`` also the document's ``text_hash``.

    Compared are lower-case letters and digits. An item of m of them with an edit budget of e = floor(``budget`` * m) must
    leave m - q + 1 - q * e of its q-grams whole (the q-gram lemma), on diagonals no further apart than e; bands of diagonals
    that hold so many are verified by an alignment limited to the band. Where the lemma leaves none, the item's q-grams are
    shorter, so that no find within budget is dropped. The benchmark is a stated query set: it is
    taken in blocks of about ``block_chars`` characters, so a task holds one block's index however long the benchmark,
    and the documents are read once per block.

    Null and empty texts hold no item; items with fewer than ``q`` letters and digits are no evidence and aren't
    searched. Repeated rows are searched each, and equal finds appear once. Other columns are left out. An empty
    table on either side gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"), *[text_hash(text_col)] * hashed)
    schema = "doc_id long, item_id long, n_edits int, start long, end long" + ", text_hash long" * hashed

    def search(ids, texts):
        built = []

        def work(batch):
            if not built:
                built.append(indexes(ids, texts, q, budget))
            body, out = batch.column(1).to_pylist(), []
            for a, b in slices(body):
                out += [(a + t, index.ids[i], edits, start, end) for index in built[0] for t, i, edits, start, end in index.found(body[a:b])]
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = [None, pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            at = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), *[pa.array(c, k) for c, k in zip(cols[1:], kinds[1:], strict=True)], *[c.take(at) for c in batch.columns[2:]]],
                names=["doc_id", "item_id", "n_edits", "start", "end"] + ["text_hash"] * hashed,
            )

        return by_arrow(rows, work, schema)

    found = [search(*block) for block in blocks(benchmark, item_col, item_text_col, block_chars)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found).distinct()
