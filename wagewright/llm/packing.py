"""Pack tokenised documents into training sequences by a length histogram."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagewright.llm.common import by_arrow, give_back, ship_code, slices
from wagewright.session import settled

LENGTH = 1024
CONTROLS = re.compile("[\x1c-\x1f]")
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: White space that an ASCII table doesn't tell: its code points, and controls that not all call white space.
ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Characters whose class no version of Unicode doubts.
UNSURE = re.compile("[^\n \x21-\x7eÀ-ÖØ-öø-ÿ]")
#: How the byte-level vocabulary cuts a text before it merges bytes, and the characters that stand for bytes in its file.
CUTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def quick_encoder(path: str):
    """The same merges run by a faster library, or None if the file isn't a byte-level vocabulary whose merges come in the order of its ids."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    model, cut, letters = found["model"], found.get("pre_tokenizer") or {}, byte_letters()
    pairs = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
    ids = [model["vocab"].get(p) for p in pairs]
    if found.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    if None in ids or any(a >= b for a, b in zip(ids, ids[1:])) or not set(letters) <= model["vocab"].keys():
        return None
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if set(token) <= letters.keys()}
    extra = {t["content"] for t in found.get("added_tokens", [])}
    ranks = {k: i for k, i in ranks.items() if k.decode("utf-8", "replace") not in extra}
    return tiktoken.Encoding("merges", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})


def units(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the units of the texts ``raw[at[i]:at[i + 1]]`` begin: stretches that the tokenizer never joins with what stands beside them.

    A word takes the single space before it. Of a longer run of white space all but the last character are a unit, and so are
    the last one if it isn't a space and a run that ends a text. No text is empty.
    """
    space = ((raw >= 9) & (raw <= 13)) | (raw == 32)
    first = np.zeros(len(raw), dtype=bool)
    first[at[:-1]] = True
    last = np.zeros(len(raw), dtype=bool)
    last[at[1:] - 1] = True
    open_ = space & (first | np.append(True, ~space[:-1]))  # a run begins
    close = np.flatnonzero(space & (last | np.append(~space[1:], True)))  # and ends
    begins = first | open_
    within = close[~last[close]]  # a word follows in the same text
    begins[within] = True
    begins[within[raw[within] != 32] + 1] = True
    return np.flatnonzero(begins)


class Tokens:
    """Ids of whole texts. With a byte-level vocabulary, units are encoded once for each call, however often they occur in its texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.quick = quick_encoder(path)
        self.feed = None if self.quick is None else self.quick.encode_to_numpy("\n")

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pool(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the distinct units, and how many each has: many units in one text, parted by line feeds, whose token no unit has.

        Units of plain letters, digits and signs go through the faster library, which merges the same pairs in the same order; all others don't.
        """
        kinds: list[list[int]] = [[], [], [], [], []]
        for i, u in enumerate(distinct):
            kinds[4 if not u.strip(" \t\n\x0b\x0c\r") else 2 * (UNSURE.search(u) is not None) + (u[0] == " ")].append(i)
        ids, sizes = [], np.zeros(len(distinct), dtype=np.int64)
        for some in kinds[:4]:
            for a in range(0, len(some), 4000):
                joined = "\n".join([distinct[i] for i in some[a : a + 4000]])
                found = self._encode([joined])[0] if UNSURE.search(joined) else self.quick.encode_to_numpy(joined)
                ends = np.append(np.flatnonzero(found == self.feed), len(found))
                sizes[some[a : a + 4000]] = np.diff(ends, prepend=-1) - 1
                ids.append(found[found != self.feed])
        blank = self._encode([distinct[i] for i in kinds[4]])
        sizes[kinds[4]] = [len(x) for x in blank]
        order = np.concatenate([np.array(k, dtype=np.int64) for k in kinds])
        starts = np.zeros(len(distinct), dtype=np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate([*ids, *blank, np.zeros(0, "<u4")]), np.stack([starts, sizes])

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text and a closing 0."""
        texts = [t or "" for t in texts]
        end = np.zeros(1, "<u4")
        out: list[np.ndarray] = [end] * len(texts)
        odd = [i for i, t in enumerate(texts) if self.quick is None or not t.isascii() and ODD.search(t) or t.isascii() and CONTROLS.search(t)]
        for i, found in zip(odd, self._encode([texts[i] for i in odd]), strict=True):
            out[i] = np.append(found, end)
        rest = set(odd)
        plain = [i for i, t in enumerate(texts) if t and i not in rest]
        if not plain:
            return out
        body = [texts[i].encode() for i in plain]
        raw = np.frombuffer(b"".join(body), dtype=np.uint8)
        at = np.zeros(len(body) + 1, dtype=np.int64)
        np.cumsum([len(b) for b in body], out=at[1:])
        begins = units(raw, at)
        found = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(raw))), pa.py_buffer(raw)).dictionary_encode()
        pool, (starts, sizes) = self._pool(found.dictionary.to_pylist())
        unit = found.indices.to_numpy()
        long = sizes[unit]
        ends = np.cumsum(long)
        flat = pool[np.repeat(starts[unit] - (ends - long), long) + np.arange(int(ends[-1]))]
        cut = np.append(0, ends)[np.searchsorted(begins, at)]
        for i, a, b in zip(plain, cut[:-1], cut[1:], strict=True):
            out[i] = np.append(flat[a:b], end)
        return out


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def cut_rows(rows: DataFrame, path: str, length: int) -> DataFrame:
    """Per row: whole windows (their checksums) and the rest's ids; ``task`` and ``rank`` number rests of one length.

    The numbers are made as the rows pass, so no sort is needed; they hold once the rows are written.
    """

    def run(batches):
        try:
            yield from cut(batches)
        finally:
            _tokens.clear()
            give_back()

    def cut(batches):
        task, seen, windows = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64), 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 4_000_000):
                ids = tokens(path).ids(texts[a:b])
                size = np.array([len(x) for x in ids], dtype=np.int64)
                full = size // length
                rest = size - full * length
                rank, before = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
                for k, r in enumerate(rest):
                    rank[k], before[k] = seen[r], windows
                    seen[r] += 1
                    windows += full[k]
                crcs = [[crc(x[j * length : (j + 1) * length]) for j in range(n)] for x, n in zip(ids, full, strict=True)]
                left = [x[n * length :].tobytes() for x, n in zip(ids, full, strict=True)]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(np.full(n, task, np.int32)), pa.array(size), pa.array(rest.astype(np.int32)), pa.array(rank), pa.array(before),
                     pa.array(crcs, pa.list_(pa.int64())), pa.array([crc(np.frombuffer(x, "<u4")) for x in left], pa.int64()), pa.array(left, pa.binary())],
                    names=["doc_id", "task", "doc_tokens", "rest", "rank", "windows_before", "window_crcs", "rest_crc", "ids"],
                )

    ship_code(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, task int, doc_tokens long, rest int, rank long, windows_before long, window_crcs array<long>, rest_crc long, ids binary")


def combinations(histogram: np.ndarray, length: int, deep: int) -> list[tuple[int, ...]]:
    """Multisets of one, two or three lengths at hand that fill a window exactly; triples of the ``deep`` commonest lengths."""
    at_hand = np.flatnonzero(histogram[:length])
    has = set(at_hand.tolist())
    found = {(a, length - a) for a in at_hand.tolist() if a <= length - a and length - a in has}
    common = sorted(at_hand.tolist(), key=lambda x: (-histogram[x], x))[:deep]
    for i, a in enumerate(common):
        for b in common[i:]:
            c = length - a - b
            if c > 0 and c in has:
                found.add(tuple(sorted((a, b, c))))
    return sorted(found)


def nonnegative(a: np.ndarray, b: np.ndarray, steps: int = 400) -> np.ndarray:
    """Least squares with no negative part: projected accelerated gradient on ``a x = b``."""
    if not a.shape[1]:
        return np.zeros(0)
    v = np.ones(a.shape[1])
    for _ in range(30):
        v = a.T @ (a @ v)
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - a.T @ (a @ y - b) / (1.02 * norm))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(histogram: np.ndarray, length: int, deep: int = 48) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Combinations with their repeats, and how many of each length are left over.

    Repeats solve the histogram in least squares, are rounded down, and are then raised greedily while the lengths at hand allow.
    """
    ways = combinations(histogram, length, deep)
    left = histogram[: length + 1].astype(np.int64).copy()
    left[0] = 0
    if not ways:
        return [], left
    a = np.zeros((length, len(ways)))
    for k, way in enumerate(ways):
        for x in way:
            a[x, k] += 1
    x = nonnegative(a, histogram[:length].astype(float))
    repeats = np.zeros(len(ways), dtype=np.int64)
    for rounding in (0, 1):
        for k in np.argsort(-x, kind="stable"):
            need = {v: ways[k].count(v) for v in ways[k]}
            most = min(int(left[v]) // c for v, c in need.items())
            n = most if rounding else min(most, int(x[k] + 1e-9))
            if n:
                repeats[k] += n
                for v, c in need.items():
                    left[v] -= n * c
    return [(w, int(n)) for w, n in zip(ways, repeats, strict=True) if n], left


def slot_table(ways: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length and slot of a combination: the ranks it takes, the first sequence and the offset."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for way, n in ways:
        offset = 0
        for v in way:
            rows.append((v, used.get(v, 0), n, first, offset))
            used[v] = used.get(v, 0) + n
            offset += v
        first += n
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return {"length": cols[0], "from": cols[1], "n": cols[2], "sequence": cols[3], "offset": cols[4], "sequences": np.int64(first)}


def tail_cuts(total: int, length: int) -> list[int]:
    """Where the last, short stretch of the stream is cut: into powers of two, so that nothing is padded."""
    cuts, at = [], total - total % length
    for k in range(length.bit_length() - 1, -1, -1):
        if (total % length) >> k & 1:
            at += 1 << k
            cuts.append(at)
    return cuts


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None, deep: int = 48
) -> DataFrame:
    """Pieces of sequences: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Whole windows of a document are sequences of their own. The rests' lengths make a histogram of ``length`` bins, the only
    thing the driver sees. Combinations of one to three lengths that fill a window are repeated as a non-negative
    least-squares solution says, rounded; a rest's number among those of its length names its combination and slot. What
    no combination takes is laid end to end, longest first, and cut at window ends; the last short window is cut into
    powers of two. So no sequence is padded, and only rests in that stream are cut. Numbers within a length come from
    counts per task, so a length that a third of all documents share meets in no task.

    A null text is empty: one piece with id 0 alone. Repeated rows are packed each, null ids stay null, other columns are
    left out, and an empty table gives no rows.
    """
    path = path or vocabulary_path()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))
    cut = settled(cut_rows(rows, path, length), "tokens")

    per_task = settled(
        cut.groupBy("task", "rest").agg(F.count("*").alias("n"), F.sum(F.size("window_crcs").cast("long")).alias("windows")), "ranks"
    )
    earlier = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_task.select("task", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    tasks = per_task.groupBy("task").agg(F.sum("windows").alias("windows"))
    # A row for each task that read the input: a number of rows that grows with files, not documents.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    window_shift = tasks.select("task", F.coalesce(F.sum("windows").over(before), F.lit(0)).alias("window_shift"))

    histogram = np.zeros(length + 1, dtype=np.int64)
    for r in per_task.groupBy("rest").agg(F.sum("n").alias("n")).collect():
        histogram[r.rest] = r.n
    n_windows = int(tasks.agg(F.sum("windows")).first()[0] or 0)
    ways, left = plan(histogram, length, deep)
    slots = slot_table(ways)
    taken = histogram - left
    # The stream: lengths from long to short, each length's unused ranks in order.
    stream = np.zeros(length + 1, dtype=np.int64)
    at = 0
    for v in range(length - 1, 0, -1):
        stream[v] = at
        at += v * int(left[v])
    cuts = np.array(tail_cuts(at, length), dtype=np.int64)
    whole = at - at % length
    base = n_windows + int(slots["sequences"])

    def place(batch):
        col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
        rest = col["rest"].to_numpy(zero_copy_only=False).astype(np.int64)
        rank = col["rank"].to_numpy(zero_copy_only=False)
        size = col["doc_tokens"].to_numpy(zero_copy_only=False)
        first_window = col["window"].to_numpy(zero_copy_only=False)
        at_row, out = [], []
        for k, r in enumerate(rest):
            crcs = col["window_crcs"][k].as_py()
            for j, c in enumerate(crcs):
                at_row.append(k)
                out.append((j * length, length, c, first_window[k] + j, 0))
            if not r:
                continue
            begin = len(crcs) * length
            if rank[k] < taken[r]:
                lo = np.searchsorted(slots["length"], r, side="left")
                hi = np.searchsorted(slots["length"], r, side="right")
                s = lo + np.searchsorted(slots["from"][lo:hi], rank[k], side="right") - 1
                at_row.append(k)
                out.append((begin, r, col["rest_crc"][k].as_py(), n_windows + slots["sequence"][s] + rank[k] - slots["from"][s], slots["offset"][s]))
                continue
            ids = np.frombuffer(col["ids"][k].as_py(), "<u4")
            a = stream[r] + (rank[k] - taken[r]) * r
            end = a + r
            for x, y, number, opened in windows_of(int(a), int(end), length, whole, cuts):
                at_row.append(k)
                out.append((begin + x - a, y - x, crc(ids[x - a : y - a]), base + number, x - opened))
        cols = np.array(out, dtype=np.int64).reshape(-1, 5).T
        rows_ = pa.array(np.array(at_row, dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [col["doc_id"].take(rows_), pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]), pa.array(size[np.array(at_row, dtype=np.int64)]), pa.array(cols[3]), pa.array(cols[4])],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    met = cut.join(shift, ["task", "rest"]).join(window_shift, "task")
    ready = met.select(
        "doc_id", "rest", (F.col("rank") + F.col("shift")).alias("rank"), "doc_tokens", "window_crcs", "rest_crc",
        (F.col("windows_before") + F.col("window_shift")).alias("window"),
        F.when(F.col("rank") + F.col("shift") >= F.element_at(F.array(*[F.lit(int(x)) for x in taken]), F.col("rest") + 1), F.col("ids")).alias("ids"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return by_arrow(ready, place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def windows_of(a: int, end: int, length: int, whole: int, cuts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Parts of ``[a, end)`` of the stream: bounds, window number and where that window begins."""
    while a < end:
        if a < whole:
            number = a // length
            opened, close = number * length, (number + 1) * length
        else:
            k = int(np.searchsorted(cuts, a, side="right"))
            number, opened, close = whole // length + k, int(cuts[k - 1]) if k else whole, int(cuts[k])
        yield a, min(end, close), number, opened
        a = min(end, close)
