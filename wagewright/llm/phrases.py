"""Collocations by dynamic itemset counting over cyclic shards."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.llm.common import ship_code
from wagewright.llm.words import BASE, mixed
from wagewright.session import parallelism, scratch, settled

#: Characters that end a piece and those that part words within one.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
NEVER, CHARS, HELD = 255, 8_000_000, 6_000_000
STEP = np.uint64(0xD6E8FEB86659FD93)


def _kinds() -> np.ndarray:
    kind = np.zeros(256, dtype=np.uint8)
    kind[list(BLANKS)] = 1
    kind[list(BREAKS)] = 2
    return kind


KIND = _kinds()
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)


def string_hashes(values: pa.LargeStringArray) -> np.ndarray:
    """64 bits for each string without nulls; equal strings agree in every task."""
    at = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    size = np.diff(at)
    out = np.zeros(len(values), dtype=np.uint64)
    has = size > 0
    if has.any():
        body = np.frombuffer(values.buffers()[2], dtype=np.uint8)[at[0] : at[-1]].astype(np.uint64) + np.uint64(1)
        place = np.arange(len(body)) - np.repeat(at[:-1] - at[0], size)
        power = np.cumprod(np.full(int(size.max()), BASE))
        out[has] = np.add.reduceat(body * power[place], (at[:-1] - at[0])[has])
    return mixed(out + size.astype(np.uint64))


def words_in(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """All words, A-Z lower-cased, the text each stands in, and whether the next word is in the same piece."""
    closed = pc.binary_join_element_wise(texts, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    at = np.frombuffer(closed.buffers()[1], dtype=np.int64)[: len(closed) + 1]
    raw = np.frombuffer(closed.buffers()[2], dtype=np.uint8)[at[0] : at[-1]]
    kind = KIND[raw]
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(end - start, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(LOWER[raw[inside]]))
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    return words, np.searchsorted(at, start, side="right") - 1, piece[1:] == piece[:-1]


def packed(ids: list[np.ndarray], n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns ``ids``, whole numbers below ``n``, and how often each occurs."""
    if n ** len(ids) < 1 << 62:
        key = ids[0]
        for x in ids[1:]:
            key = key * n + x
        key, count = np.unique(key, return_counts=True)
        out = []
        for _ in ids[1:]:
            key, x = np.divmod(key, n)
            out.append(x)
        return [key, *out[::-1]], count
    order = np.lexsort(ids[::-1])
    rows = [x[order] for x in ids]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in rows])
    first = np.flatnonzero(new)
    return [x[first] for x in rows], np.diff(first, append=len(order))


class Chunk:
    """The words of some texts: each place's distinct word of its lang (``number``), and those words' hash and count."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        words, doc, self.together = words_in(texts.cast(pa.large_string()))
        coded, tongues = words.dictionary_encode(), langs.cast(pa.large_string()).dictionary_encode()
        self.words, self.tongues, n = coded.dictionary, tongues.dictionary, len(coded.dictionary)
        number = tongues.indices.to_numpy().astype(np.int64)[doc] * n + coded.indices.to_numpy()
        if n * len(self.tongues) <= 8 * len(number):
            count = np.bincount(number, minlength=n * len(self.tongues))
            seen = np.flatnonzero(count)
            place = np.zeros(len(count), dtype=np.int64)
            place[seen] = np.arange(len(seen))
            self.number, self.count = place[number], count[seen]
        else:
            seen, self.number, self.count = np.unique(number, return_inverse=True, return_counts=True)
        self.tongue, self.word = np.divmod(seen, max(n, 1))
        self.hash = mixed(string_hashes(self.words)[self.word] * STEP + string_hashes(self.tongues)[self.tongue])

    def longer(self, longest: int, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For k from 2: k, the hash of the k words from each place on, and where ``wanted(k, hashes of k - 1, hashes of k)`` holds for all parts."""
        hash_, valid = self.hash[self.number], np.ones(len(self.number), dtype=bool)
        for k in range(2, longest + 1):
            if len(hash_) < 2:
                return
            longer = mixed(hash_[:-1] * STEP + hash_[1:])
            valid = valid[:-1] & valid[1:] & wanted(k, hash_, longer)
            if k == 2:
                valid &= self.together
            hash_ = longer
            yield k, hash_, valid

    def rows(self, k: int, parts: list[np.ndarray], count: np.ndarray) -> pa.RecordBatch:
        text = [self.words.take(pa.array(self.word[x])) for x in parts]
        phrase = pc.binary_join_element_wise(*text, pa.scalar(" ", pa.large_string())) if k > 1 else text[0]
        lang = self.tongues.take(pa.array(self.tongue[parts[0]]))
        return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(np.full(len(count), k, np.int32)), pa.array(count.astype(np.int64))], names=["lang", "phrase", "k", "n"])


def chunks(batches) -> Iterator[Chunk]:
    """Whole texts, together about CHARS bytes."""
    for batch in batches:
        size = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // CHARS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if size[a:b].any():
                yield Chunk(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a))


def summed(hashes: list[np.ndarray], counts: list[np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and the sums of their counts (1 each without any)."""
    all_ = np.concatenate(hashes)
    if counts is None:
        return np.unique(all_, return_counts=True)
    order = np.argsort(all_, kind="stable")
    all_ = all_[order]
    first = np.flatnonzero(np.diff(all_, prepend=~all_[:1]))
    return all_[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else np.zeros(0, np.int64)


COUNTS = "p int, k int, start int, hashes binary, counts binary"


def shard_scan(docs: DataFrame, step: int, shards: int, parts: int, active) -> DataFrame:
    """The counts of one step over the documents of one shard, by hash, dealt into ``parts`` ranges of hashes."""

    def run(batches):
        now, held, size = active.value, {}, 0
        shift = np.uint64(64 - len(now[0]).bit_length() + 1)
        edges = (np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - parts.bit_length() + 1)) if parts > 1 else np.zeros(0, np.uint64)

        def flushed():
            for (k, start), (hashes, counts) in held.items():
                hashes, counts = summed(hashes, counts if k == 1 else None)
                cut = [0, *np.searchsorted(hashes, edges), len(hashes)]
                at = [p for p in range(parts) if cut[p] < cut[p + 1]]
                blobs = [[x[cut[p] : cut[p + 1]].tobytes() for p in at] for x in (hashes, counts.astype("<u4"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), *[pa.array([x] * len(at), pa.int32()) for x in (k, start)], *[pa.array(b, pa.binary()) for b in blobs]], names=["p", "k", "start", "hashes", "counts"]
                )
            held.clear()

        for chunk in chunks(batches):
            from_ = []

            def starts(k, shorter, _, from_=from_):
                first = now[k - 2][shorter >> shift]
                from_[:] = [np.maximum(first[:-1], first[1:])]
                return from_[0] <= step

            if step < shards:
                own = held.setdefault((1, 0), ([], []))
                own[0].append(chunk.hash)
                own[1].append(chunk.count)
                size += len(chunk.hash)
            for k, hashes, valid in chunk.longer(len(now) + 1, starts):
                for start in range(max(step - shards + 1, 0), step + 1):
                    found = hashes[valid & (from_[0] == start)]
                    if len(found):
                        held.setdefault((k, start), ([], []))[0].append(found)
                        size += len(found)
            if size > HELD:
                yield from flushed()
                size = 0
        yield from flushed()

    ship_code(docs.sparkSession)
    return docs.mapInArrow(run, COUNTS)


def bit_map(slots: np.ndarray, first: int, n: int) -> bytes:
    """Which of the ``n`` slots from ``first`` on occur, as packed and compressed bits."""
    bits = np.zeros(n, dtype=bool)
    bits[slots.astype(np.int64) - first] = True
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def merge_counts(found: DataFrame, step: int, shards: int, parts: int, min_count: int, longest: int, filter_bits: int, final_bits: int) -> DataFrame:
    """Sums over the counts of a step and those still open. Per range of hashes: what stays ``open``, and bit maps of what has
    ``reached`` the threshold so far and of what has it after a whole cycle (``kept``)."""

    def run(table):
        p = table.column("p")[0].as_py()
        held, out = {}, []
        for k, start, hashes, counts in zip(*[table.column(c).to_pylist() for c in ("k", "start", "hashes", "counts")], strict=True):
            own = held.setdefault((k, start), ([], []))
            own[0].append(np.frombuffer(hashes, "<u8"))
            own[1].append(np.frombuffer(counts, "<u4").astype(np.int64))
        maps = {}
        for (k, start), (hashes, counts) in held.items():
            hashes, counts = summed(hashes, counts)
            often = hashes[counts >= min_count]
            if k < longest:
                maps.setdefault(("reached", k), []).append(often)
            if start + shards - 1 > step:
                out.append(("open", k, start, hashes.tobytes(), np.minimum(counts, (1 << 32) - 1).astype("<u4").tobytes()))
            else:
                maps.setdefault(("kept", k), []).append(often)
        for (what, k), often in maps.items():
            bits = filter_bits if what == "reached" else final_bits
            n = (1 << bits) // parts
            out.append((what, k, 0, bit_map(np.concatenate(often) >> np.uint64(64 - bits), p * n, n), b""))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.Table.from_arrays([pa.array([p] * len(out), pa.int32()), *cols], names=["p", "what", "k", "start", "hashes", "counts"])

    return found.groupBy("p").applyInArrow(run, "p int, what string, k int, start int, hashes binary, counts binary")


def taken_maps(state: DataFrame, what: str, parts: int, bits: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The bit maps of one kind: phrase length, first slot, bits. All together they have at most 2 ** ``bits`` bits for each length."""
    for r in state.filter(F.col("what") == what).select("p", "k", "hashes").toLocalIterator():
        yield r.k, r.p * ((1 << bits) // parts), np.unpackbits(np.frombuffer(zlib.decompress(bytes(r.hashes)), np.uint8))


def exact_counts(docs: DataFrame, told) -> DataFrame:
    """Phrases whose every part is in the bit maps, counted as strings, and all words by lang (``k`` 0)."""

    def run(batches):
        maps = told.value
        shift = np.uint64(64 - (8 * len(maps[0])).bit_length() + 1)

        def known(k, hashes):
            slot = hashes >> shift
            return (maps[k - 1][slot >> np.uint64(3)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1

        for chunk in chunks(batches):
            total = np.bincount(chunk.tongue, weights=chunk.count, minlength=len(chunk.tongues)).astype(np.int64)
            names = chunk.tongues.cast(pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array([""] * len(total), pa.string()), pa.array(np.zeros(len(total), np.int32)), pa.array(total)], names=["lang", "phrase", "k", "n"])
            one = known(1, chunk.hash)
            at = np.flatnonzero(one)
            yield chunk.rows(1, [at], chunk.count[at])

            def wanted(k, _, longer, one=one, chunk=chunk):
                here = known(k, longer)
                if k == 2:
                    own = one[chunk.number]
                    here &= own[:-1] & own[1:]
                return here

            for k, _, valid in chunk.longer(len(maps), wanted):
                at = np.flatnonzero(valid)
                if len(at):
                    parts, count = packed([chunk.number[at + i] for i in range(k)], len(chunk.count))
                    yield chunk.rows(k, parts, count)

    return docs.mapInArrow(run, "lang string, phrase string, k int, n long")


def frequent_phrases(
    docs: DataFrame, longest: int, min_count: int, shards: int, filter_bits: int, final_bits: int, lang_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """Exact counts (``lang``, ``phrase``, ``k``, ``n``) of all phrases of up to ``longest`` words found ``min_count`` times, and all words' number by lang.

    Dynamic itemset counting. Documents are dealt into shards, which are scanned in a cycle, one a step. Words are counted from step
    0; a longer phrase is counted from the first step at which both its subphrases have reached the threshold, while those are
    still being counted, and until it has seen every shard once. So lengths are interleaved, and late phrases cost late steps only.

    Counts go by 64-bit hash, packed, in as many ranges of hashes as there are shuffle partitions: a range is one task's share of
    all counts, whatever phrase is hot. Which phrases may start is told to the tasks as the step by slot of a table of 2 **
    ``filter_bits`` bytes for each length: its size is fixed, and a phrase that shares a slot only starts early and is still counted
    for one whole cycle. So no phrase is missed; two of one hash only look commoner. What is common by hash, as bit maps of 2 ** ``final_bits``
    bits, picks the phrases that a last scan counts as strings.
    """
    spark = docs.sparkSession
    parts = 1 << min((2 * parallelism(spark) - 1).bit_length(), filter_bits - 3, final_bits - 3)  # whole bytes of the maps
    folder = scratch(spark, "shards")
    lang = F.coalesce(F.col(lang_col), F.lit("und")).alias("lang")
    whole = docs.select(F.coalesce(text_col, F.lit("")).alias("text"), lang, F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
    whole.write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    read = spark.read.schema("text string, lang string, shard int").parquet(folder)
    active = [np.full(1 << filter_bits, NEVER, dtype=np.uint8) for _ in range(longest - 1)]
    kept = [np.zeros((1 << final_bits) // 8 or 1, dtype=np.uint8) for _ in range(longest)]
    state = None
    for step in range(longest * shards):
        if step >= shards and not any(((a <= step) & (a > step - shards)).any() for a in active):
            break  # whatever started has seen a whole cycle
        told = spark.sparkContext.broadcast(active)
        found = shard_scan(read.filter(F.col("shard") == step % shards).select("text", "lang"), step, shards, parts, told)
        if state is not None:
            found = found.unionByName(state.filter("what = 'open'").drop("what"))
        state = settled(merge_counts(found, step, shards, parts, min_count, longest, filter_bits, final_bits), f"step-{step}")
        told.destroy()
        for k, first, bits in taken_maps(state, "reached", parts, filter_bits):
            now = active[k - 1][first : first + len(bits)]
            now[(bits[: len(now)] == 1) & (now == NEVER)] = step + 1
        for k, first, bits in taken_maps(state, "kept", parts, final_bits):
            packed_ = np.packbits(bits)
            kept[k - 1][first // 8 : first // 8 + len(packed_)] |= packed_
    told = spark.sparkContext.broadcast(kept)
    counts = exact_counts(read.select("text", "lang"), told).groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n"))
    counts = settled(counts.filter((F.col("n") >= min_count) | (F.col("k") == 0)), "phrases")
    told.destroy()
    return counts.filter("k > 0"), counts.filter("k = 0").select("lang", "n")


def first_of_each(rows: DataFrame, group: str, order: list[Column], n: int, out: str, parts: int = 32) -> DataFrame:
    """The first ``n`` rows of each group, numbered; the rows of a group are thinned in ``parts`` parts before they meet."""
    part = F.pmod(F.xxhash64(*[c for c in rows.columns if c != group]), F.lit(parts))
    thin = rows.withColumn("_part", part).withColumn("_nth", F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)))
    thin = thin.filter(F.col("_nth") <= n).drop("_part", "_nth")
    return thin.withColumn(out, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")).filter(F.col(out) <= n)


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 3, min_count: int = 10, cover: int = 50, first: int = 2000,
    shards: int = 2, filter_bits: int = 24, final_bits: int = 26,
) -> DataFrame:
    """The ``first`` phrases of each lang: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased in A-Z, cut at ``.,;:!?`` and line ends into pieces and those at blanks and tabs into words. ``n`` counts
    all words of the lang, ``a`` all occurrences of a phrase of 2 to ``longest`` words in pieces, overlaps included; phrases with
    ``a >= min_count`` are candidates. Cut after its k-th word a phrase has the parts' counts ``l`` and ``r`` and the score
    floor(10^6 a a / (l r)), in DECIMAL(38); the lowest counts, of equal ones the first. A candidate goes if a longer candidate
    that holds it has at least ``cover`` percent of its count. Order: score, ``a`` (both falling), phrase in bytes.

    A null lang is ``und``, a null or empty text has no words; repeated rows count each; other columns are left out; texts of any
    length are read whole; an empty table gives no rows.
    """
    counts, totals = frequent_phrases(docs, longest, min_count, shards, filter_bits, final_bits, lang_col, text_col)
    candidates = counts.filter("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    def joined(words: Column, a: Column, size: Column) -> Column:
        return F.array_join(F.slice(words, a, size), " ")

    w, k, i = F.col("w"), F.col("k"), F.col("i")
    cuts = candidates.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), k - 1)).alias("i"))
    cuts = cuts.select("lang", "phrase", "k", "a", "i", joined(w, F.lit(1), i).alias("left"), joined(w, i + 1, k - i).alias("right"))
    sides = {c: counts.select("lang", F.col("phrase").alias(c), F.col("n").alias(c[0])) for c in ("left", "right")}
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    scored = cuts.join(sides["left"], ["lang", "left"]).join(sides["right"], ["lang", "right"])
    scored = scored.withColumn("over", wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("under", wide["l"] * wide["r"])
    scored = scored.withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "i", "l", "r")).alias("cut"))

    inner = candidates.filter(F.col("k") > 2).select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(2), k - 1)).alias("i"))
    inner = inner.select("lang", "a", "w", "i", F.explode(F.sequence(F.lit(1), k - i + 1)).alias("from"))
    inner = inner.groupBy("lang", joined(w, F.col("from"), i).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    top = first_of_each(rows, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], first, "rank")
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
