"""A prefix trie over conversations, from identical ones collapsed into weighted sequences."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagewright.llm.common import ship_code
from wagewright.session import settled

WORD = "[^\\x20\\x09-\\x0D]+"
#: Ids in one piece of an end list, and turns of a conversation that one window orders.
IDS, CHUNK = 500, 1024
KEY = ["depth", "k1", "k2"]


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``pos`` from 1, ``mark`` (MD5 of role and text) and ``n_words`` of each turn.

    Turns are ordered by number, null first; turns of one number by their mark. A null role or text is empty, rows without a
    conversation are left out. The order is cut into ranges, which also part a long conversation; places within a range are
    shifted by the turns of the same conversation in earlier ranges.
    """
    said, spoke = F.coalesce(text, F.lit("")), F.coalesce(role, F.lit(""))
    mark = F.unhex(F.md5(F.concat(F.char_length(spoke).cast("string"), F.lit(":"), spoke, said).cast("binary")))
    light = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), mark.alias("mark"), F.regexp_count(said, F.lit(WORD)).cast("long").alias("n_words")
    )
    order = [F.asc_nulls_first("turn"), F.asc("mark")]
    ranged = settled(light, "turns").repartitionByRange(F.asc("conv_id"), *order).withColumn("range", F.spark_partition_id())
    ranged = settled(ranged, "ranges")
    counts = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.withColumn("shift", F.sum("n").over(earlier)).filter("shift > 0").drop("n")  # at most a row for each range
    placed = ranged.withColumn("pos", F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order)))
    pos = (F.col("pos") + F.coalesce("shift", F.lit(0))).cast("long")
    return settled(placed.join(shift, ["conv_id", "range"], "left").select("conv_id", pos.alias("pos"), "mark", "n_words"), "numbered")


def with_heads(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: their turns (``conv_id``, ``depth``, ``mark``, ``n_words``, ``last``) and all ids with ``last``.

    Conversation c takes its first h = crc32(c) % ``most`` turns from conversation c - c % ``block`` (all if that has fewer,
    none if it is absent) and its own turns from number h + 1 on. ``last`` is the number of turns after that, maybe 0.
    """
    long = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    info = long.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % block)
    base = long.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    taken = F.least("h", F.coalesce("base_own", F.lit(0)))
    info = info.join(base, "base", "left").withColumn("taken", taken).withColumn("last", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    info = settled(info.select("conv_id", "base", "h", "taken", "last"), "rebuilt")
    heads = turns.filter((F.col("conv_id") % block == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    first = info.filter("taken > 0").join(heads, "base").filter("pos <= taken").withColumnRenamed("pos", "depth")
    own = turns.join(info, "conv_id").filter("pos > h").withColumn("depth", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ("conv_id", "depth", "mark", "n_words", "last")
    return first.select(*columns).unionByName(own.select(*columns)), info.select("conv_id", "last")


def running(rows: DataFrame, value: dict[str, Column], fold, back: bool = False) -> DataFrame:
    """``rows`` with ``fold`` of each value over the turns of a conversation up to ``depth`` (or from it on, ``back``).

    A conversation is cut into stretches of CHUNK turns; only their totals, one row each, meet in one window.
    """
    rows = settled(rows, "stretches").withColumn("chunk", F.floor(F.col("depth") / CHUNK))
    way = F.desc if back else F.asc
    inside = Window.partitionBy("conv_id", "chunk").orderBy(way("depth"))  # equal depths are peers
    long = rows.groupBy("conv_id", "chunk").agg(*[fold(v).alias(f"all_{c}") for c, v in value.items()])
    others = Window.partitionBy("conv_id").orderBy(way("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = long.select("conv_id", "chunk", *[fold(f"all_{c}").over(others).alias(f"before_{c}") for c in value], F.row_number().over(Window.partitionBy("conv_id").orderBy(way("chunk"))).alias("nth"))
    carried = carried.filter("nth > 1").drop("nth")
    out = rows.select("*", *[fold(v).over(inside).alias(f"in_{c}") for c, v in value.items()]).join(carried, ["conv_id", "chunk"], "left")
    join = (lambda a, b: a.bitwiseXOR(b)) if fold is F.bit_xor else (lambda a, b: a + b)
    total = {c: join(F.col(f"in_{c}"), F.coalesce(f"before_{c}", F.lit(0))) for c in value}
    return out.select(*[c for c in rows.columns if c != "chunk" and c not in value], *[x.alias(c) for c, x in total.items()])


def end_lists(ends: DataFrame) -> DataFrame:
    """KEY and ``ends_sha256``: the hash of the ids that end there, ascending, comma-joined.

    Ids are sorted by ranges of (key, id), so a sequence that most conversations share lies in many tasks, which join IDS of
    them at a time. The pieces of one sequence pass the hash one after the other; no list is held whole.
    """

    def pieces(batches):
        at, first, ids = None, None, []

        def made():
            return pa.RecordBatch.from_pylist([{"depth": at[0], "k1": at[1], "k2": at[2], "first": first, "ids": ",".join(map(str, ids))}], schema=kinds)

        kinds = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
        out = []
        for batch in batches:
            for key in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if key[:3] != at or len(ids) == IDS:
                    if ids:
                        out.append(made())
                    at, first, ids = key[:3], key[3], []
                ids.append(key[3])
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        if ids:
            yield made()

    def hashed(batches):
        at, digest, out = None, None, []
        for batch in batches:
            for *key, _, ids in zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True):
                if key != at:
                    if digest:
                        out.append((*at, digest.hexdigest()))
                    at, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield from batch_of(out)
            out = []
        yield from batch_of([(*at, digest.hexdigest())] if digest else [])

    def batch_of(rows):
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=[*KEY, "ends_sha256"])

    ship_code(ends.sparkSession)
    key = "depth long, k1 long, k2 long"
    ordered = ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    listed = ordered.mapInArrow(pieces, f"{key}, first long, ids string")
    return listed.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, f"{key}, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie over ``turns`` (``conv_id``, ``depth`` from 1, ``mark``, ``n_words``, ``last``) of the conversations ``ids``.

    A node is a distinct sequence of the first d turns; the root has none. Per node: ``conv_id`` (the smallest of its
    conversations), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (below or at it), ``saved_tokens``
    (over its subtree, the words of a node's last turn times its conversations but one) and ``ends_sha256`` (of the ids that end there).

    A node is known by two 64-bit folds over the marks and places of its turns. Identical conversations
    collapse into one sequence with a weight and a list of ends, known by its smallest conversation. A sequence is a leaf if an anti-join
    finds no node under it. All counts then come from the prefixes of distinct sequences, a row for each turn: a node's own cost
    is booked once, on the sequence of its smallest conversation, sums run along each sequence, and prefixes add them up.
    Ids are whole numbers. No conversation: no node. Conversations without turns belong to the root.
    """
    salted = {f"k{i}": F.xxhash64(F.lit(i), "depth", "mark") for i in (1, 2)}
    rows = turns.select("conv_id", "depth", "n_words", "last", *[v.alias(f"own{c}") for c, v in salted.items()])
    prefixes = running(rows, {c: F.col(f"own{c}") for c in salted}, F.bit_xor)
    parent = [F.col(f"k{i}").bitwiseXOR(F.col(f"ownk{i}")).alias(f"p{i}") for i in (1, 2)]
    prefixes = settled(prefixes.select("conv_id", *KEY, "n_words", "last", *parent), "prefixes")
    none = [F.lit(0).cast("long").alias(c) for c in KEY]
    ends = prefixes.filter("depth = last").select("conv_id", *KEY).unionByName(ids.filter("last = 0").select("conv_id", *none))
    sequences = settled(ends.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")

    paths = prefixes.join(sequences.select("conv_id", "weight"), "conv_id").drop("last")
    root = sequences.select("conv_id", *none, F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), "weight")
    paths = settled(paths.unionByName(root), "paths")
    nodes = paths.groupBy(*KEY).agg(*[F.min(c).alias(c) for c in ("conv_id", "n_words", "p1", "p2")], F.sum("weight").alias("n_convs"))
    nodes = settled(nodes, "nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = settled(nodes.filter("depth > 0").groupBy(*above).agg(F.count("*").alias("n_children")), "children")
    leaves = sequences.join(children, KEY, "left_anti").select("conv_id", "depth")

    def booked(frame, saved, leaf, keyed=False):
        return frame.select("conv_id", "depth", *[F.col(c) if keyed else F.lit(None).cast("long").alias(c) for c in ("k1", "k2")], saved.cast("long").alias("saved"), F.lit(leaf).cast("long").alias("leaf"))

    cost = (F.col("n_convs") - 1) * F.col("n_words")
    entries = booked(paths, F.lit(0), 0, keyed=True).unionByName(booked(nodes.filter(cost > 0), cost, 0)).unionByName(booked(leaves, F.lit(0), 1))
    below = running(entries, {"saved": F.col("saved"), "leaf": F.col("leaf")}, F.sum, back=True).filter(F.col("k1").isNotNull())
    sums = below.groupBy(*KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    # The parts of a node meet in one shuffle.
    parts = [nodes.select(*KEY, "conv_id", "p1", "p2", "n_convs"), sums, children, end_lists(ends)]
    kinds = {"conv_id": "long", "p1": "long", "p2": "long", "n_convs": "long", "saved_tokens": "long", "n_leaves": "long", "n_children": "long", "ends_sha256": "string"}
    padded = [p.select(*KEY, *[(F.col(c) if c in p.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]) for p in parts]
    met = padded[0]
    for p in padded[1:]:
        met = met.unionAll(p)
    whole = met.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in kinds])
    upper = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(upper, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
