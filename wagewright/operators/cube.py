"""Pre-aggregates kept up from row changes, and headcounts over any roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.session import settled


def signed_rows(changes: DataFrame, schema: str) -> DataFrame:
    """The rows that ``snapshots.changes`` took away (``sign`` -1) and put in (+1), out of their JSON images."""
    kinds = {"old_data": -1, "new_data": 1}
    images = [F.struct(F.from_json(c, schema).alias("row"), F.lit(s).alias("sign")) for c, s in kinds.items()]
    return changes.select(F.inline(F.array(*images))).filter("row IS NOT NULL").select("row.*", "sign")


def build(rows: DataFrame, keys: list[str], sums: list[str], ends: list[str]) -> DataFrame:
    """The cube of ``rows``: per cell ``n``, ``sum_x`` for ``sums``, ``min_x`` and ``max_x`` for ``ends``."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in sums], *[x for c in ends for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    )


def _same_cell(keys: list[str], other: str) -> Column:
    cond = F.col(keys[0]).eqNullSafe(F.col(f"{other}_{keys[0]}"))
    for k in keys[1:]:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{other}_{k}"))
    return cond


def refresh(cube: DataFrame, signed: DataFrame, rows: DataFrame, keys: list[str], sums: list[str], ends: list[str]) -> DataFrame:
    """The cube after a change, from the signed rows of the change; ``rows`` is the table after it.

    Counts and sums take the signed rows' own. A least or greatest value that only gained rows follows from those; where a
    removed row held it, the cells that lost it, and only those, are read again from ``rows``: a semi join with the few
    lost cells, which also prunes partitions on the keys. A cell without rows goes. Cells without changes
    are passed on unread by any aggregate. Null keys make a cell of their own.
    """
    taken, put = F.col("sign") < 0, F.col("sign") > 0
    moves = [F.sum("sign").alias("_n"), *[F.sum(F.col(c) * F.col("sign")).alias(f"_sum_{c}") for c in sums]]
    for c in ends:
        moves += [F.min(F.when(put, F.col(c))).alias(f"_in_min_{c}"), F.max(F.when(put, F.col(c))).alias(f"_in_max_{c}")]
        moves += [F.min(F.when(taken, F.col(c))).alias(f"_out_min_{c}"), F.max(F.when(taken, F.col(c))).alias(f"_out_max_{c}")]
    delta = signed.groupBy(*keys).agg(*moves).withColumnsRenamed({k: f"d_{k}" for k in keys})
    delta = settled(delta.withColumn("_hit", F.lit(1)), "deltas")
    both = cube.withColumn("_had", F.lit(1)).join(delta, _same_cell(keys, "d"), "full")
    kinds = dict(cube.dtypes)
    changed = both.filter("_hit = 1").select(
        *[F.when(F.col("_had") == 1, F.col(k)).otherwise(F.col(f"d_{k}")).alias(k) for k in keys],
        (F.coalesce("n", F.lit(0)) + F.col("_n")).alias("n"),
        *[(F.coalesce(f"sum_{c}", F.lit(0)) + F.coalesce(f"_sum_{c}", F.lit(0))).cast(kinds[f"sum_{c}"]).alias(f"sum_{c}") for c in sums],
        *[F.least(f"min_{c}", f"_in_min_{c}").alias(f"min_{c}") for c in ends], *[F.greatest(f"max_{c}", f"_in_max_{c}").alias(f"max_{c}") for c in ends],
        # Lost: a removed value was the extreme, and no added one is beyond it.
        *[(F.coalesce(F.col(f"_out_min_{c}") <= F.col(f"min_{c}"), F.lit(False)) & ~F.coalesce(F.col(f"_in_min_{c}") <= F.col(f"min_{c}"), F.lit(False))).alias(f"_lost_min_{c}") for c in ends],
        *[(F.coalesce(F.col(f"_out_max_{c}") >= F.col(f"max_{c}"), F.lit(False)) & ~F.coalesce(F.col(f"_in_max_{c}") >= F.col(f"max_{c}"), F.lit(False))).alias(f"_lost_max_{c}") for c in ends],
    )
    lost = F.lit(False)
    for c in ends:
        lost = lost | F.col(f"_lost_min_{c}") | F.col(f"_lost_max_{c}")
    changed = settled(changed.filter("n > 0").withColumn("_lost", lost), "changed")
    cells = settled(changed.filter("_lost").select(*[F.col(k).alias(f"l_{k}") for k in keys]), "lost")
    again = rows.join(cells, _same_cell(keys, "l"), "left_semi").groupBy(*keys).agg(
        *[x for c in ends for x in (F.min(c).alias(f"_again_min_{c}"), F.max(c).alias(f"_again_max_{c}"))]
    ).withColumnsRenamed({k: f"a_{k}" for k in keys})
    whole = changed.join(again, _same_cell(keys, "a"), "left")
    fixed = {f"{side}_{c}": F.when(F.col("_lost"), F.col(f"_again_{side}_{c}")).otherwise(F.col(f"{side}_{c}")) for c in ends for side in ("min", "max")}
    done = whole.withColumns(fixed).select(*cube.columns)
    untouched = cube.join(delta.select(*[f"d_{k}" for k in keys]), _same_cell(keys, "d"), "left_anti")
    return untouched.unionByName(done)


def headcount_cells(rows: DataFrame, keys: list[str], person: str, bits: int = 14) -> DataFrame:
    """Per cell a distinct sketch of the persons, to be stored beside the cube's sums."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(person, F.lit(bits)).alias("people"))


def stated_error(bits: int) -> float:
    """Four standard errors of a sketch with 2 ** bits registers, as a share of the count."""
    return 4 * 1.04 / (2**bits) ** 0.5


def headcount_rollup(cells: DataFrame, rows: DataFrame, keys: list[str], person: str, bits: int = 14) -> DataFrame:
    """Heads over every roll-up of the keys: ``level`` (which keys are rolled up, 0 none), the exact ``headcount`` and the ``estimate`` of merged sketches.

    A person counts once in a roll-up, so headcounts can't be added up. Sketches can be merged: the estimate reads the stored cells only. The exact
    count reads the rows in two steps: distinct persons per cell, then, for each roll-up, distinct persons of those counted by
    group and person before they are counted by group. No group's persons meet in one task.
    """
    sets = [list(keys[:k]) for k in range(len(keys), -1, -1)]
    merged = cells.rollup(*keys).agg(F.grouping_id().alias("level"), F.hll_sketch_estimate(F.hll_union_agg("people")).alias("estimate"))
    once = settled(rows.select(*keys, person).filter(F.col(person).isNotNull()).distinct(), "heads")
    counts = None
    for kept in sets:
        level = sum(1 << (len(keys) - 1 - i) for i in range(len(keys)) if keys[i] not in kept)
        one = once.select(*kept, person).distinct().groupBy(*kept).agg(F.count("*").alias("headcount"))
        one = one.select(*[(F.col(k) if k in kept else F.lit(None)).cast(dict(rows.dtypes)[k]).alias(k) for k in keys], "headcount", F.lit(level).cast("bigint").alias("level"))
        counts = one if counts is None else counts.unionByName(one)
    right = merged.withColumnsRenamed({k: f"m_{k}" for k in keys}).withColumnRenamed("level", "m_level")
    cond = _same_cell(keys, "m") & (F.col("level") == F.col("m_level"))
    close = F.abs(F.col("estimate") - F.col("headcount")) <= F.ceil(F.col("headcount") * stated_error(bits))
    return counts.join(right, cond).select(*keys, "level", "headcount", "estimate", close.cast("int").alias("within_error"))
