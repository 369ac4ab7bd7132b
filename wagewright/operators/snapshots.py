"""Changes to a keyed table as plain jobs: append, update, delete, merge, diff, and reading an earlier state.

A change takes a frame and returns it with the column ``CHANGE``, which says
what happened to each row. The caller writes that once (``session.settled``);
``state`` is the table after the change and ``tally`` counts the change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.operators.joins import first_per_key

CHANGE = "_change"
KEPT, UPDATED, INSERTED, DELETED = "kept", "updated", "inserted", "deleted"


def _tagged(df: DataFrame, tag: str | Column) -> DataFrame:
    return df.withColumn(CHANGE, F.lit(tag) if isinstance(tag, str) else tag)


def _met(where: Column | str) -> Column:
    """A predicate that is null isn't met."""
    return F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))


def append(target: DataFrame | None, new: DataFrame) -> DataFrame:
    """New rows after the old ones; the schema grows to the union of the columns."""
    fresh = _tagged(new, INSERTED)
    return fresh if target is None else _tagged(target, KEPT).unionByName(fresh, allowMissingColumns=True)


def update(target: DataFrame, where: Column | str, values: dict[str, Column]) -> DataFrame:
    """Rows that meet the predicate take the values, in the columns' own types."""
    hit, kinds = _met(where), dict(target.dtypes)
    changed = {c: F.when(F.col(CHANGE) == UPDATED, v.cast(kinds[c])).otherwise(F.col(c)) for c, v in values.items()}
    return _tagged(target, F.when(hit, UPDATED).otherwise(KEPT)).withColumns(changed)


def delete(target: DataFrame, where: Column | str) -> DataFrame:
    return _tagged(target, F.when(_met(where), DELETED).otherwise(KEPT))


def merge(target: DataFrame, source: DataFrame, key: str, order: list[Column], matched: bool = True, missing: bool = True) -> DataFrame:
    """Upsert by one join on the key; of several source rows of a key the first in ``order`` counts.

    Matched rows keep the columns the source lacks, inserted rows get null
    there, and columns only the source has are left out. A null key never matches.
    """
    shared = [c for c in target.columns if c != key and c in source.columns]
    old = target.select(F.col(key), F.struct(*target.columns).alias("_old"))
    new = first_per_key(source, [key], order).select(F.col(key), F.struct(key, *shared).alias("_new"))
    both = old.join(new, key, "full")
    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    tag = F.when(~had, INSERTED).when(has & F.lit(matched), UPDATED).otherwise(KEPT)
    both = _tagged(both, tag)
    rows = both if missing else both.filter(F.col(CHANGE) != INSERTED)
    taken = F.col(CHANGE).isin(UPDATED, INSERTED)
    kinds = dict(target.dtypes)
    picked = [
        F.when(taken, F.col("_new")[c].cast(kinds[c])).otherwise(F.col("_old")[c]).alias(c) if c in shared or c == key else F.col("_old")[c].alias(c)
        for c in target.columns
    ]
    return rows.select(*picked, CHANGE)


def add_column(target: DataFrame, name: str, kind: str, default: str | None = None) -> DataFrame:
    """Rows so far read the default; a column that exists is left as it is."""
    return _tagged(target if name in target.columns else target.withColumn(name, F.lit(default).cast(kind)), KEPT)


def state(changed: DataFrame) -> DataFrame:
    """The table after a change."""
    return changed.filter(F.col(CHANGE) != DELETED).drop(CHANGE)


def tally(changed: DataFrame, key: str) -> DataFrame:
    """One row: rows after the change, rows added and removed (an update does both), whether every key is set."""
    def times(*tags: str) -> Column:
        return F.count_if(F.col(CHANGE).isin(*tags))

    whole = F.bool_and(F.col(key).isNotNull() | (F.col(CHANGE) == DELETED))
    return changed.agg(
        times(KEPT, UPDATED, INSERTED).alias("rows"), times(UPDATED, INSERTED).alias("added"),
        times(UPDATED, DELETED).alias("removed"), F.coalesce(whole, F.lit(True)).alias("keys_complete"),
    )


def valid_at(history: DataFrame, at: Column | str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows of a dated table that held at an instant: from ``start`` on, before ``end``; a null end is open."""
    at = F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at
    return history.filter((F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) > at)))


def changes(old: DataFrame, new: DataFrame, key: str, tracked: list[str], table_name: str) -> DataFrame:
    """Row changes between two versions with before and after images as JSON.

    One full outer join on the key; unchanged rows are dropped right after it.
    """
    before = old.select(F.col(key), F.struct(*tracked).alias("old"))
    after = new.select(F.col(key), F.struct(*tracked).alias("new"))
    both = before.join(after, key, "full").filter(~F.col("old").eqNullSafe(F.col("new")))
    action = F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "DELETE").otherwise("UPDATE")
    return both.select(
        F.lit(table_name).alias("table_name"), F.col(key).alias("record_id"), action.alias("action"),
        F.to_json("old").alias("old_data"), F.to_json("new").alias("new_data"),
    )
