"""Every registered query against its SQL on the smallest tables, and its plan."""

import collections
import io
import re
from contextlib import redirect_stdout

import duckdb
import pytest

from wagewright.catalogue import REGISTRY
from wagewright.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(repr(r[i] + 0.0) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


# No join of all pairs, no Python in the row path.
BANNED = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|FlatMapGroups")


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_matches_sql(spark, con, key):
    df = REGISTRY[key].run(spark, SF)
    assert not BANNED.search(plan(df))
    result = con.execute(REGISTRY[key].oracle())
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert bag([tuple(r) for r in df.collect()], df.columns) == bag(result.fetchall(), names)


def test_every_query_has_sql():
    assert [k for k, q in REGISTRY.items() if q.sql is None] == []


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
