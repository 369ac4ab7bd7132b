"""Loads, cubes, ledgers, indexes and layouts that are kept up as changes arrive, against plain Python."""

import datetime as dt
import io
import os
import random
from collections import Counter, defaultdict
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wagewright.operators import cube, ledger, loading, search, snapshots, sweep
from wagewright.operators import payroll as pay
from wagewright.operators import warehouse as wh
from wagewright.operators.slabs import SlabError, tax_by_slabs
from wagewright.plans import upkeep
from wagewright.session import scratch, settled
from wagewright.streaming import jobs

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


# ---- type 2 -----------------------------------------------------------------------
DIM = "k int, s string, row_hash string, effective_from date, effective_to date, is_current int"


def dimension(spark, rows):
    from wagewright.functions.text import row_hash

    df = spark.createDataFrame([(k, s, None, a, b, int(b is None)) for k, s, a, b in rows], DIM)
    return df.withColumn("row_hash", row_hash("s"))


def loaded(df):
    return sorted((r.k, r.s, r.effective_from, r.effective_to, r.is_current) for r in df.collect())


def test_late_state_splits_the_version_it_falls_in(spark):
    """A load dated before the open version leaves that one open and current."""
    now = dimension(spark, [(1, "A", day(0), day(365)), (1, "B", day(365), None)])
    got = wh.type2_apply(now, spark.createDataFrame([(1, "C")], "k int, s string"), "k", ["s"], str(day(100)))
    assert loaded(got) == [(1, "A", day(0), day(100), 0), (1, "B", day(365), None, 1), (1, "C", day(100), day(365), 0)]
    before = wh.type2_apply(now, spark.createDataFrame([(1, "C")], "k int, s string"), "k", ["s"], str(day(-10)))
    assert loaded(before)[-1] == (1, "C", day(-10), day(0), 0)


def test_two_incoming_rows_of_one_key(spark):
    now = dimension(spark, [(1, "A", day(0), None), (None, "N", day(0), None)])
    two = spark.createDataFrame([(1, "B"), (1, "C"), (1, "B"), (None, "X")], "k int, s string")
    got = loaded(wh.type2_apply(now, two, "k", ["s"], str(day(9)), [F.desc("s")]).filter("k = 1"))
    assert got == [(1, "A", day(0), day(9), 0), (1, "C", day(9), None, 1)]


def replay(versions, states):
    """Value by day of one key: the versions, then the incoming states, each until the next step."""
    steps = {a: s for a, b, s in versions if b is None or b > a}
    for a, b, _ in versions:
        if b is not None and (b == a or b not in steps):
            steps.setdefault(b, None)
    steps.update(states)
    return {d: s for d, s in steps.items()}


@pytest.mark.parametrize("limits", [{}, {"chunk_rows": 2}])
def test_loads_against_a_step_function(spark, limits):
    draw = random.Random(3)
    held, states = defaultdict(list), defaultdict(dict)
    for k in range(40):
        at = 0
        for _ in range(draw.randint(0, 5)):
            a = at + draw.randint(0, 6) * (at > 0) * draw.choice([0, 1])  # sometimes with a gap
            at = a + draw.randint(1, 9)
            held[k].append((a, None if draw.random() < 0.1 else at, draw.choice("AB")))
            if held[k][-1][1] is None:
                break
        for _ in range(draw.randint(0, 4)):
            states[k][draw.randint(-3, 50)] = draw.choice("ABC")
    now = dimension(spark, [(k, s, day(a), None if b is None else day(b)) for k, vs in held.items() for a, b, s in vs])
    rows = [(k, s, day(d)) for k, ds in states.items() for d, s in ds.items()]
    got = settled(wh.type2_load(now, spark.createDataFrame(rows * 2, "k int, s string, effective_from date"), "k", ["s"], **limits))
    by_key = defaultdict(list)
    for r in got.collect():
        assert r.effective_to is None or r.effective_to > r.effective_from or not states[r.k]
        by_key[r.k].append(r)
    for k in range(40):
        assert sum(r.is_current for r in by_key[k]) <= 1
        steps = sorted(replay(held[k], states[k]).items())
        for d in range(-5, 80):
            want = next((s for at, s in reversed(steps) if at <= d), None)
            found = [r.s for r in by_key[k] if r.effective_from <= day(d) and (r.effective_to is None or r.effective_to > day(d))]
            assert found == ([want] if want else []), (k, d)
    again = wh.type2_load(got, spark.createDataFrame(rows, "k int, s string, effective_from date"), "k", ["s"], **limits)
    assert loaded(again) == loaded(got)


def test_retention_keeps_what_an_instant_can_see(spark):
    draw = random.Random(8)
    rows = [(k, day(draw.randint(0, 60)), i, draw.choice("ABX")) for i in range(300) for k in [draw.randint(0, 20)]]
    df = spark.createDataFrame(rows, "k int, at date, id int, s string")
    kept = {r.id for r in wh.retained_changes(df, ["k"], "at", "id", str(day(30)), F.col("s") == "X").collect()}
    for k in range(21):
        own = sorted(r[1:] for r in rows if r[0] == k)
        last = [r for r in own if r[0] <= day(30)][-1:]
        want = {r[1] for r in own if r[0] > day(30)} | {r[1] for r in last if r[2] != "X"}
        assert {r[1] for r in own} & kept == want
    spans = spark.createDataFrame([(i, day(a), day(b) if b else None) for i, (a, b) in enumerate([(0, 5), (0, 30), (5, 31), (31, 40), (7, None), (30, 30), (35, 35)])], "id int, valid_from date, valid_to date")
    left = wh.retained_versions(spans, str(day(30)), "valid_from", "valid_to")
    for d in (30, 33, 36, 50):
        at = F.lit(str(day(d))).cast("date")
        assert {r.id for r in snapshots.valid_at(spans, at).collect()} == {r.id for r in snapshots.valid_at(left, at).collect()}
    assert {r.id for r in left.collect()} == {2, 3, 4}


# ---- slabs -------------------------------------------------------------------------
SLABS = "fiscal_year string, income_from double, income_to double, tax_rate_pct double, surcharge_pct double"


def slab_frame(spark, years):
    return spark.createDataFrame([(y, float(a), None if b is None else float(b), float(r), None) for y, rows in years.items() for a, b, r in rows], SLABS)


def test_slab_table_equals_the_formula(spark):
    incomes = [0, -5, 1, 250000, 250000.01, 399999.99, 400000, 400000.01, 1199999.5, 2400000, 99999999.99, None]
    rows = [(y, None if x is None else float(x)) for y in ("new", "old", "none") for x in incomes]
    df = spark.createDataFrame(rows, "y string, x double").withColumn("x", F.col("x").cast("decimal(18,2)"))
    got = tax_by_slabs(df, "x", "y", slab_frame(spark, {"new": pay.NEW_SLABS, "old": pay.OLD_SLABS}))
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    want = got.withColumn("want", F.when(F.col("y") == "new", pay.slab_tax("x", pay.NEW_SLABS)).when(F.col("y") == "old", pay.slab_tax("x", pay.OLD_SLABS)))
    for r in want.collect():
        assert r.slab_tax == (None if r.x is None else r.want) and (r.slab_no is None) == (r.y == "none" or r.x is None)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 100])
def test_any_number_of_slabs(spark, n):
    bounds = [7 * i * i for i in range(n)]
    rows = list(zip(bounds, [*bounds[1:], None], range(n)))
    xs = sorted({b + d for b in bounds for d in (-1, 0, 1)} | {10**6})
    got = tax_by_slabs(spark.createDataFrame([(x,) for x in xs], "x long"), "x", F.lit("y"), slab_frame(spark, {"y": rows})).collect()
    for r in got:
        x = max(r.x, 0)
        assert r.slab_no == max([1] + [i + 1 for i, b in enumerate(bounds) if b < x])
        assert r.slab_tax == sum(Decimal(max(min(x, hi if hi is not None else x) - lo, 0) * rate) / 100 for lo, hi, rate in rows)


@pytest.mark.parametrize("rows,fault", [
    ([(0, 10, 1), (11, None, 2)], "incomes between"), ([(0, 10, 1), (9, None, 2)], "overlap"), ([(5, None, 1)], "start at 0"), ([(0, 10, 1)], "upper limit"),
    ([(0, None, 1), (10, None, 2)], "overlap"), ([(0, 0, 1), (0, None, 1)], "before it starts"),
])
def test_bad_slabs_are_named(spark, rows, fault):
    with pytest.raises(SlabError, match=fault):
        tax_by_slabs(spark.createDataFrame([(1,)], "x long"), "x", F.lit("y"), slab_frame(spark, {"fine": [(0, None, 3)], "y": rows}))


# ---- cubes -------------------------------------------------------------------------
def test_refresh_equals_rebuild(spark):
    draw = random.Random(2)
    kind = "id int, d string, m int, v decimal(18,2)"

    def row(i):
        return (i, draw.choice(["a", "b", None]), draw.randint(1, 4), Decimal(draw.randint(1, 9)))

    rows = {i: row(i) for i in range(120)}
    for turn in range(4):
        after = {i: r for i, r in rows.items() if draw.random() > 0.3 * (turn != 2)}
        after |= {i: row(i) for i in list(after)[:: 5]} | {i: row(i) for i in range(1000 * (turn + 1), 1000 * (turn + 1) + 15)}
        if turn == 3:
            after = {i: r for i, r in after.items() if r[2] != 1}  # whole cells go
        old, new = (spark.createDataFrame(list(x.values()), kind) for x in (rows, after))
        stored = settled(cube.build(old, ["d", "m"], ["v"], ["v"]))
        signed = cube.signed_rows(snapshots.changes(old, new, "id", ["d", "m", "v"], "t"), "d string, m int, v decimal(18,2)")
        got = cube.refresh(stored, signed, new, ["d", "m"], ["v"], ["v"])
        want = cube.build(new, ["d", "m"], ["v"], ["v"])
        assert Counter(tuple(r) for r in got.select(*want.columns).collect()) == Counter(tuple(r) for r in want.collect())
        rows = after


def test_only_lost_cells_are_read_again(spark):
    """Rows of cells that kept their extremes may be unreadable: they aren't looked at."""
    old = spark.createDataFrame([(1, "a", 5), (2, "a", 7), (3, "b", 5), (4, "b", 9)], "id int, d string, v int")
    new = spark.createDataFrame([(1, "a", 5), (2, "a", 6), (3, "b", 5), (4, "b", 9), (5, "b", 6)], "id int, d string, v int")
    signed = cube.signed_rows(snapshots.changes(old, new, "id", ["d", "v"], "t"), "d string, v int")
    poisoned = new.withColumn("v", F.when(F.col("d") == "b", F.raise_error(F.lit("read"))).otherwise(F.col("v")).cast("int"))
    got = {r.d: (r.n, r.min_v, r.max_v) for r in cube.refresh(settled(cube.build(old, ["d"], ["v"], ["v"])), signed, poisoned, ["d"], ["v"], ["v"]).collect()}
    assert got == {"a": (2, 5, 6), "b": (3, 5, 9)}


def test_headcounts(spark):
    rows = [(d, y, p % 700) for d in "ab" for y in (1, 2, None) for p in range(0, 3000, 1 + y if y else 7)] + [("a", 1, None)]
    df = spark.createDataFrame(rows, "d string, y int, p int")
    got = cube.headcount_rollup(settled(cube.headcount_cells(df, ["d", "y"], "p")), df, ["d", "y"], "p").collect()
    heads = lambda f: len({p for d, y, p in rows if p is not None and f(d, y)})
    assert {(r.d, r.y, r.level): r.headcount for r in got} == {
        **{(d, y, 0): heads(lambda a, b: (a, b) == (d, y)) for d in "ab" for y in (1, 2, None)}, **{(d, None, 1): heads(lambda a, b: a == d) for d in "ab"}, (None, None, 3): heads(lambda a, b: True)
    }
    assert all(r.within_error == 1 and r.estimate > 0 for r in got)


# ---- ledger ------------------------------------------------------------------------
def repay(loans, paid):
    out = {}
    for i, emp, owed, emis, status in loans:
        closed = None
        for e, d, _, a in sorted(paid, key=lambda r: (r[2], r[1])):
            if e == emp and status == "Active" and a > 0:
                owed, emis = owed - a, emis + 1
                if owed <= 0:
                    status, closed = "Closed", d
        out[i] = (owed, emis, status, closed)
    return out


def test_ledger_in_order(spark):
    draw = random.Random(6)
    paid = [(draw.choice([1, 1, 2, 3]), i, dt.datetime(2020, 1, draw.randint(1, 20)), Decimal(draw.randint(-2, 40)) / 4) for i in range(150)]
    loans = [(i, draw.randint(1, 4), Decimal(draw.randint(-1, 300)), draw.randint(0, 3), draw.choice(["Active", "Active", "Closed", "Pending"])) for i in range(90)]
    d = spark.createDataFrame(paid, "emp_id long, deduction_id long, paid_at timestamp_ntz, amount decimal(18,2)").repartition(3)
    x = spark.createDataFrame(loans, "loan_id long, emp_id long, outstanding decimal(18,2), emis_paid long, status string")
    got = ledger.settle_loans(x, settled(ledger.running_deductions(d)), "loan_id").collect()
    assert {r.loan_id: (r.new_outstanding, r.new_emis_paid, r.new_status, r.closed_by) for r in got} == repay(loans, paid) and len(got) == 90


def test_keyed_state_over_restarts(spark):
    landing, out, check = (scratch(spark, n) for n in ("landing", "out", "check"))
    own = jobs.stream_session(spark, 3)
    draw = random.Random(1)
    sent = defaultdict(list)
    for turn in range(3):
        rows = [(draw.choice([1, 1, 2, turn + 5]), 100 * turn + i, dt.datetime(2020, 1 + turn, draw.randint(1, 9)), draw.randint(1, 50)) for i in range(40)]
        jobs.stage_files(spark.createDataFrame(rows, "k long, id long, at timestamp_ntz, u long").repartition(4), landing)
        for k, i, at, u in sorted(rows, key=lambda r: (r[2], r[1])):
            sent[k].append((i, u))
        stream = own.readStream.schema("k long, id long, at timestamp_ntz, u long").parquet(landing)
        jobs.append_to(jobs.running_by_key(stream, "k", "at", "id", "u"), out, check)
    got = {r.id: (r.k, r.nth, r.total) for r in spark.read.parquet(out).collect()}
    assert len(got) == 120
    for k, rows in sent.items():
        total = 0
        for n, (i, u) in enumerate(rows, 1):
            total += u
            assert got[i] == (k, n, total)


def test_many_keys_share_states(spark):
    """The number of states is bounded, whatever the number of keys; keys of one state stay apart over a restart, also large and negative ones."""
    landing, out, check = (scratch(spark, n) for n in ("landing", "out", "check"))
    own = jobs.stream_session(spark)
    known = [k * (2**62 // 4000) * (-1) ** k - k for k in range(4000)]
    sent = defaultdict(list)
    for turn in range(2):
        rows = [(k, 2 * i + turn + 10**16, dt.datetime(2020, 1 + turn, 1 + i % 5), i + 1) for i, k in enumerate(known[turn * 1000:] + known[:2500])]
        jobs.stage_files(spark.createDataFrame(rows, "k long, id long, at timestamp_ntz, u long").repartition(4), landing)
        for k, i, at, u in sorted(rows, key=lambda r: (r[2], r[1])):
            sent[k].append((i, u))
        stream = own.readStream.schema("k long, id long, at timestamp_ntz, u long").parquet(landing)
        jobs.append_to(jobs.running_by_key(stream, "k", "at", "id", "u"), out, check)
    want = [(k, i, n, sum(u for _, u in rows[:n])) for k, rows in sent.items() for n, (i, _) in enumerate(rows, 1)]
    assert sorted((r.k, r.id, r.nth, r.total) for r in spark.read.parquet(out).collect()) == sorted(want)
    assert spark.read.format("statestore").load(check).count() <= 2048 < len(sent) == 4000


# ---- replacing a partition ------------------------------------------------------------
def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_run_replaces_its_month_alone_and_can_be_repeated(spark):
    path = upkeep.stored_records(spark, SF)
    before, month = files(path), upkeep.BATCH_MONTH
    slips = spark.createDataFrame([(i, Decimal(i * 10 - 50)) for i in range(1, 150)], "emp_id bigint, net decimal(18,2)")
    upkeep.run_month(spark, path, slips, month)
    first = sorted(map(str, upkeep.read_records(spark, path).collect()))
    after = files(path)
    other = {f for f in before if f"period={month}" not in f}
    assert other and all(after.get(f) == before[f] for f in other) and not {f for f in before if f"period={month}" in f} & set(after)
    upkeep.run_month(spark, path, slips, month)
    assert sorted(map(str, upkeep.read_records(spark, path).collect())) == first


def test_replace_partitions_leaves_others(spark):
    path = scratch(spark, "parts")
    loading.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "x int, p string"), path, ["p"])
    loading.replace_partitions(spark.createDataFrame([(9, "b"), (8, "d")], "x int, p string"), path, ["p"])
    assert {(r.x, r.p) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b"), (3, "c"), (8, "d")}


# ---- search ------------------------------------------------------------------------
def test_search_equals_the_scan(spark):
    draw = random.Random(5)
    rows = [(i, *[None if draw.random() < 0.1 else "".join(draw.choice("abAé%_") for _ in range(draw.randint(0, 9))) for _ in range(2)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    index = search.store_index(search.trigram_index(df, "id", ["a", "b"]), "id", scratch(spark, "grams"))
    some = [r[1] for r in rows if r[1]]
    for size in range(1, 9):
        for _ in range(3):
            text = (draw.choice(some) * 8)[:size]
            want = {i for i, a, b in rows if text in (a or "") or text in (b or "")}
            assert {r.id for r in search.find(df, index, "id", ["a", "b"], text).collect()} == want
    assert search.find(df, index, "id", ["a", "b"], "nowhere").count() == 0
    found = search.find(df, index, "id", ["a", "b"], some[0][:3] if len(some[0]) >= 3 else "aba")
    assert "left_semi" in plan(found).lower() or "LeftSemi" in plan(found)


# ---- sweep -------------------------------------------------------------------------
def test_load_by_day(spark):
    draw = random.Random(4)
    rows = [(draw.choice("xxy"), draw.randint(0, 6), day(a), day(a + draw.randint(-2, 9))) for a in [draw.randint(0, 40) for _ in range(120)]] + [("x", 1, day(3), None), ("z", 9, None, day(4))]
    df = spark.createDataFrame(rows, "g string, who int, a date, b date")
    want = {}
    for g in "xyz":
        for d in range(-5, 60):
            own = Counter(w for h, w, a, b in rows if h == g and a and b and a <= day(d) <= b)
            if own:
                want[g, day(d)] = [sum(own.values()), len(own), sum(n > 1 for n in own.values())]
    for (g, d), v in want.items():
        v.append(int(v[1] == max(x[1] for (h, _), x in want.items() if h == g)))
    got = sweep.load_by_day(df, "g", "who", "a", "b")
    assert "Join" not in plan(got)
    assert {(r.g, r.day): [r.requests, r.away, r.overlapping, r.peak] for r in got.collect()} == want


# ---- layout ------------------------------------------------------------------------
def test_bucketed_join_moves_no_facts(spark):
    n = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (n, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            text = plan(upkeep.bucketed_payroll_join(spark, SF))
            assert "Bucketed: true" in text and "\nExchange" not in text.replace("BroadcastExchange", "") and "hashpartitioning" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", n)
