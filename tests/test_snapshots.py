from pyspark.sql import functions as F

from wagewright.operators import snapshots as snap
from wagewright.operators.loading import insert_ignore, upsert
from wagewright.operators.snapshots import changes


def rows(spark, data):
    return spark.createDataFrame(data, "id bigint, s string, v double")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def base(spark):
    return rows(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, None, None)])


def counts(changed):
    return tuple(snap.tally(changed, "id").first())


def test_update_in_the_columns_own_type(spark):
    got = snap.update(base(spark), "v > 1.5", {"v": F.col("v") * 10, "s": F.col("id")})
    assert content(snap.state(got)) == [(1, "a", 1.0), (2, "2", 20.0), (3, "3", 30.0), (4, None, None)]
    assert counts(got) == (4, 2, 2, True)


def test_update_decides_on_the_old_values(spark):
    got = snap.state(snap.update(base(spark), "v < 2.5", {"v": F.lit(9.0), "s": F.when(F.col("v") < 2.5, "x").otherwise("y")}))
    assert content(got)[:2] == [(1, "x", 9.0), (2, "x", 9.0)]


def test_delete_ignores_null_predicate(spark):
    got = snap.delete(base(spark), "v > 1.5")
    assert [r[0] for r in content(snap.state(got))] == [1, 4]
    assert counts(got) == (2, 0, 2, True)


def test_merge_keeps_columns_the_source_lacks(spark):
    source = spark.createDataFrame([(2, 20.0, "u"), (2, 21.0, "w"), (9, 9.0, "n"), (None, 5.0, "z")], "id bigint, v double, extra string")
    target = base(spark).unionByName(rows(spark, [(None, "n", 0.0)]))
    order = [F.col("v").desc()]
    got = snap.merge(target, source, "id", order)
    assert content(snap.state(got)) == content(rows(spark, [(1, "a", 1.0), (2, "b", 21.0), (3, "c", 3.0), (4, None, None), (9, None, 9.0), (None, "n", 0.0), (None, None, 5.0)]))
    assert counts(got) == (7, 3, 1, False)
    assert content(snap.state(snap.merge(target, source, "id", order, missing=False))) == content(rows(spark, [(1, "a", 1.0), (2, "b", 21.0), (3, "c", 3.0), (4, None, None), (None, "n", 0.0)]))
    assert counts(snap.merge(target, source, "id", order, matched=False, missing=False)) == (5, 0, 0, False)


def test_merge_with_a_null_in_the_source_sets_null(spark):
    source = rows(spark, [(1, None, 7.0)])
    assert content(snap.state(snap.merge(base(spark), source, "id", [F.col("v")])))[0] == (1, None, 7.0)


def test_append_widens_and_defaults_hold_for_old_rows(spark):
    old = snap.state(snap.add_column(base(spark), "bonus", "double", "5"))
    assert snap.state(snap.add_column(old, "bonus", "double", "6")).agg(F.sum("bonus")).first()[0] == 20.0
    got = snap.append(old, rows(spark, [(7, "z", 7.0)]).withColumn("note", F.lit("late")))
    assert {r["id"]: (r["bonus"], r["note"]) for r in snap.state(got).filter("id IN (1, 7)").collect()} == {1: (5.0, None), 7: (None, "late")}
    assert counts(got) == (5, 1, 0, True)


def test_empty_table(spark):
    none = base(spark).limit(0)
    assert counts(snap.delete(none, "v > 1")) == (0, 0, 0, True)
    assert counts(snap.merge(none, base(spark), "id", [F.col("v")])) == (4, 4, 0, True)


def test_state_at_an_instant_in_any_zone(spark):
    held = spark.sql("""SELECT id, CAST(f AS timestamp_ntz) AS valid_from, CAST(t AS timestamp_ntz) AS valid_to FROM VALUES
        (1, '2026-01-01', '2026-01-03'), (2, '2026-01-02', NULL), (3, '2026-01-02 10:00:00', '2026-01-02 11:00:00') AS x(id, f, t)""")
    own = spark.newSession()
    for zone in ("UTC", "Asia/Kolkata"):
        own.conf.set("spark.sql.session.timeZone", zone)
        for at, ids in {"2025-12-31": [], "2026-01-01": [1], "2026-01-02 10:00:00": [1, 2, 3], "2026-01-02 11:00:00": [1, 2], "2026-01-03": [2]}.items():
            assert sorted(r["id"] for r in snap.valid_at(held, at).collect()) == ids


def test_change_capture(spark):
    old, new = rows(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)]), rows(spark, [(1, "a", 1.0), (2, "x", 2.0), (4, "d", 4.0), (3, "c", None)])
    got = {r["record_id"]: (r["action"], r["old_data"], r["new_data"]) for r in changes(old, new, "id", ["s"], "t").collect()}
    assert got == {2: ("UPDATE", '{"s":"b"}', '{"s":"x"}'), 4: ("INSERT", None, '{"s":"d"}')}


def test_keyed_loads(spark):
    target, source = rows(spark, [(1, "a", 1.0), (2, "b", 2.0)]), rows(spark, [(2, "x", 5.0), (2, "y", 6.0), (3, "z", 7.0)])
    order = [F.col("v").desc()]
    assert content(upsert(target, source, ["id"], order)) == [(1, "a", 1.0), (2, "y", 6.0), (3, "z", 7.0)]
    assert content(insert_ignore(target, source, ["id"], order)) == [(1, "a", 1.0), (2, "b", 2.0), (3, "z", 7.0)]
