"""Tables where one key, amount and user hold a third of the rows; results must stay exact."""

import re

import duckdb
import pytest

from wagewright.catalogue import REGISTRY
from wagewright.sources.tables import TABLES

from test_oracle import SF, bag

KEYS = """rolling_mean_50 rolling_mean_50_chunked scd2_backdated_load loan_ledger leave_load_by_day cube_delta_refresh headcount_rollup payroll_spikes revision_history scd2_dim_employee scd2_asof_lookup latest_n_per_entity dedup_keep_first
global_rank_bucketed gini_index nearest_rank_percentiles agg_multi_function percent_of_total cumulative_column group_by_key_lists
merge_three_datasets apply_revisions dept_payroll_cost ytd_salary correlated_loans top_earner_per_dept iqr_outliers
audit_snapshot_diff upsert_replace end_to_end_kpis payroll_components row_number_in_group rank_dense_rank ntile_quartiles""".split()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changed = {
        "orders": "* REPLACE (CASE WHEN o_orderkey%3=0 THEN 7 ELSE o_custkey END AS o_custkey, CASE WHEN o_orderkey%3=1 THEN 250000.5 ELSE o_totalprice END AS o_totalprice)",
        "lineitem": "* REPLACE (CASE WHEN l_partkey%3=0 THEN 12 ELSE l_orderkey END AS l_orderkey)",
        "events": "* REPLACE (CASE WHEN event_id%3=0 THEN 3 ELSE user_id END AS user_id, CASE WHEN event_id%3=1 THEN 5.5 ELSE value END AS value)",
        "customer": "* REPLACE (CASE WHEN c_custkey%3=0 THEN 4 ELSE c_nationkey END AS c_nationkey, CASE WHEN c_custkey%3=1 THEN 5000.25 ELSE c_acctbal END AS c_acctbal)",
    }
    for name in TABLES:
        con.execute(f"COPY (SELECT {changed.get(name, '*')} FROM '{SF}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("key", KEYS)
def test_hot_tables(spark, skewed, key):
    folder, con = skewed
    df = REGISTRY[key].run(spark, folder)
    got = bag([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(REGISTRY[key].oracle())
    assert got == bag(result.fetchall(), [c[0] for c in result.description])


def test_a_hot_user_is_in_many_chunks(spark, skewed):
    """No task's window holds the hot user's whole history."""
    from wagewright.plans import windows

    folder, _ = skewed
    events = spark.read.parquet(f"{folder}/events.parquet")
    hot = events.groupBy("user_id").count().orderBy("count", ascending=False).first()
    plan = windows.rolling_mean(spark, folder, chunk_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    assert hot["count"] > 300 and re.search(r"windowspecdefinition\(user_id#\d+L?, _chunk#\d+L?,", plan)
