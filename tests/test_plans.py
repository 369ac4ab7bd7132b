"""Plans that must not appear, and those that must."""

import io
import re
from contextlib import redirect_stdout

import pytest

from wagewright.catalogue import REGISTRY

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(REGISTRY["anti_join_no_payroll"].run(spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in text
    assert "o_totalprice" not in text and "c_acctbal" not in text


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(REGISTRY["top_n_earners"].run(spark, SF))


@pytest.mark.parametrize("key", ["latest_n_per_entity", "dedup_keep_first", "top_earner_per_dept"])
def test_group_limit_runs_before_the_shuffle(spark, key):
    assert plan(REGISTRY[key].run(spark, SF)).count("WindowGroupLimit") >= 2


def test_lines_are_combined_before_the_join(spark):
    text = plan(REGISTRY["enrich_ratios"].run(spark, SF))
    assert "partial_sum" in text


def test_partition_filter(spark):
    assert re.search(r"PartitionFilters: \[.*pay_year", plan(REGISTRY["partition_pruned_read"].run(spark, SF)))
