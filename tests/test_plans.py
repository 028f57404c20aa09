"""Physical plans: no pair products, no whole table in one task, filters and columns in the scan."""

import contextlib
import io
import re

import pytest
from conftest import TINY

from tidemark.plans import plans
from tidemark.session import sizing

PLANS = {n: p for n, p in plans().items() if not n.startswith("stream_")}


def explained(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def texts(spark):
    return {n: explained(p(spark, TINY)) for n, p in PLANS.items()}


def test_no_pair_products(texts):
    bad = [n for n, t in texts.items() if "CartesianProduct" in t or "NestedLoopJoin" in t]
    assert bad == []


def test_every_window_has_a_partition(texts):
    """A window without PARTITION BY gathers its input in one task."""
    bad = []
    for name, text in texts.items():
        for block in re.findall(r"\(\d+\) Window\n(?:.+\n)+", text):
            arguments = re.search(r"Arguments: \[(.*)\], \[(.*?)\](?:, \[.*\])?$", block, re.M)
            if arguments is None or not arguments.group(2).strip():
                bad.append((name, block))
    assert bad == []


#: reports of one row, the covered days of a table, totals
SINGLE = {"work_ready", "duplicate_report", "enrichment_coverage", "constraint_report",
          "component_counts", "backfill_range", "backfill_summary", "missing_periods",
          # the share of all rows that makes a key hot
          "prev_amount", "change_feed_log", "key_history", "rank_in_category", "product_price_rank",
          "percentile_linear", "percentile_rank_pick", "latency_summary", "aggregate_runs",
          "heavy_mix", "scorecard", "mode_stats"}


def test_single_task_stages_only_merge_partial_results(texts):
    gathers = {n for n, t in texts.items() if "SinglePartition" in t}
    assert gathers <= SINGLE, gathers - SINGLE
    for name in gathers:
        # what is gathered are partial aggregates
        assert "partial_" in texts[name]


def test_no_python_in_batch_queries(texts):
    assert [n for n, t in texts.items() if "Python" in t or "ArrowEval" in t or "InPandas" in t] == []


def test_group_limits_before_the_shuffle(texts):
    for name in ("group_top_n", "claim_batch", "claim_next_batch"):
        assert "WindowGroupLimit" in texts[name], name


def test_top_k_is_not_a_full_sort(texts):
    for name in ("top_traders", "top_products", "top_priced", "top_salaries", "top_duplicates",
                 "latest_windows", "lake_readback", "sensor_top", "sensor_range_top"):
        assert "TakeOrderedAndProject" in texts[name], name


def test_filters_and_columns_reach_the_scan(texts):
    recent = texts["item_revenue"]
    assert "GreaterThanOrEqual(l_shipdate" in recent and "LessThanOrEqual(l_shipdate" in recent
    assert re.search(r"ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,"
                     r"l_shipdate:timestamp_ntz>", recent)
    assert "EqualTo(event_type,purchase)" in texts["lake_readback"]
    asked = texts["archive_range_stats"]
    assert asked.count("GreaterThanOrEqual(o_orderdate,1999-07-01") == 2
    # two narrow columns of the wide table
    assert "ReadSchema: struct<l_extendedprice:double,l_shipdate:timestamp_ntz>" in texts["daily_revenue"]


def test_two_step_windows_shuffle_totals(texts):
    """Order lines are reduced to (item, window) totals before the lookup."""
    text = texts["self_join_windows"]
    assert text.index("HashAggregate") < text.index("Join")


def test_sizes_for_a_hundred_terabytes():
    conf = sizing(100 << 40, 8000)
    scans = (100 << 40) // int(conf["spark.sql.files.maxPartitionBytes"])
    assert scans <= 110_000 and conf["spark.sql.shuffle.partitions"] == "50000"
    small = sizing(1 << 30, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
