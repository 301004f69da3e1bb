"""Plan properties that matter at scale, checked on Spark's physical plans."""

import re

import pytest

from __spark_entry__ import queries
from tidewater import plans

QUERIES = {name: q for name, q in queries().items() if name in plans.QUERIES}
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF", "MapInArrow")


#: Queries whose feature is a user's Python function over ordered groups (G4, G6): Arrow batches only.
USER_FUNCTIONS = {"ordered_fold", "window_function"}


def _plan(spark, sf, name):
    df = QUERIES[name](spark, sf)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_registered_queries(spark, sf, name):
    plan = _plan(spark, sf, name)
    allowed = {"MapInArrow"} if name in USER_FUNCTIONS else set()
    assert not any(n in plan for n in PYTHON_NODES if n not in allowed), name


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = _plan(spark, sf, "filter_threshold")
    assert "GreaterThan(value,10.0)" in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    plan = _plan(spark, sf, "sql_filter_status")
    assert "EqualTo(event_type,purchase)" in plan


@pytest.mark.parametrize("name", ["running_sum", "running_max", "changelog_group_sum", "count_tumbling",
                                  "count_sliding", "watermark_audit", "late_refire",
                                  "order_timeout_review"])
def test_full_data_windows_are_blocked(spark, sf, name):
    """Every window over input rows partitions by (key..., block), never by the key alone."""
    plan = _plan(spark, sf, name)
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", plan)
    assert windows, name
    full = [parts for parts, order in windows if "_mk0" in order]
    assert full, name
    assert all("_blk0" in parts for parts in full), (name, full)


def test_sessions_shuffle_the_rows_once(spark, sf):
    df = QUERIES["session_sum"](spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    full = set(re.findall(r"(?<!Reused)Exchange hashpartitioning\(user_id#\d+L?, _blk#\d+L?", final))
    assert len(full) == 1 and "ReusedExchange" in final
    rows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[_t#", final)
    assert rows and all("_blk" in parts for parts in rows)


def test_interval_join_keys_on_time_bucket(spark, sf):
    plan = _plan(spark, sf, "interval_join")
    assert re.search(r"\[user_id#\d+L?, _bucket#\d+L?\]", plan)


def test_topk_limit_below_shuffle(spark, sf):
    plan = _plan(spark, sf, "topk_per_tick")
    assert "WindowGroupLimit" in plan


def test_writers_keep_parallelism(spark, sf):
    plan = QUERIES["sink_kafka_json"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(4)" in plan or "Exchange RoundRobin" in plan
