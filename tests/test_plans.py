"""Physical plans: what must and must not be in them."""

import pytest

from workload.queries import QUERIES


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


PLAIN = sorted(n for n in QUERIES if not n.startswith(("stream_", "tag_store", "kmeans")) and n != "model_score")


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_rows_and_no_nested_loops(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "NestedLoop", "CartesianProduct"):
        assert operator not in text


@pytest.mark.parametrize("name", ["tag_equal_inner", "tag_equal_left", "tag_range_inner", "tag_range_left",
                                  "ip_area_join", "access_metrics"])
def test_small_lookups_are_broadcast(spark, sf_dir, name):
    assert "BroadcastHashJoin" in plan(spark, sf_dir, name)


@pytest.mark.parametrize("name", ["tag_equal_shuffled", "tag_range_shuffled", "ip_area_join_shuffled"])
def test_large_lookups_are_salted(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "_salt" in text and "hashpartitioning(" in text


def test_matching_needs_no_shuffle(spark, sf_dir):
    for name in ("tag_equal_inner", "tag_equal_left", "tag_range_inner", "ip_area_join", "access_log_parse"):
        assert "Exchange hashpartitioning" not in plan(spark, sf_dir, name)


def test_top_category_limits_groups_before_the_shuffle(spark, sf_dir):
    for name in ("payway_top1", "payway_second"):
        text = plan(spark, sf_dir, name)
        assert "WindowGroupLimit" in text and "Partial" in text


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    for name in ("recency_days", "category_counts", "behaviour_counts", "keyed_reduce", "access_metrics"):
        assert "partial_" in plan(spark, sf_dir, name)


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    assert "ReadSchema: struct<c_custkey:bigint>" in plan(spark, sf_dir, "tag_equal_inner")
    assert "GreaterThan(c_custkey,4)" in plan(spark, sf_dir, "filter_gt")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan(spark, sf_dir, "recency_days")


def test_json_is_parsed_once_for_the_used_fields(spark, sf_dir):
    text = plan(spark, sf_dir, "behaviour_counts")
    assert "get_json_object" not in text and "goods_name" not in text and text.count("from_json(") == 1


def test_access_lines_are_counted_by_a_hash_aggregate(spark, sf_dir):
    from tagweave.operators.metrics import access_per_ip

    lines = spark.createDataFrame([], "ip string, code string, useragent string, access_time timestamp")
    plan = access_per_ip(lines)._jdf.queryExecution().sparkPlan().toString()
    lowest = [line.strip(" +-:") for line in plan.splitlines() if "Aggregate" in line][-1]
    assert lowest.startswith("HashAggregate")
