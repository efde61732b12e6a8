"""What the plans of the batch queries must look like at any scale."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stackweave.plans import catalog
from tests import compare

# These run jobs while they are built.
EAGER = ("stream_", "profile_", "all_profile", "frame_counts")
BATCH = [name for name in catalog.QUERIES if not name.startswith(EAGER)]


def text_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plan_of(spark, folder, name):
    return text_of(catalog.QUERIES[name](spark, folder))


def single_task_windows(plan):
    """Windows whose definition starts with an order or a frame, as they have no partition."""
    first = re.findall(r"windowspecdefinition\(([^,]*)", plan)
    return [part for part in first if re.search(r" ASC| DESC|^specifiedwindowframe", part)]


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_and_no_single_task(spark, small, name):
    plan = plan_of(spark, small, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not single_task_windows(plan)


def test_the_window_check_finds_windows_without_partition(spark):
    rows = spark.range(3).withColumn("k", F.col("id") % 2)
    running = F.sum("id").over(Window.orderBy("id"))
    assert single_task_windows(text_of(rows.select(running)))
    assert not single_task_windows(text_of(rows.select(F.sum("id").over(Window.partitionBy("k").orderBy("id")))))


def test_scans_read_only_what_is_used(spark, small):
    plan = plan_of(spark, small, "trace_volume")
    assert "o_totalprice" not in plan and "o_custkey" not in plan
    plan = plan_of(spark, small, "samples_with_context")
    assert "text" not in plan and "props" not in plan and "transform(" not in plan
    plan = plan_of(spark, small, "snapshot_samples")
    assert "text" not in plan and "transform(" not in plan


def test_filters_reach_the_scan(spark, small):
    assert "EqualTo(event_type,error)" in plan_of(spark, small, "samples_with_context")
    assert "Not(EqualTo(event_type,error))" in plan_of(spark, small, "context_changes")


def test_stateless_work_has_no_shuffle(spark, small):
    for name in ("trace_volume", "route_logs", "scope_records", "flatten_scope_logs", "limit_attributes",
                 "limit_links", "sanitised_endpoints", "encoded_attributes", "disabled_flags", "requirements_parsed"):
        assert "Exchange" not in plan_of(spark, small, name), name


def test_configuration_is_shuffled_as_settings_and_as_processes(spark, small):
    """Repeats go before the first exchange; the second moves one row per process and setting, and
    nothing after it moves or sorts anything, whatever is computed."""
    for name in ("config_report", "resolved_endpoints", "typed_config", "effective_config"):
        plan = plan_of(spark, small, name)
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Scan parquet") == 1, name


def test_profiles_are_shuffled_once(spark, small):
    """Numbered samples are written; one exchange then serves grouping and ranking, beside the one
    over the runs of a tick that finds where each run's numbers start."""
    for name in ("profile_locations", "profile_functions"):
        plan = plan_of(spark, small, name)
        assert len(re.findall(r"Exchange hashpartitioning\(service\S+, instance\S+, source\S+, tick_ts\S+, part", plan)) == 1, name
        assert plan.count("Exchange hashpartitioning") <= 4, name


def test_results_compare_by_kind_of_type():
    assert compare.kind("timestamp_ntz") == compare.kind("TIMESTAMP") and compare.kind("BIGINT") == compare.kind("bigint")
