"""Physical-plan properties that matter at scale, checked on every
registered query: no cartesian or nested-loop joins, no row-at-a-time
Python, pruned scans, pushed snapshot-day filters, windows only over
bounded (per-day reduced) groups."""

import re

import pytest

from keepsake.registry import queries
from tools.plan_report import physical_plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    return {n: physical_plan(fn(spark, SF)) for n, fn in queries().items()}


def test_no_cartesian_nested_loop_or_row_python(plans):
    for name, p in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in p, (name, bad)


def test_python_only_for_nfkd(plans):
    users = {n for n, p in plans.items() if "ArrowEvalPython" in p}
    assert users <= {"q3_backup_plan", "p2_needs_backup", "u5_copy_request_key", "m1_upsert_last_checked",
                     "m6_dedupe_copy_requests", "p21_copy_result_class", "p22_submit_error_class",
                     "m2_record_backups", "s17_unexpire", "f14_copy_errors_message"}


def test_retention_windows_rank_daily_rows_only(plans):
    specs = re.findall(r"windowspecdefinition\(([^)]*)", plans["q1_retention_plan"])
    assert specs and all("young" in s for s in specs)
    # the per-day reduction feeding the window has a buffer of fixed width, so no task sorts raw copies
    reduced = re.findall(r"(\w+Aggregate)\(keys=\[parent_id#\d+L?, _day", plans["q1_retention_plan"])
    assert reduced and set(reduced) == {"HashAggregate"}
    for name in ("w9_keep_n_young", "w10_keep_one_old", "p8_grace_filter"):
        # top-k per table: a partial group limit runs before the shuffle
        assert "WindowGroupLimit" in plans[name], name


def test_headline_plans_do_not_grow(plans):
    """Each job plans its candidates once; a second use of a frame would multiply these."""
    most = {"q12_latency_run": 10, "q14_quality_run": 15, "q1_retention_plan": 28, "q16_orphaned_backups": 2, "q11_latency_sli_4": 4}
    for name, n in most.items():
        assert plans[name].count("Exchange hashpartitioning") <= n, name


def test_census_partition_pruning(spark, scratch):
    from keepsake.operators import sli as S
    from keepsake.sources.testviews import AS_OF, TestViews
    v = TestViews.of(spark, SF)
    v.census_tables.write.partitionBy("snapshot_date").parquet(scratch + "/census_tables")
    v.census_partitions.write.partitionBy("snapshot_date").parquet(scratch + "/census_partitions")
    ct = spark.read.parquet(scratch + "/census_tables")
    cp = spark.read.parquet(scratch + "/census_partitions")
    p = physical_plan(S.modified_before(ct, cp, 4, AS_OF))
    pf = re.findall(r"PartitionFilters: \[(isnotnull\(snapshot_date[^,]*, \(snapshot_date#\d+ >= [0-9-]+)", p)
    assert len(pf) == 2 and all(f.endswith(">= 2024-01-25") for f in pf), p


def test_scans_are_pruned_and_filtered(plans):
    p = plans["q11_latency_sli_4"]
    events = [s for s in re.findall(r"ReadSchema: (struct<[^>]*>)", p) if "event_id" in s]
    assert events and all("props" not in s for s in events)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-25", p)
    q16 = plans["q16_orphaned_backups"]
    assert all("o_orderpriority" not in s for s in re.findall(r"ReadSchema: (struct<[^>]*>)", q16))


def _bracket_groups(text: str) -> int:
    depth = groups = 0
    for ch in text:
        if ch == "[":
            groups += depth == 0
            depth += 1
        elif ch == "]":
            depth -= 1
    return groups


def test_no_global_window(plans):
    """A window without partition keys would run in one task.  Spark prints
    a window as `Window [functions], [partition keys], [order]`; a global one
    has no partition group."""
    for name, p in plans.items():
        for node in re.findall(r"Window (\[.*)", p):
            assert _bracket_groups(node) == 3, (name, node[:200])


def test_global_window_detector(spark):
    from pyspark.sql import Window, functions as F
    df = spark.range(10)
    g = physical_plan(df.withColumn("r", F.row_number().over(Window.orderBy("id"))))
    assert [_bracket_groups(n) for n in re.findall(r"Window (\[.*)", g)] == [2]


def test_dataset_restore_meets_requests_tables_and_copies_once(plans):
    assert len(re.findall(r"\bExchange (?:hash|range|Single|Round)", plans["q6_dataset_restore_plan"])) <= 6


@pytest.mark.parametrize("name, exchanges", [("w4_newest_latency_snapshot", 4), ("w5_newest_quality_snapshot", 4), ("a1_latency_by_count", 4), ("a2_last_snapshot_time", 4),
                                             ("m2_record_backups", 6)])
def test_current_views_read_one_day_of_the_stored_history(plans, name, exchanges):
    p = plans[name]
    assert len(re.findall(r"\bExchange (?:hash|range|Single|Round)", p)) <= exchanges, p
    if name[0] in "wa":
        assert set(re.findall(r"ingest_date#\d+ = ([0-9-]+)", p)) == {"2024-01-30"} and "events" not in p
