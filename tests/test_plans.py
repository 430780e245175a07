"""Shape of the physical plans: what is shuffled, broadcast and read."""

import itertools
import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from punctual import schemas as S
from punctual.operators import joins, ordering
from punctual.operators.joins import BROADCAST, SHUFFLE, JoinPlan, salted_join
from punctual.operators.periods import first_successes
from punctual.plans import charts
from punctual.plans.collection import collect_round
from punctual.plans.history import matched_history, run_history, sla_history
from punctual.plans.status import workflow_status
from punctual.sources import driver_tables as data

SF_DIR = "/root/testdata/sf0.001"
LAZY = [name for name in entry.queries() if not name.startswith(("stream", "rounds"))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_or_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    frames = {
        "config": data.sla_config(spark, SF_DIR),
        "jobs": data.job_state(spark, SF_DIR),
        "runs": data.run_state(spark, SF_DIR),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}")
    return [spark.read.parquet(f"{folder}/{name}") for name in frames]


def test_run_history_never_shuffles_runs_behind_a_broadcast(tables):
    config, jobs, runs = tables
    assert "hashpartitioning" not in plan_of(run_history(config, jobs, runs, data.AS_OF, BROADCAST))


def test_match_reduces_runs_before_the_exchange(tables):
    config, _, runs = tables
    lines = plan_of(matched_history(config, runs, data.AS_OF, BROADCAST)).splitlines()
    scan = max(i for i, line in enumerate(lines) if "result_state" in line and "FileScan" in line)
    above = [line for line in lines[:scan] if "Exchange" in line][-1]
    partial = max(i for i, line in enumerate(lines[:scan]) if "partial_min" in line)
    assert "hashpartitioning" in above and lines.index(above) < partial < scan


def test_scans_push_filters_and_prune_columns(tables, capsys):
    config, jobs, runs = tables
    sla_history(config, jobs, runs, data.AS_OF, BROADCAST).explain("formatted")
    shown = capsys.readouterr().out
    pushed = re.findall(r"PushedFilters: \[(.*)\]", shown)
    assert any("EqualTo(result_state,SUCCEEDED)" in line and "GreaterThanOrEqual(period_start_time" in line for line in pushed)
    assert any("GreaterThanOrEqual(period_end_time" in line for line in pushed)
    assert "run_id" not in "".join(re.findall(r"ReadSchema: (.*)", shown))


def scans_of(plan, column):
    return [line for line in plan.splitlines() if "FileScan" in line and column in line]


@pytest.mark.parametrize("how", [BROADCAST, SHUFFLE])
def test_status_reads_the_runs_once(tables, how):
    plan = plan_of(workflow_status(*tables, data.AS_OF, how))
    assert len(scans_of(plan, "period_start_time")) == 1
    nearest = [line for line in plan.splitlines() if "Aggregate(" in line and "result_state" in line][-1]
    assert "HashAggregate" in nearest and "partial_max" in nearest


def test_a_round_reads_its_feed_once(spark, tables, tmp_path):
    config, jobs, runs = tables
    data.round_feed(spark, SF_DIR).write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    details, errors = data.job_details(spark, SF_DIR), data.collection_errors(spark, SF_DIR)
    result = collect_round(runs, jobs, config, feed, details, errors, data.AS_OF, BROADCAST)
    assert len(scans_of(plan_of(result.changes), "feed_kind")) == 1


def test_join_plan_follows_the_row_count(tables, monkeypatch):
    config = tables[0]
    assert JoinPlan.measure(config) == BROADCAST
    monkeypatch.setattr(joins, "BROADCAST_PERIOD_WORKFLOWS", 3)
    assert JoinPlan.measure(config) == JoinPlan(broadcast_workflows=True, broadcast_periods=False)
    monkeypatch.setattr(joins, "BROADCAST_WORKFLOWS", 5)
    assert JoinPlan.measure(config) == SHUFFLE


def ran(df):
    """The plan as it was run, with what Spark decided on the way."""

    df.collect()
    return plan_of(df).split("Initial Plan")[0]


@pytest.mark.parametrize("build", [matched_history, sla_history, run_history, workflow_status])
def test_the_shuffled_plan_broadcasts_no_exploded_side(tables, build):
    """Spark's estimate leaves out the explosion, so such a side went to the driver whatever its rows."""

    config, jobs, runs = tables
    given = (config, runs) if build is matched_history else (config, jobs, runs)
    assert_no_exploded_broadcast(build(*given, data.AS_OF, SHUFFLE))


@pytest.mark.parametrize(
    "cut", [charts.sla_compliance_trend, charts.sla_delivery_calendar, charts.workflow_risk_map, ordering.sla_history_order]
)
@pytest.mark.parametrize("as_of", [data.AS_OF, data.IN_FEBRUARY])
def test_views_of_the_deadline_history_broadcast_no_exploded_side(tables, cut, as_of):
    """A view reads few columns, which makes Spark's estimate of the exploded side smaller still."""

    assert_no_exploded_broadcast(cut(sla_history(*tables, as_of, JoinPlan(broadcast_workflows=True, broadcast_periods=False))))


@pytest.mark.parametrize(
    "cut", [None, charts.sla_compliance_trend, charts.sla_delivery_calendar, charts.workflow_risk_map, ordering.sla_history_order]
)
@pytest.mark.parametrize("as_of", [data.AS_OF, data.IN_FEBRUARY])
def test_views_of_the_deadline_history_send_no_workflows_to_the_driver(tables, cut, as_of):
    """Names and run metrics have a row per workflow; the display order alone broadcasts, a row per hour."""

    history = sla_history(*tables, as_of, JoinPlan(broadcast_workflows=True, broadcast_periods=False))
    plan = ran(cut(history) if cut else history)
    assert plan.count("BroadcastExchange") == (cut is ordering.sla_history_order)


def test_jobs_meet_the_deadlines_without_moving_them(tables):
    """Above the windows over a workflow's deadlines nothing is shuffled."""

    plan = ran(sla_history(*tables, data.AS_OF, SHUFFLE)).splitlines()
    windows = [i for i, line in enumerate(plan) if "Window " in line]
    assert windows and not [line for line in plan[: windows[-1]] if "Exchange" in line]


def test_a_broadcast_period_is_sent_once(tables):
    """A copy for each day it touches made the broadcast, and with it the driver, about four times as large."""

    config, _, runs = tables
    plan = ran(matched_history(config, runs, data.AS_OF, BROADCAST)).splitlines()
    sent = [i for i, line in enumerate(plan) if "BroadcastExchange" in line]
    below = [itertools.takewhile(lambda other: "Exchange" not in other and "Scan" not in other, plan[i + 1 :]) for i in sent]
    assert max(sum("Generate" in line for line in lines) for lines in below) == 1


@pytest.mark.parametrize("how", [BROADCAST, SHUFFLE])
def test_a_period_of_many_days_finds_its_first_success(spark, how):
    """Ends on the opening bound, between days, on the deadline and after it; another job's and a period without opening."""

    end = "timestamp'2024-01-{} {}'"
    periods = spark.sql(
        f"""SELECT * FROM VALUES
        ('1', 1, 'a', {end.format("02", "06:00:00")}, {end.format("09", "06:00:00")}),
        ('1', 1, 'a', {end.format("09", "06:00:00")}, {end.format("16", "06:00:00")}),
        ('1', 2, 'b', {end.format("02", "06:00:00")}, {end.format("16", "06:00:00")}),
        ('1', 3, 'a', NULL, {end.format("30", "06:00:00")})
        AS t(workspace_id, configured_order, job_id, previous_deadline_utc, deadline_utc)"""
    )
    times = [("02", "06:00:00"), ("05", "23:59:59"), ("05", "12:00:00"), ("16", "06:00:00"), ("16", "06:00:01")]
    rows = ", ".join(f"('1', 'a', 'succeeded', {end.format(*time)})" for time in times)
    runs = spark.sql(
        f"""SELECT workspace_id, job_id, IF(state = 'succeeded', '{S.SUCCEEDED}', 'other') AS result_state, period_end_time
        FROM VALUES {rows}, ('1', 'a', 'failed', {end.format("03", "00:00:00")}), ('1', 'c', 'succeeded', {end.format("04", "00:00:00")})
        AS t(workspace_id, job_id, state, period_end_time)"""
    )
    found = first_successes(periods, runs, how).select("configured_order", F.date_format("on_time_completion_utc", "dd HH:mm:ss"))
    assert sorted(map(tuple, found.collect())) == [(1, "05 12:00:00"), (1, "16 06:00:00")]


def assert_no_exploded_broadcast(df):
    plan = ran(df).splitlines()
    for i, line in enumerate(plan):
        if "BroadcastExchange" in line:
            # Down to the next shuffle, whose size is known.
            below = itertools.takewhile(lambda other: "Exchange" not in other and "Scan" not in other, plan[i + 1 :])
            assert not [other for other in below if "Generate" in other]


def test_salted_join_splits_a_hot_key(spark):
    from pyspark.sql import functions as F

    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"))
    right = left.select("key").distinct().withColumn("name", F.col("key").cast("string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, ["key"], F.col("id"))
        assert joined.count() == 3000
        tasks = joined.filter("key = -1").select(F.spark_partition_id()).distinct().count()
        assert tasks > 1
        kept = salted_join(left, right.filter("key <> -1"), ["key"], F.col("id"), "left_anti")
        assert kept.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("build", [workflow_status, sla_history, run_history])
def test_both_strategies_agree(tables, build):
    config, jobs, runs = tables
    wide, narrow = (build(config, jobs, runs, data.AS_OF, plan) for plan in (BROADCAST, SHUFFLE))
    assert wide.exceptAll(narrow).count() == 0
    assert narrow.exceptAll(wide).count() == 0
