"""Semantics of the views on small hand-made workflows."""

from datetime import date

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions.schedules import CURRENT, HISTORY
from punctual.operators import periods
from punctual.operators.joins import BROADCAST, SHUFFLE, attach
from punctual.operators.runs import latest_runs, recent_runs
from punctual.operators.workflows import configured_workflows, monitored_workflows
from punctual.plans import charts
from punctual.plans.history import run_history, sla_history
from punctual.plans.status import current_workflow_health, workflow_status

NOW = at("2026-03-10 12:00")
DAILY = ("daily", "06:00", "UTC", {})


@pytest.fixture(scope="module")
def no_jobs(make):
    return make.jobs(("9", "9", "other", "2026-03-10 11:59", "2026-03-10 11:59", None))


def healthy(make, *names):
    return make.jobs(*[(1, i, name, "2026-03-10 11:59", "2026-03-10 11:59", None) for i, name in enumerate(names, 1)])


def one(df, **where):
    for column, value in where.items():
        df = df.filter(F.col(column) == value)
    return df.collect()[0]


@pytest.mark.parametrize("plan", [BROADCAST, SHUFFLE])
def test_period_bounds_are_exclusive_then_inclusive(make, no_jobs, plan):
    config = make.config((1, 1, 1, *DAILY))
    runs = make.runs(
        (1, 1, 1, "2026-03-08 05:00", "2026-03-08 06:00:00", "SUCCEEDED"),
        (1, 1, 2, "2026-03-09 05:00", "2026-03-09 06:00:01", "SUCCEEDED"),
    )
    history = sla_history(config, no_jobs, runs, NOW, plan)
    shown = {
        str(row["deadline_utc"])[5:10]: (row["sla_status"], row["delivery_state"], row["completion_margin_minutes"])
        for row in history.filter(F.col("deadline_utc").between(at("2026-03-08 00:00"), at("2026-03-11 23:00"))).collect()
    }
    assert shown["03-08"][:2] == ("Met", "Met") and float(shown["03-08"][2]) == 0.0
    # One second late: missed, recovered in the next period and on time for that one.
    assert shown["03-09"][:2] == ("Missed", "Late recovery") and float(shown["03-09"][2]) == 0.0
    assert shown["03-10"][:2] == ("Met", "Met") and float(shown["03-10"][2]) == 1440.0
    assert shown["03-11"][:2] == ("Pending", "Pending") and shown["03-11"][2] is None


def test_early_success_meets_the_upcoming_deadline(make, no_jobs):
    config = make.config((1, 1, 1, *DAILY))
    runs = make.runs(
        (1, 1, 1, "2026-03-10 05:00", "2026-03-10 05:30", "SUCCEEDED"),
        (1, 1, 2, "2026-03-10 08:00", "2026-03-10 09:00", "SUCCEEDED"),
    )
    status = one(workflow_status(config, no_jobs, runs, NOW))
    assert (status["sla_status"], status["sla_pending_flag"], status["sla_missed_flag"]) == ("Met", 0, 0)
    assert status["next_deadline_utc"].strftime("%m-%d %H:%M") == "03-11 06:00"


def test_a_missed_deadline_outranks_a_met_one(make, no_jobs):
    config = make.config((1, 1, 1, *DAILY))
    runs = make.runs((1, 1, 2, "2026-03-10 08:00", "2026-03-10 09:00", "SUCCEEDED"))
    status = one(workflow_status(config, no_jobs, runs, NOW))
    assert (status["sla_status"], status["needs_attention_flag"]) == ("Missed", 1)
    assert status["health_status"] == "Configuration problem"


def test_pending_flag_before_the_first_deadline(make):
    first = {"first_deadline_date": date(2026, 3, 23)}
    config = make.config((1, 1, 1, "fortnightly", "06:00", "UTC", first))
    status = one(workflow_status(config, healthy(make, "w"), make.runs((1, 1, 1, "2026-03-01 00:00", None, "RUNNING")), NOW))
    assert (status["sla_status"], status["health_status"], status["sla_pending_flag"]) == ("Pending", "Pending", 0)
    assert (status["latest_run_result"], status["latest_run_end_time"]) == ("RUNNING", None)


def test_newest_run_by_start_then_run_id(make, no_jobs):
    """A later start wins over any run id, the larger id at equal starts, whatever the states are."""

    largest, smallest = 2**63 - 1, -(2**63)
    same = "2026-03-10 09:00:00"
    cases = {
        1: [(largest, "2026-03-10 08:59:59", "RUNNING"), (smallest, same, "FAILED")],
        2: [(smallest, same, "SUCCEEDED"), (largest, same, "CANCELLED"), (-1, same, "WAITING_FOR_A_PLACE")],
        3: [(7, same, "UNKNOWN"), (6, same, "SUCCEEDED"), (-7, same, "QUEUED")],
        4: [(5, "2026-03-10 09:00:00.000001", "FAILED"), (6, same, "SUCCEEDED"), (4, "2026-03-10 09:00:00.000001", "FAILED")],
    }
    config = make.config(*[(1, job, job, *DAILY) for job in (*cases, 5)])
    runs = make.runs(*[(1, job, run, start, None, state) for job, found in cases.items() for run, start, state in found])
    shown = rows(workflow_status(config, no_jobs, runs, NOW), "configured_order", "latest_run_result")
    assert shown == [(1, "FAILED"), (2, "CANCELLED"), (3, "UNKNOWN"), (4, "FAILED"), (5, None)]
    known = configured_workflows(config, NOW).select(*S.WORKFLOW_KEY, "job_id")
    for plan in (BROADCAST, SHUFFLE):
        newest = latest_runs(attach(recent_runs(runs, NOW, 60, False), known, plan))
        assert rows(newest, "configured_order", "run_id") == [(1, smallest), (2, largest), (3, 7), (4, 5)]


def test_collection_problems(make):
    config = make.config(*[(1, i, i, *DAILY) for i in range(1, 7)])
    jobs = make.jobs(
        (1, 2, "b", "2026-03-10 11:59", "2026-03-10 11:59", "boom"),
        (1, 3, "c", "2026-03-10 11:59", "2026-03-10 11:39:59", None),
        (1, 4, "d", "2026-03-10 11:59", "2026-03-10 11:40:00", None),
        (1, 5, None, "2026-03-10 11:59", None, None),
        (2, 6, "elsewhere", "2026-03-10 11:59", "2026-03-10 11:59", None),
    )
    shown = rows(monitored_workflows(config, jobs, NOW), "configured_order", "workflow_name", "configuration_problem")
    assert shown == [
        (1, "Job 1", "Jobs API collection pending"),
        (2, "b", "Jobs API collection failed"),
        (3, "c", "Jobs API data stale"),
        (4, "d", None),
        (5, "Job 5", None),
        (6, "Job 6", "Jobs API collection pending"),
    ]


@pytest.mark.parametrize("plan", [BROADCAST, SHUFFLE])
def test_today_is_the_workflows_own_day(make, plan):
    config = make.config((1, 1, 1, "daily", "06:00", "Australia/Melbourne", {}), (1, 2, 2, *DAILY))
    # 12:00 UTC is 23:00 in Melbourne; its day began at 13:00 UTC the day before.
    runs = make.runs(
        *[
            (1, job, 10 * job + i, "2026-03-09 00:00", end, state)
            for job in (1, 2)
            for i, (end, state) in enumerate(
                [
                    ("2026-03-09 12:59:59", "SUCCEEDED"),
                    ("2026-03-09 13:00:00", "SUCCEEDED"),
                    ("2026-03-10 00:00:00", "FAILED"),
                    ("2026-03-10 10:00:00", "RUNNING"),
                ]
            )
        ]
    )
    shown = rows(
        workflow_status(config, healthy(make, "m", "u"), runs, NOW, plan),
        "workflow_name",
        "successful_runs_today",
        "unsuccessful_runs_today",
    )
    assert shown == [("m", 1, 1), ("u", 0, 1)]


def test_orders_of_two_workspaces_do_not_mix(make):
    config = make.config((1, 1, 1, *DAILY), (2, 1, 1, *DAILY))
    jobs = make.jobs(
        (1, 1, "one", "2026-03-10 11:59", "2026-03-10 11:59", None),
        (2, 1, "two", "2026-03-10 11:59", "2026-03-10 11:59", None),
    )
    runs = make.runs((1, 1, 1, "2026-03-10 05:00", "2026-03-10 05:30", "SUCCEEDED"))
    status = workflow_status(config, jobs, runs, NOW, ordered=True)
    assert [(r["workflow_name"], r["sla_status"]) for r in status.collect()] == [("one", "Pending"), ("two", "Missed")]
    history = sla_history(config, jobs, runs, NOW)
    assert one(history, workflow_name="two", due_deadline_recency=1)["sla_status"] == "Missed"
    assert one(history, workflow_name="one", due_deadline_recency=1)["sla_status"] == "Met"


def test_run_history_window_and_open_end(make):
    config = make.config((1, 1, 1, *DAILY))
    runs = make.runs(
        (1, 1, 1, "2026-01-09 00:00:00", "2026-01-09 00:00:30.900", "SUCCEEDED"),
        (1, 1, 2, "2026-01-08 23:59:59", "2026-01-09 01:00", "SUCCEEDED"),
        (1, 1, 3, "2026-03-01 00:00", None, "FAILED"),
        (1, 1, 4, "2026-03-01 00:00", None, "RUNNING"),
        (1, 2, 5, "2026-03-01 00:00", "2026-03-01 01:00", "SUCCEEDED"),
    )
    shown = run_history(config, healthy(make, "w"), runs, NOW, ordered=True).collect()
    assert [(r["run_id"], r["duration_seconds"], r["run_outcome"]) for r in shown] == [
        (1, 30, "Success"),
        (3, None, "Not successful"),
    ]
    assert rows(charts.run_duration_lanes(run_history(config, healthy(make, "w"), runs, NOW), newest=1), "run_id") == [(3,)]


def test_metrics_and_attention(make):
    config = make.config(*[(1, i, i, "monthly", "06:00", "UTC", {"day_of_month": 5}) for i in (1, 2, 3)])
    runs = make.runs(
        (1, 1, 1, "2026-03-04 05:00", "2026-03-04 05:01", "SUCCEEDED"),
        (1, 1, 2, "2026-03-04 05:00", "2026-03-04 05:03", "FAILED"),
        (1, 2, 3, "2026-03-09 05:00", "2026-03-09 05:03", "CANCELLED"),
        (1, 2, 4, "2026-01-09 05:00", "2026-01-09 05:03", "SUCCEEDED"),
    )
    history = sla_history(config, healthy(make, "a", "b", "c"), runs, NOW)
    columns = (
        "workflow_name",
        "run_success_rate_30d",
        "sla_compliance_rate_30d",
        "average_duration_seconds_30d",
        "total_runs_30d",
        "unsuccessful_runs_30d",
        "evaluated_deadlines_30d",
        "missed_deadlines_30d",
        "attention_level",
    )
    assert rows(history.filter("due_deadline_recency = 1"), *columns) == [
        ("a", 0.5, 1.0, 120.0, 2, 1, 1, 0, "Needs attention"),
        ("b", 0.0, 0.0, 180.0, 1, 1, 1, 1, "Critical"),
        ("c", None, 0.0, None, 0, 0, 1, 1, "Needs attention"),
    ]
    assert rows(charts.workflow_risk_map(history), "workflow_name") == [("a",), ("b",)]
    assert charts.delivery_margin_timeline(history).count() == 3
    health = current_workflow_health(workflow_status(config, healthy(make, "a", "b", "c"), runs, NOW))
    assert rows(health, "health_status", "workflows") == [("Missed", 2), ("Pending", 1)]


@pytest.mark.parametrize(
    ("frequency", "own", "today", "expected"),
    [
        ("monthly", {"day_of_month": 31}, "2026-03-10 12:00", ["01-31", "02-28", "03-31", "04-30"]),
        ("weekly", {"day_of_week": "tuesday"}, "2026-03-10 12:00", ["02-24", "03-03", "03-10", "03-17"]),
        ("weekly", {"day_of_week": "wednesday"}, "2026-03-10 12:00", ["02-18", "02-25", "03-04", "03-11"]),
        ("daily", {}, "2026-03-10 12:00", ["03-08", "03-09", "03-10", "03-11"]),
        ("fortnightly", {"first_deadline_date": date(2026, 3, 1)}, "2026-03-10 12:00", ["02-01", "02-15", "03-01", "03-15"]),
        ("fortnightly", {"first_deadline_date": date(2026, 4, 1)}, "2026-03-10 12:00", ["03-04", "03-18", "04-01", "04-15"]),
    ],
)
def test_current_dates(make, no_jobs, frequency, own, today, expected):
    workflows = monitored_workflows(make.config((1, 1, 1, frequency, "06:00", "UTC", own)), no_jobs, at(today))
    shown = periods.expand_deadlines(workflows, CURRENT).select(F.date_format("deadline_date", "MM-dd"))
    assert sorted(row[0] for row in shown.collect()) == sorted(expected)


def test_every_displayed_period_has_both_neighbours(make, no_jobs):
    schedules = [
        ("daily", {}),
        ("weekly", {"day_of_week": "sunday"}),
        ("fortnightly", {"first_deadline_date": date(2025, 1, 3)}),
        ("monthly", {"day_of_month": 30}),
    ]
    config = make.config(*[(1, i, i, name, "23:59", "America/New_York", own) for i, (name, own) in enumerate(schedules, 1)])
    for day in ("2026-03-01 00:30", "2026-03-10 12:00", "2026-12-31 23:30"):
        workflows = monitored_workflows(config, no_jobs, at(day))
        found = periods.eligible(periods.deadline_periods(workflows, HISTORY))
        wrong = found.filter("previous_deadline_utc >= deadline_utc or next_deadline_utc <= deadline_utc")
        assert wrong.count() == 0
        open_ended = found.filter("next_deadline_utc is null").groupBy("configured_order").count()
        assert rows(open_ended) == [(i, 1) for i in range(1, 5)]


def test_scenarios(make):
    """On time, recovery after a failure, late delivery, long duration."""

    config = make.config(*[(1, i, i, *DAILY) for i in (1, 2, 3, 4)])
    runs = make.runs(
        (1, 1, 1, "2026-03-10 05:00", "2026-03-10 05:10", "SUCCEEDED"),
        (1, 2, 2, "2026-03-10 05:00", "2026-03-10 05:10", "FAILED"),
        (1, 2, 3, "2026-03-10 05:20", "2026-03-10 05:30", "SUCCEEDED"),
        (1, 3, 4, "2026-03-10 05:50", "2026-03-10 06:45", "SUCCEEDED"),
        (1, 4, 5, "2026-03-09 23:00", "2026-03-10 05:59", "SUCCEEDED"),
    )
    history = sla_history(config, healthy(make, "on time", "recovery", "late", "long"), runs, NOW)
    latest = charts.delivery_margin_timeline(history)
    assert rows(latest, "workflow_name", "delivery_state", F.col("completion_margin_minutes").cast("double")) == [
        ("late", "Late recovery", -45.0),
        ("long", "Met", 1.0),
        ("on time", "Met", 50.0),
        ("recovery", "Met", 30.0),
    ]
