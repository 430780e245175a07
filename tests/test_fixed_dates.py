"""Due deadlines at chosen instants, as both windows find them, and the zone check."""

from dataclasses import dataclass
from datetime import date

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from punctual.functions.instants import deadline_instant
from punctual.functions.schedules import FIXED_DATE_HISTORY
from punctual.operators.joins import BROADCAST, SHUFFLE
from punctual.plans.checks import assert_checks, checks, due_in_both_windows


@dataclass(frozen=True)
class Case:
    """A workflow, the instant it is judged at, its successes, and the deadlines expected (UTC)."""

    schedule: tuple
    judged: str
    successes: tuple = ()
    last: str | None = None
    status: str | None = None
    following: str | None = None


CASES = {
    # 02:30 doesn't exist on 30 March in Paris, so the deadline is 03:30 summer time.
    "gap hour, in time": Case(("daily", "02:30", "Europe/Paris", {}), "2025-03-30 12:00", ("2025-03-30 01:29",), "2025-03-30 01:30", "Met", "2025-03-31 00:30"),
    "gap hour, a minute late": Case(("daily", "02:30", "Europe/Paris", {}), "2025-03-30 12:00", ("2025-03-30 01:31",), "2025-03-30 01:30", "Missed", "2025-03-31 00:30"),
    "end of a short month": Case(("monthly", "09:15", "UTC", {"day_of_month": 31}), "2025-03-01 00:00", ("2025-01-31 09:15:01",), "2025-02-28 09:15", "Met", "2025-03-31 09:15"),
    "success of the period before": Case(("monthly", "09:15", "UTC", {"day_of_month": 31}), "2025-03-01 00:00", ("2025-01-31 09:15",), "2025-02-28 09:15", "Missed", "2025-03-31 09:15"),
    "day ahead of UTC": Case(("weekly", "18:00", "Asia/Tokyo", {"day_of_week": "saturday"}), "2025-05-03 09:00:01", ("2025-04-28 00:00",), "2025-05-03 09:00", "Met", "2025-05-10 09:00"),
    "a second before it is due": Case(("weekly", "18:00", "Asia/Tokyo", {"day_of_week": "saturday"}), "2025-05-03 08:59:59", ("2025-04-28 00:00",), "2025-04-26 09:00", "Missed", "2025-05-03 09:00"),
    "success at the deadline": Case(("fortnightly", "07:45", "UTC", {"first_deadline_date": date(2025, 7, 4)}), "2025-07-19 00:00", ("2025-07-18 07:45",), "2025-07-18 07:45", "Met", "2025-08-01 07:45"),
    "first deadline still ahead": Case(("fortnightly", "07:45", "UTC", {"first_deadline_date": date(2025, 12, 24)}), "2025-12-01 00:00", following="2025-12-24 07:45"),
    "first deadline passed": Case(("fortnightly", "07:45", "UTC", {"first_deadline_date": date(2025, 12, 24)}), "2025-12-24 08:00", last="2025-12-24 07:45", status="Missed", following="2026-01-07 07:45"),
}


@pytest.fixture(scope="module")
def inputs(spark, make):
    config = make.config(*[("5", i, name, *case.schedule) for i, (name, case) in enumerate(CASES.items())])
    instants = spark.createDataFrame([(name, at(case.judged)) for name, case in CASES.items()], "workflow_name string, as_of timestamp")
    workflows = (
        config.withColumn("workflow_name", F.col("configured_job_id"))
        .withColumn("job_id", F.col("configured_job_id"))
        .join(instants, "workflow_name")
    )
    ends = [(name, end) for name, case in CASES.items() for end in case.successes]
    return workflows, make.runs(*[("5", name, i, end, end, "SUCCEEDED") for i, (name, end) in enumerate(ends)])


@pytest.mark.parametrize("plan", [BROADCAST, SHUFFLE])
def test_deadlines_at_fixed_dates(inputs, plan):
    facts = due_in_both_windows(*inputs, plan=plan, history=FIXED_DATE_HISTORY).cache()
    expectations = {}
    for name, case in CASES.items():
        wanted = F.col("workflow_name") == name
        for window in ("current", "history"):
            for column, text in (("last_deadline_utc", case.last), ("next_deadline_utc", case.following)):
                wanted &= F.col(f"{window}_{column}").eqNullSafe(F.lit(at(text) if text else None).cast("timestamp"))
            wanted &= F.col(f"{window}_last_status").eqNullSafe(F.lit(case.status))
        missed = int(case.status == "Missed")
        wanted &= (F.col("sla_missed_flag") == missed) & (F.col("needs_attention_flag") == missed)
        expectations[name] = wanted
    result = checks(facts, expectations)
    assert rows(result) == sorted((name, True) for name in CASES)
    assert assert_checks(result).count() == len(CASES)


def test_failed_check_raises(spark):
    facts = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(Exception, match="nothing failed"):
        assert_checks(checks(facts, {"nothing": F.col("x") == 2})).collect()


def test_zone_conversion(spark):
    """A plain day, the hour that is skipped and the hour that occurs twice, east and west of UTC."""

    cases = [
        (date(2025, 6, 2), "00:15", "Asia/Kathmandu", "2025-06-01 18:30:00"),
        (date(2025, 9, 28), "02:45", "Pacific/Auckland", "2025-09-27 14:45:00"),
        (date(2025, 4, 6), "02:45", "Pacific/Auckland", "2025-04-05 13:45:00"),
        (date(2025, 10, 26), "01:20", "Europe/London", "2025-10-26 00:20:00"),
    ]
    frame = spark.createDataFrame([case[:3] for case in cases], "d date, t string, z string")
    shown = frame.select(deadline_instant(F.col("d"), F.col("t"), F.col("z")).cast("string"))
    assert [row[0] for row in shown.collect()] == [case[3] for case in cases]
