"""Deadline periods and the runs that satisfy them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions import sla
from punctual.functions.instants import local_date
from punctual.functions.schedules import (
    ScheduleWindow,
    deadline_dates,
    is_eligible,
    last_and_next_period,
    period_array,
)
from punctual.operators.joins import SHUFFLE, JoinPlan, shuffled

PERIOD_FIELDS = ["deadline_date", "previous_deadline_utc", "deadline_utc", "next_deadline_utc"]


def with_local_today(workflows: DataFrame) -> DataFrame:
    return workflows.withColumn("local_today", local_date(F.col("as_of"), F.col("timezone")))


def expand_deadlines(workflows: DataFrame, window: ScheduleWindow) -> DataFrame:
    """One row per workflow and local deadline date."""

    dated = with_local_today(workflows).withColumn("deadline_date", F.explode(deadline_dates(window)))
    return dated.filter(F.col("deadline_date").isNotNull())


def deadline_periods(workflows: DataFrame, window: ScheduleWindow) -> DataFrame:
    """One row per generated deadline with its neighbours, including rows that only bound a period.

    The neighbours come from the workflow's own array, so no shuffle and no sort is needed.
    """

    kept = workflows.columns
    expanded = with_local_today(workflows).select(*kept, F.inline(period_array(window)))
    return expanded.select(*kept, *PERIOD_FIELDS)


def eligible(periods: DataFrame) -> DataFrame:
    return periods.filter(is_eligible())


def due_periods(workflows: DataFrame, window: ScheduleWindow) -> DataFrame:
    """One row per workflow with its latest due and its next period, null where there is none."""

    chosen = with_local_today(workflows).withColumn(
        "_chosen", last_and_next_period(window, F.col("as_of"))
    )
    return chosen.select(
        *workflows.columns,
        "local_today",
        F.col("_chosen.last.previous_deadline_utc").alias("last_opens_utc"),
        F.col("_chosen.last.deadline_utc").alias("last_deadline_utc"),
        F.col("_chosen.next.previous_deadline_utc").alias("next_opens_utc"),
        F.col("_chosen.next.deadline_utc").alias("next_deadline_utc"),
    )


def _second_slot() -> F.Column:
    """The one-second slot (s, s + 1 s] a run ends in. Deadlines are whole seconds, so no slot
    crosses a deadline and the first end of a slot stands for the slot."""

    micros = F.unix_micros("period_end_time")
    return micros - F.pmod(micros - 1, F.lit(1_000_000))


def first_successes(periods: DataFrame, runs: DataFrame, plan: JoinPlan = SHUFFLE) -> DataFrame:
    """First success inside (previous deadline, deadline] of each period that has one.

    Runs are never the build side. Periods few enough to broadcast are sent once each, since copies
    would take that much of the driver, and a run compares its job's periods, at most about 90.
    Otherwise periods are repeated for every UTC day they touch, so a run probes the one or two of its
    day by hash and the exact bounds only decide between those; runs shrink to one row per job and
    second before they are shuffled, and the day in the key spreads a hot job over the days of the window.
    """

    ends = runs.filter(
        (F.col("result_state") == S.SUCCEEDED) & F.col("period_end_time").isNotNull()
    ).select(*S.JOB_KEY, "period_end_time")
    bounds = periods.select(*S.WORKFLOW_KEY, "job_id", "previous_deadline_utc", "deadline_utc")
    if plan.broadcast_periods:
        candidates = ends.join(F.broadcast(bounds), S.JOB_KEY)
    else:
        ends = (
            ends.groupBy(*S.JOB_KEY, _second_slot().alias("_slot"))
            .agg(F.min("period_end_time").alias("period_end_time"))
            .drop("_slot")
        )
        ends = ends.withColumn("_day", F.to_date("period_end_time"))
        touched = F.sequence(F.to_date("previous_deadline_utc"), F.to_date("deadline_utc"))
        by_day = bounds.withColumn("_day", F.explode(touched))
        candidates = ends.join(shuffled(by_day), [*S.JOB_KEY, "_day"])
    inside = (F.col("period_end_time") > F.col("previous_deadline_utc")) & (
        F.col("period_end_time") <= F.col("deadline_utc")
    )
    return (
        candidates.filter(inside)
        .groupBy(*S.WORKFLOW_KEY, "deadline_utc")
        .agg(F.min("period_end_time").alias("on_time_completion_utc"))
    )


def match_runs(periods: DataFrame, runs: DataFrame, plan: JoinPlan = SHUFFLE) -> DataFrame:
    """Every period with its first on-time completion and its status."""

    first = first_successes(periods, runs, plan)
    status = sla.deadline_status(
        F.col("on_time_completion_utc").isNotNull(), F.col("deadline_utc"), F.col("as_of")
    )
    if not plan.broadcast_periods:
        first = shuffled(first)
    return periods.join(first, [*S.WORKFLOW_KEY, "deadline_utc"], "left").select(
        *[periods[column] for column in periods.columns],
        "on_time_completion_utc",
        status.alias("sla_status"),
    )


def with_recovery(matched: DataFrame) -> DataFrame:
    """Add late recovery, observed completion, delivery state and margins.

    A late recovery is a success in (deadline, next deadline]: exactly the first on-time success of
    the following period, so it is read from the next row instead of a second range join.
    """

    following = Window.partitionBy(*S.WORKFLOW_KEY).orderBy("deadline_utc")
    recovered = matched.withColumn(
        "late_recovery_utc", F.lead("on_time_completion_utc").over(following)
    )
    observed = F.coalesce("on_time_completion_utc", "late_recovery_utc")
    state = sla.delivery_state(F.col("sla_status"), F.col("late_recovery_utc"))
    margin = sla.completion_margin(F.col("deadline_utc"), observed)
    return recovered.select(
        "*",
        observed.alias("observed_completion_utc"),
        state.alias("delivery_state"),
        margin.alias("completion_margin_minutes"),
        sla.display_margin(margin).alias("display_margin_minutes"),
    )


def last_and_next_due(matched: DataFrame) -> DataFrame:
    """Latest due and next upcoming deadline per workflow with their statuses."""

    deadline, status = F.col("deadline_utc"), F.col("sla_status")
    due = F.when(deadline <= F.col("as_of"), deadline)
    upcoming = F.when(deadline > F.col("as_of"), deadline)
    return matched.groupBy(*S.WORKFLOW_KEY).agg(
        F.max(due).alias("last_deadline_utc"),
        F.max_by(status, due).alias("last_status"),
        F.min(upcoming).alias("next_deadline_utc"),
        F.min_by(status, upcoming).alias("next_status"),
    )


def is_recently_due(days: int = S.METRIC_WINDOW_DAYS) -> F.Column:
    opens = F.date_sub(F.to_date("as_of"), days).cast("timestamp")
    return F.col("deadline_utc").between(opens, F.col("as_of"))


def sla_metrics(matched: DataFrame, days: int = S.METRIC_WINDOW_DAYS) -> DataFrame:
    """Evaluated, met and missed deadlines per workflow over the recent days."""

    status = F.col("sla_status")
    return (
        matched.filter(is_recently_due(days))
        .groupBy(*S.WORKFLOW_KEY)
        .agg(
            F.count_if(status.isin("Met", "Missed")).alias("evaluated_deadlines_30d"),
            F.count_if(status == "Met").alias("met_deadlines_30d"),
            F.count_if(status == "Missed").alias("missed_deadlines_30d"),
        )
    )
