"""Chart-ready frames cut from the history views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions.sla import sla_target_rate, try_ratio


def sla_delivery_calendar(history: DataFrame) -> DataFrame:
    """Deadlines within the calendar's day offsets."""

    offset = F.col("deadline_day_offset")
    return history.filter(offset.between(S.CALENDAR_FIRST_OFFSET, S.CALENDAR_LAST_OFFSET)).select(
        "workflow_name",
        "deadline_date",
        "deadline_utc",
        "sla_status",
        "observed_completion_utc",
        "completion_margin_minutes",
    )


def delivery_margin_timeline(history: DataFrame) -> DataFrame:
    """Latest due deadline of every workflow."""

    return history.filter(F.col("due_deadline_recency") == 1).select(
        "workflow_name",
        "display_margin_minutes",
        "delivery_state",
        "deadline_utc",
        "observed_completion_utc",
        "completion_margin_minutes",
    )


def workflow_risk_map(history: DataFrame) -> DataFrame:
    """Workflows whose run and deadline rates are both known."""

    def is_valid(rate: Column) -> Column:
        return rate.isNotNull() & ~F.isnan(rate)

    return history.filter(
        (F.col("due_deadline_recency") == 1)
        & is_valid(F.col("run_success_rate_30d"))
        & is_valid(F.col("sla_compliance_rate_30d"))
    ).select(
        "workflow_name",
        "run_success_rate_30d",
        "sla_compliance_rate_30d",
        "average_duration_seconds_30d",
        "attention_level",
        "total_runs_30d",
        "unsuccessful_runs_30d",
        "evaluated_deadlines_30d",
        "missed_deadlines_30d",
    )


def run_duration_lanes(history: DataFrame, newest: int = S.CHART_RUNS) -> DataFrame:
    """Newest runs by start; equal starts are settled by run id, then job."""

    return (
        history.orderBy(F.desc("run_start_time"), F.desc("run_id"), F.desc("job_id"))
        .limit(newest)
        .select(
            "run_start_time",
            "run_end_time",
            "workflow_name",
            "run_outcome",
            "run_id",
            "duration_seconds",
            "result_state",
        )
    )


def daily_run_outcomes(history: DataFrame) -> DataFrame:
    """Runs per day and outcome."""

    return history.groupBy("run_date", "run_outcome").agg(F.count("*").alias("runs"))


def sla_compliance_trend(history: DataFrame) -> DataFrame:
    """Share of met deadlines per day among those already decided."""

    status = F.col("sla_status")
    counts = history.groupBy("deadline_date").agg(
        F.count_if(status == "Met").alias("met"), F.count_if(status == "Missed").alias("missed")
    )
    return counts.select(
        "deadline_date",
        "met",
        "missed",
        try_ratio(F.col("met"), F.col("met") + F.col("missed")).alias("sla_compliance_rate"),
        sla_target_rate().alias("sla_target_rate"),
    )
