"""Run history and deadline history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions import sla
from punctual.functions.instants import AsOf, local_date, midnight, whole_seconds_between
from punctual.functions.schedules import HISTORY
from punctual.operators.joins import JoinPlan, shuffled
from punctual.operators.periods import (
    deadline_periods,
    eligible,
    is_recently_due,
    match_runs,
    with_recovery,
)
from punctual.operators.runs import in_window, monitored_runs, run_columns, run_metrics, terminal
from punctual.operators.workflows import configured_workflows, monitored_workflows, workflow_name

RUN_HISTORY_COLUMNS = [
    "workflow_name",
    "job_id",
    "run_id",
    "run_date",
    "run_start_time",
    "run_end_time",
    "duration_seconds",
    "result_state",
    "run_outcome",
]
SLA_HISTORY_COLUMNS = [
    "workflow_name",
    "deadline_date",
    "deadline_utc",
    "timezone",
    "deadline_day_offset",
    "sla_status",
    "delivery_state",
    "observed_completion_utc",
    "completion_margin_minutes",
    "display_margin_minutes",
    "due_deadline_recency",
    "sla_target_rate",
    "run_success_rate_30d",
    "sla_compliance_rate_30d",
    "average_duration_seconds_30d",
    "total_runs_30d",
    "unsuccessful_runs_30d",
    "evaluated_deadlines_30d",
    "missed_deadlines_30d",
    "attention_level",
]


def run_history(
    config: DataFrame,
    jobs: DataFrame,
    runs: DataFrame,
    as_of: AsOf,
    plan: JoinPlan | None = None,
    ordered: bool = False,
) -> DataFrame:
    """One row per finished run; ``ordered`` sorts newest end first, open ends last."""

    plan = plan or JoinPlan.measure(config)
    workflows = run_columns(monitored_workflows(config, jobs, as_of))
    finished = monitored_runs(workflows, runs, as_of, S.RUN_WINDOW_DAYS, terminal_only=True, plan=plan)
    history = finished.select(
        "workflow_name",
        "job_id",
        "run_id",
        F.to_date("run_end_time").alias("run_date"),
        "run_start_time",
        "run_end_time",
        whole_seconds_between(F.col("run_start_time"), F.col("run_end_time")).alias("duration_seconds"),
        "result_state",
        sla.run_outcome(F.col("result_state")).alias("run_outcome"),
    )
    return history.orderBy(F.desc_nulls_last("run_end_time")) if ordered else history


def matched_history(
    config: DataFrame, runs: DataFrame, as_of: AsOf, plan: JoinPlan | None = None
) -> DataFrame:
    """Periods of the display window with status and late recovery, before any name or metric.

    The collection state is joined later: the periods feed both sides of the match, and names are
    only needed once.
    """

    plan = plan or JoinPlan.measure(config)
    # Earlier periods reach neither the display nor the metrics, and a period's recovery lies in the
    # one after it, so the display bound can cut the periods before any run is read.
    periods = eligible(
        deadline_periods(configured_workflows(config, as_of), HISTORY)
    ).filter(F.col("deadline_utc") >= midnight(as_of, S.DISPLAY_WINDOW_DAYS))
    recent = in_window(runs, as_of, S.SLA_RUN_WINDOW_DAYS)
    return with_recovery(match_runs(periods, recent, plan))


def sla_history(
    config: DataFrame,
    jobs: DataFrame,
    runs: DataFrame,
    as_of: AsOf,
    plan: JoinPlan | None = None,
    ordered: bool = False,
) -> DataFrame:
    """One row per workflow and deadline; ``ordered`` sorts by deadline for display."""

    plan = plan or JoinPlan.measure(config)
    matched = matched_history(config, runs, as_of, plan)
    metrics = run_metrics(terminal(in_window(runs, as_of, S.SLA_RUN_WINDOW_DAYS)), as_of)
    names = jobs.select(*S.JOB_KEY, "job_name")
    # What is known of a job becomes one row per workflow, which meets the deadlines where they lie.
    # Neither it nor its parts go through the driver, unless the periods may as well.
    if not plan.broadcast_periods:
        metrics, names = shuffled(metrics), shuffled(names)
    known = configured_workflows(config, as_of).select(*S.WORKFLOW_KEY, "job_id")
    known = known.join(metrics, S.JOB_KEY, "left").join(names, S.JOB_KEY, "left").drop("job_id")
    if not plan.broadcast_periods:
        known = shuffled(known)

    # All of a workflow's deadlines (at most 93) share one partition, sorted, since the recovery
    # lookup, so ranks, metrics and the job's facts need neither another shuffle nor another sort.
    workflow = Window.partitionBy(*S.WORKFLOW_KEY)
    position = F.row_number().over(workflow.orderBy("deadline_utc"))
    is_due = F.col("deadline_utc") <= F.col("as_of")
    # Due deadlines come first in time order, so the newest of them has the highest position.
    recency = (F.count_if(is_due).over(workflow) - position + 1).cast("int")
    recent, status = is_recently_due(), F.col("sla_status")
    counted = matched.select(
        "*",
        F.when(is_due, recency).alias("_recency"),
        F.count_if(recent & status.isin("Met", "Missed")).over(workflow).alias("_evaluated"),
        F.count_if(recent & (status == "Met")).over(workflow).alias("_met"),
        F.count_if(recent & (status == "Missed")).over(workflow).alias("_missed"),
    )
    deadline_date = local_date(F.col("deadline_utc"), F.col("timezone"))
    today = local_date(F.col("as_of"), F.col("timezone"))
    history = counted.join(known, S.WORKFLOW_KEY, "left").select(
        workflow_name().alias("workflow_name"),
        deadline_date.alias("deadline_date"),
        "deadline_utc",
        "timezone",
        F.datediff(deadline_date, today).alias("deadline_day_offset"),
        "sla_status",
        "delivery_state",
        "observed_completion_utc",
        "completion_margin_minutes",
        "display_margin_minutes",
        F.col("_recency").alias("due_deadline_recency"),
        sla.sla_target_rate().alias("sla_target_rate"),
        sla.try_ratio(F.col("successful_runs_30d"), F.col("total_runs_30d")).alias("run_success_rate_30d"),
        sla.try_ratio(F.col("_met"), F.col("_evaluated")).alias("sla_compliance_rate_30d"),
        "average_duration_seconds_30d",
        F.coalesce("total_runs_30d", F.lit(0)).alias("total_runs_30d"),
        F.coalesce("unsuccessful_runs_30d", F.lit(0)).alias("unsuccessful_runs_30d"),
        F.col("_evaluated").alias("evaluated_deadlines_30d"),
        F.col("_missed").alias("missed_deadlines_30d"),
        sla.attention_level(F.col("_missed"), F.col("unsuccessful_runs_30d")).alias("attention_level"),
    )
    return history.orderBy("deadline_utc") if ordered else history
