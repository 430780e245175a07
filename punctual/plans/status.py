"""Current status of every workflow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions import sla
from punctual.functions.instants import AsOf
from punctual.functions.schedules import CURRENT
from punctual.operators.joins import JoinPlan, attach
from punctual.operators.periods import due_periods
from punctual.operators.runs import is_today, newest_by_state, recent_runs
from punctual.operators.workflows import monitored_workflows

STATUS_COLUMNS = [
    "configured_order",
    "workflow_name",
    "job_id",
    "frequency",
    "timezone",
    "configuration_problem",
    "latest_run_result",
    "latest_run_end_time",
    "next_deadline_utc",
    "sla_status",
    "health_status",
    "monitored_workflow_count",
    "successful_runs_today",
    "unsuccessful_runs_today",
    "sla_pending_flag",
    "sla_missed_flag",
    "configuration_problem_flag",
    "needs_attention_flag",
]


def _succeeded_within(opens: str, deadline: str) -> Column:
    ended = F.col("run_end_time")
    return F.count_if(
        (F.col("result_state") == S.SUCCEEDED) & (ended > F.col(opens)) & (ended <= F.col(deadline))
    )


def _run_facts(workflows: DataFrame, runs: DataFrame, as_of: AsOf, plan: JoinPlan) -> DataFrame:
    """Everything the status needs from runs, from one scan and one hash aggregation over them.

    The latest due and the next period are fixed by the configuration alone, so each run meets its
    workflow's two periods as plain columns of the joined row.
    """

    lookup = workflows.select(
        *S.WORKFLOW_KEY,
        "job_id",
        "timezone",
        "local_today",
        "last_opens_utc",
        "last_deadline_utc",
        "next_opens_utc",
        "next_deadline_utc",
    )
    recent = recent_runs(runs, as_of, S.RUN_WINDOW_DAYS, terminal_only=False)
    state, today = F.col("result_state"), is_today(as_of)
    counts = [
        F.count_if((state == S.SUCCEEDED) & today).alias("succeeded_today"),
        F.count_if(sla.is_unsuccessful(state) & today).alias("unsuccessful_today"),
        _succeeded_within("last_opens_utc", "last_deadline_utc").alias("last_successes"),
        _succeeded_within("next_opens_utc", "next_deadline_utc").alias("next_successes"),
    ]
    return newest_by_state(attach(recent, lookup, plan), ["run_end_time"], counts)


def workflow_status(
    config: DataFrame,
    jobs: DataFrame,
    runs: DataFrame,
    as_of: AsOf,
    plan: JoinPlan | None = None,
    ordered: bool = False,
) -> DataFrame:
    """One row per configured workflow; ``ordered`` sorts by configuration order for display."""

    plan = plan or JoinPlan.measure(config)
    workflows = due_periods(monitored_workflows(config, jobs, as_of), CURRENT)
    facts = _run_facts(workflows, runs, as_of, plan)

    def period_status(successes: str, deadline: str) -> Column:
        met = F.coalesce(F.col(successes), F.lit(0)) > 0
        status = sla.deadline_status(met, F.col(deadline), F.col("as_of"))
        return F.when(F.col(deadline).isNotNull(), status)

    known = workflows.join(facts, S.WORKFLOW_KEY, "left").select(
        "*",
        period_status("last_successes", "last_deadline_utc").alias("last_status"),
        period_status("next_successes", "next_deadline_utc").alias("next_status"),
    )
    problem, last, following = F.col("configuration_problem"), F.col("last_status"), F.col("next_status")
    status = known.select(
        "workspace_id",
        "configured_order",
        "workflow_name",
        "job_id",
        "frequency",
        "timezone",
        "configuration_problem",
        F.col("latest.result_state").alias("latest_run_result"),
        F.col("latest.run_end_time").alias("latest_run_end_time"),
        "next_deadline_utc",
        sla.sla_status(last, following).alias("sla_status"),
        sla.health_status(problem, last, following).alias("health_status"),
        F.lit(1).alias("monitored_workflow_count"),
        F.coalesce("succeeded_today", F.lit(0)).alias("successful_runs_today"),
        F.coalesce("unsuccessful_today", F.lit(0)).alias("unsuccessful_runs_today"),
        sla.pending_flag(last, following).alias("sla_pending_flag"),
        sla.flag(last == "Missed").alias("sla_missed_flag"),
        sla.flag(problem.isNotNull()).alias("configuration_problem_flag"),
        sla.flag(problem.isNotNull() | (last == "Missed")).alias("needs_attention_flag"),
    )
    if ordered:
        status = status.orderBy(*S.WORKFLOW_KEY)
    return status.select(*STATUS_COLUMNS)


def current_workflow_health(status: DataFrame) -> DataFrame:
    """Workflow count per health status with the flag totals."""

    return status.groupBy("health_status").agg(
        F.sum("monitored_workflow_count").alias("workflows"),
        F.sum("sla_pending_flag").alias("pending"),
        F.sum("sla_missed_flag").alias("missed"),
        F.sum("configuration_problem_flag").alias("configuration_problems"),
        F.sum("needs_attention_flag").alias("need_attention"),
    )
