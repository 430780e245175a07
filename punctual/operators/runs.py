"""Runs of monitored workflows and their per-workflow summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions import run_states
from punctual.functions.instants import AsOf, epoch_ms_to_ts, instant, local_date, midnight, shifted
from punctual.functions.instants import whole_seconds_between
from punctual.functions.sla import is_unsuccessful
from punctual.operators.joins import SHUFFLE, JoinPlan, attach
from punctual.operators.periods import with_local_today

# More than twice the distance of any run id from zero, so that starts decide first.
RUN_ID_SPAN = "100000000000000000000"
# Microseconds of the last instant of the year 9999.
LAST_START = 253_402_300_799_999_999


def to_run_state(raw: DataFrame, collected_at: AsOf, carried: Sequence[str] = ()) -> DataFrame:
    """Raw run records to state rows; a run that has not started takes the collection instant.

    ``carried`` names columns that go along unchanged.
    """

    started = F.coalesce(epoch_ms_to_ts(F.col("start_time")), instant(collected_at))
    state = run_states.result_state(
        F.col("status.state"), F.col("status.termination_details.code")
    )
    return raw.select(
        "workspace_id",
        F.col("job_id").cast("string").alias("job_id"),
        "run_id",
        started.alias("period_start_time"),
        epoch_ms_to_ts(F.col("end_time")).alias("period_end_time"),
        state.alias("result_state"),
        *carried,
    )


def collapse_runs(runs: DataFrame) -> DataFrame:
    """One row per run for input that was not upserted; a no-op on the run state table."""

    return runs.groupBy(*S.RUN_KEY).agg(
        F.min("period_start_time").alias("period_start_time"),
        F.max("period_end_time").alias("period_end_time"),
        F.max("result_state").alias("result_state"),
    )


def in_window(runs: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    return runs.filter(F.col("period_start_time") >= midnight(as_of, days))


def terminal(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("result_state").isin(*S.TERMINAL_STATES))


def recent_runs(runs: DataFrame, as_of: AsOf, window_days: int, terminal_only: bool) -> DataFrame:
    """Runs in the window; the state table holds one row per run already."""

    recent = in_window(runs, as_of, window_days)
    recent = terminal(recent) if terminal_only else recent.filter(F.col("result_state").isNotNull())
    return recent.select(
        *S.RUN_KEY,
        F.col("period_start_time").alias("run_start_time"),
        F.col("period_end_time").alias("run_end_time"),
        "result_state",
    )


def monitored_runs(
    workflows: DataFrame,
    runs: DataFrame,
    as_of: AsOf,
    window_days: int,
    terminal_only: bool,
    plan: JoinPlan = SHUFFLE,
) -> DataFrame:
    """Runs in the window with the columns of their workflow."""

    return attach(recent_runs(runs, as_of, window_days, terminal_only), workflows, plan)


def run_columns(workflows: DataFrame) -> DataFrame:
    """The workflow columns run-level work needs, kept narrow for the join."""

    dated = with_local_today(workflows)
    return dated.select(*S.WORKFLOW_KEY, "job_id", "timezone", "local_today", "workflow_name")


def run_order() -> Column:
    """Start, then run id, as one number of fixed width, which a hash aggregate can keep.

    Starts after the year 9999, which no feed can date, count as its end.
    """

    micros = F.least(F.unix_micros("run_start_time"), F.lit(LAST_START)).cast("decimal(18,0)")
    return micros * F.lit(RUN_ID_SPAN).cast("decimal(21,0)") + F.col("run_id").cast("decimal(19,0)")


def newest_by_state(runs: DataFrame, carried: Sequence[str], sums: Sequence[Column] = ()) -> DataFrame:
    """One row per workflow: ``latest`` (state and ``carried`` columns of its newest run) and the sums.

    Picking a whole row per group in one aggregation would sort every run, because a text is no
    fixed-width value. As part of the key the state costs nothing: one hash aggregate finds the newest
    run of every state, and only those few rows per workflow are compared as wholes. ``sums`` are named
    counts or sums.
    """

    by_state = runs.groupBy(*S.WORKFLOW_KEY, "result_state").agg(
        F.max(run_order()).alias("_newest"),
        *[F.max_by(column, run_order()).alias(column) for column in carried],
        *sums,
    )
    fields = [*S.WORKFLOW_KEY, "result_state", "_newest", *carried]
    totals = [F.sum(column).alias(column) for column in by_state.columns if column not in fields]
    latest = F.max(F.struct("_newest", "result_state", *carried)).alias("latest")
    return by_state.groupBy(*S.WORKFLOW_KEY).agg(latest, *totals)


def latest_runs(monitored: DataFrame) -> DataFrame:
    """Newest run per workflow by start, then run id."""

    carried = ["run_start_time", "run_id", "run_end_time"]
    found = newest_by_state(monitored, carried)
    return found.select(*S.WORKFLOW_KEY, *[f"latest.{name}" for name in (*carried, "result_state")])


def is_today(as_of: AsOf) -> Column:
    """Whether a run ended on the workflow's local date; the wide bounds spare most zone lookups."""

    near = F.col("run_end_time").between(shifted(as_of, days=-2), shifted(as_of, days=2))
    return near & (local_date(F.col("run_end_time"), F.col("timezone")) == F.col("local_today"))


def today_counts(runs: DataFrame, as_of: AsOf) -> DataFrame:
    """Finished runs of the workflow's local day. Runs are unique, so a plain count is distinct."""

    state = F.col("result_state")
    return (
        runs.filter(is_today(as_of))
        .groupBy(*S.WORKFLOW_KEY)
        .agg(
            F.count_if(state == S.SUCCEEDED).alias("successful_runs_today"),
            F.count_if(is_unsuccessful(state)).alias("unsuccessful_runs_today"),
        )
    )


def run_metrics(runs: DataFrame, as_of: AsOf, days: int = S.METRIC_WINDOW_DAYS) -> DataFrame:
    """Run counts and average duration per job over finished runs, by end time.

    Needs no configuration: it groups the state table itself by job with map-side partial sums.
    """

    state = F.col("result_state")
    duration = whole_seconds_between(F.col("period_start_time"), F.col("period_end_time"))
    return (
        runs.filter(F.col("period_end_time") >= midnight(as_of, days))
        .groupBy(*S.JOB_KEY)
        .agg(
            F.count("*").alias("total_runs_30d"),
            F.count_if(state == S.SUCCEEDED).alias("successful_runs_30d"),
            F.count_if(is_unsuccessful(state)).alias("unsuccessful_runs_30d"),
            F.avg(duration).alias("average_duration_seconds_30d"),
        )
    )
