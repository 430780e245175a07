"""Consistency checks between the current and the history view of the same deadlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions import sla
from punctual.functions.schedules import CURRENT, HISTORY, ScheduleWindow
from punctual.operators.joins import SHUFFLE, JoinPlan
from punctual.operators.periods import deadline_periods, eligible, last_and_next_due, match_runs


def due_in_both_windows(
    workflows: DataFrame,
    runs: DataFrame,
    plan: JoinPlan = SHUFFLE,
    history: ScheduleWindow = HISTORY,
) -> DataFrame:
    """Latest due and next deadline of every workflow, once from each window.

    ``workflows`` carries its own ``as_of`` column, so rows may be judged at different instants.
    """

    def due(window: ScheduleWindow, prefix: str) -> DataFrame:
        matched = match_runs(eligible(deadline_periods(workflows, window)), runs, plan)
        found = last_and_next_due(matched)
        renamed = [F.col(name).alias(f"{prefix}{name}") for name in found.columns if name not in S.WORKFLOW_KEY]
        return found.select(*S.WORKFLOW_KEY, *renamed)

    last, following = F.col("current_last_status"), F.col("current_next_status")
    return (
        workflows.select(*S.WORKFLOW_KEY, "workflow_name")
        .join(due(CURRENT, "current_"), S.WORKFLOW_KEY, "left")
        .join(due(history, "history_"), S.WORKFLOW_KEY, "left")
        .select(
            "*",
            sla.sla_status(last, following).alias("current_sla_status"),
            sla.pending_flag(last, following).alias("sla_pending_flag"),
            sla.flag(last == "Missed").alias("sla_missed_flag"),
            sla.flag(last == "Missed").alias("needs_attention_flag"),
        )
    )


def checks(facts: DataFrame, expectations: dict[str, Column]) -> DataFrame:
    """One row per expectation: whether exactly one row of ``facts`` satisfies it."""

    counted = facts.agg(*[F.count_if(condition).alias(name) for name, condition in expectations.items()])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("check"), (F.col(name) == 1).alias("passed")) for name in expectations]
    )
    return counted.select(F.inline(pairs))


def assert_checks(results: DataFrame) -> DataFrame:
    """The same rows; reading them raises for the first check that did not pass."""

    message = F.concat(F.col("check"), F.lit(" failed"))
    return results.select("check", "passed", F.assert_true(F.col("passed"), message).alias("asserted"))
