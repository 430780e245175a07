"""Status, margin and rate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions.instants import whole_seconds_between


def deadline_status(met: Column, deadline: Column, as_of: Column) -> Column:
    """A success decides first, so an early success already meets an upcoming deadline."""

    return F.when(met, "Met").when(deadline <= as_of, "Missed").otherwise("Pending")


def delivery_state(status: Column, late_recovery: Column) -> Column:
    recovered = (status == "Missed") & late_recovery.isNotNull()
    return F.when(recovered, "Late recovery").otherwise(status)


def completion_margin(deadline: Column, observed: Column) -> Column:
    """Minutes before (+) or after (-) the deadline, as a decimal with one place."""

    return F.round(whole_seconds_between(observed, deadline) / F.lit("60.0").cast("decimal(3,1)"), 1)


def display_margin(margin: Column) -> Column:
    return F.coalesce(margin, F.lit("0.0").cast("decimal(2,1)"))


def sla_target_rate() -> Column:
    return F.lit(S.SLA_TARGET_RATE).cast("decimal(4,2)")


def try_ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def attention_level(missed: Column, unsuccessful: Column) -> Column:
    has_missed = F.coalesce(missed, F.lit(0)) > 0
    has_unsuccessful = F.coalesce(unsuccessful, F.lit(0)) > 0
    return (
        F.when(has_missed & has_unsuccessful, "Critical")
        .when(has_missed | has_unsuccessful, "Needs attention")
        .otherwise("Healthy")
    )


def sla_status(last_status: Column, next_status: Column) -> Column:
    """A missed latest deadline outranks whatever comes next."""

    current = F.coalesce(next_status, last_status, F.lit("Pending"))
    return F.when(last_status == "Missed", "Missed").otherwise(current)


def health_status(problem: Column, last_status: Column, next_status: Column) -> Column:
    return F.when(problem.isNotNull(), "Configuration problem").otherwise(
        sla_status(last_status, next_status)
    )


def pending_flag(last_status: Column, next_status: Column) -> Column:
    # A null last status makes the comparison null, so the flag stays 0 before the first deadline.
    upcoming = F.coalesce(next_status, F.lit("Pending")) == "Pending"
    return flag((last_status != "Missed") & upcoming)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def run_outcome(state: Column) -> Column:
    return F.when(state == S.SUCCEEDED, "Success").otherwise("Not successful")


def is_unsuccessful(state: Column) -> Column:
    return state.isin(*S.UNSUCCESSFUL_STATES)
