"""One collection round over all jobs at once, as data instead of a loop over jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions import run_states
from punctual.functions.instants import AsOf, instant, shifted
from punctual.operators.joins import JoinPlan, config_join
from punctual.operators.runs import to_run_state
from punctual.operators.state import (
    FEED_RANKS,
    ORDER_FIELDS,
    feed_rank,
    incremental_windows,
    nonterminal_gap,
    upsert_jobs,
    with_order,
)

# Stages run in this order for a job; a failed stage hides what later stages would have returned.
STAGE_RANKS = {"details": 0, "completed": 1, "active": 2, "lookup": 3}


@dataclass(frozen=True)
class CollectionRound:
    """The state after a round and what changed in it.

    ``changes`` holds one raw record per run that was listed or looked up; a record of kind
    ``missing`` removes its run.
    """

    runs: DataFrame
    jobs: DataFrame
    changes: DataFrame
    job_updates: DataFrame


def changed_runs(changes: DataFrame, as_of: AsOf) -> DataFrame:
    return to_run_state(changes.filter(F.col("feed_kind") != "missing"), as_of)


def ordered_changes(changes: DataFrame, as_of: AsOf) -> tuple[DataFrame, DataFrame]:
    """Changed and removed runs with the order in which they were observed, as the store takes them."""

    marked = with_order(changes)
    missing = F.col("feed_kind") == "missing"
    key = ["workspace_id", F.col("job_id").cast("string").alias("job_id"), "run_id"]
    found = marked.filter(~missing)
    return to_run_state(found, as_of, ORDER_FIELDS), marked.filter(missing).select(*key, *ORDER_FIELDS)


def removed_runs(changes: DataFrame) -> DataFrame:
    removed = changes.filter(F.col("feed_kind") == "missing")
    return removed.select("workspace_id", F.col("job_id").cast("string").alias("job_id"), "run_id")


def job_outcomes(
    monitored: DataFrame, details: DataFrame, errors: DataFrame, as_of: AsOf
) -> DataFrame:
    """Name and first failed stage of every monitored job; a job without a name fails at once."""

    stage = F.coalesce(
        F.try_element_at(
            F.create_map(*[F.lit(part) for pair in STAGE_RANKS.items() for part in pair]),
            F.col("stage"),
        ),
        F.lit(0),
    )
    reported = (
        errors.select(
            "workspace_id", F.col("job_id").cast("string").alias("job_id"), stage.alias("_stage"), "message"
        )
        .groupBy(*S.JOB_KEY)
        .agg(F.min("_stage").alias("_stage"), F.min_by("message", F.struct("_stage", "message")).alias("_message"))
    )
    named = (
        details.select(
            "workspace_id",
            F.col("job_id").cast("string").alias("job_id"),
            run_states.checked_job_name(F.col("settings.name")).alias("job_name"),
        )
        .groupBy(*S.JOB_KEY)
        .agg(F.max("job_name").alias("job_name"))
    )
    failed_details = F.col("_stage") == STAGE_RANKS["details"]
    unnamed = F.col("job_name").isNull() & ~F.coalesce(failed_details, F.lit(False))
    return (
        monitored.select(*S.JOB_KEY)
        .distinct()
        .join(named, S.JOB_KEY, "left")
        .join(reported, S.JOB_KEY, "left")
        .select(
            *S.JOB_KEY,
            F.when(~F.coalesce(failed_details, F.lit(False)), F.col("job_name")).alias("job_name"),
            F.when(unnamed, F.lit(STAGE_RANKS["details"])).otherwise(F.col("_stage")).alias("failed_stage"),
            run_states.bounded_error(
                F.when(unnamed, run_states.missing_name_error(F.col("job_id"))).otherwise(F.col("_message"))
            ).alias("last_error_message"),
            instant(as_of).alias("last_collection_attempt_at"),
        )
    )


def job_limits(outcomes: DataFrame, windows: DataFrame) -> DataFrame:
    """What bounds the records of a job: its first failed stage and its windows, one row per job."""

    return outcomes.join(windows, S.JOB_KEY).select(
        "workspace_id",
        F.col("job_id").cast("bigint").alias("job_id"),
        "failed_stage",
        "history_start_at",
        "incremental_start_at",
    )


def fold_feed(feed: DataFrame, limits: DataFrame, as_of: AsOf, plan: JoinPlan) -> DataFrame:
    """One row per run over all its landed records, from one pass over the feed and one shuffle.

    ``listed`` is the record that wins among the listings, ``answer`` the one among the lookups, and
    ``open_before`` says that a listing showed the run open and started before its job's window.

    Records count up to the stage at which their job failed: what arrived before it broke off stays,
    and a job that failed at its details was never listed. Completed runs count from the job's window
    on; the retention bound is a literal on the raw column, so that the scan can use it.
    """

    kind = F.col("feed_kind")
    history_ms = (F.unix_micros(shifted(as_of, days=-S.RETENTION_DAYS)) / 1000).cast("bigint")
    known = kind.isin(*FEED_RANKS) & ((kind != "completed") | (F.col("start_time") >= history_ms))
    from_ms = F.floor(F.unix_micros("incremental_start_at") / 1000)
    reached = (
        config_join(feed.filter(known), limits, S.JOB_KEY, F.col("run_id"), plan)
        .filter(F.col("failed_stage").isNull() | (feed_rank(kind) <= F.col("failed_stage")))
        .filter((kind != "completed") | (F.col("start_time") >= from_ms))
    )
    record = F.struct(*[column for column in feed.columns if column not in S.RUN_KEY])
    carried = [column for column in reached.columns if column not in S.RUN_KEY]
    # Nulls are the least of a struct's field, so its maximum takes them last.
    ties = ["observed_at", "end_time", "start_time", "status.state", "status.termination_details.code"]
    ranked = F.struct(feed_rank(kind), *[F.col(tie).alias(f"_{k}") for k, tie in enumerate(ties)], record.alias("record"))
    started, is_listing = F.col("period_start_time"), kind.isin("completed", "active")
    early = (started >= F.col("history_start_at")) & (started < F.col("incremental_start_at"))
    left_open = (kind == "active") & ~F.col("result_state").isin(*S.TERMINAL_STATES) & early
    return (
        to_run_state(reached, as_of, carried)
        .groupBy(*S.RUN_KEY)
        .agg(
            F.max(F.when(is_listing, ranked)).getField("record").alias("listed"),
            F.max(F.when(~is_listing, ranked)).getField("record").alias("answer"),
            F.max(left_open).alias("open_before"),
        )
    )


def round_changes(folded: DataFrame, gap: DataFrame) -> DataFrame:
    """One raw record per run that was listed, or asked about and answered.

    Lookups follow the listings: asked about are runs that a listing left open before the window, and
    the stored ones of ``gap`` that no listing showed. An answer to what wasn't asked changes nothing.
    """

    stored_open = F.col("_stored_open").isNotNull() & F.col("listed").isNull()
    asked = F.col("open_before") | stored_open
    chosen = F.when(asked & F.col("answer").isNotNull(), F.col("answer")).otherwise(F.col("listed"))
    return (
        folded.join(gap.select(*S.RUN_KEY, F.lit(True).alias("_stored_open")), S.RUN_KEY, "left")
        .select("workspace_id", F.col("job_id").cast("bigint").alias("job_id"), "run_id", chosen.alias("record"))
        .filter(F.col("record").isNotNull())
        .select(*S.RUN_KEY, "record.*")
    )


def apply_changes(stored: DataFrame, changes: DataFrame, as_of: AsOf) -> DataFrame:
    """Replace every changed run in one pass; removed runs simply do not come back."""

    keys = changes.select("workspace_id", F.col("job_id").cast("string").alias("job_id"), "run_id")
    return stored.join(keys, S.RUN_KEY, "left_anti").unionByName(changed_runs(changes, as_of))


def collect_round(
    stored_runs: DataFrame,
    stored_jobs: DataFrame,
    config: DataFrame,
    feed: DataFrame,
    details: DataFrame,
    errors: DataFrame,
    as_of: AsOf,
    plan: JoinPlan | None = None,
) -> CollectionRound:
    """Apply one batch of landed records to the state.

    ``feed`` holds raw records of kinds completed, active, detail and missing. Expired runs go first.
    Confirmed-missing runs are removed in the same result as the good rows, whatever else failed for
    their job, and a failing job never stops another one.
    """

    plan = plan or JoinPlan.measure(config)
    monitored = config.select("workspace_id", F.col("configured_job_id").alias("job_id")).distinct()
    configured = config.select("workspace_id").distinct()
    expired = F.col("period_start_time") < shifted(as_of, days=-S.RETENTION_DAYS)
    scoped = config_join(
        stored_runs,
        configured.withColumn("_scoped", F.lit(True)),
        ["workspace_id"],
        F.col("run_id"),
        plan,
        "left",
    )
    kept = scoped.filter(~(expired & F.coalesce("_scoped", F.lit(False)))).select(*stored_runs.columns)

    outcomes = job_outcomes(monitored, details, errors, as_of)
    windows = incremental_windows(monitored, stored_jobs, as_of)
    folded = fold_feed(feed, job_limits(outcomes, windows), as_of, plan)
    changes = round_changes(folded, nonterminal_gap(kept, windows, plan)).select(*feed.columns)
    succeeded_at = F.when(F.col("failed_stage").isNull(), instant(as_of))
    updates = outcomes.select(
        *S.JOB_KEY,
        "job_name",
        "last_collection_attempt_at",
        succeeded_at.alias("last_successful_collection_at"),
        "last_error_message",
    )
    return CollectionRound(
        runs=apply_changes(kept, changes, as_of),
        jobs=upsert_jobs(stored_jobs, updates),
        changes=changes,
        job_updates=updates,
    )


def failed_jobs(job_updates: DataFrame) -> DataFrame:
    """Jobs whose collection failed, for the summary error of the round."""

    return job_updates.filter(F.col("last_error_message").isNotNull()).select(
        *S.JOB_KEY, "last_error_message"
    )
