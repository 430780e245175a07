"""Transitions of the run and job state tables as pure DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions.instants import AsOf, instant, shifted
from punctual.operators.joins import SHUFFLE, JoinPlan, config_join

# Later feeds win over earlier ones for the same run.
FEED_RANKS = {"completed": 1, "active": 2, "detail": 3, "missing": 3}


def latest_per_key(batch: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep the newest row per key.

    Spark plans a group limit before the shuffle, so even a key that owns a third of the batch sends
    one row per task. The order must be total for a deterministic result.
    """

    ranked = Window.partitionBy(*keys).orderBy(*newest_first)
    return batch.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def feed_rank(kind: Column) -> Column:
    ranks = F.create_map(*[F.lit(part) for pair in FEED_RANKS.items() for part in pair])
    return F.coalesce(F.try_element_at(ranks, kind), F.lit(0))


# When and by which feed the state of a run was observed; later observations win.
ORDER_FIELDS = ["observed_at", "feed_rank"]


def observation_order() -> Column:
    return F.struct(*ORDER_FIELDS)


def with_order(records: DataFrame) -> DataFrame:
    """Raw records with the rank of their feed."""

    return records.withColumn("feed_rank", feed_rank(F.col("feed_kind")))


def not_outdated(records: DataFrame, observed: DataFrame) -> DataFrame:
    """Raw records at least as new as what is known of their run.

    ``observed`` has one row per run key with ``ORDER_FIELDS``. A record without an instant, or of a run never
    observed, is kept; so is one that was observed just when the stored state was.
    """

    known = observed.select("workspace_id", F.col("job_id").cast("bigint").alias("job_id"), "run_id", observation_order().alias("_seen"))
    joined = with_order(records).join(known, S.RUN_KEY, "left")
    fresh = F.col("_seen").isNull() | F.col("observed_at").isNull() | (observation_order() >= F.col("_seen"))
    return joined.filter(fresh).select(*records.columns)


def combine_feeds(*feeds: DataFrame) -> DataFrame:
    """One raw record per run over the completed, active and looked-up feeds; the later feed wins."""

    combined = feeds[0]
    for feed in feeds[1:]:
        combined = combined.unionByName(feed)
    tie_breaks = [
        F.desc_nulls_last(column)
        for column in ("observed_at", "end_time", "start_time", "status.state", "status.termination_details.code")
    ]
    return latest_per_key(combined, S.RUN_KEY, [feed_rank(F.col("feed_kind")).desc(), *tie_breaks])


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace stored rows with the incoming row of the same key and add the others.

    ``incoming`` holds one row per key. No side is forced: Spark broadcasts a small batch, so the
    stored rows need no shuffle, and shuffles by the full key otherwise.
    """

    untouched = stored.join(incoming.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(incoming)


def upsert_runs(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    return upsert(stored, incoming, S.RUN_KEY)


def upsert_jobs(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keep the old name and success time where the new ones are null; always take the error."""

    old, new = stored.alias("old"), incoming.alias("new")
    arrived = F.col("new.last_collection_attempt_at").isNotNull()
    return old.join(new, S.JOB_KEY, "full_outer").select(
        *S.JOB_KEY,
        F.coalesce("new.job_name", "old.job_name").alias("job_name"),
        F.coalesce("new.last_collection_attempt_at", "old.last_collection_attempt_at").alias(
            "last_collection_attempt_at"
        ),
        F.coalesce("new.last_successful_collection_at", "old.last_successful_collection_at").alias(
            "last_successful_collection_at"
        ),
        F.when(arrived, F.col("new.last_error_message"))
        .otherwise(F.col("old.last_error_message"))
        .alias("last_error_message"),
    )


def expire_runs(stored: DataFrame, workspace_id: str, cutoff: AsOf) -> DataFrame:
    """Drop one workspace's runs that started before the cutoff."""

    expired = (F.col("workspace_id") == workspace_id) & (F.col("period_start_time") < instant(cutoff))
    return stored.filter(~expired)


def retention_cutoff(as_of: AsOf) -> Column:
    """The exact instant 60 days before, not midnight as in the views."""

    return shifted(as_of, days=-S.RETENTION_DAYS)


def delete_runs(stored: DataFrame, missing: DataFrame) -> DataFrame:
    return stored.join(missing.select(*S.RUN_KEY), S.RUN_KEY, "left_anti")


def replace_workspace(stored: DataFrame, workspace_id: str, rows: DataFrame) -> DataFrame:
    """Replace one workspace's rows, also by none; other workspaces keep theirs."""

    return stored.filter(F.col("workspace_id") != workspace_id).unionByName(rows)


def purge_workspace(stored: DataFrame, workspace_id: str) -> DataFrame:
    return stored.filter(F.col("workspace_id") != workspace_id)


def checkpoints(jobs: DataFrame, monitored: DataFrame) -> DataFrame:
    """Last successful collection of the monitored jobs that have one."""

    return (
        jobs.filter(F.col("last_successful_collection_at").isNotNull())
        .join(monitored.select(*S.JOB_KEY), S.JOB_KEY, "left_semi")
        .select(*S.JOB_KEY, "last_successful_collection_at")
    )


def incremental_windows(monitored: DataFrame, jobs: DataFrame, as_of: AsOf) -> DataFrame:
    """First instant each monitored job is read from: the overlap before its last success, at most
    the retention."""

    history_start = shifted(as_of, days=-S.RETENTION_DAYS)
    overlap = F.expr(f"INTERVAL {S.OVERLAP_MINUTES} MINUTES")
    resumed = F.col("last_successful_collection_at") - overlap
    return (
        monitored.select(*S.JOB_KEY)
        .join(checkpoints(jobs, monitored), S.JOB_KEY, "left")
        .select(
            *S.JOB_KEY,
            history_start.alias("history_start_at"),
            F.greatest(history_start, F.coalesce(resumed, history_start)).alias("incremental_start_at"),
        )
    )


def select_incremental(
    completed: DataFrame, windows: DataFrame, as_of: AsOf, plan: JoinPlan = SHUFFLE
) -> DataFrame:
    """Completed records that started inside their job's window.

    The retention bound applies to every job and is a literal on the raw column, so the scan can use
    it; the per-job bound follows after the join with the small window table.
    """

    history_ms = (F.unix_micros(shifted(as_of, days=-S.RETENTION_DAYS)) / 1000).cast("bigint")
    recent = completed.filter(F.col("start_time") >= history_ms)
    bounds = windows.select(
        "workspace_id",
        F.col("job_id").cast("bigint").alias("job_id"),
        F.floor(F.unix_micros("incremental_start_at") / 1000).alias("_from_ms"),
    )
    return (
        config_join(recent, bounds, S.JOB_KEY, F.col("run_id"), plan)
        .filter(F.col("start_time") >= F.col("_from_ms"))
        .select(*completed.columns)
    )


def nonterminal_gap(stored: DataFrame, windows: DataFrame, plan: JoinPlan = SHUFFLE) -> DataFrame:
    """Stored open runs older than the incremental window: start inclusive, end exclusive."""

    started = F.col("period_start_time")
    open_runs = stored.filter(~F.col("result_state").isin(*S.TERMINAL_STATES))
    return (
        config_join(open_runs, windows, S.JOB_KEY, F.col("run_id"), plan)
        .filter((started >= F.col("history_start_at")) & (started < F.col("incremental_start_at")))
        .select(*S.RUN_KEY)
    )


def lookup_runs(gap: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the looked-up runs into found records and runs confirmed not to exist.

    An answer of kind ``detail`` is a run, one of kind ``missing`` says the run does not exist. A
    run without an answer is in neither part: silence is no proof that it is gone.
    """

    asked = gap.select("workspace_id", F.col("job_id").cast("bigint").alias("job_id"), "run_id")
    answered = answers.join(asked, S.RUN_KEY, "left_semi")
    found = answered.filter(F.col("feed_kind") == "detail")
    missing = answered.filter(F.col("feed_kind") == "missing").select(
        "workspace_id", F.col("job_id").cast("string").alias("job_id"), "run_id"
    )
    return found, missing.distinct()


