"""Collection as a stream: every micro-batch is one collection round."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctual import schemas as S
from punctual.functions.instants import AsOf, shifted
from punctual.operators.config import config_rows, split_documents, validate_config
from punctual.operators.joins import JoinPlan
from punctual.operators.state import feed_rank, latest_per_key, not_outdated, retention_cutoff
from punctual.plans.collection import collect_round, failed_jobs, ordered_changes
from punctual.plans.history import matched_history
from punctual.plans.status import workflow_status
from punctual.sources.store import StateStore

POLL_INTERVAL = "5 minutes"


def upsert_batch(store: StateStore, batch: DataFrame, collected_at: AsOf) -> None:
    """Keep the newest record per run of a batch and apply it; a missing run is removed.

    Files of a landing folder come in any order, so a record observed before the stored state of its
    run changes nothing. Repeating a batch changes nothing either. No watermark is used: inside the
    retention no record is too late.
    """

    rank = feed_rank(F.col("feed_kind"))
    newest = latest_per_key(batch, S.RUN_KEY, [F.col("observed_at").desc(), rank.desc(), F.col("status.state").desc()])
    store.commit_runs(*ordered_changes(newest.checkpoint(), collected_at))


def collect_batch(
    store: StateStore,
    batch: DataFrame,
    details: DataFrame,
    errors: DataFrame,
    as_of: AsOf,
    raise_on_failure: bool = False,
    workspaces: DataFrame | None = None,
) -> DataFrame:
    """Apply one collection round to the store and return the jobs that failed.

    Records observed before the stored state of their run take no part in the round. Retention holds for
    ``workspaces`` (every stored one by default), configured or not. Failed jobs are counted while the job
    states are computed; the error of ``raise_on_failure`` names their number and the table that lists them.
    """

    store.expire(retention_cutoff(as_of), workspaces)
    batch = batch.checkpoint()
    keys = batch.select("workspace_id", F.col("job_id").cast("string").alias("job_id"), "run_id").distinct()
    fresh = not_outdated(batch, store.observations(keys))
    state = collect_round(store.runs(), store.jobs(), store.config(), fresh, details, errors, as_of)
    # The round reads the tables its commits replace, so its results are fixed before the first one.
    changes, seen = state.changes.checkpoint(), Observation()
    failures = F.count_if(F.col("last_error_message").isNotNull()).alias("failed")
    updates = state.job_updates.observe(seen, failures).checkpoint()
    store.commit_runs(*ordered_changes(changes, as_of))
    store.commit_jobs(updates)
    if raise_on_failure and seen.get["failed"]:
        listed = f"last_error_message in {store.name(S.JOB_STATE_TABLE)}"
        raise RuntimeError(f"Jobs API collection failed for {seen.get['failed']} jobs: see {listed}")
    return failed_jobs(updates)


def collect_documents(
    store: StateStore,
    documents: DataFrame,
    batch: DataFrame,
    details: DataFrame,
    errors: DataFrame,
    as_of: AsOf,
) -> tuple[DataFrame, DataFrame]:
    """The collector run as one operation: documents (workspace_id, document) to a committed round.

    Valid documents replace their workspace's configuration where it changed; a refused document
    leaves the stored one. Then the round runs over all configurations. Returns the validation errors
    and the failed jobs.
    """

    valid, problems = validate_config(*split_documents(documents))
    problems = problems.checkpoint()
    refused = problems.select("workspace_id").distinct()
    accepted = documents.select("workspace_id").distinct().join(refused, "workspace_id", "left_anti")
    store.commit_config(accepted, config_rows(valid, as_of))
    return problems, collect_batch(store, batch, details, errors, as_of)


def once(
    store: StateStore,
    apply: Callable[[DataFrame, datetime], None],
    clock: Callable[[], datetime],
) -> Callable[[DataFrame, int], None]:
    """``apply`` as a batch function that takes effect once per micro-batch.

    Before the first commit the batch is noted with its instant, after the last one as finished. A batch
    that Spark hands out again, because the stream stopped before it was recorded as done, is skipped if it
    had finished; otherwise it is applied again with the instant it was first given, and its commits give
    the same rows. Streams are told apart by the identifier in their checkpoint.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        last = store.last_batch(query_id)
        if last and (batch_id < last["batch_id"] or (batch_id == last["batch_id"] and last["finished"])):
            return
        begun = last and batch_id == last["batch_id"]
        collected_at = last["collected_at"].replace(tzinfo=UTC) if begun else clock()
        if not begun:
            store.note_batch(query_id, batch_id, collected_at, finished=False)
        apply(batch, collected_at)
        store.note_batch(query_id, batch_id, collected_at, finished=True)

    return run


def start_run_stream(
    store: StateStore,
    feed: DataFrame,
    apply: Callable[[DataFrame, datetime], None],
    checkpoint: str,
    available_now: bool = False,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
) -> StreamingQuery:
    """Run ``apply`` once on every micro-batch of a feed with the instant the batch first began.

    One query per store keeps a single writer.
    """

    writer = feed.writeStream.foreachBatch(once(store, apply, clock)).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": POLL_INTERVAL}
    return writer.trigger(**trigger).start()


def evaluate_batch(
    store: StateStore, batch: DataFrame, as_of: datetime, plan: JoinPlan | None = None
) -> tuple[DataFrame, DataFrame]:
    """Status and deadline history of the workflows a batch touched."""

    touched = batch.selectExpr("workspace_id", "cast(job_id as string) AS configured_job_id").distinct()
    config = store.config().join(touched, ["workspace_id", "configured_job_id"], "left_semi")
    config = config.select(*S.SLA_CONFIG.names)
    plan = plan or JoinPlan.measure(config)
    # The longest window of both views; older start dates aren't read.
    jobs, runs = store.jobs(), store.runs(shifted(as_of, days=-S.SLA_RUN_WINDOW_DAYS - 1))
    return (
        workflow_status(config, jobs, runs, as_of, plan),
        matched_history(config, runs, as_of, plan),
    )
