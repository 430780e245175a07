"""Entry points of the checks: the flagship query, every registered query and its SQL."""

from __future__ import annotations

import itertools
import os
import sys
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import StreamingQueryException

from oracle.statements import statements
from punctual import schemas as S
from punctual.functions import run_states
from punctual.functions.instants import instant
from punctual.functions.schedules import CURRENT, HISTORY
from punctual.operators import catalogue, config, ordering, periods, runs, state, workflows
from punctual.operators.joins import SHUFFLE, JoinPlan, attach
from punctual.plans import charts, checks, collection, history, status
from punctual.session import ensure_checkpoints, use_utc
from punctual.sources import driver_tables as data
from punctual.sources import feeds
from punctual.sources.store import StateStore
from punctual.streaming.collector import collect_batch, start_run_stream, upsert_batch

AS_OF = data.AS_OF
Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Types both engines share: instants without zone, wide integers, doubles for decimals."""

    def plain(field: T.StructField) -> F.Column:
        kind = field.dataType
        if isinstance(kind, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz")
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(field.name).cast("bigint")
        if isinstance(kind, T.DecimalType):
            return F.col(field.name).cast("double")
        return F.col(field.name)

    return df.select(*[plain(field).alias(field.name) for field in df.schema])


def _inputs(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> tuple[DataFrame, DataFrame, DataFrame]:
    return data.sla_config(spark, sf_dir), data.job_state(spark, sf_dir, as_of), data.run_state(spark, sf_dir, as_of)


def _workflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings, jobs, _ = _inputs(spark, sf_dir)
    return workflows.monitored_workflows(settings, jobs, AS_OF)


def _status(spark: SparkSession, sf_dir: str, plan: JoinPlan | None = None, as_of: datetime = AS_OF) -> DataFrame:
    return status.workflow_status(*_inputs(spark, sf_dir, as_of), as_of, plan)


def _run_history(spark: SparkSession, sf_dir: str, plan: JoinPlan | None = None, as_of: datetime = AS_OF) -> DataFrame:
    return history.run_history(*_inputs(spark, sf_dir, as_of), as_of, plan)


def _sla_history(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    return history.sla_history(*_inputs(spark, sf_dir, as_of), as_of)


def _status_runs(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    settings, jobs, stored = _inputs(spark, sf_dir, as_of)
    plan = JoinPlan.measure(settings)
    known = runs.run_columns(workflows.monitored_workflows(settings, jobs, as_of))
    return runs.monitored_runs(known, stored, as_of, S.RUN_WINDOW_DAYS, terminal_only=False, plan=plan)


def _matched(spark: SparkSession, sf_dir: str, window=HISTORY, days=S.SLA_RUN_WINDOW_DAYS, plan=None, as_of: datetime = AS_OF) -> DataFrame:
    settings, jobs, stored = _inputs(spark, sf_dir, as_of)
    plan = plan or JoinPlan.measure(settings)
    found = periods.deadline_periods(workflows.monitored_workflows(settings, jobs, as_of), window)
    return periods.match_runs(periods.eligible(found), runs.in_window(stored, as_of, days), plan)


def _config_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return data.config_headers(spark, sf_dir), data.config_entries(spark, sf_dir)


def _valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = config.validate_config(*_config_inputs(spark, sf_dir))
    return config.config_rows(valid, AS_OF)


def _windows(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    monitored = data.monitored_jobs(data.sla_config(spark, sf_dir))
    return state.incremental_windows(monitored, data.spread_job_state(spark, sf_dir, as_of), as_of)


def _gap(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    plan = JoinPlan.measure(data.sla_config(spark, sf_dir))
    return state.nonterminal_gap(data.run_state(spark, sf_dir, as_of), _windows(spark, sf_dir, as_of), plan)


def _round(spark: SparkSession, sf_dir: str) -> collection.CollectionRound:
    return collection.collect_round(
        data.earlier_runs(spark, sf_dir),
        data.spread_job_state(spark, sf_dir),
        data.sla_config(spark, sf_dir),
        data.round_feed(spark, sf_dir),
        data.job_details(spark, sf_dir),
        data.collection_errors(spark, sf_dir),
        AS_OF,
    )


def result_state_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("status.termination_details.code")
    lifecycle = F.col("status.state")
    return (
        data.raw_runs(spark, sf_dir)
        .select(
            lifecycle.alias("state"), code.alias("code"), run_states.result_state(lifecycle, code).alias("result_state")
        )
        .groupBy("state", "code", "result_state")
        .agg(F.count("*").alias("records"))
    )


def bounded_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = data.table(spark, sf_dir, "documents")
    return documents.select("doc_id", run_states.bounded_error(F.col("text")).alias("error_text"))


def collapsed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.collapse_runs(runs.to_run_state(data.change_feed(spark, sf_dir), AS_OF))


def upsert_latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, kind = data.change_feed(spark, sf_dir), F.col("feed_kind")
    stored = runs.to_run_state(state.combine_feeds(changes.filter(kind == "completed")), AS_OF)
    incoming = runs.to_run_state(state.combine_feeds(changes.filter(kind == "active")), AS_OF)
    return state.upsert_runs(stored, incoming)


def _fresh_store(spark: SparkSession, purpose: str) -> tuple[StateStore, str]:
    """An empty store and its folder among the checkpoints."""

    name = f"{purpose}_{os.getpid()}_{datetime.now(UTC):%H%M%S%f}"
    folder = f"{ensure_checkpoints(spark)}/{name}"
    store = StateStore(spark, name, shards=2)
    store.ensure_tables(create_namespace=True, location=f"{folder}/tables")
    return store, folder


def stream_upsert_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed and looked-up records of all events as a stream, upserted into a state store."""

    store, folder = _fresh_store(spark, "stream")
    schema = data.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    feed = data.listed_then_looked_up(data.event_records(events))
    query = start_run_stream(
        store, feed, lambda batch, _: upsert_batch(store, batch, AS_OF), f"{folder}/offsets", available_now=True
    )
    query.awaitTermination()
    return store.runs()


def stream_restarted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as landed files, newest first, in a stream that stops inside a batch and is restarted.

    The second of three batches breaks off after its rows were committed and before it is noted
    as finished; each batch has an instant of its own, which the repeated batch has to keep.
    """

    store, folder = _fresh_store(spark, "restarted")
    records = data.listed_then_looked_up(data.raw_runs(spark, sf_dir)).withColumn("observed_at", data.version_instant())
    files = data.land_in_parts(records, f"{folder}/landing")
    feed = feeds.stream_run_feed(spark, f"{folder}/landing", files_per_batch=files)
    asked, applied = (AS_OF + timedelta(minutes=5 * k) for k in itertools.count()), []

    def apply(batch: DataFrame, collected_at: datetime) -> None:
        upsert_batch(store, batch, collected_at)
        applied.append(collected_at)
        if len(applied) == 2:
            raise InterruptedError("stopped between the commits")

    def run() -> None:
        start_run_stream(store, feed, apply, f"{folder}/offsets", True, lambda: next(asked)).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        run()
    # A run that had not started took its batch's instant; which batch that was depends on the files.
    started = F.when(F.col("period_start_time") >= instant(AS_OF), instant(AS_OF)).otherwise(F.col("period_start_time"))
    return store.runs().withColumn("period_start_time", started)


def rounds_in_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collection rounds, of which the second lands older records of runs the first one saw finished."""

    store, _ = _fresh_store(spark, "rounds")
    settings = data.sla_config(spark, sf_dir)
    store.commit_config(settings.select("workspace_id").distinct(), settings)
    raw, details = data.raw_runs(spark, sf_dir), data.job_details(spark, sf_dir)
    errors = data.collection_errors(spark, sf_dir).limit(0)
    older = data.listed_then_looked_up(raw).filter((F.col("feed_kind") == "active") & (F.col("status.state") == "RUNNING"))
    later = F.col("observed_at") + F.expr("INTERVAL 1 HOUR")
    collect_batch(store, raw.withColumn("observed_at", later), details, errors, AS_OF)
    collect_batch(store, older, details, errors, AS_OF + timedelta(minutes=5))
    return store.runs()


def upsert_job_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.upsert_jobs(data.job_state(spark, sf_dir), _round(spark, sf_dir).job_updates)


def expire_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = state.retention_cutoff(datetime(2024, 3, 20, 12, tzinfo=UTC))
    return state.expire_runs(data.run_state(spark, sf_dir), "111", cutoff)


def delete_missing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = data.lookup_answers(spark, sf_dir).filter(F.col("feed_kind") == "missing")
    missing = answers.withColumn("job_id", F.col("job_id").cast("string"))
    return state.delete_runs(data.run_state(spark, sf_dir), missing)


def valid_workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = data.table(spark, sf_dir, "orders")
    ids = orders.select(F.explode(F.array("o_orderpriority", F.col("o_custkey").cast("string"))).alias("id"))
    return ids.groupBy("id").agg(F.count("*").alias("uses")).select(
        "id",
        run_states.is_valid_workspace_id(F.col("id")).alias("valid_workspace"),
        run_states.is_valid_identifier(F.col("id")).alias("valid_identifier"),
        "uses",
    )


def incremental_selection(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    completed = data.raw_runs(spark, sf_dir).filter(F.col("feed_kind") == "completed")
    plan = JoinPlan.measure(data.sla_config(spark, sf_dir))
    chosen = state.select_incremental(completed, _windows(spark, sf_dir, as_of), as_of, plan)
    return chosen.select(*S.RUN_KEY, "start_time", "end_time")


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    monitored = data.monitored_jobs(data.sla_config(spark, sf_dir))
    return state.checkpoints(data.spread_job_state(spark, sf_dir), monitored)


def lookup_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, missing = state.lookup_runs(_gap(spark, sf_dir), data.lookup_answers(spark, sf_dir))
    rows = runs.to_run_state(found, AS_OF).select(F.lit("detail").alias("answer"), *S.RUN_KEY, "result_state")
    gone = missing.select(F.lit("missing").alias("answer"), *S.RUN_KEY, F.lit(None).cast("string").alias("result_state"))
    return rows.unionByName(gone)


def replace_workspace_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = _valid_rows(spark, sf_dir).withColumn("workspace_id", F.lit("222"))
    replaced = state.replace_workspace(data.sla_config(spark, sf_dir), "222", fresh)
    return replaced.select(*S.WORKFLOW_KEY, "configured_job_id", "frequency", "completion_time", "timezone")


def config_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _valid_rows(spark, sf_dir)
    weekly = F.col("frequency") == "weekly"
    moved = F.when(weekly, F.concat(F.col("completion_time"), F.lit("+"))).otherwise(F.col("completion_time"))
    changed = stored.withColumn("completion_time", moved).withColumn("config_changed_at", F.lit(None).cast("timestamp"))
    return config.config_difference(stored, changed).select("change", "configured_job_id")


def configured_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid_rows(spark, sf_dir).drop("config_changed_at")


def config_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.validate_config(*_config_inputs(spark, sf_dir))[1]


def duplicate_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config_errors(spark, sf_dir).filter(F.col("message").startswith("duplicates "))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.users(spark, sf_dir).select((F.col("u") + 1).alias("job_id"))


def candidate_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.candidate_jobs(data.job_catalogue(spark, sf_dir), _listed(spark, sf_dir), "CUSTOMER#")


def new_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.new_jobs(data.job_catalogue(spark, sf_dir), _listed(spark, sf_dir))


def default_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.default_entries(new_jobs(spark, sf_dir), "06:30")


def scoped_job_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = data.sla_config(spark, sf_dir).filter(F.col("workspace_id") == "222")
    return workflows.scope_to_configured(data.job_state(spark, sf_dir), settings).select("job_id", "job_name")


def monitored_workflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _workflows(spark, sf_dir).select(
        *S.WORKFLOW_KEY, "job_id", "frequency", "timezone", "workflow_name", "configuration_problem"
    )


def collection_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings, jobs, _ = _inputs(spark, sf_dir)
    health = workflows.collection_health(settings, jobs, AS_OF)
    return health.groupBy("configuration_problem").agg(F.count("*").alias("workflows"))


def _deadlines(window) -> Query:
    def expand(spark: SparkSession, sf_dir: str) -> DataFrame:
        dated = periods.expand_deadlines(_workflows(spark, sf_dir), window)
        return dated.select(*S.WORKFLOW_KEY, "frequency", "deadline_date")

    return expand


def deadline_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.deadline_periods(_workflows(spark, sf_dir), HISTORY)
    return found.select(*S.WORKFLOW_KEY, *periods.PERIOD_FIELDS)


def eligible_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.eligible(periods.deadline_periods(_workflows(spark, sf_dir), CURRENT))
    return found.select(*S.WORKFLOW_KEY, "deadline_date", "previous_deadline_utc", "deadline_utc")


def deadline_status(spark: SparkSession, sf_dir: str, plan: JoinPlan | None = None, as_of: datetime = AS_OF) -> DataFrame:
    """Flagship: every deadline period with its first on-time completion and status."""

    matched = _matched(spark, sf_dir, plan=plan, as_of=as_of)
    return matched.select(*S.WORKFLOW_KEY, "deadline_utc", "on_time_completion_utc", "sla_status")


def on_time_and_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.with_recovery(_matched(spark, sf_dir)).select(
        *S.WORKFLOW_KEY,
        "deadline_utc",
        "sla_status",
        "delivery_state",
        "on_time_completion_utc",
        "late_recovery_utc",
        "observed_completion_utc",
        "completion_margin_minutes",
        "display_margin_minutes",
    )


def latest_runs(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    settings, _, stored = _inputs(spark, sf_dir, as_of)
    plan = JoinPlan.measure(settings)
    recent = runs.recent_runs(stored, as_of, S.RUN_WINDOW_DAYS, terminal_only=False)
    known = workflows.configured_workflows(settings, as_of).select(*S.WORKFLOW_KEY, "job_id")
    return runs.latest_runs(attach(recent, known, plan))


def today_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.today_counts(_status_runs(spark, sf_dir), AS_OF)


def _due(which: str) -> Query:
    def due(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = periods.last_and_next_due(_matched(spark, sf_dir, CURRENT, S.RUN_WINDOW_DAYS))
        deadline, judged = f"{which}_deadline_utc", f"{which}_status"
        return found.filter(F.col(deadline).isNotNull()).select(*S.WORKFLOW_KEY, deadline, judged)

    return due


def window_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings, jobs, stored = _inputs(spark, sf_dir)
    known = workflows.monitored_workflows(settings, jobs, AS_OF)
    recent = runs.in_window(stored, AS_OF, S.SLA_RUN_WINDOW_DAYS)
    return checks.due_in_both_windows(known, recent, JoinPlan.measure(settings)).select(
        *S.WORKFLOW_KEY,
        "current_last_deadline_utc",
        "history_last_deadline_utc",
        "current_next_deadline_utc",
        "history_next_deadline_utc",
        "current_last_status",
        "history_last_status",
        "current_sla_status",
    )


def run_metrics_30d(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    recent = runs.in_window(data.run_state(spark, sf_dir, as_of), as_of, S.SLA_RUN_WINDOW_DAYS)
    return runs.run_metrics(runs.terminal(recent), as_of)


def _at(build: Callable[..., DataFrame], as_of: datetime) -> Query:
    return lambda spark, sf_dir: build(spark, sf_dir, as_of=as_of)


def _view(build: Query, cut: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: cut(build(spark, sf_dir))


_QUERIES: dict[str, Query] = {
    "result_state_mapping": result_state_mapping,
    "run_state_rows": data.run_state,
    "bounded_errors": bounded_errors,
    "collapsed_runs": collapsed_runs,
    "upsert_latest_runs": upsert_latest_runs,
    "stream_upsert_runs": stream_upsert_runs,
    "stream_restarted_runs": stream_restarted_runs,
    "rounds_in_reverse": rounds_in_reverse,
    "upsert_job_state": upsert_job_state,
    "expire_runs": expire_runs,
    "delete_missing_runs": delete_missing_runs,
    "purge_workspace": _view(data.run_state, lambda df: state.purge_workspace(df, "222")),
    "valid_workspaces": valid_workspaces,
    "incremental_windows": _windows,
    "checkpoints": checkpoints,
    "incremental_selection": incremental_selection,
    "reconcile_gap": _gap,
    "lookup_results": lookup_results,
    "collection_round_runs": lambda spark, sf_dir: _round(spark, sf_dir).runs,
    "collection_round_jobs": lambda spark, sf_dir: _round(spark, sf_dir).jobs,
    "failed_jobs": lambda spark, sf_dir: collection.failed_jobs(_round(spark, sf_dir).job_updates),
    "replace_workspace_config": replace_workspace_config,
    "config_difference": config_difference,
    "configured_order": configured_order,
    "config_errors": config_errors,
    "duplicate_jobs": duplicate_jobs,
    "candidate_jobs": candidate_jobs,
    "new_jobs": new_jobs,
    "default_entries": default_entries,
    "scoped_job_state": scoped_job_state,
    "monitored_workflows": monitored_workflows,
    "collection_health": collection_health,
    "deadlines_current": _deadlines(CURRENT),
    "deadlines_history": _deadlines(HISTORY),
    "deadline_periods": deadline_periods,
    "eligible_periods": eligible_periods,
    "deadline_status": deadline_status,
    "deadline_status_shuffled": lambda spark, sf_dir: deadline_status(spark, sf_dir, SHUFFLE),
    "on_time_and_late": on_time_and_late,
    "latest_runs": latest_runs,
    "today_counts": today_counts,
    "last_due": _due("last"),
    "next_due": _due("next"),
    "window_agreement": window_agreement,
    "run_metrics_30d": run_metrics_30d,
    "sla_metrics_30d": _view(_matched, periods.sla_metrics),
    "workflow_status": _status,
    "workflow_status_shuffled": lambda spark, sf_dir: _status(spark, sf_dir, SHUFFLE),
    "run_history": _run_history,
    "run_history_shuffled": lambda spark, sf_dir: _run_history(spark, sf_dir, SHUFFLE),
    "sla_history": _sla_history,
    "run_history_order": _view(_run_history, ordering.run_history_order),
    "sla_history_order": _view(_sla_history, ordering.sla_history_order),
    "sla_delivery_calendar": _view(_sla_history, charts.sla_delivery_calendar),
    "delivery_margin_timeline": _view(_sla_history, charts.delivery_margin_timeline),
    "workflow_risk_map": _view(_sla_history, charts.workflow_risk_map),
    "run_duration_lanes": _view(_run_history, charts.run_duration_lanes),
    "daily_run_outcomes": _view(_run_history, charts.daily_run_outcomes),
    "sla_compliance_trend": _view(_sla_history, charts.sla_compliance_trend),
    "current_workflow_health": _view(_status, status.current_workflow_health),
    "run_metrics_30d_in_february": _at(run_metrics_30d, data.IN_FEBRUARY),
    "sla_metrics_30d_in_february": _view(_at(_matched, data.IN_FEBRUARY), periods.sla_metrics),
    "sla_history_in_february": _at(_sla_history, data.IN_FEBRUARY),
    "incremental_selection_in_march": _at(incremental_selection, data.IN_MARCH),
    "reconcile_gap_in_march": _at(_gap, data.IN_MARCH),
    "latest_runs_in_march": _at(latest_runs, data.IN_MARCH),
    "run_history_in_march": _at(_run_history, data.IN_MARCH),
    "workflow_status_in_march": _at(_status, data.IN_MARCH),
    "deadline_status_in_april": _at(deadline_status, data.IN_APRIL),
}


def _registered(build: Query) -> Query:
    return lambda spark, sf_dir: _plain(build(use_utc(spark), sf_dir))


def entry(spark: SparkSession) -> DataFrame:

    return queries()["sla_history"](spark, "/root/testdata/sf0.001")


def _dealt() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the optional subpackage, if it is there."""

    try:
        import corpus_pipeline
        from llm import queries as dealt
    except ModuleNotFoundError as missing:
        if missing.name not in ("llm", "corpus_pipeline"):
            raise
        return {}, {}
    found, sql = dict(dealt.QUERIES), dict(dealt.ORACLES)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Query]:
    own = {name: _registered(build) for name, build in _QUERIES.items()}
    return own | {name: (lambda spark, sf_dir, build=build: build(use_utc(spark), sf_dir)) for name, build in _dealt()[0].items()}


def oracle_sql() -> dict[str, str]:
    return statements() | _dealt()[1]
