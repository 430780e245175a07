import json

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.operators.joins import BROADCAST
from punctual.operators.state import retention_cutoff
from punctual.sources import feeds
from punctual.sources import store as store_module
from punctual.sources.store import StateStore
from punctual.streaming.collector import collect_batch, collect_documents, evaluate_batch, once, start_run_stream, upsert_batch

NOW = at("2026-08-25 12:00")


@pytest.fixture
def store(spark, request):
    namespace = "s_" + request.node.name.replace("[", "_").replace("]", "")
    store = StateStore(spark, namespace, shards=3)
    store.ensure_tables(create_namespace=True)
    store.ensure_tables()
    return store


def test_tables_have_schema_and_comments(spark, store):
    for table, read, schema in (
        (S.RUN_STATE_TABLE, store.runs(), S.RUN_STATE),
        (S.JOB_STATE_TABLE, store.jobs(), S.JOB_STATE),
        (S.SLA_CONFIG_TABLE, store.config(), S.SLA_CONFIG),
    ):
        assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in schema]
        comments = {c.name: c.description for c in spark.catalog.listColumns(f"{store.namespace}.{table}")}
        assert comments["workspace_id"] == "Workspace that owns the job"


def test_commit_rewrites_only_touched_dates(spark, store, make):
    store.commit_runs(
        make.runs(
            (1, 1, 1, "2026-08-20 10:00", None, "RUNNING"),
            (1, 1, 2, "2026-08-21 10:00", None, "RUNNING"),
            (2, 1, 1, "2026-08-20 10:00", None, "RUNNING"),
        )
    )

    def files():
        stored = spark.table(store.name(S.RUN_STATE_TABLE)).select("shard", "start_date", F.input_file_name())
        return {(r[0], str(r[1])): r[2] for r in stored.collect()}

    before = files()
    store.commit_runs(make.runs((1, 1, 2, "2026-08-21 10:00", "2026-08-21 11:00", "SUCCEEDED")))
    after = files()
    assert [date for (_, date), file in before.items() if file != after[_, date]] == ["2026-08-21"]
    assert rows(store.runs(), "workspace_id", "run_id", "result_state") == [
        ("1", 1, "RUNNING"),
        ("1", 2, "SUCCEEDED"),
        ("2", 1, "RUNNING"),
    ]


def test_a_batch_looks_for_its_keys_in_their_shards(spark, store, make, capsys):
    store.commit_runs(make.runs((1, 1, 1, "2026-08-20 10:00", None, "RUNNING"), (2, 1, 2, "2026-08-21 10:00", None, "RUNNING")))
    keys = make.runs((2, 1, 2, "2026-08-21 10:00", None, "RUNNING")).select(*S.RUN_KEY)
    store.observations(keys).explain("formatted")
    plan = capsys.readouterr().out
    assert "shard" in plan.split("PartitionFilters: ")[1].splitlines()[0]
    assert "period_start_time" not in plan.split("ReadSchema: ")[1].splitlines()[0]
    assert rows(store.observations(keys), "run_id") == [(2,)]


def test_touched_partitions_prune_the_scan(store, make, capsys):
    store.commit_runs(make.runs((1, 1, 1, "2026-08-20 10:00", None, "RUNNING"), (1, 1, 2, "2026-08-21 10:00", None, "RUNNING")))
    store.runs(at("2026-08-21 00:00")).explain("formatted")
    assert "start_date" in capsys.readouterr().out.split("PartitionFilters: ")[1].splitlines()[0]


@pytest.mark.parametrize("limit", [0, 1000])
def test_commit_with_many_and_few_keys(store, make, monkeypatch, limit):
    monkeypatch.setattr(store_module, "BROADCAST_KEYS", limit)
    store.commit_runs(make.runs((1, 1, 1, "2026-08-20 10:00", None, "RUNNING"), (1, 1, 2, "2026-08-20 10:00", None, "RUNNING")))
    gone = make.runs((1, 1, 2, "2026-08-20 10:00", None, "RUNNING"))
    store.commit_runs(make.runs((1, 1, 1, "2026-08-20 10:00", None, "QUEUED")), gone)
    assert rows(store.runs(), "run_id", "result_state") == [(1, "QUEUED")]
    store.commit_runs(store.runs().limit(0), store.runs())
    assert rows(store.runs()) == []


def test_a_run_can_move_to_its_real_start_and_be_removed(store, make):
    store.commit_runs(make.runs((1, 1, 1, "2026-08-25 10:00", None, "QUEUED"), (1, 1, 2, "2026-08-24 10:00", None, "RUNNING")))
    store.commit_runs(
        make.runs((1, 1, 1, "2026-08-23 09:00", None, "RUNNING")),
        make.runs((1, 1, 2, "2026-08-24 10:00", None, "RUNNING")).select(*S.RUN_KEY),
    )
    assert rows(store.runs(), "run_id", "result_state") == [(1, "RUNNING")]
    assert rows(store.runs(at("2026-08-23 10:00")), "run_id") == []
    assert rows(store.runs(at("2026-08-23 09:00")), "run_id") == [(1,)]


def test_expire_and_purge(store, make):
    store.commit_runs(
        make.runs(
            (1, 1, 1, "2026-06-20 10:00", None, "RUNNING"),
            (1, 1, 2, "2026-06-26 11:59", None, "RUNNING"),
            (1, 1, 3, "2026-06-26 12:00", None, "RUNNING"),
            (2, 1, 4, "2026-06-20 10:00", None, "RUNNING"),
        )
    )
    store.expire(retention_cutoff(NOW), store.spark.createDataFrame([("1",)], "workspace_id string"))
    assert rows(store.runs(), "run_id") == [(3,), (4,)]
    assert rows(store.observations(), "run_id") == [(3,), (4,)]
    store.purge("2")
    assert rows(store.runs(), "run_id") == [(3,)]


def test_config_replacement(store, make):
    mine = make.config((1, 1, 5, "daily", "06:00", "UTC", {}), (1, 2, 6, "daily", "06:00", "UTC", {}))
    assert store.replace_config("2", make.config((2, 1, 7, "daily", "06:00", "UTC", {})))
    assert store.replace_config("1", mine)
    later = mine.withColumn("config_changed_at", F.lit(NOW))
    assert not store.replace_config("1", later)
    assert store.config().filter(F.col("config_changed_at") == F.lit(NOW)).count() == 0
    assert store.replace_config("1", later.filter("configured_order = 1"))
    assert rows(store.config(), "workspace_id", "configured_order") == [("1", 1), ("2", 1)]
    # An empty configuration removes the rows instead of keeping the old partition.
    assert store.replace_config("1", mine.limit(0))
    assert rows(store.config(), "workspace_id") == [("2",)]


def record(job, run, start, end=None, state="TERMINATED", code="SUCCESS", kind="completed", ws="111", seen=NOW):
    ms = lambda text: int(at(text).timestamp() * 1000) if text else None
    return (ws, job, run, ms(start), ms(end), (state, (code,)), kind, seen)


def test_collect_batch_end_to_end(spark, store, make):
    store.replace_config("111", make.config((111, 1, 42, "daily", "06:00", "UTC", {}), (111, 2, 43, "daily", "06:00", "UTC", {})))
    store.commit_jobs(make.jobs((111, 42, "Orders", "2026-08-25 11:55", "2026-08-25 11:55", None)))
    store.commit_runs(make.runs((111, 42, 700, "2026-06-11 12:00", None, "RUNNING"), (111, 42, 900, "2026-08-23 12:00", None, "RUNNING")))
    batch = spark.createDataFrame(
        [
            record(42, 1000, "2026-08-25 05:00", "2026-08-25 05:30"),
            record(42, 1001, "2026-08-25 11:50", None, "RUNNING", None, "active"),
            record(42, 900, "2026-08-23 12:00", "2026-08-23 13:00", kind="detail"),
            record(43, 2000, "2026-08-25 05:00", "2026-08-25 05:30"),
        ],
        S.RAW_RUN,
    )
    details = spark.createDataFrame([("111", 42, ("Orders",))], S.JOB_DETAILS)
    errors = spark.createDataFrame([], S.COLLECTION_ERRORS)
    for _ in range(2):  # repeating a batch changes nothing
        failed = collect_batch(store, batch, details, errors, NOW)
        assert rows(failed) == [("111", "43", "Jobs API returned no name for job ID 43")]
        # 1000 started before the incremental window of job 42, so only its later run arrives.
        assert rows(store.runs(), "run_id", "result_state") == [(1001, "RUNNING"), (900, "SUCCEEDED")]
    with pytest.raises(RuntimeError, match="failed for 1 jobs: see last_error_message in"):
        collect_batch(store, batch, details, errors, NOW, raise_on_failure=True)
    status, matched = evaluate_batch(store, batch, NOW, BROADCAST)
    assert rows(status, "workflow_name", "latest_run_result") == [("Job 43", None), ("Orders", "RUNNING")]
    assert matched.count() > 0


def test_empty_config_still_expires(spark, store, make):
    store.commit_runs(make.runs((111, 42, 700, "2026-06-11 12:00", None, "RUNNING")))
    empty = [spark.createDataFrame([], schema) for schema in (S.RAW_RUN, S.JOB_DETAILS, S.COLLECTION_ERRORS)]
    collect_batch(store, *empty, NOW)
    assert store.runs().count() == 0


def test_failed_jobs_are_counted_and_listed(spark, store, make):
    store.replace_config("111", make.config(*[(111, i, i, "daily", "06:00", "UTC", {}) for i in range(1, 31)]))
    empty = [spark.createDataFrame([], schema) for schema in (S.RAW_RUN, S.JOB_DETAILS, S.COLLECTION_ERRORS)]
    with pytest.raises(RuntimeError, match="failed for 30 jobs"):
        collect_batch(store, *empty, NOW, raise_on_failure=True)
    assert store.jobs().filter("last_error_message is not null").count() == 30


def test_missing_and_late_records_of_a_stream(spark, store):
    feed = lambda *records: spark.createDataFrame(list(records), S.RAW_RUN)
    upsert_batch(store, feed(record(1, 1, "2026-08-24 05:00", "2026-08-24 06:00", seen=at("2026-08-25 13:00")), record(1, 2, "2026-08-24 05:00")), NOW)
    # an hour older, landed later
    upsert_batch(store, feed(record(1, 1, "2026-08-24 05:00", None, "RUNNING", None, "active"), record(1, 2, None, kind="missing")), NOW)
    assert rows(store.runs(), "run_id", "result_state") == [(1, "SUCCEEDED")]


def test_an_older_record_changes_nothing_in_a_later_round(spark, store, make):
    store.replace_config("111", make.config((111, 1, 42, "daily", "06:00", "UTC", {})))
    details = spark.createDataFrame([("111", 42, ("Orders",))], S.JOB_DETAILS)
    errors = spark.createDataFrame([], S.COLLECTION_ERRORS)
    finished = record(42, 1, "2026-08-25 11:53", "2026-08-25 11:57", seen=at("2026-08-25 11:58"))
    running = record(42, 1, "2026-08-25 11:53", None, "RUNNING", None, "active", seen=at("2026-08-25 11:54"))
    for later, seen in ((finished, 0), (running, 5)):
        collect_batch(store, spark.createDataFrame([later], S.RAW_RUN), details, errors, at(f"2026-08-25 12:0{seen}"))
    assert rows(store.runs(), "run_id", "result_state") == [(1, "SUCCEEDED")]
    # The same instant and feed, and anything newer, counts.
    newer = record(42, 1, "2026-08-25 11:53", "2026-08-25 11:57", code="CANCELED", seen=at("2026-08-25 11:58"))
    collect_batch(store, spark.createDataFrame([newer], S.RAW_RUN), details, errors, at("2026-08-25 12:06"))
    assert rows(store.runs(), "run_id", "result_state") == [(1, "CANCELLED")]


def test_a_removed_run_stays_away_from_older_records(spark, store):
    feed = lambda *records: spark.createDataFrame(list(records), S.RAW_RUN)
    gone = [record(1, run, None, kind="missing", seen=at("2026-08-25 11:00")) for run in (1, 2)]
    upsert_batch(store, feed(record(1, 1, "2026-08-24 05:00", None, "RUNNING", None, "active", seen=at("2026-08-25 10:00"))), NOW)
    upsert_batch(store, feed(*gone), NOW)  # 2 was never stored
    older = [record(1, run, "2026-08-24 05:00", None, "RUNNING", None, "active", seen=at("2026-08-25 10:30")) for run in (1, 2)]
    upsert_batch(store, feed(*older), NOW)
    assert rows(store.runs()) == []
    newer = [record(1, run, "2026-08-24 05:00", "2026-08-24 06:00", seen=at("2026-08-25 11:30")) for run in (1, 2)]
    upsert_batch(store, feed(*newer), NOW)
    assert rows(store.runs(), "run_id", "result_state") == [(1, "SUCCEEDED"), (2, "SUCCEEDED")]
    # Removal by a plain key keeps the order that was known.
    store.commit_runs(store.runs().limit(0), store.runs())
    upsert_batch(store, feed(*older), NOW)
    assert rows(store.runs()) == []


def test_a_commit_that_breaks_off_is_applied_again(store, make):
    old = make.runs((1, 1, 1, "2026-08-20 10:00", None, "RUNNING"), (1, 1, 2, "2026-08-20 11:00", None, "RUNNING"))
    store.commit_runs(old)
    new = make.runs((1, 1, 1, "2026-08-20 10:00", None, "QUEUED"))
    broken = F.when(F.col("run_id") < 5, F.raise_error(F.lit("lost"))).otherwise(F.col("result_state"))
    with pytest.raises(Exception, match="lost"):
        store._overwrite(S.RUN_STATE_TABLE, store._stored(S.RUN_STATE_TABLE).withColumn("result_state", broken))
    assert rows(store.runs()) == rows(old)
    for _ in range(2):
        store.commit_runs(new)
        assert rows(store.runs(), "run_id", "result_state") == [(1, "QUEUED"), (2, "RUNNING")]


def test_everything_old_expires(spark, store, make):
    feed = lambda *records: spark.createDataFrame(list(records), S.RAW_RUN)
    upsert_batch(store, feed(record(1, 1, "2026-05-01 05:00", "2026-05-01 06:00", seen=at("2026-05-01 07:00"))), NOW)
    upsert_batch(store, feed(record(1, 2, None, kind="missing", seen=at("2026-05-01 07:00"))), NOW)
    upsert_batch(store, feed(record(1, 3, "2026-06-26 11:00", "2026-06-26 11:30", seen=at("2026-06-26 13:00"))), NOW)
    store.expire(retention_cutoff(NOW))
    assert spark.table(store.name(S.RUN_STATE_TABLE)).count() == 0 and rows(store.observations()) == []
    assert spark.sql(f"SHOW PARTITIONS {store.name(S.RUN_STATE_TABLE)}").count() == 0


def test_a_stopped_batch_is_applied_once_more_with_its_instant(spark, store, tmp_path):
    landing = str(tmp_path / "landing")
    for part in range(3):
        unstarted = [record(1, 10 * part + i, None, None, "QUEUED", None, "active", seen=at(f"2026-08-25 1{part}:00")) for i in range(4)]
        spark.createDataFrame(unstarted, S.RAW_RUN).coalesce(1).write.mode("append").parquet(landing)
    feed = feeds.stream_run_feed(spark, landing, files_per_batch=1)
    hours, applied = iter(range(24)), []

    def run(fail_at, after_commit):
        def apply(batch, collected_at):
            if len(applied) == fail_at and not after_commit:
                applied.append("before")
                raise InterruptedError("stopped")
            upsert_batch(store, batch, collected_at)
            applied.append(collected_at)
            if len(applied) == fail_at + 1 and after_commit:
                raise InterruptedError("stopped")

        clock = lambda: at(f"2026-08-26 {next(hours):02d}:00")
        query = start_run_stream(store, feed, apply, str(tmp_path / "offsets"), True, clock)
        try:
            query.awaitTermination()
        except Exception:
            return query.id
        return query.id

    first = run(1, after_commit=True)
    assert run(3, after_commit=False) == first
    assert run(-1, after_commit=True) == first
    starts = {r["run_id"]: r["period_start_time"].hour for r in store.runs().collect()}
    assert starts == {10 * part + i: part for part in range(3) for i in range(4)}
    assert [a if a == "before" else a.hour for a in applied] == [0, 1, 1, "before", 2]
    last = store.last_batch(first)
    assert (last["batch_id"], last["finished"]) == (2, True)


def test_a_finished_batch_is_skipped(spark, store):
    context, seen = spark.sparkContext, []
    context.setLocalProperty("sql.streaming.queryId", "q")
    try:
        run = once(store, lambda batch, collected_at: seen.append(collected_at), lambda: NOW)
        for batch_id in (4, 4, 3, 5):
            run(spark.range(1), batch_id)
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)
    assert seen == [NOW, NOW]


def test_a_commit_over_thousands_of_workspaces(spark, store):
    many = spark.range(5000).selectExpr(
        "cast(id + 1 as string) workspace_id", "'1' job_id", "id run_id", "timestamp'2026-08-20 10:00:00' period_start_time",
        "cast(null as timestamp) period_end_time", "'RUNNING' result_state",
    )
    store.commit_runs(many.repartition(2))
    assert store.runs().count() == 5000


def test_rows_of_another_workspace_are_refused(store, make):
    with pytest.raises(ValueError, match="workspace 1"):
        store.replace_config("1", make.config((2, 1, 5, "daily", "06:00", "UTC", {})))


def test_documents_to_a_committed_round(spark, store):
    documents = spark.createDataFrame([("111", "{"), ("112", json.dumps({"version": 3, "workflows": ["{}"]}))], "workspace_id string, document string")
    empty = [spark.createDataFrame([], schema) for schema in (S.RAW_RUN, S.JOB_DETAILS, S.COLLECTION_ERRORS)]
    problems, failed = collect_documents(store, documents, *empty, NOW)
    assert {r["workspace_id"] for r in problems.collect()} == {"111", "112"} and failed.count() == 0
    assert any("is not of type 'object'" in r["message"] for r in problems.collect())
    assert store.config().count() == 0


def test_stream_equals_batch(spark, store, tmp_path):
    first = [record(1, i, "2026-08-24 05:00", None, "RUNNING", None, "active") for i in range(20)]
    second = [record(1, i, "2026-08-24 05:00", "2026-08-24 06:00", kind="completed", seen=at("2026-08-25 13:00")) for i in range(0, 20, 2)]
    third = [record(1, i, "2026-08-24 05:00", "2026-08-24 06:00", code="CANCELED", kind="detail") for i in range(0, 20, 3)]
    landing = str(tmp_path / "landing")
    for part in (first, second, third):
        spark.createDataFrame(part, S.RAW_RUN).coalesce(1).write.mode("append").parquet(landing)
    feed = feeds.stream_run_feed(spark, landing, files_per_batch=1)
    query = start_run_stream(store, feed, lambda batch, _: upsert_batch(store, batch, NOW), str(tmp_path / "offsets"), available_now=True)
    query.awaitTermination()
    expected = [(i, "SUCCEEDED" if i % 2 == 0 else "CANCELLED" if i % 3 == 0 else "RUNNING") for i in range(20)]
    assert rows(store.runs(), "run_id", "result_state") == sorted(expected, key=str)


def test_feed_readers(spark, tmp_path, capsys):
    path = str(tmp_path / "feed")
    spark.createDataFrame(
        [record(1, 1, "2026-08-24 05:00"), record(1, 2, "2026-08-25 05:00"), record(1, 3, "2026-08-25 05:00", kind="active")], S.RAW_RUN
    ).write.parquet(path)
    recent = feeds.read_run_feed(spark, path, "completed", at("2026-08-25 00:00"))
    assert rows(recent, "run_id") == [(2,)]
    recent.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(start_time" in plan and "EqualTo(feed_kind,completed)" in plan
    jobs = tmp_path / "jobs.json"
    jobs.write_text(json.dumps({"job_id": 5, "settings": {"name": "five"}}) + "\n" + json.dumps({"job_id": 6}))
    assert rows(feeds.read_job_catalogue(spark, str(jobs))) == [(5, "five"), (6, None)]
    documents = tmp_path / "documents"
    documents.mkdir()
    (documents / "111.json").write_text('{\n "version": 3 }')
    assert rows(feeds.read_config_documents(spark, str(documents)), "workspace_id") == [("111",)]
