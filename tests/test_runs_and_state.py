import itertools
from datetime import UTC, datetime

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions import run_states
from punctual.functions.instants import epoch_ms_to_ts
from punctual.operators import catalogue, runs, state
from punctual.plans.collection import changed_runs, collect_round, failed_jobs, removed_runs

NOW = datetime(2026, 8, 25, 12, 0, tzinfo=UTC)


def raw(spark, *records):
    """Records of (workspace, job, run, start, end, state, code, kind[, observed])."""

    def ms(text):
        return int(at(text).timestamp() * 1000) if isinstance(text, str) else text

    full = [
        (str(ws), job, run, ms(start), ms(end), (lifecycle, (code,)) if lifecycle else None, kind, at(*seen) if seen else NOW)
        for ws, job, run, start, end, lifecycle, code, kind, *seen in records
    ]
    return spark.createDataFrame(full, S.RAW_RUN)


def expected_state(lifecycle, code):
    """The rule in words: only an ended run has a result, and only listed codes are no failure."""

    if lifecycle is None:
        return S.UNKNOWN
    if lifecycle.upper() == "INTERNAL_ERROR":
        return S.FAILED
    if lifecycle.upper() != "TERMINATED":
        return lifecycle.upper()
    lists = ((S.SUCCESS_CODES, S.SUCCEEDED), (S.CANCEL_CODES, S.CANCELLED), (S.SKIP_CODES, S.SKIPPED))
    return next((state for codes, state in lists if code in codes), S.FAILED)


def test_result_state_of_every_pair(spark):
    lifecycles = [None, "BLOCKED", "waiting", "Running", "TERMINATING", "TERMINATED", "INTERNAL_ERROR"]
    codes = [None, "DRIVER_ERROR", *S.SUCCESS_CODES, *S.CANCEL_CODES, *S.SKIP_CODES]
    pairs = list(itertools.product(lifecycles, codes))
    records = raw(spark, *[(7, 70, k, "2025-02-03 04:05", None, lifecycle, code, "active") for k, (lifecycle, code) in enumerate(pairs)])
    found = {r.run_id: r.result_state for r in runs.to_run_state(records, NOW).collect()}
    assert found == {k: expected_state(*pair) for k, pair in enumerate(pairs)}


def test_missing_start_takes_collection_time(spark):
    records = raw(spark, (1, 2, 3, 0, 0, "QUEUED", None, "active"), (1, 2, 4, None, None, "PENDING", None, "active"))
    assert rows(runs.to_run_state(records, NOW), "run_id", F.col("period_start_time") == F.lit(NOW), "period_end_time") == [
        (3, True, None),
        (4, True, None),
    ]


def test_epoch_zero_is_missing(spark):
    frame = spark.createDataFrame([(0,), (None,), (1500,)], "ms long")
    shown = frame.select(epoch_ms_to_ts(F.col("ms")).cast("string"))
    assert [row[0] for row in shown.collect()] == [None, None, "1970-01-01 00:00:01.5"]


def test_error_text_and_names(spark):
    texts = ["  a\n\t b  c \x1c", "x" * 600, "é" * 501]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row[0] for row in frame.select(run_states.bounded_error(F.col("t"))).collect()]
    assert got == [" ".join(t.split())[:500] for t in texts]
    names = spark.createDataFrame([("  Daily Orders\n",), (" \t",), (None,)], "n string")
    assert [row[0] for row in names.select(run_states.checked_job_name(F.col("n"))).collect()] == ["Daily Orders", None, None]


def test_workspace_ids(spark):
    frame = spark.createDataFrame([("111",), ("011",), ("1a",), (None,), ("1\n",)], "w string")
    got = [row[0] for row in frame.select(run_states.is_valid_workspace_id(F.col("w"))).collect()]
    assert got[:4] == [True, False, False, False]
    assert run_states.validated_workspace_id("8040") == "8040"
    for bad in ("08", "", "8; DROP TABLE x", "8\n"):
        with pytest.raises(ValueError, match="without leading zeros"):
            run_states.validated_workspace_id(bad)
    assert run_states.quoted("lake", "state-2") == "`lake`.`state-2`"
    with pytest.raises(ValueError, match="as a name"):
        run_states.quoted("x`y")


def test_later_feed_wins(spark):
    start = "2026-08-24 00:00"
    feeds = [
        raw(spark, (1, 2, 3, start, start, "TERMINATED", "SUCCESS", "completed")),
        raw(spark, (1, 2, 3, start, None, "RUNNING", None, "active"), (1, 2, 4, start, None, "RUNNING", None, "active")),
        raw(spark, (1, 2, 4, start, start, "TERMINATED", "CANCELED", "detail")),
    ]
    combined = runs.to_run_state(state.combine_feeds(*feeds), NOW)
    assert rows(combined, "run_id", "result_state") == [(3, "RUNNING"), (4, "CANCELLED")]


def test_newest_observation_wins_inside_a_feed(spark):
    start = "2026-08-24 00:00"
    feed = raw(
        spark,
        (1, 2, 3, start, start, "TERMINATED", "SUCCESS", "completed", "2026-08-24 02:00"),
        (1, 2, 3, start, None, "RUNNING", None, "completed", "2026-08-24 01:00"),
    )
    assert rows(runs.to_run_state(state.combine_feeds(feed), NOW), "result_state") == [("SUCCEEDED",)]


def test_upsert_runs_is_idempotent(make):
    stored = make.runs((1, 2, 3, "2026-08-24 00:00", None, "RUNNING"), (1, 2, 9, "2026-08-23 00:00", None, "RUNNING"))
    incoming = make.runs((1, 2, 3, "2026-08-24 00:00", "2026-08-24 01:00", "SUCCEEDED"), (2, 2, 3, "2026-08-24 00:00", None, "RUNNING"))
    once = state.upsert_runs(stored, incoming)
    assert rows(once, "workspace_id", "run_id", "result_state") == [
        ("1", 3, "SUCCEEDED"),
        ("1", 9, "RUNNING"),
        ("2", 3, "RUNNING"),
    ]
    assert rows(state.upsert_runs(once, incoming)) == rows(once)


def test_upsert_jobs_keeps_name_and_success_and_clears_error(make):
    stored = make.jobs(
        (1, 1, "old", "2026-08-24 00:00", "2026-08-24 00:00", None),
        (1, 2, "two", "2026-08-24 00:00", "2026-08-24 00:00", "broken"),
        (1, 3, "three", "2026-08-24 00:00", None, "still broken"),
    )
    updates = make.jobs(
        (1, 1, None, "2026-08-25 00:00", None, "failed now"),
        (1, 2, "two!", "2026-08-25 00:00", "2026-08-25 00:00", None),
        (1, 4, None, "2026-08-25 00:00", None, "new"),
    )
    merged = state.upsert_jobs(stored, updates)
    success = F.date_format("last_successful_collection_at", "dd")
    assert rows(merged, "job_id", "job_name", success, "last_error_message") == [
        ("1", "old", "24", "failed now"),
        ("2", "two!", "25", None),
        ("3", "three", None, "still broken"),
        ("4", None, None, "new"),
    ]


def test_expire_only_one_workspace_at_the_exact_instant(make):
    stored = make.runs(
        (1, 1, 1, "2026-06-26 11:59:59", None, "RUNNING"),
        (1, 1, 2, "2026-06-26 12:00:00", None, "RUNNING"),
        (2, 1, 3, "2026-06-01 00:00:00", None, "RUNNING"),
    )
    assert rows(state.expire_runs(stored, "1", state.retention_cutoff(NOW)), "run_id") == [(2,), (3,)]


def test_replace_workspace_by_nothing(make):
    stored = make.config((1, 1, 5, "daily", "06:00", "UTC", {}), (2, 1, 6, "daily", "06:00", "UTC", {}))
    assert rows(state.replace_workspace(stored, "1", stored.limit(0)), "workspace_id") == [("2",)]
    assert rows(state.purge_workspace(stored, "2"), "workspace_id") == [("1",)]


def test_windows_resume_before_the_last_success(spark, make):
    """The overlap lies before the last success; no success, or one beyond the retention, reads all of it."""

    back = {"31": "2026-08-25 09:30", "32": "2026-06-26 12:15", "33": "2026-06-26 12:14", "34": "2026-02-02 00:00", "35": None}
    jobs = make.jobs(
        *[(8, job, "j", "2026-08-25 11:00", success, None) for job, success in back.items()],
        (9, 31, "other workspace", "2026-08-25 11:00", "2026-08-25 11:00", None),
        (8, 36, "not monitored", "2026-08-25 11:00", "2026-08-25 11:00", None),
    )
    monitored = spark.createDataFrame([("8", job) for job in [*back, "37"]], "workspace_id string, job_id string")
    assert rows(state.checkpoints(jobs, monitored), "job_id") == [("31",), ("32",), ("33",), ("34",)]
    windows = state.incremental_windows(monitored, jobs, NOW)
    whole = "2026-06-26 12:00:00"
    assert rows(windows, "job_id", F.col("incremental_start_at").cast("string")) == [
        ("31", "2026-08-25 09:15:00"), *[(job, whole) for job in ("32", "33", "34", "35", "37")],
    ]
    assert {r[0] for r in rows(windows, F.col("history_start_at").cast("string"))} == {whole}


def test_gap_holds_open_runs_between_the_bounds(spark, make):
    low, high = "2025-10-01 00:00", "2025-11-01 00:00"
    cases = {
        1: ("5", "50", low, "RUNNING", True),
        2: ("5", "50", "2025-09-30 23:59:59", "RUNNING", False),
        3: ("5", "50", "2025-10-31 23:59:59", "QUEUED", True),
        4: ("5", "50", high, "QUEUED", False),
        **{5 + k: ("5", "50", "2025-10-10 10:00", state, False) for k, state in enumerate(S.TERMINAL_STATES)},
        20: ("6", "50", "2025-10-10 10:00", "RUNNING", False),
        21: ("5", "51", "2025-10-10 10:00", "RUNNING", False),
        22: ("5", "50", "2025-10-10 10:00", S.UNKNOWN, True),
    }
    stored = make.runs(*[(ws, job, run, start, None, result) for run, (ws, job, start, result, _) in cases.items()])
    windows = spark.createDataFrame(
        [("5", "50", at(low), at(high))],
        "workspace_id string, job_id string, history_start_at timestamp, incremental_start_at timestamp",
    )
    assert {run for (run,) in rows(state.nonterminal_gap(stored, windows), "run_id")} == {run for run, case in cases.items() if case[-1]}


@pytest.fixture
def scenario(spark, make):
    """One job, last collected at 11:00, so its window begins at 10:45; the runs are named for what becomes of them."""

    job, ended = (5, 61), "2026-08-25 11:30"
    OLD, GONE, DONE, LISTED, SILENT, NEW, EARLY = range(201, 208)
    stored = make.runs(
        (*job, OLD, "2026-06-26 11:59", None, "RUNNING"),
        (*job, GONE, "2026-07-30 08:00", None, "RUNNING"),
        (*job, DONE, "2026-08-02 08:00", None, "QUEUED"),
        (*job, LISTED, "2026-08-25 10:45", None, "RUNNING"),
        (*job, SILENT, "2026-08-03 08:00", None, "RUNNING"),
    )
    feed = raw(
        spark,
        (*job, NEW, "2026-08-25 10:45", ended, "TERMINATED", S.CANCEL_CODES[0], "completed"),
        (*job, EARLY, "2026-08-25 10:44:59", ended, "TERMINATED", S.SUCCESS_CODES[0], "completed"),
        (*job, LISTED, "2026-08-25 10:45", None, "RUNNING", None, "active"),
        (*job, GONE, None, None, None, None, "missing"),
        (*job, LISTED, None, None, None, None, "missing"),
        (*job, DONE, "2026-08-02 08:00", "2026-08-02 09:00", "INTERNAL_ERROR", None, "detail"),
        (5, 62, 1, ended, None, "RUNNING", None, "active"),
    )
    jobs = make.jobs((*job, "before", "2026-08-25 11:00", "2026-08-25 11:00", "of last time"))
    config = make.config((*job[:1], 1, job[1], "daily", "21:05", "UTC", {}))
    details = spark.createDataFrame([("5", 61, ("\tweather grid ",))], S.JOB_DETAILS)

    def collect(*errors, names=details):
        reported = spark.createDataFrame([("5", 61, *error) for error in errors], S.COLLECTION_ERRORS)
        return collect_round(stored, jobs, config, feed, names, reported, NOW)

    return collect


def test_round_without_errors(scenario):
    result = scenario()
    assert rows(result.runs, "run_id", "result_state") == [(203, "FAILED"), (204, "RUNNING"), (205, "RUNNING"), (206, "CANCELLED")]
    assert rows(removed_runs(result.changes), "run_id") == [(202,)]
    success = F.col("last_successful_collection_at") == F.lit(NOW)
    assert rows(result.jobs, "job_name", success, "last_error_message") == [("weather grid", True, None)]


# A failing stage, the records that arrive all the same, and whether confirmed absences still count.
STAGES = {"details": ([], False), "completed": ([206], False), "active": ([204, 206], False), "lookup": ([203, 204, 206], True)}


@pytest.mark.parametrize("stage", STAGES)
def test_failed_stage_hides_later_ones(scenario, stage):
    arrived, removes = STAGES[stage]
    result = scenario((stage, f"{stage}\n  timed\tout"))
    assert sorted(run for (run,) in rows(changed_runs(result.changes, NOW), "run_id")) == arrived
    assert rows(removed_runs(result.changes), "run_id") == ([(202,)] if removes else [])
    success = F.col("last_successful_collection_at").cast("string")
    assert rows(result.jobs, success, "last_error_message") == [("2026-08-25 11:00:00", f"{stage} timed out")]
    assert rows(failed_jobs(result.job_updates), "job_id") == [("61",)]


def test_blank_name_fails_the_job(spark, scenario):
    for name in (" \n", None):
        result = scenario(names=spark.createDataFrame([("5", 61, (name,))], S.JOB_DETAILS))
        assert rows(result.job_updates, "last_error_message") == [("Jobs API returned no name for job ID 61",)]
        assert result.changes.count() == 0


def test_catalogue(spark):
    names = {4: "Zebra count", 7: None, 11: "ärger  report", 15: "zebra feed", 16: "", 23: "Ärger mail", 9007: "twin"}
    jobs = spark.createDataFrame(list(names.items()), "job_id long, name string")
    listed = spark.createDataFrame([(9007,), (15,)], "job_id long")
    shown = catalogue.candidate_jobs(jobs, listed, ordered=True).collect()
    assert {r["job_id"] for r in shown if r["already_monitored"]} == {9007, 15} and len(shown) == len(names)
    folded = [(r["name"] or "").upper().lower() for r in shown]
    assert folded == sorted(folded)
    assert {job for (job,) in rows(catalogue.candidate_jobs(jobs, listed, "ÄRGER"), "job_id")} == {11, 23}
    assert {job for (job,) in rows(catalogue.candidate_jobs(jobs, listed, "zEBRA"), "job_id")} == {4, 15}
    entries = rows(catalogue.default_entries(catalogue.new_jobs(jobs, listed), "18:40"))
    assert {entry[0] for entry in entries} == {4, 7, 11, 16, 23}
    assert (11, "active", "daily", "18:40", "ärger report") in entries
    for bad in ("18:4", "24:00", ""):
        with pytest.raises(ValueError, match="HH:MM"):
            catalogue.default_entries(jobs, bad)
