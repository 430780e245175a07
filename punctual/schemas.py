"""Table schemas, vocabularies and constants."""

from __future__ import annotations

from pyspark.sql import types as T

# Table names, states, codes, windows and thresholds that results depend on.
RUN_STATE_TABLE = "workflow_run_api_state"
JOB_STATE_TABLE = "workflow_job_api_state"
SLA_CONFIG_TABLE = "workflow_sla_config"
BATCH_TABLE = "workflow_collection_batches"

SUCCEEDED, FAILED, CANCELLED, SKIPPED = "SUCCEEDED", "FAILED", "CANCELLED", "SKIPPED"
UNSUCCESSFUL_STATES = (FAILED, CANCELLED, SKIPPED)
TERMINAL_STATES = (SUCCEEDED, *UNSUCCESSFUL_STATES)
UNKNOWN = "UNKNOWN"
SUCCESS_CODES = ("SUCCESS",)
CANCEL_CODES = ("CANCELED", "USER_CANCELED")
SKIP_CODES = ("DISABLED", "SKIPPED", "MAX_CONCURRENT_RUNS_EXCEEDED", "MAX_JOB_QUEUE_SIZE_EXCEEDED")

FREQUENCIES = ("daily", "weekly", "fortnightly", "monthly")
WEEKDAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
MONITORING_STATUSES = ("active", "inactive")

CONFIG_VERSION = 3
RETENTION_DAYS = 60
RUN_WINDOW_DAYS = 60
SLA_RUN_WINDOW_DAYS = 100
METRIC_WINDOW_DAYS = 30
DISPLAY_WINDOW_DAYS = 60
STALE_MINUTES = 20
OVERLAP_MINUTES = 15
SLA_TARGET_RATE = "0.99"
ERROR_TEXT_LENGTH = 500
CHART_RUNS = 100
CALENDAR_FIRST_OFFSET, CALENDAR_LAST_OFFSET = -59, 31

# One workflow is one row of the configuration. Orders restart in every workspace, so the
# workspace is part of the key.
WORKFLOW_KEY = ["workspace_id", "configured_order"]
JOB_KEY = ["workspace_id", "job_id"]
RUN_KEY = ["workspace_id", "job_id", "run_id"]


def _field(name: str, kind: T.DataType, nullable: bool, comment: str) -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment})


RUN_STATE = T.StructType(
    [
        _field("workspace_id", T.StringType(), False, "Workspace that owns the job"),
        _field("job_id", T.StringType(), False, "Job identifier"),
        _field("run_id", T.LongType(), False, "Run identifier"),
        _field("period_start_time", T.TimestampType(), False, "Start of the run, UTC"),
        _field("period_end_time", T.TimestampType(), True, "End of a finished run, UTC"),
        _field("result_state", T.StringType(), False, "Normalised state of the run"),
    ]
)

OBSERVED = T.StructType(
    [
        _field("workspace_id", T.StringType(), False, "Workspace that owns the job"),
        _field("job_id", T.StringType(), False, "Job identifier"),
        _field("run_id", T.LongType(), False, "Run identifier"),
        _field("observed_at", T.TimestampType(), True, "When the stored state was observed, UTC"),
        _field("feed_rank", T.IntegerType(), True, "Rank of the feed that showed it"),
    ]
)

BATCHES = T.StructType(
    [
        _field("query_id", T.StringType(), False, "Identifier of the stream, fixed by its checkpoint"),
        _field("batch_id", T.LongType(), False, "Number of its last micro-batch"),
        _field("collected_at", T.TimestampType(), False, "Instant given to that batch, UTC"),
        _field("finished", T.BooleanType(), False, "Whether all commits of the batch ended"),
    ]
)

JOB_STATE = T.StructType(
    [
        _field("workspace_id", T.StringType(), False, "Workspace that owns the job"),
        _field("job_id", T.StringType(), False, "Job identifier"),
        _field("job_name", T.StringType(), True, "Last job name collected"),
        _field("last_collection_attempt_at", T.TimestampType(), False, "Last attempt, UTC"),
        _field("last_successful_collection_at", T.TimestampType(), True, "Last success, UTC"),
        _field("last_error_message", T.StringType(), True, "Bounded error text of the last attempt"),
    ]
)

SLA_CONFIG = T.StructType(
    [
        _field("workspace_id", T.StringType(), False, "Workspace that owns the job"),
        _field("configured_order", T.IntegerType(), False, "Position among the active entries, from 1"),
        _field("configured_job_id", T.StringType(), False, "Job identifier in the configuration"),
        _field("frequency", T.StringType(), False, "Schedule frequency"),
        _field("completion_time", T.StringType(), False, "Local deadline time, HH:MM"),
        _field("timezone", T.StringType(), False, "IANA zone of the deadline"),
        _field("day_of_week", T.StringType(), True, "Day of a weekly schedule"),
        _field("first_deadline_date", T.DateType(), True, "First date of a 14-day schedule"),
        _field("day_of_month", T.IntegerType(), True, "Day of a monthly schedule"),
        _field("config_changed_at", T.TimestampType(), False, "Instant of the last change, UTC"),
    ]
)

RAW_RUN = T.StructType(
    [
        T.StructField("workspace_id", T.StringType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("start_time", T.LongType()),
        T.StructField("end_time", T.LongType()),
        T.StructField(
            "status",
            T.StructType(
                [
                    T.StructField("state", T.StringType()),
                    T.StructField(
                        "termination_details", T.StructType([T.StructField("code", T.StringType())])
                    ),
                ]
            ),
        ),
        T.StructField("feed_kind", T.StringType()),
        T.StructField("observed_at", T.TimestampType()),
    ]
)

JOB_DETAILS = T.StructType(
    [
        T.StructField("workspace_id", T.StringType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("settings", T.StructType([T.StructField("name", T.StringType())])),
    ]
)

COLLECTION_ERRORS = T.StructType(
    [
        T.StructField("workspace_id", T.StringType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("stage", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
