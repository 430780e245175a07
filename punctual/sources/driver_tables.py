"""Run, job and configuration inputs derived from the test tables.

Every function reads a whole table and lets Spark derive the rows, so work grows with the data.
An event is a run, its user the job it belongs to, and every user one configured workflow.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual import schemas as S
from punctual.functions.instants import instant, shifted
from punctual.operators.runs import to_run_state

# The instant the views are taken at, and the mapping from users to schedules.
AS_OF = datetime(2024, 1, 31, 0, 0, 0, tzinfo=UTC)
SPLIT_AT = datetime(2024, 1, 24, 12, 0, 0, tzinfo=UTC)
# Later instants inside a day, at which the 30, 60 and 100 days cut some of the events and keep some.
IN_FEBRUARY = datetime(2024, 2, 14, 15, 42, 30, tzinfo=UTC)
IN_MARCH = datetime(2024, 3, 30, 9, 20, 15, tzinfo=UTC)
IN_APRIL = datetime(2024, 4, 24, 18, 5, 0, tzinfo=UTC)
ZONES = ["UTC", "Australia/Melbourne", "America/New_York", "Asia/Kolkata", "Europe/London"]
FIRST_FORTNIGHT = datetime(2024, 1, 1)


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once, as a catalog would keep it."""

    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _choose(values: list[str] | tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def workspace(user: Column) -> Column:
    return F.when(user % 7 == 0, "222").otherwise("111")


def raw_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(table(spark, sf_dir, "events"))


def event_records(events: DataFrame) -> DataFrame:
    """Events as raw run records: five types for five outcomes, open runs among the clicks."""

    kind = F.col("event_type")
    is_open = (kind == "click") & (F.col("event_id") % 2 == 0)
    queued = is_open & (F.col("value") < 2)
    started = F.unix_millis(F.col("ts").cast("timestamp"))
    state = (
        F.when(queued, "QUEUED")
        .when(is_open, "RUNNING")
        .when(kind == "error", "INTERNAL_ERROR")
        .otherwise("TERMINATED")
    )
    code = (
        F.when(kind == "purchase", "SUCCESS")
        .when(kind == "signup", "USER_CANCELED")
        .when(kind == "view", "MAX_CONCURRENT_RUNS_EXCEEDED")
        .when((kind == "click") & ~is_open, "RUN_EXECUTION_ERROR")
    )
    ended = started + F.floor(F.col("value") * 10) * 1000
    return events.select(
        workspace(F.col("user_id")).alias("workspace_id"),
        (F.col("user_id") + 1).alias("job_id"),
        F.col("event_id").alias("run_id"),
        F.when(queued, F.lit(0)).otherwise(started).alias("start_time"),
        F.when(~is_open, ended).alias("end_time"),
        F.struct(state.alias("state"), F.struct(code.alias("code")).alias("termination_details")).alias(
            "status"
        ),
        F.when(is_open, "active").otherwise("completed").alias("feed_kind"),
        F.col("ts").cast("timestamp").alias("observed_at"),
    )


def listed_then_looked_up(raw: DataFrame) -> DataFrame:
    """Two versions of every finished run: first listed as running, later looked up with its end."""

    fields = [column for column in raw.columns if column not in S.RUN_KEY]
    running = F.struct(F.lit("RUNNING").alias("state"), F.struct(F.lit(None).cast("string").alias("code")).alias("termination_details"))
    first = {"end_time": F.lit(None).cast("bigint"), "status": running, "feed_kind": F.lit("active")}
    last = {"feed_kind": F.lit("detail")}

    def version(changes: dict[str, Column]) -> Column:
        return F.struct(*[changes.get(name, F.col(name)).alias(name) for name in fields])

    is_open = F.col("feed_kind") == "active"
    versions = F.when(is_open, F.array(version({}))).otherwise(F.array(version(first), version(last)))
    return raw.select(*S.RUN_KEY, F.inline(versions))


def version_instant() -> Column:
    """When a version of ``listed_then_looked_up`` was observed: lookups an hour after listings."""

    looked_up = F.col("feed_kind") == "detail"
    return F.when(looked_up, F.col("observed_at") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("observed_at"))


def land_in_parts(records: DataFrame, path: str, parts: int = 3) -> int:
    """Write records as landed files, span by span of their observation instants, the newest span first.

    The bounds come from approximate quantiles of all records, so every span has about the same share. Returns
    how many files make one of ``parts`` batches.
    """

    seen = F.unix_micros("observed_at")
    shares = [k / parts for k in range(1, parts)]
    bounds = records.agg(F.percentile_approx(seen, shares).alias("b")).first()["b"] or []
    edges = [None, *sorted(bounds, reverse=True), None]
    for high, low in zip(edges, edges[1:]):
        span = F.lit(True)
        if high is not None:
            span &= seen < high
        if low is not None:
            span &= seen >= low
        records.filter(span).write.mode("append").parquet(path)
    return -(-len(records.sparkSession.read.parquet(path).inputFiles()) // parts)


def run_state(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    return to_run_state(raw_runs(spark, sf_dir), as_of)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("u")).distinct()


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def schedule(user: Column) -> dict[str, Column]:
    frequency = _choose(S.FREQUENCIES, user)
    time = F.concat(_two_digits((user * 7) % 24), F.lit(":"), _two_digits((user * 13) % 60))
    first = F.date_add(F.lit(FIRST_FORTNIGHT.date()), (user % 35).cast("int"))
    return {
        "frequency": frequency,
        "completion_time": time,
        "timezone": _choose(ZONES, user),
        "day_of_week": F.when(frequency == "weekly", _choose(S.WEEKDAYS, user)),
        "first_deadline_date": F.when(frequency == "fortnightly", first),
        "day_of_month": F.when(frequency == "monthly", (user % 31 + 1).cast("int")),
    }


def sla_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One workflow per user. Orders restart per workspace, so two workspaces share them."""

    u = F.col("u")
    order = F.when(u % 7 == 0, F.floor(u / 7) + 1).otherwise(u - F.floor(u / 7))
    return users(spark, sf_dir).select(
        workspace(u).alias("workspace_id"),
        order.cast("int").alias("configured_order"),
        (u + 1).cast("string").alias("configured_job_id"),
        *[column.alias(name) for name, column in schedule(u).items()],
        instant(AS_OF).alias("config_changed_at"),
    )


def job_state(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    """Job state with every collection condition: none, failed, stale, never succeeded, current."""

    u = F.col("u")
    kind = u % 10
    last_success = (
        F.when(kind == 2, shifted(as_of, minutes=-45))
        .when(kind == 3, F.lit(None).cast("timestamp"))
        .otherwise(shifted(as_of, minutes=-3))
    )
    return (
        users(spark, sf_dir)
        .filter(kind != 0)
        .select(
            workspace(u).alias("workspace_id"),
            (u + 1).cast("string").alias("job_id"),
            F.when(kind != 4, F.concat(F.lit("Job name "), u)).alias("job_name"),
            instant(as_of).alias("last_collection_attempt_at"),
            last_success.alias("last_successful_collection_at"),
            F.when(kind == 1, F.concat(F.lit("collection error for job "), u + 1)).alias(
                "last_error_message"
            ),
        )
    )


def spread_job_state(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    """Job state whose last success lies 0 to 39 days back, so incremental windows differ."""

    u = F.col("u")
    back = F.make_dt_interval((u % 40).cast("int"))
    return job_state(spark, sf_dir, as_of).withColumn("u", F.col("job_id").cast("bigint") - 1).select(
        *[
            F.when(u % 10 != 3, instant(as_of) - back).alias(name)
            if name == "last_successful_collection_at"
            else F.col(name)
            for name in S.JOB_STATE.names
        ]
    )


def monitored_jobs(config: DataFrame) -> DataFrame:
    return config.select("workspace_id", F.col("configured_job_id").alias("job_id"))


def lookup_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer for every open run: finished when its event's counter is low, otherwise gone."""

    raw = raw_runs(spark, sf_dir)
    counter = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
    )
    exists = F.col("k") < 50
    finished = F.struct(
        F.lit("TERMINATED").alias("state"), F.struct(F.lit("SUCCESS").alias("code")).alias("termination_details")
    )
    return (
        raw.filter(F.col("feed_kind") == "active")
        .join(counter, "run_id")
        .select(
            "workspace_id",
            "job_id",
            "run_id",
            F.when(exists, F.col("ms")).alias("start_time"),
            F.when(exists, F.col("ms") + F.col("k") * 1000).alias("end_time"),
            F.when(exists, finished).alias("status"),
            F.when(exists, "detail").otherwise("missing").alias("feed_kind"),
            shifted(AS_OF, minutes=-1).alias("observed_at"),
        )
    )


def earlier_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored state before the round: what was known when the last week began."""

    known = raw_runs(spark, sf_dir).filter(F.col("observed_at") < instant(SPLIT_AT))
    return to_run_state(known, SPLIT_AT)


def round_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the sources answer in a round: completed and active records and lookups."""

    return raw_runs(spark, sf_dir).unionByName(lookup_answers(spark, sf_dir))


def job_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job details for every user; some names are blank and some need trimming."""

    u = F.col("u")
    name = F.when(u % 9 == 4, "  ").otherwise(F.concat(F.lit(" Job name "), u, F.lit("\t")))
    return users(spark, sf_dir).select(
        workspace(u).alias("workspace_id"),
        (u + 1).alias("job_id"),
        F.struct(name.alias("name")).alias("settings"),
    )


def collection_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of single stages for some jobs."""

    u = F.col("u")
    stage = F.when(u % 10 == 1, "completed").when(u % 10 == 5, "active").when(u % 10 == 8, "lookup")
    return users(spark, sf_dir).select(
        workspace(u).alias("workspace_id"),
        (u + 1).alias("job_id"),
        stage.alias("stage"),
        F.concat(stage, F.lit("  failed\n for job "), u + 1).alias("message"),
    ).filter("stage is not null")


def job_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as jobs; those without a positive balance have no name."""

    customer = table(spark, sf_dir, "customer")
    return customer.select(
        (F.col("c_custkey") + 1).alias("job_id"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"),
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as run records: several versions per order and line, the newest by ship date."""

    lines = table(spark, sf_dir, "lineitem")
    started = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    state = F.when(F.col("l_returnflag") == "R", "INTERNAL_ERROR").otherwise("TERMINATED")
    code = F.when(F.col("l_returnflag") == "N", "SUCCESS").when(F.col("l_returnflag") == "A", "CANCELED")
    return lines.select(
        F.lit("111").alias("workspace_id"),
        F.col("l_orderkey").alias("job_id"),
        F.col("l_linenumber").cast("bigint").alias("run_id"),
        started.alias("start_time"),
        (started + F.floor(F.col("l_extendedprice") * 100)).alias("end_time"),
        F.struct(state.alias("state"), F.struct(code.alias("code")).alias("termination_details")).alias(
            "status"
        ),
        F.when(F.col("l_linestatus") == "F", "completed").otherwise("active").alias("feed_kind"),
        F.col("l_shipdate").cast("timestamp").alias("observed_at"),
    )


def config_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three documents: field errors in 111, errors across fields in 222, none in 333."""

    text = F.concat(
        F.lit('{"version": 3, "default_timezone": "'),
        F.when(F.col("workspace_id") == "222", "Nowhere/Default").otherwise("Europe/London"),
        F.lit('", "workflows": []}'),
    )
    documents = users(spark, sf_dir).select(config_workspace(F.col("u")).alias("workspace_id")).distinct()
    return documents.select("workspace_id", text.alias("header"))


def config_workspace(user: Column) -> Column:
    return _choose(["111", "222", "333"], user)


def config_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per user. Document 111 breaks single fields, 222 zones and job uniqueness."""

    u, ws = F.col("u"), config_workspace(F.col("u"))
    wrong = F.when(ws == "111", u % 12)
    fields = schedule(u)
    frequency = fields["frequency"]
    zone = F.when((ws == "222") & (u % 11 == 0), "Nowhere/Invalid").when(u % 4 != 3, fields["timezone"])
    job = F.when((ws == "222") & (u % 10 >= 8), u - u % 10 + 1).otherwise(u + 1)
    return users(spark, sf_dir).select(
        ws.alias("workspace_id"),
        u.alias("entry_index"),
        F.when(wrong == 0, F.lit(None)).when(wrong == 3, -u).otherwise(job).cast("bigint").alias("job_id"),
        F.when(wrong == 6, "paused").otherwise(F.when(u % 5 == 2, "inactive").otherwise("active")).alias(
            "monitoring_status"
        ),
        frequency.alias("frequency"),
        F.when(wrong == 9, "25:00").otherwise(fields["completion_time"]).alias("completion_time"),
        zone.alias("timezone"),
        F.when((ws == "111") & (u % 8 == 4), "monday").otherwise(fields["day_of_week"]).alias("day_of_week"),
        F.when((ws == "111") & (u % 8 == 6), F.lit(None))
        .otherwise(fields["first_deadline_date"].cast("string"))
        .alias("first_deadline_date"),
        F.when((ws == "111") & (u % 8 == 3), 32).otherwise(fields["day_of_month"]).alias("day_of_month"),
    )


def config_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same entries as JSON texts; absent fields are left out."""

    sla = F.struct(
        "frequency", "completion_time", "timezone", "day_of_week", "first_deadline_date", "day_of_month"
    )
    entry = F.struct("job_id", "monitoring_status", sla.alias("sla"))
    return config_fields(spark, sf_dir).select("workspace_id", "entry_index", F.to_json(entry).alias("entry"))
