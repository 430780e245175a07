"""Configuration documents: validation, ordering and change detection.

A document is one JSON text per workspace. ``split_documents`` turns documents into headers (one row
per workspace) and entries (one row per listed job with its JSON text), so a long list is validated
in parallel. Validation reports every problem as a row (workspace_id, entry_index, path, message);
entry_index is null for the header.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual import schemas as S
from punctual.functions.instants import AsOf, instant
from punctual.operators.joins import salted_join, with_position

# Patterns, key sets and texts of the configuration format.
COMPLETION_TIME = r"^([01][0-9]|2[0-3]):[0-5][0-9]$"
WHOLE_BYTES = 8 << 20  # of a document that surely fits a variant
HEADER_KEYS = ("version", "default_timezone", "workflows")
ENTRY_KEYS = ("job_id", "monitoring_status", "sla")
SLA_KEYS = (
    "frequency",
    "completion_time",
    "timezone",
    "day_of_week",
    "first_deadline_date",
    "day_of_month",
)
SLA_REQUIRED = ("frequency", "completion_time")
DAY_NAMES = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
OWN_FIELD = {
    "daily": None,
    "weekly": "day_of_week",
    "fortnightly": "first_deadline_date",
    "monthly": "day_of_month",
}
VERSION_2_MESSAGE = (
    "workflow-monitoring.yml uses version 2. Remove workspace_id and jobs_api_config, "
    "set version: 3, and set catalog and schema as bundle variables."
)
SCHEDULE_MESSAGES = {
    "daily_extra": "daily SLA only accepts completion_time and timezone",
    "weekly_missing": "weekly SLA requires a lowercase day_of_week",
    "weekly_extra": "weekly SLA does not accept first_deadline_date or day_of_month",
    "fortnightly_missing": "fortnightly SLA requires first_deadline_date",
    "fortnightly_extra": "fortnightly SLA does not accept day_of_week or day_of_month",
    "monthly_missing": "monthly SLA requires day_of_month from 1 to 31",
    "monthly_extra": "monthly SLA does not accept day_of_week or first_deadline_date",
}

# The first letters of the type a parsed JSON value reports.
JSON_TYPES = {"integer": "BIGINT", "string": "STRING", "object": "OBJECT", "array": "ARRAY"}


class _Node:
    """SQL checks on one place of a parsed text.

    The surrounding lambda binds ``f``, a struct with the kind ('' when absent), text and number of
    every place, so each is extracted once and the checks stay small.
    """

    def __init__(self, name: str, json_path: str, label: str):
        self.name, self.json_path, self.label = name, json_path, label
        self.kind, self.text, self.number = (f"f.{name}.{part}" for part in ("kind", "text", "number"))
        self.present = f"{self.kind} <> ''"

    @property
    def extraction(self) -> str:
        return (
            f"'{self.name}', named_struct("
            f"'kind', coalesce(schema_of_variant(try_variant_get(v, '{self.json_path}', 'variant')), ''), "
            f"'text', try_variant_get(v, '{self.json_path}', 'string'), "
            f"'number', try_variant_get(v, '{self.json_path}', 'double'))"
        )

    def child(self, name: str, label: str) -> _Node:
        return _Node(name, f"{self.json_path}.{name}", label)

    def is_a(self, type_name: str) -> str:
        found = f"startswith({self.kind}, '{JSON_TYPES[type_name]}')"
        if type_name == "integer":
            # A number without a fraction is an integer however it was written.
            return f"({found} OR ({self.is_number} AND {self.number} = floor({self.number})))"
        return found

    @property
    def is_number(self) -> str:
        return f"{self.kind} RLIKE '^(BIGINT|DECIMAL|DOUBLE)'"

    @property
    def shown(self) -> str:
        """The value as error texts show it."""

        return (
            f"CASE {self.kind} WHEN 'STRING' THEN concat(\"'\", {self.text}, \"'\") "
            f"WHEN 'BOOLEAN' THEN initcap({self.text}) WHEN 'VOID' THEN 'None' ELSE {self.text} END"
        )

    def error(self, condition: str, message: str) -> str:
        found = f"named_struct('path', {self.label}, 'message', {message})"
        return f"CASE WHEN {condition} THEN {found} END"

    def value_error(self, condition: str, text: str) -> str:
        return self.error(condition, f'concat({self.shown}, " {text}")')

    def type_error(self, type_name: str) -> str:
        return self.value_error(
            f"{self.present} AND NOT {self.is_a(type_name)}", f"is not of type '{type_name}'"
        )

    def required(self, child: _Node) -> str:
        missing = f"{self.is_a('object')} AND {child.kind} = ''"
        return self.error(missing, f"\"'{child.name}' is a required property\"")

    def unknown_keys(self, known: tuple[str, ...]) -> str:
        listed = ", ".join(f"'{key}'" for key in known)
        extra = f"array_sort(array_except(json_object_keys({self.text}), array({listed})))"
        verb = f"if(size({extra}) = 1, ' was', ' were')"
        message = (
            f"concat(\"Additional properties are not allowed ('\", array_join({extra}, \"', '\"), "
            f"\"'\", {verb}, ' unexpected)')"
        )
        return self.error(f"{self.is_a('object')} AND size({extra}) > 0", message)

    def one_of(self, values: tuple[str, ...]) -> str:
        listed = ", ".join(f"'{value}'" for value in values)
        allowed = f"{self.kind} = 'STRING' AND {self.text} IN ({listed})"
        return self.value_error(f"{self.present} AND NOT ({allowed})", f"is not one of [{listed}]")

    def matches(self, pattern: str) -> str:
        return self.value_error(
            f"{self.is_a('string')} AND NOT {self.text} RLIKE '{pattern}'", f"does not match '{pattern}'"
        )

    def not_empty(self) -> str:
        return self.error(f"{self.is_a('string')} AND {self.text} = ''", "\"'' should be non-empty\"")

    def at_least(self, limit: int) -> str:
        return self.value_error(
            f"{self.is_number} AND {self.number} < {limit}", f"is less than the minimum of {limit}"
        )

    def at_most(self, limit: int) -> str:
        return self.value_error(
            f"{self.is_number} AND {self.number} > {limit}", f"is greater than the maximum of {limit}"
        )

    def is_date(self) -> str:
        valid = f"{self.text} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' AND try_to_date({self.text}) IS NOT NULL"
        return self.value_error(f"{self.is_a('string')} AND NOT ({valid})", "is not a 'date'")


def _without_workflows(document: str) -> Column:
    """The document with an empty list of workflows; values of unknown keys are left out. Null if it is no JSON object."""

    kept = [name for name in HEADER_KEYS if name != "workflows"]
    values = F.from_json(document, T.StructType([T.StructField(name, T.VariantType()) for name in kept]))

    def member(key: Column) -> Column:
        text = F.when(key == "workflows", "[]")
        for name in kept:
            text = text.when(key == name, F.to_json(values[name]))
        quoted = F.to_json(F.array(key))
        quoted = F.substring(quoted, F.lit(2), F.length(quoted) - 2)  # without the brackets
        return F.concat(quoted, F.lit(":"), F.coalesce(text, F.lit("null")))

    return F.concat(F.lit("{"), F.array_join(F.transform(F.json_object_keys(document), member), ","), F.lit("}"))


def split_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (workspace_id, document) to headers and entries.

    The header of a document beyond ``WHOLE_BYTES`` has an empty list in place of its workflows, so
    that it fits a variant; the listed entries are read one by one in any case.
    """

    listed = F.from_json("document", T.StructType([T.StructField("workflows", T.ArrayType(T.StringType()))]))
    # A text entry loses its quotes above; its JSON kind tells it from an object of the same text.
    kinds = F.from_json("document", T.StructType([T.StructField("workflows", T.ArrayType(T.VariantType()))]))
    # Only a list that is read to its end may be left out of the header.
    left_out = (F.octet_length("document") > WHOLE_BYTES) & listed["workflows"].isNotNull() & kinds["workflows"].isNotNull()
    header = F.when(left_out, F.coalesce(_without_workflows("document"), "document")).otherwise(F.col("document"))
    headers = documents.select("workspace_id", header.alias("header"))
    both = F.arrays_zip(listed["workflows"].alias("text"), kinds["workflows"].alias("value"))
    exploded = documents.select("workspace_id", F.posexplode(both).alias("entry_index", "pair"))
    is_text = F.coalesce(F.schema_of_variant("pair.value") == "STRING", F.lit(False))
    entry = F.when(is_text, F.to_json("pair.value")).otherwise(F.col("pair.text"))
    entries = exploded.select("workspace_id", "entry_index", entry.alias("entry"))
    return headers, entries


def _problems(text: str, nodes: list[_Node], checks: list[str]) -> Column:
    """Array of the (path, message) structs of the failed checks of a JSON text, parsed once."""

    places = ", ".join(node.extraction for node in nodes)
    return F.expr(
        f"flatten(transform(array(try_parse_json({text})), v -> flatten(transform(array(named_struct({places})), "
        f"f -> array_compact(array({', '.join(checks)}))))))"
    )


def header_problems() -> Column:
    """Problems of the document level; version 2 reports only how to migrate."""

    root = _Node("root", "$", "'root'")
    children = [root.child(name, f"'{name}'") for name in HEADER_KEYS]
    version, zone, workflows = children
    old = f"({version.is_a('integer')} AND {version.number} = 2)"
    wanted = f"({version.is_a('integer')} AND {version.number} = {S.CONFIG_VERSION})"
    checks = [
        root.type_error("object"),
        root.unknown_keys(HEADER_KEYS),
        *[root.required(child) for child in children],
        version.error(f"{version.present} AND NOT {wanted}", f"'{S.CONFIG_VERSION} was expected'"),
        zone.type_error("string"),
        zone.not_empty(),
        workflows.type_error("array"),
    ]
    return _problems(
        "header",
        [root, *children],
        [
            root.error("v IS NULL", "'the document is not valid JSON'"),
            root.error(f"coalesce({old}, false)", f"'{VERSION_2_MESSAGE}'"),
            *[f"CASE WHEN NOT coalesce({old}, false) THEN {check} END" for check in checks],
        ],
    )


def entry_problems() -> Column:
    """Problems of single entries that need no other entry."""

    root = _Node("root", "$", "concat('workflows[', entry_index, ']')")
    children = [root.child(name, f"concat('workflows[', entry_index, '].{name}')") for name in ENTRY_KEYS]
    job_id, status, sla = children
    fields = [sla.child(name, f"concat('workflows[', entry_index, '].sla.{name}')") for name in SLA_KEYS]
    frequency, time, zone, weekday, first, day = fields
    # A listed bare word arrives without its quotes, so it does not parse as JSON.
    bare = "if(entry IS NULL, 'None', concat(\"'\", entry, \"'\"))"
    checks = [
        root.error("v IS NULL", f"concat({bare}, \" is not of type 'object'\")"),
        root.type_error("object"),
        root.unknown_keys(ENTRY_KEYS),
        *[root.required(child) for child in children],
        job_id.type_error("integer"),
        job_id.at_least(1),
        status.one_of(S.MONITORING_STATUSES),
        sla.type_error("object"),
        sla.unknown_keys(SLA_KEYS),
        sla.required(frequency),
        sla.required(time),
        frequency.one_of(S.FREQUENCIES),
        time.type_error("string"),
        time.matches(COMPLETION_TIME),
        zone.type_error("string"),
        zone.not_empty(),
        weekday.one_of(DAY_NAMES),
        first.type_error("string"),
        first.is_date(),
        day.type_error("integer"),
        day.at_least(1),
        day.at_most(31),
    ]
    # Every frequency requires its own field and refuses the fields of the others.
    known = ", ".join(f"'{name}'" for name in S.FREQUENCIES)
    applies = f"{sla.is_a('object')} AND {frequency.kind} = 'STRING' AND {frequency.text} IN ({known})"
    refused = f"concat('not allowed when frequency is ', {frequency.text})"
    for node in (weekday, first, day):
        owner = next(name for name, own in OWN_FIELD.items() if own == node.name)
        missing = f"{applies} AND {frequency.text} = '{owner}' AND {node.kind} = ''"
        checks.append(sla.error(missing, f"\"'{node.name}' is a required property\""))
        checks.append(node.error(f"{applies} AND {frequency.text} <> '{owner}' AND {node.present}", refused))
    return _problems("entry", [root, *children, *fields], checks)


def _problem(condition: Column, path: Column, message: Column) -> Column:
    return F.when(condition, F.struct(path.alias("path"), message.alias("message")))


def _entry_path(suffix: str) -> Column:
    return F.concat(F.lit("workflows["), F.col("entry_index"), F.lit(f"]{suffix}"))


def known_zones(df: DataFrame) -> DataFrame:
    """The IANA zone names that both the platform and the engine know, about 600 short rows."""

    engine = df.sparkSession._jvm.java.time.ZoneId.getAvailableZoneIds()
    names = [(name,) for name in sorted(zoneinfo.available_timezones() & set(engine))]
    return df.sparkSession.createDataFrame(names, "timezone string").withColumn("_known", F.lit(True))


def _unknown_zone(path: Column) -> Column:
    message = F.concat(F.lit('"'), F.col("timezone"), F.lit('" is not an IANA timezone'))
    return _problem(F.col("_known").isNull(), path, message)


def judged_headers(headers: DataFrame, zones: DataFrame) -> DataFrame:
    """Default zone of every document with its own problems and those that need other fields valid."""

    zone = F.get_json_object("header", "$.default_timezone").alias("timezone")
    read = headers.select("workspace_id", zone, header_problems().alias("field_problems"))
    return read.join(F.broadcast(zones), "timezone", "left").select(
        "workspace_id",
        F.col("timezone").alias("default_timezone"),
        "field_problems",
        F.array_compact(F.array(_unknown_zone(F.lit("default_timezone")))).alias("cross_problems"),
    )


def schedule_field_problem() -> Column:
    """Restatement of the frequency rules over the typed columns; null when they hold."""

    frequency = F.col("frequency")
    has_weekday = F.coalesce(F.col("day_of_week"), F.lit("")) != ""
    has_first = F.coalesce(F.col("first_deadline_text"), F.lit("")) != ""
    has_day = F.col("day_of_month").isNotNull()
    cases = (
        ("daily_extra", (frequency == "daily") & (has_weekday | has_first | has_day)),
        ("weekly_missing", (frequency == "weekly") & ~has_weekday),
        ("weekly_extra", (frequency == "weekly") & (has_first | has_day)),
        ("fortnightly_missing", (frequency == "fortnightly") & ~has_first),
        ("fortnightly_extra", (frequency == "fortnightly") & (has_weekday | has_day)),
        ("monthly_missing", (frequency == "monthly") & ~has_day),
        ("monthly_extra", (frequency == "monthly") & (has_weekday | has_first)),
    )
    problem = F.lit(None).cast("string")
    for name, condition in reversed(cases):
        problem = F.when(condition, SCHEDULE_MESSAGES[name]).otherwise(problem)
    return problem


def _typed(entries: DataFrame) -> DataFrame:
    def field(path: str, kind: str) -> Column:
        return F.try_variant_get("_entry", f"$.{path}", kind)

    parsed = entries.withColumn("_entry", F.try_parse_json("entry"))
    return parsed.select(
        "workspace_id",
        F.col("entry_index").cast("bigint").alias("entry_index"),
        field("job_id", "bigint").alias("job_id"),
        field("monitoring_status", "string").alias("monitoring_status"),
        field("sla.frequency", "string").alias("frequency"),
        field("sla.completion_time", "string").alias("completion_time"),
        F.nullif(field("sla.timezone", "string"), F.lit("")).alias("own_timezone"),
        field("sla.day_of_week", "string").alias("day_of_week"),
        field("sla.first_deadline_date", "string").alias("first_deadline_text"),
        field("sla.day_of_month", "int").alias("day_of_month"),
        entry_problems().alias("field_problems"),
    )


def repeated_jobs(entries: DataFrame) -> DataFrame:
    """``entries`` are typed, so 1 and 1.0 are one job. First position of every job listed more than once, by a map-side aggregate."""

    return (
        entries.filter("job_id IS NOT NULL")
        .groupBy("workspace_id", "job_id")
        .agg(F.min("entry_index").alias("_first"), F.count("*").alias("_entries"))
        .filter("_entries > 1")
        .drop("_entries")
    )


def judged_entries(headers: DataFrame, entries: DataFrame, zones: DataFrame) -> DataFrame:
    """Typed entries with the default zone filled in (an empty zone counts as missing) and problems.

    One workspace may own most entries and one job may be listed most often, so both lookups are
    salted joins against one row per workspace or repeated job.
    """

    defaults = headers.select("workspace_id", "default_timezone")
    typed = _typed(entries)
    zoned = salted_join(typed, defaults, ["workspace_id"], F.col("entry_index"), "left")
    zoned = zoned.withColumn("timezone", F.coalesce("own_timezone", "default_timezone"))
    found = salted_join(
        zoned, repeated_jobs(typed), ["workspace_id", "job_id"], F.col("entry_index"), "left"
    ).join(F.broadcast(zones), "timezone", "left")
    misplaced = schedule_field_problem()
    duplicate = F.concat(F.lit("duplicates workflows["), F.col("_first"), F.lit("]"))
    cross = F.array(
        _unknown_zone(_entry_path(".sla.timezone")),
        _problem(misplaced.isNotNull(), _entry_path(".sla"), misplaced),
        _problem(F.col("entry_index") > F.col("_first"), _entry_path(".job_id"), duplicate),
    )
    return found.withColumn("cross_problems", F.array_compact(cross)).drop(
        "own_timezone", "default_timezone", "_first", "_known"
    )


def validate_config(
    headers: DataFrame, entries: DataFrame, ordered: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Typed entries of the valid documents, and every error of the others.

    Rules that compare fields across a document apply only where its single fields are all valid.
    Any error refuses the whole document, so the stored rows of that workspace stay.
    """

    zones = known_zones(headers)
    own = judged_headers(headers, zones)
    listed = judged_entries(own, entries, zones)
    has_field, has_cross = F.size("field_problems") > 0, F.size("cross_problems") > 0
    judged = own.withColumn("entry_index", F.lit(None).cast("bigint")).unionByName(
        listed, allowMissingColumns=True
    )
    verdicts = judged.groupBy("workspace_id").agg(
        F.bool_or(has_field).alias("_field"), F.bool_or(has_field | has_cross).alias("_refused")
    )
    decided = salted_join(judged, verdicts, ["workspace_id"], F.coalesce("entry_index", F.lit(0)))
    reported = F.when(F.col("_field"), F.col("field_problems")).otherwise(F.col("cross_problems"))
    errors = decided.select("workspace_id", "entry_index", F.inline(reported))
    if ordered:
        errors = errors.orderBy("workspace_id", F.asc_nulls_first("entry_index"), F.col("path") != "root", "path")
    valid = salted_join(listed, verdicts, ["workspace_id"], F.col("entry_index")).filter(~F.col("_refused"))
    return valid.drop("field_problems", "cross_problems", "_field", "_refused"), errors


def config_rows(valid: DataFrame, changed_at: AsOf) -> DataFrame:
    """Table rows of the active entries, numbered per workspace in document order."""

    active = valid.filter(F.col("monitoring_status") == "active")
    return with_position(active, ["workspace_id"], "entry_index", "configured_order").select(
        "workspace_id",
        "configured_order",
        F.col("job_id").cast("string").alias("configured_job_id"),
        "frequency",
        "completion_time",
        "timezone",
        "day_of_week",
        F.try_to_date("first_deadline_text").alias("first_deadline_date"),
        "day_of_month",
        instant(changed_at).alias("config_changed_at"),
    )


def config_difference(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that differ between two configurations, ignoring when they were written."""

    compared = [column for column in S.SLA_CONFIG.names if column != "config_changed_at"]
    old, fresh = stored.select(*compared), new.select(*compared)
    added = fresh.exceptAll(old).withColumn("change", F.lit("added"))
    return added.unionByName(old.exceptAll(fresh).withColumn("change", F.lit("removed")))


def config_changed(stored: DataFrame, new: DataFrame) -> bool:
    return not config_difference(stored, new).isEmpty()
