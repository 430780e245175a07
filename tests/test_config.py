import calendar
import itertools
import json

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.operators import config
from punctual.operators.joins import with_position

DAILY = {"frequency": "daily", "completion_time": "21:05"}


def entry(job_id=1, status="active", **sla):
    return {"job_id": job_id, "monitoring_status": status, "sla": sla or DAILY}


@pytest.fixture
def validate(spark):
    def run(*entries, zone="UTC", version=3, **extra):
        document = {"version": version, "default_timezone": zone, "workflows": list(entries), **extra}
        documents = spark.createDataFrame([("111", json.dumps(document))], "workspace_id string, document string")
        valid, errors = config.validate_config(*config.split_documents(documents), ordered=True)
        return valid, [f"{row['path']}: {row['message']}" for row in errors.collect()]

    return run


#: For every frequency, the field it needs with a fitting value.
OWN_FIELD = {
    "daily": {},
    "weekly": {"day_of_week": "saturday"},
    "fortnightly": {"first_deadline_date": "2024-02-29"},
    "monthly": {"day_of_month": 29},
}
FIELDS = {name: value for own in OWN_FIELD.values() for name, value in own.items()}


def schedule(frequency, time="23:45", **more):
    return {"frequency": frequency, "completion_time": time, **OWN_FIELD[frequency], **more}


def test_every_frequency_becomes_a_row_in_its_zone(validate):
    zones = [None, "Asia/Kathmandu", None, "America/St_Johns"]
    entries = [
        entry(900 - i, **schedule(frequency, f"0{i}:10", **({"timezone": zone} if zone else {})))
        for i, (frequency, zone) in enumerate(zip(OWN_FIELD, zones))
    ]
    valid, errors = validate(*entries, zone="Africa/Nairobi")
    assert errors == []
    found = config.config_rows(valid, at("2024-05-05 05:05")).orderBy("configured_order").collect()
    for i, (row, frequency, zone) in enumerate(zip(found, OWN_FIELD, zones)):
        assert (row.configured_order, row.configured_job_id, row.frequency) == (i + 1, str(900 - i), frequency)
        assert (row.completion_time, row.timezone) == (f"0{i}:10", zone or "Africa/Nairobi")
        own = {name: str(row[name]) for name in FIELDS if row[name] is not None}
        assert own == {name: str(value) for name, value in OWN_FIELD[frequency].items()}


def test_inactive_entries_are_checked_but_take_no_position(validate):
    entries = [entry(1, "inactive", **schedule("monthly")), entry(2, **schedule("daily")), entry(3, "inactive"), entry(4, **schedule("weekly"))]
    valid, errors = validate(*entries)
    assert errors == []
    assert rows(config.config_rows(valid, at("2024-05-05 05:05")), "configured_order", "configured_job_id") == [(1, "2"), (2, "4")]
    off = [entry(k, "inactive") for k in (5, 6)]
    assert config.config_rows(validate(*off)[0], at("2024-05-05 05:05")).count() == 0
    assert validate(*off, entry(7, "inactive", **schedule("daily", timezone="")))[1] == ["workflows[2].sla.timezone: '' should be non-empty"]


@pytest.mark.parametrize("frequency", OWN_FIELD)
def test_fields_belong_to_one_frequency(validate, frequency):
    """Without its field a schedule is incomplete; the fields of all others are refused, alone and together."""

    own, errors = OWN_FIELD[frequency], []
    entries = [entry(1, frequency=frequency, completion_time="11:11")]
    errors += [f"workflows[0].sla: '{name}' is a required property" for name in own]
    foreign = [name for name in FIELDS if name not in own]
    for name in foreign:
        entries.append(entry(len(entries) + 1, **schedule(frequency, **{name: FIELDS[name]})))
        errors.append(f"workflows[{len(entries) - 1}].sla.{name}: not allowed when frequency is {frequency}")
    entries.append(entry(len(entries) + 1, **schedule(frequency, **{name: FIELDS[name] for name in foreign})))
    errors += [f"workflows[{len(entries) - 1}].sla.{name}: not allowed when frequency is {frequency}" for name in foreign]
    assert sorted(validate(*entries)[1]) == sorted(errors)


TIME_PATTERN = "^([01][0-9]|2[0-3]):[0-5][0-9]$"


def test_values_outside_their_range(validate):
    cases = [
        (schedule("monthly", day_of_month=0), ".day_of_month: 0 is less than the minimum of 1"),
        (schedule("monthly", day_of_month=40), ".day_of_month: 40 is greater than the maximum of 31"),
        (schedule("monthly", day_of_month="last"), ".day_of_month: 'last' is not of type 'integer'"),
        (schedule("fortnightly", first_deadline_date="2023-02-29"), ".first_deadline_date: '2023-02-29' is not a 'date'"),
        (schedule("weekly", day_of_week="someday"), f".day_of_week: 'someday' is not one of {[name.lower() for name in calendar.day_name]}"),
        (schedule("daily", "24:00"), f".completion_time: '24:00' does not match '{TIME_PATTERN}'"),
        (schedule("daily", "9:30"), f".completion_time: '9:30' does not match '{TIME_PATTERN}'"),
        ({**schedule("daily"), "frequency": "yearly"}, f".frequency: 'yearly' is not one of {list(S.FREQUENCIES)}"),
        (schedule("daily", owner="team"), ": Additional properties are not allowed ('owner' was unexpected)"),
    ]
    found = validate(*[entry(k + 1, **sla) for k, (sla, _) in enumerate(cases)])[1]
    assert sorted(found) == sorted(f"workflows[{k}].sla{text}" for k, (_, text) in enumerate(cases))


@pytest.mark.parametrize("zone", ["Mars/Olympus", "+05:30", "GMT+2"])
def test_zones_are_iana_names(validate, zone):
    assert validate(entry(1, **schedule("daily", timezone=zone)))[1] == [f'workflows[0].sla.timezone: "{zone}" is not an IANA timezone']


def test_every_error_is_reported_and_nothing_is_valid(validate):
    nameless = {"monitoring_status": "off", "sla": schedule("daily", "7pm")}
    valid, errors = validate(entry(-4), nameless, 17, entry(False), entry(3, **schedule("weekly")), zone="Mars/Olympus")
    assert set(errors) == {
        "workflows[0].job_id: -4 is less than the minimum of 1",
        "workflows[1]: 'job_id' is a required property",
        "workflows[1].monitoring_status: 'off' is not one of ['active', 'inactive']",
        f"workflows[1].sla.completion_time: '7pm' does not match '{TIME_PATTERN}'",
        "workflows[2]: 17 is not of type 'object'",
        "workflows[3].job_id: False is not of type 'integer'",
    }
    assert valid.count() == 0


def test_header_errors(validate):
    assert validate(version=2)[1][0].startswith("root: workflow-monitoring.yml uses version 2.")
    assert validate(version=4)[1] == ["version: 3 was expected"]
    assert validate(zone="Mars/Olympus")[1] == ['default_timezone: "Mars/Olympus" is not an IANA timezone']
    assert validate(owner="me")[1] == ["root: Additional properties are not allowed ('owner' was unexpected)"]


def test_unreadable_document(spark):
    documents = spark.createDataFrame([("111", "{")], "workspace_id string, document string")
    _, errors = config.validate_config(*config.split_documents(documents))
    assert ("document is not valid JSON" in errors.first()["message"])


def test_header_of_a_large_document(spark):
    large = '{"version": %s, "default_timezone": "UTC", %s"workflows": [%s]%s'
    entry = F.format_string('{"job_id": 1, "note": "%s"}', F.repeat(F.lit("x"), F.lit(1 << 20)))
    parts = [("1", ("3", "", "}")), ("2", ("4", '"owner": 1, ', "}")), ("3", ("3", "", ""))]
    small = spark.createDataFrame([(name, *part) for name, part in parts], "workspace_id string, v string, o string, stop string")
    text = F.format_string(large, "v", "o", F.concat_ws(", ", F.array_repeat(entry, 132)), "stop")
    headers, listed = config.split_documents(small.select("workspace_id", text.alias("document")))
    found = {r.workspace_id: [p.message for p in r.problems] for r in headers.select("workspace_id", config.header_problems().alias("problems")).collect()}
    assert found["1"] == []
    assert found["2"] == ["Additional properties are not allowed ('owner' was unexpected)", "3 was expected"]
    assert found["3"] == ["the document is not valid JSON"]
    assert listed.where("workspace_id = '1'").count() == 132


def test_duplicates_name_the_first_entry(validate):
    jobs = [30, 20, 20, 10, 30, 20]
    _, errors = validate(*[entry(job, "inactive" if k == 2 else "active") for k, job in enumerate(jobs)])
    assert errors == [f"workflows[{k}].job_id: duplicates workflows[{jobs.index(job)}]" for k, job in enumerate(jobs) if jobs.index(job) < k]


def test_schedule_restatement(spark):
    """The rule on stored rows agrees with the one on documents for every combination of fields."""

    combinations = [(frequency, *held) for frequency in OWN_FIELD for held in itertools.product([False, True], repeat=3)]
    frame = spark.createDataFrame(
        [(f, "friday" if week else None, "2024-02-29" if first else None, 29 if month else None) for f, week, first, month in combinations],
        "frequency string, day_of_week string, first_deadline_text string, day_of_month int",
    )
    shown = [row[0] for row in frame.select(config.schedule_field_problem()).collect()]
    fitting = {"daily": (0, 0, 0), "weekly": (1, 0, 0), "fortnightly": (0, 1, 0), "monthly": (0, 0, 1)}
    for (frequency, *held), problem in zip(combinations, shown):
        assert (problem is None) == (tuple(held) == fitting[frequency])
        assert problem is None or problem in config.SCHEDULE_MESSAGES.values()


def test_change_detection_ignores_the_timestamp(make):
    stored = make.config((1, 1, 5, "daily", "06:00", "UTC", {}))
    same = stored.withColumn("config_changed_at", F.lit(at("2026-01-01 00:00")))
    assert not config.config_changed(stored, same)
    assert config.config_changed(stored, same.withColumn("completion_time", F.lit("07:00")))
    assert config.config_changed(stored.limit(0), stored)


def test_positions_are_exact_across_buckets(spark):
    numbers = spark.range(0, 60_000, 2).select(F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("g"), "id")
    ranked = with_position(numbers, ["g"], "id", "position")
    summary = ranked.groupBy("g").agg(
        F.min("position"), F.max("position"), F.count_distinct("position"), F.corr("position", "id")
    )
    shown = {row[0]: row[1:] for row in summary.collect()}
    assert shown["a"][:3] == (1, 20_000, 20_000)
    assert shown["b"][:3] == (1, 10_000, 10_000)
    assert shown["a"][3] > 0.999999
