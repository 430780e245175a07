import os
import sys
from datetime import UTC, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from punctual import schemas as S
from punctual.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    """A UTC instant from ``YYYY-MM-DD HH:MM[:SS]``."""

    return datetime.fromisoformat(text).replace(tzinfo=UTC)


@pytest.fixture(scope="session")
def make(spark):
    """Build the three tables from short rows."""

    class Make:
        def runs(self, *rows):
            full = [
                (str(ws), str(job), run, at(start), at(end) if end else None, state)
                for ws, job, run, start, end, state in rows
            ]
            return spark.createDataFrame(full, S.RUN_STATE)

        def jobs(self, *rows):
            full = [
                (str(ws), str(job), name, at(attempt), at(success) if success else None, error)
                for ws, job, name, attempt, success, error in rows
            ]
            return spark.createDataFrame(full, S.JOB_STATE)

        def config(self, *rows):
            """Rows of (workspace, order, job, frequency, time, zone, {field: value})."""

            full = []
            for ws, order, job, frequency, time, zone, own in rows:
                full.append(
                    (
                        str(ws),
                        order,
                        str(job),
                        frequency,
                        time,
                        zone,
                        own.get("day_of_week"),
                        own.get("first_deadline_date"),
                        own.get("day_of_month"),
                        at("2024-01-01 00:00"),
                    )
                )
            return spark.createDataFrame(full, S.SLA_CONFIG)

    return Make()


def rows(df, *columns):
    """Sorted row tuples of some columns."""

    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=str)
