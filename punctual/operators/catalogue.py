"""Jobs that could be monitored."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.run_states import catalogue_name, collapsed_whitespace, folded
from punctual.operators.config import COMPLETION_TIME


def candidate_jobs(
    catalogue: DataFrame,
    monitored: DataFrame,
    name_contains: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Catalogue jobs with a flag for those already listed, active or not; optionally by name part."""

    jobs = catalogue.select("job_id", catalogue_name(F.col("name")).alias("name"))
    if name_contains:
        jobs = jobs.filter(F.contains(folded(F.col("name")), folded(F.lit(name_contains))))
    listed = monitored.select("job_id").distinct().withColumn("_listed", F.lit(True))
    flagged = jobs.join(listed, "job_id", "left").select(
        "job_id", "name", F.coalesce("_listed", F.lit(False)).alias("already_monitored")
    )
    return flagged.orderBy(folded(F.col("name")), "job_id") if ordered else flagged


def new_jobs(catalogue: DataFrame, monitored: DataFrame) -> DataFrame:
    """Catalogue jobs that are not listed yet."""

    jobs = catalogue.select("job_id", catalogue_name(F.col("name")).alias("name"))
    return jobs.join(monitored.select("job_id"), "job_id", "left_anti")


def default_entries(jobs: DataFrame, completion_time: str) -> DataFrame:
    """An active daily configuration entry for every picked job, with a one-line label."""

    if not re.fullmatch(COMPLETION_TIME[1:-1], completion_time):
        raise ValueError(f"{completion_time!r} is not a 24-hour HH:MM time")
    return jobs.select(
        "job_id",
        F.lit("active").alias("monitoring_status"),
        F.lit("daily").alias("frequency"),
        F.lit(completion_time).alias("completion_time"),
        collapsed_whitespace(F.col("name")).alias("label"),
    )
