"""Configured workflows joined with the state of their collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions.instants import AsOf, instant, shifted
from punctual.operators.joins import salted_join


def scope_to_configured(jobs: DataFrame, config: DataFrame) -> DataFrame:
    """Job state of the workspaces that have at least one configured workflow."""

    configured = config.select("workspace_id").distinct()
    scoped = salted_join(jobs, configured, ["workspace_id"], F.col("job_id"), "left_semi")
    return scoped.select(*jobs.columns)


def configuration_problem(collected: Column, error: Column, last_success: Column, as_of: AsOf) -> Column:
    # A null last success is not stale: the comparison is null and no branch applies.
    return (
        F.when(~collected, "Jobs API collection pending")
        .when(error.isNotNull(), "Jobs API collection failed")
        .when(last_success < shifted(as_of, minutes=-S.STALE_MINUTES), "Jobs API data stale")
    )


def configured_workflows(config: DataFrame, as_of: AsOf) -> DataFrame:
    """Configuration rows ready for schedule expansion, without any collection state."""

    return config.withColumns({"job_id": F.col("configured_job_id"), "as_of": instant(as_of)})


def workflow_name() -> Column:
    return F.coalesce("job_name", F.concat(F.lit("Job "), F.col("job_id")))


def monitored_workflows(config: DataFrame, jobs: DataFrame, as_of: AsOf) -> DataFrame:
    """Configuration rows with the collected job name and any collection problem.

    The join on workspace and job already keeps out job state of other workspaces. Both sides are
    one row per job; Spark broadcasts the job state only when its size allows.
    """

    state = jobs.select(
        "workspace_id",
        "job_id",
        "job_name",
        "last_successful_collection_at",
        "last_error_message",
        F.lit(True).alias("_collected"),
    )
    problem = configuration_problem(
        F.col("_collected").isNotNull(),
        F.col("last_error_message"),
        F.col("last_successful_collection_at"),
        as_of,
    )
    return (
        configured_workflows(config, as_of)
        .join(state, S.JOB_KEY, "left")
        .select(
            *[config[column] for column in config.columns],
            "job_id",
            workflow_name().alias("workflow_name"),
            problem.alias("configuration_problem"),
            "as_of",
        )
    )


def collection_health(config: DataFrame, jobs: DataFrame, as_of: AsOf) -> DataFrame:
    """Collection problem of every workflow as of one instant, null when healthy."""

    return monitored_workflows(config, jobs, as_of).select(
        *S.WORKFLOW_KEY, "job_id", "workflow_name", "configuration_problem"
    )
