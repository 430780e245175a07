"""Readers for landed run records, job details, configuration documents and job catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions.instants import AsOf, shifted


def read_run_feed(
    spark: SparkSession,
    path: str,
    kind: str | None = None,
    started_from: AsOf | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Raw run records, optionally of one feed kind and from one start instant on.

    Both conditions are plain comparisons on raw columns, so Parquet row groups can be skipped.
    """

    feed = spark.read.schema(S.RAW_RUN).format(file_format).load(path)
    if kind is not None:
        feed = feed.filter(F.col("feed_kind") == kind)
    if started_from is not None:
        first_ms = (F.unix_micros(shifted(started_from)) / 1000).cast("bigint")
        feed = feed.filter(F.col("start_time") >= first_ms)
    return feed


def stream_run_feed(
    spark: SparkSession, path: str, file_format: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """The same records as a stream over the landing folder."""

    reader = spark.readStream.schema(S.RAW_RUN).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_job_details(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    return spark.read.schema(S.JOB_DETAILS).format(file_format).load(path)


def read_job_catalogue(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Every job with its name, as listed."""

    return read_job_details(spark, path, file_format).select(
        "job_id", F.col("settings.name").alias("name")
    )


def read_config_documents(spark: SparkSession, path: str) -> DataFrame:
    """Configuration documents, one JSON file per workspace named ``<workspace_id>.json``."""

    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return spark.read.text(path, wholetext=True).select(
        F.regexp_extract(name, r"^(.*)\.json$", 1).alias("workspace_id"),
        F.col("value").alias("document"),
    )
