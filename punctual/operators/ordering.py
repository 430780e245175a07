"""Positions in a display order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_rank(df: DataFrame, bucket: Column, key: Column, name: str = "position", descending: bool = False) -> DataFrame:
    """Rank of every row by ``key`` (equal keys share a rank, null keys come last).

    ``bucket`` must not fall where ``key`` rises and is null exactly where it is. Rows are ranked
    inside their bucket; a running total of the bucket sizes, one row per bucket, gives the rest. Rows
    without a key share one rank, so they are spread over all tasks.
    """

    def order(column: str) -> Column:
        return F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)

    piece = F.when(bucket.isNull(), F.spark_partition_id()).otherwise(F.lit(0))
    bucketed = df.select("*", bucket.alias("_bucket"), key.alias("_key"), piece.alias("_piece"))
    before = Window.orderBy(order("_of")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(F.col("_bucket").alias("_of"))
        .agg(F.count("*").alias("_size"))
        .select("_of", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.rank().over(Window.partitionBy("_bucket", "_piece").orderBy(order("_key")))
    ranked = bucketed.withColumn("_within", within)
    found = ranked.join(offsets, ranked["_bucket"].eqNullSafe(offsets["_of"]))
    return found.select(*df.columns, (F.col("_within") + F.col("_offset")).alias(name))


def run_history_order(history: DataFrame) -> DataFrame:
    """Position of every run, newest end first, open ends last."""

    return with_rank(history, F.date_trunc("hour", "run_end_time"), F.col("run_end_time"), descending=True)


def sla_history_order(history: DataFrame) -> DataFrame:
    """Position of every deadline in time order."""

    return with_rank(history, F.date_trunc("hour", "deadline_utc"), F.col("deadline_utc"))
