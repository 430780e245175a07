"""Join and ranking helpers that hold up when one key owns much of the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A workflow is one narrow row when runs look up their workflow, and at most 93 rows of about 170
# bytes when runs look up their period. Both limits keep a broadcast below 100 MB.
BROADCAST_WORKFLOWS = 100_000
BROADCAST_PERIOD_WORKFLOWS = 5_000
# A key that owns a third of the rows should spread over about as many tasks as a shuffle has.
LEAST_SALTS, MOST_SALTS = 8, 1024
POSITION_BUCKET = 10_000


@dataclass(frozen=True)
class JoinPlan:
    """Which configuration-side tables are small enough to broadcast."""

    broadcast_workflows: bool
    broadcast_periods: bool

    @staticmethod
    def measure(config: DataFrame) -> JoinPlan:
        """Decide from the row count of the configuration, never reading past the limit."""

        rows = config.limit(BROADCAST_WORKFLOWS + 1).count()
        return JoinPlan(rows <= BROADCAST_WORKFLOWS, rows <= BROADCAST_PERIOD_WORKFLOWS)


def shuffled(df: DataFrame) -> DataFrame:
    """Keep a join from broadcasting this side.

    Spark takes exploded rows to be as large as what they were exploded from, and compressed shuffle
    files to be as large as the rows they hold, so it would build sides on the driver that are many
    times its limit.
    """

    return df.hint("merge")


BROADCAST = JoinPlan(broadcast_workflows=True, broadcast_periods=True)
SHUFFLE = JoinPlan(broadcast_workflows=False, broadcast_periods=False)


def salt_count(spark: SparkSession) -> int:
    """A third of the shuffle partitions, within bounds; the small side is repeated so often."""

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_SALTS, min(MOST_SALTS, partitions // 3))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: Column,
    how: str = "inner",
) -> DataFrame:
    """Join a large, possibly skewed left side to a smaller right side.

    Each left key is split over the salts by ``spread`` and the right side is repeated once per
    salt, so a key that owns a third of the left rows still runs in many tasks.
    """

    salts = salt_count(left.sparkSession)
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted_right = shuffled(right.withColumn("_salt", every_salt))
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def config_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: Column,
    plan: JoinPlan,
    how: str = "inner",
) -> DataFrame:
    """Join to a side with at most one row per workflow: broadcast while that is small, else salted."""

    if plan.broadcast_workflows:
        return left.join(F.broadcast(right), keys, how)
    return salted_join(left, right, keys, spread, how)


def attach(runs: DataFrame, workflows: DataFrame, plan: JoinPlan) -> DataFrame:
    """Give every run its workflow columns; runs of other jobs drop out."""

    return config_join(runs, workflows, ["workspace_id", "job_id"], F.col("run_id"), plan)


def with_position(df: DataFrame, group: list[str], index: str, name: str) -> DataFrame:
    """Number the rows of each group from 1 in index order, without one task per group.

    Rows are ranked inside fixed index buckets; a running total of the bucket sizes, one row per
    bucket, supplies what comes before. ``index`` must be a non-negative integer, unique per group.
    """

    bucketed = df.withColumn("_bucket", F.floor(F.col(index) / POSITION_BUCKET))
    buckets = [*group, "_bucket"]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*buckets)
        .agg(F.count("*").alias("_size"))
        .select(*buckets, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy(*buckets).orderBy(index))
    return (
        bucketed.withColumn("_within", within)
        .join(offsets, buckets)
        .withColumn(name, (F.col("_within") + F.col("_offset")).cast("int"))
        .drop("_bucket", "_within", "_offset")
    )
