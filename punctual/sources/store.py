"""The state tables in the Spark catalog, changed by dynamic partition overwrite.

A commit writes the new rows of the partitions it touches; Spark stages the files and replaces just those
partitions when the job commits. Nothing else is kept beside the rows: a run's row carries when and by
which feed its state was observed, and a commit takes a record only if it is at least as new. So a commit
that is applied again, in whole or after it broke off, gives the same rows. With a transactional format as
``provider`` every commit is atomic by itself; with plain files a reader may meet some partitions of a
commit before the others.

Runs lie by shard and start date, a shard being fixed by workspace and job. So the number of partitions is
bounded by the retention whatever the number of workspaces, a job's runs are looked for in one shard, and a
workspace with most of the rows spreads over all of them.

A run that is removed, or moves to another date, stays under its old date as a removed row, which no read
returns. It keeps the order in which things were observed, and goes with its date when the retention has
passed.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual import schemas as S
from punctual.functions.instants import AsOf, instant
from punctual.functions.run_states import quoted, validated_workspace_id
from punctual.operators.config import config_changed, config_difference
from punctual.operators.state import ORDER_FIELDS, observation_order, upsert_jobs
from punctual.session import ensure_checkpoints

# Run keys of one batch that may be broadcast: about 80 bytes each, so 40 MB.
BROADCAST_KEYS = 500_000
# Partitions per start date, and of the smaller tables, unless the store is made with another number.
SHARDS = 16
# Partitions that one statement drops.
DROPPED_AT_ONCE = 200

_REMOVED = T.StructField("removed", T.BooleanType(), False, {"comment": "Whether the row has left this partition"})
_OBSERVED = [field for field in S.OBSERVED if field.name in ORDER_FIELDS]
_DATED = T.StructField("start_date", T.DateType(), True, {"comment": "UTC date of the start"})
_SHARD = T.StructField("shard", T.IntegerType(), False, {"comment": "Part of the table its key belongs to"})
_TABLES = {
    S.RUN_STATE_TABLE: ([*S.RUN_STATE, *_OBSERVED, _REMOVED, _SHARD, _DATED], ["shard", "start_date"], "Latest state of every monitored run"),
    S.JOB_STATE_TABLE: ([*S.JOB_STATE, _SHARD], ["shard"], "Collection state of every monitored job"),
    S.SLA_CONFIG_TABLE: ([*S.SLA_CONFIG, _SHARD], ["shard"], "Valid schedule configuration"),
    S.BATCH_TABLE: (list(S.BATCHES), ["query_id"], "Last micro-batch of every stream"),
}
_SHARD_KEYS = {S.RUN_STATE_TABLE: S.JOB_KEY, S.JOB_STATE_TABLE: S.JOB_KEY, S.SLA_CONFIG_TABLE: ["workspace_id"]}


class StateStore:
    """Reads and commits of the state tables of one namespace, which has one writer at a time.

    ``shards`` is fixed for the life of the tables: every store of a namespace has to name the same number.
    """

    def __init__(self, spark: SparkSession, namespace: str, provider: str = "parquet", shards: int = SHARDS):
        self.spark = spark
        self.namespace = namespace
        self.provider = provider
        self.shards = shards
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        ensure_checkpoints(spark)

    def name(self, table: str) -> str:
        return quoted(*self.namespace.split("."), table)

    def ensure_tables(self, create_namespace: bool = False, location: str | None = None) -> None:
        """Create what is missing; ``location`` places a new namespace in a folder of its own."""

        if create_namespace:
            namespace = quoted(*self.namespace.split("."))
            placed = f" LOCATION '{location}'" if location else ""
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{placed}")
        for table, (fields, partitions, comment) in _TABLES.items():
            columns = [
                f"{field.name} {field.dataType.simpleString()}"
                f"{'' if field.nullable else ' NOT NULL'} COMMENT '{field.metadata.get('comment', '')}'"
                for field in fields
            ]
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(columns)}) USING {self.provider} "
                f"PARTITIONED BY ({', '.join(partitions)}) COMMENT '{comment}'"
            )

    def _with_shard(self, table: str, rows: DataFrame) -> DataFrame:
        return rows.withColumn("shard", F.pmod(F.xxhash64(*_SHARD_KEYS[table]), F.lit(self.shards)).cast("int"))

    # Reads

    def _stored(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def runs(self, since: AsOf | None = None) -> DataFrame:
        """Run state; ``since`` prunes to the start dates that can hold later starts."""

        rows = self._stored(S.RUN_STATE_TABLE).filter(~F.col("removed"))
        if since is not None:
            first = instant(since)
            rows = rows.filter((F.col("start_date") >= F.to_date(first)) & (F.col("period_start_time") >= first))
        return rows.select(*S.RUN_STATE.names)

    def jobs(self) -> DataFrame:
        return self._stored(S.JOB_STATE_TABLE).select(*S.JOB_STATE.names)

    def config(self) -> DataFrame:
        return self._stored(S.SLA_CONFIG_TABLE).select(*S.SLA_CONFIG.names)

    def observations(self, keys: DataFrame | None = None) -> DataFrame:
        """When each run, a removed one too, was last observed; ``keys`` (run keys) limits the scan."""

        rows = self._rows_of(keys) if keys is not None else self._stored(S.RUN_STATE_TABLE)
        newest = F.max(observation_order()).alias("newest")
        return rows.groupBy(*S.RUN_KEY).agg(newest).select(*S.RUN_KEY, "newest.*")

    def _rows_of(self, keys: DataFrame) -> DataFrame:
        """Stored rows, removed ones too, of unique run keys.

        A run can lie under another date than the one a batch gives it, so the keys are looked for under
        all dates, but only in the batch's shards and, as callers select little, on few columns.
        """

        keys = self._with_shard(S.RUN_STATE_TABLE, keys)
        shards = [row[0] for row in keys.select("shard").distinct().collect()]
        if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
            keys = F.broadcast(keys)
        rows = self._stored(S.RUN_STATE_TABLE).filter(F.col("shard").isin(shards))
        return rows.join(keys.drop("shard"), S.RUN_KEY, "left_semi")

    # Commits

    def _overwrite(self, table: str, rows: DataFrame) -> None:
        """Replace the partitions that ``rows`` lie in.

        Rebalancing writes few files per partition, yet splits a partition that holds most rows.
        """

        ordered = rows.select(*self._stored(table).columns)
        ordered.hint("rebalance", *_TABLES[table][1]).write.insertInto(self.name(table), overwrite=True)

    def _replace(self, table: str, touched: DataFrame, rows: DataFrame) -> None:
        """Replace the touched partitions by ``rows``, which lie in them; those without rows are dropped."""

        places = _TABLES[table][1]
        touched, rows = touched.select(*places).distinct().checkpoint(), rows.checkpoint()
        self._overwrite(table, rows)
        emptied = touched.join(rows.select(*places).distinct(), places, "left_anti")
        self._drop(table, emptied.toLocalIterator())

    def _drop(self, table: str, partitions: Iterable[Row]) -> None:
        specs = ["PARTITION (" + ", ".join(f"{k} = '{v}'" for k, v in found.asDict().items()) + ")" for found in partitions]
        for low in range(0, len(specs), DROPPED_AT_ONCE):
            listed = ", ".join(specs[low : low + DROPPED_AT_ONCE])
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {listed}")

    def commit_runs(self, incoming: DataFrame, removed: DataFrame | None = None) -> None:
        """Upsert run rows and remove others (unique keys), rewriting only the partitions involved.

        Both may carry ``ORDER_FIELDS``; what was observed before the stored state of its run changes
        nothing, and rows without them count as newest. A run that isn't stored and is said to be missing is
        remembered, so that an older record can't bring it back.
        """

        arrived = self._with_shard(S.RUN_STATE_TABLE, _arrivals(incoming, removed)).checkpoint()
        held = self._rows_of(arrived.select(*S.RUN_KEY))
        held = held.select(*S.RUN_KEY, "period_start_time", *ORDER_FIELDS, "shard", "start_date").checkpoint()
        seen = held.groupBy(*S.RUN_KEY).agg(F.max(observation_order()).alias("_seen"))
        fresh = arrived.join(seen, S.RUN_KEY, "left").filter(
            F.col("_seen").isNull() | F.col("observed_at").isNull() | (observation_order() >= F.col("_seen"))
        )
        # A row without an order of its own takes over the stored one, so that older records stay out.
        order = {name: F.when(F.col("observed_at").isNull(), F.col(f"_seen.{name}")).otherwise(F.col(name)) for name in ORDER_FIELDS}
        fresh = fresh.withColumns(order).checkpoint()
        live = fresh.filter(~F.col("removed")).drop("_seen")
        # Where the keys lie now; the place of a live row isn't vacated.
        places = held.select(*S.RUN_KEY, "period_start_time", "shard", "start_date")
        known = places.join(fresh.select(*S.RUN_KEY, *ORDER_FIELDS), S.RUN_KEY)
        vacated = known.join(live.select(*S.RUN_KEY, "start_date"), [*S.RUN_KEY, "start_date"], "left_anti")
        unheard = fresh.filter(F.col("removed") & F.col("_seen").isNull() & F.col("observed_at").isNotNull())
        gone = vacated.unionByName(unheard.select(*vacated.columns))
        gone = gone.withColumns(
            {
                "period_end_time": F.lit(None).cast("timestamp"),
                "result_state": F.lit(S.UNKNOWN),
                "removed": F.lit(True),
            }
        )
        new = live.unionByName(gone).checkpoint()
        place = ["shard", "start_date"]
        stored = self._stored(S.RUN_STATE_TABLE)
        # At most the shards times the dates of the retention, so the list may be broadcast.
        touched = F.broadcast(new.select(*place).distinct())
        kept = stored.join(touched, place, "left_semi").join(fresh.select(*S.RUN_KEY), S.RUN_KEY, "left_anti")
        self._overwrite(S.RUN_STATE_TABLE, kept.unionByName(new))

    def expire(self, cutoff: AsOf, workspaces: DataFrame | None = None) -> None:
        """Remove the runs of some workspaces (all by default) that started before the cutoff.

        For all workspaces, earlier dates are dropped whole and the date of the cutoff is written again;
        otherwise every date up to it that holds such a run.
        """

        edge = F.to_date(instant(cutoff))
        rows = self._stored(S.RUN_STATE_TABLE)
        if workspaces is None:
            dates = rows.filter(F.col("start_date") < edge).select("shard", "start_date").distinct()
            self._drop(S.RUN_STATE_TABLE, dates.toLocalIterator())
            rows, leaves = rows.filter(F.col("start_date") == edge), F.col("period_start_time") < instant(cutoff)
        else:
            chosen = workspaces.select("workspace_id", F.lit(True).alias("_chosen")).distinct()
            rows = rows.filter(F.col("start_date") <= edge).join(chosen, "workspace_id", "left")
            leaves = (F.col("period_start_time") < instant(cutoff)) & F.coalesce("_chosen", F.lit(False))
        self._remove(S.RUN_STATE_TABLE, rows, leaves)

    def _remove(self, table: str, rows: DataFrame, leaves: Column) -> None:
        """Write the partitions again that have rows to leave, without them."""

        touched = rows.filter(leaves).select(*_TABLES[table][1]).distinct().checkpoint()
        if not touched.isEmpty():
            self._replace(table, touched, rows.join(F.broadcast(touched), _TABLES[table][1], "left_semi").filter(~leaves))

    def commit_jobs(self, updates: DataFrame) -> None:
        updates = self._with_shard(S.JOB_STATE_TABLE, updates).checkpoint()
        stored = self._stored(S.JOB_STATE_TABLE).join(F.broadcast(updates.select("shard").distinct()), "shard", "left_semi")
        merged = upsert_jobs(stored, updates)
        self._overwrite(S.JOB_STATE_TABLE, self._with_shard(S.JOB_STATE_TABLE, merged))

    def replace_config(self, workspace_id: str, rows: DataFrame) -> bool:
        """Replace one workspace's configuration if it changed; an empty one removes every row."""

        validated_workspace_id(workspace_id)
        mine = F.col("workspace_id") == workspace_id
        if not rows.filter(~mine | F.col("workspace_id").isNull()).isEmpty():
            raise ValueError(f"the rows must all belong to workspace {workspace_id}")
        if not config_changed(self.config().filter(mine), rows):
            return False
        self._replace_config(self.spark.range(1).select(F.lit(workspace_id).alias("workspace_id")), rows)
        return True

    def commit_config(self, workspaces: DataFrame, rows: DataFrame) -> None:
        """Replace the configuration of those workspaces whose rows changed."""

        mine = rows.join(workspaces, "workspace_id", "left_semi").checkpoint()
        stored = self.config().join(workspaces, "workspace_id", "left_semi")
        changed = config_difference(stored, mine).select("workspace_id").distinct().checkpoint()
        if not changed.isEmpty():
            self._replace_config(changed, mine.join(changed, "workspace_id", "left_semi"))

    def _replace_config(self, workspaces: DataFrame, rows: DataFrame) -> None:
        touched = self._with_shard(S.SLA_CONFIG_TABLE, workspaces).select("shard").distinct()
        stored = self._stored(S.SLA_CONFIG_TABLE).join(F.broadcast(touched), "shard", "left_semi")
        others = stored.join(workspaces, "workspace_id", "left_anti")
        fresh = self._with_shard(S.SLA_CONFIG_TABLE, rows).select(*others.columns)
        self._replace(S.SLA_CONFIG_TABLE, touched, others.unionByName(fresh))

    def purge(self, workspace_id: str) -> None:
        """Remove every row of a workspace from all tables."""

        validated_workspace_id(workspace_id)
        for table in _SHARD_KEYS:
            self._remove(table, self._stored(table), F.col("workspace_id") == workspace_id)

    # Micro-batches

    def last_batch(self, query_id: str) -> dict | None:
        """The last micro-batch of a stream: its number, instant and whether all its commits ended."""

        row = self._stored(S.BATCH_TABLE).filter(F.col("query_id") == query_id).first()
        return row.asDict() if row else None

    def note_batch(self, query_id: str, batch_id: int, collected_at: datetime, finished: bool) -> None:
        row = self.spark.createDataFrame([(query_id, batch_id, collected_at, finished)], S.BATCHES)
        self._overwrite(S.BATCH_TABLE, row.coalesce(1))


def _arrivals(incoming: DataFrame, removed: DataFrame | None) -> DataFrame:
    """Incoming and removed runs in the columns of the run table."""

    def ordered(df: DataFrame) -> list[Column]:
        return [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in _OBSERVED]

    rows = incoming.select(*S.RUN_STATE.names, *ordered(incoming), F.lit(False).alias("removed"))
    if removed is not None:
        # A run that was never stored lies under the date on which it was found missing.
        gone = removed.select(
            *S.RUN_KEY,
            *[F.lit(None).cast(S.RUN_STATE[name].dataType).alias(name) for name in ("period_end_time", "result_state")],
            *ordered(removed),
            F.lit(True).alias("removed"),
        )
        gone = gone.withColumn("period_start_time", F.col("observed_at"))
        gone = gone.join(rows.select(*S.RUN_KEY), S.RUN_KEY, "left_anti").dropDuplicates(S.RUN_KEY)
        rows = rows.unionByName(gone)
    return rows.withColumn("start_date", F.to_date("period_start_time"))
