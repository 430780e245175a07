"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Checkpoints go with the frames that need them; a stream would fill the shared folder else.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The store replaces only the partitions a commit touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "punctual", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session with the engine settings; ``master`` is left to spark-submit when None."""

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Stored instants are UTC, so dates and zone conversions need a UTC session."""

    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError(f"the session time zone must be UTC, not {zone}")


def ensure_checkpoints(spark: SparkSession) -> str:
    """Return the checkpoint folder, which every executor must reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without the setting gets a
    scratch folder of its own.
    """

    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="punctual-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
