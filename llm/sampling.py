"""Bounded, reproducible samples of labelled ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.textbatch import unit_hash


def sample_labels(labels: DataFrame, id_col: str, value_col: str, per_value: int, salt: str) -> tuple[DataFrame, dict[int, int]]:
    """(id, y) of about ``per_value`` ids for each of the values 0 and 1, and the counts of both.

    An id with several labels counts as 1 if any of them is 1; null ids and other values are left
    out. Which ids are taken depends on their hash alone.
    """

    clean = labels.select(F.col(id_col).alias("id"), F.col(value_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    clean = clean.groupBy("id").agg(F.max("y").alias("y"))
    counts = {row["y"]: row["n"] for row in clean.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("y") == value, F.lit(min(1.0, per_value / n))).otherwise(share)
    return clean.where(unit_hash(F.col("id"), salt) < share), counts
