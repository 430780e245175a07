"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def components(edges: DataFrame, partitions: int | None = None) -> DataFrame:
    """(node, root) of every node of ``edges`` (src, dst); root is the smallest node reachable.

    Every step replaces a node's edges by edges to its smallest neighbour. Minima are combined
    before the shuffle and joined back, so a node with very many neighbours is never gathered in
    one group. The number of steps grows with the logarithm of the longest path. Loops are dropped;
    no edges give no rows. ``partitions`` is the most in which edges are kept between the steps, for
    callers that know how many their rows came in; every task of a step leaves files of its own.
    """

    current, state = _fixed(_tidy(edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))), partitions)
    while state["n"]:
        current, after = _fixed(_tidy(_small_star(_large_star(current))), partitions)
        if after == state:
            break
        state = after
    # Stars: every edge leads from a node to its root.
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""

    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _fixed(edges: DataFrame, partitions: int | None) -> tuple[DataFrame, dict]:
    """The edges as a checkpoint, with their number and the sum of their hashes, taken while they are written."""

    seen = Observation()
    edges = edges.coalesce(partitions) if partitions else edges
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    return edges.observe(seen, F.count("*").alias("n"), total).checkpoint(), seen.get


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to its smallest neighbour; ``edges`` are tidy."""

    both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and itself, move to the smallest of them."""

    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.join(least, "u").select(F.inline(F.array(moved, F.struct("u", F.col("m").alias("v")))))
