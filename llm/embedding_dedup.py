"""Near-duplicate vectors by int8 tile products with error bounds.

Vectors of a label are dealt to blocks of bounded size; a tile is a pair of blocks. In a tile every
vector is scaled to unit length and quantised to int8 with its own scale, and the length of its
quantisation error is kept. The product of two quantised vectors differs from the cosine by at most
``|u~| e_v + e_u |v~| + e_u e_v``, so only pairs whose product plus bound reaches the threshold are
computed again in double precision.

Equal vectors of a label become one with a count first. A tile returns, for each vector, how many
others it links (with their counts) and one edge to the first vector of its linked group within the
tile, never the pairs themselves; sums and components over the tiles follow.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.graph import components
from llm.shipping import ready


@dataclass(frozen=True)
class Settings:
    """``block`` is the mean number of vectors of a block, ``pairs`` those recomputed at once."""

    threshold: float = 0.93
    block: int = 1024
    pairs: int = 65_536


def valid_vector(vector: F.Column) -> F.Column:
    """Not null, not empty, and every component finite."""

    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values as float, scale, error length) of unit vectors; errors are rounded up."""

    scale = np.abs(unit).max(1) / 127
    whole = np.rint(unit / scale[:, None])
    error = np.linalg.norm(unit - whole * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return whole, scale, error


def linked_pairs(one: np.ndarray, two: np.ndarray, settings: Settings, same: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows (i of one, j of two) with cosine at or above the threshold, and how many were recomputed.

    ``same``: both are one block, and only i < j is asked for.
    """

    # a power of two out of the way of overflow; it changes no cosine
    one, two = (v * np.exp2(-np.frexp(np.abs(v).max(1))[1].astype(float))[:, None] for v in (one, two))
    length_one, length_two = np.linalg.norm(one, axis=1), np.linalg.norm(two, axis=1)
    whole_one, scale_one, error_one = quantise(one / length_one[:, None])
    whole_two, scale_two, error_two = quantise(two / length_two[:, None])
    exact = np.float32 if one.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (whole_one.astype(exact) @ whole_two.astype(exact).T).astype(np.float64)
    product *= scale_one[:, None] * scale_two
    # |u~| <= 1 + e_u
    product += error_two * (1 + error_one[:, None]) + error_one[:, None] * (1 + error_two) + error_one[:, None] * error_two
    possible = product >= settings.threshold - 1e-9
    if same:
        possible = np.triu(possible, 1)
    i, j = np.nonzero(possible)
    linked = np.zeros(len(i), bool)
    for low in range(0, len(i), settings.pairs):
        a, b = i[low : low + settings.pairs], j[low : low + settings.pairs]
        cosine = np.einsum("ij,ij->i", one[a], two[b]) / (length_one[a] * length_two[b])
        linked[low : low + settings.pairs] = cosine >= settings.threshold
    return i[linked], j[linked], len(i)


def group_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """First member of each node's linked group."""

    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, root[i], low)
        np.minimum.at(after, root[j], low)
        after = after[after]
        if np.array_equal(after, root):
            break
        root = after
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root


def _tile(settings: Settings):
    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, second = key[2], key[3]
        rows = rows.sort_values("rep", kind="stable")
        left = rows[rows["block"] == first]
        right = left if first == second else rows[rows["block"] == second]
        empty = pd.DataFrame({"rep": [], "links": [], "root": []})
        if not len(left) or not len(right):
            return empty
        one = np.stack(left["vector"].to_numpy()).astype(np.float64)
        two = one if first == second else np.stack(right["vector"].to_numpy()).astype(np.float64)
        i, j, _ = linked_pairs(one, two, settings, first == second)
        if not len(i):
            return empty
        if first != second:
            both = pd.concat([left, right])
            j = j + len(left)
        else:
            both = left
        copies, reps = both["copies"].to_numpy(np.int64), both["rep"].to_numpy(np.int64)
        links = np.zeros(len(both), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = group_roots(len(both), i, j)
        seen = links > 0
        return pd.DataFrame({"rep": reps[seen], "links": links[seen], "root": reps[root][seen]})

    return work


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", settings: Settings = Settings()) -> DataFrame:
    """One row per id: id, ``n_links``, ``component_id``, ``kept``.

    Compared are vectors of equal label (not null) and equal length. Vectors that are null, empty or
    zero, or hold null or non-finite components, and those without label link with nothing. Rows
    without an id are left out; rows with the same id are one vector if equal, and otherwise the id
    links as any of them. Other columns are not read.
    """

    ready(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label")
    ).where("id is not null").distinct()
    usable = rows.where(F.col("label").isNotNull() & valid_vector(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    classes = usable.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).checkpoint()
    dealt = classes.groupBy("label", F.size("vector").alias("dims")).agg(F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"))
    blocked = classes.withColumn("dims", F.size("vector")).join(dealt, ["label", "dims"])
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    tiles = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select(
        "label", "dims", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "copies", "vector"
    )
    found = tiles.groupBy("label", "dims", "i", "j").applyInPandas(_tile(settings), "rep long, links long, root long").checkpoint()
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))

    members = usable.join(classes.select("label", "vector", "rep", "copies"), ["label", "vector"]).select("id", "rep", "copies")
    edges = found.where("rep <> root").select(F.col("rep").alias("src"), F.col("root").alias("dst"))
    several = members.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count("*").alias("c")).where("c > 1")
    same = members.join(several.select("id", "lo"), "id").where("rep <> lo").select(F.col("rep").alias("src"), F.col("lo").alias("dst"))
    roots = components(edges.unionByName(same)).withColumnRenamed("node", "rep")
    placed = members.join(links, "rep", "left").join(roots, "rep", "left")
    placed = placed.select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("root", "rep").alias("root"))
    others = rows.select("id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("root"))
    everything = placed.unionByName(others).groupBy("id").agg(F.sum("n").alias("n_links"), F.min("root").alias("root"))
    component = F.coalesce("root", "id")
    return everything.select(
        F.col("id").alias(id_col), "n_links", component.alias("component_id"), (component == F.col("id")).alias("kept")
    )
