"""Exact top-k inner products with multi-resolution segment statistics.

Every vector is turned into integers, ``floor(scale * x)``. For each resolution the dimensions fall
into segments, and a vector keeps each segment's mean and deviation. The squared distance of two
vectors is at least ``sum of n ((m - m')^2 + (s - s')^2)`` over the segments, which is the same as
saying that their inner product is at most ``sum of n (m m' + s s')``. Candidates whose bound stays
below a query's k-th best score so far are out; the bound is evaluated coarse to fine, each level on
the survivors of the one before, and only the last survivors get an exact product.

Queries and candidates meet in cells, a block of queries by a chunk of candidates, which Spark
distributes; each cell gives its k best per query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm.embedding_dedup import valid_vector
from llm.shipping import ready


@dataclass(frozen=True)
class Settings:
    """``dense``: above this share of survivors a whole product is cheaper than single ones."""

    k: int = 10
    scale: int = 1024
    segments: tuple[int, ...] = (1, 4, 16)
    queries: int = 512
    candidates: int = 8192
    step: int = 512
    dense: float = 0.2


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector, sqrt(n) * mean and sqrt(n) * deviation of every segment, side by side."""

    bounds = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    sizes = np.diff(bounds)
    means = np.add.reduceat(vectors, bounds[:-1], axis=1) / sizes
    spread = vectors - np.repeat(means, sizes, axis=1)
    deviations = np.sqrt(np.add.reduceat(spread * spread, bounds[:-1], axis=1) / sizes)
    return np.concatenate([means, deviations], axis=1) * np.sqrt(np.tile(sizes, 2))


def _best(queries: int, found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The k best (query, id, score) triples of every query: higher score, then smaller id."""

    q, ids, scores = found
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    keep = rank < k
    return q[keep], ids[keep], scores[keep]


def search_cell(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query index, id, score) of each query's k best in the cell, and the exact products made."""

    n, exact = len(queries), 0
    best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    bar = np.full(n, -np.inf)
    levels = [(segment_statistics(queries, s), segment_statistics(vectors, s)) for s in settings.segments]
    order = np.argsort(-np.einsum("ij,ij->i", vectors, vectors), kind="stable")
    for low in range(0, len(order), settings.step):
        block = order[low : low + settings.step]
        alive = query_ids[:, None] != ids[block]
        for asked, own in levels:
            share = alive.mean()
            if not share:
                break
            if share > settings.dense:
                bound = asked @ own[block].T
                alive &= bound * (1 + 1e-9) + 1e-6 >= bar[:, None] - np.abs(bar[:, None]) * 1e-9
            else:
                i, j = np.nonzero(alive)
                bound = np.einsum("ij,ij->i", asked[i], own[block[j]])
                alive[i, j] = bound * (1 + 1e-9) + 1e-6 >= bar[i] - np.abs(bar[i]) * 1e-9
        i, j = np.nonzero(alive)
        if not len(i):
            continue
        exact += len(i)
        if len(i) > settings.dense * alive.size:
            scores = (queries @ vectors[block].T)[i, j]
        else:
            scores = np.einsum("ij,ij->i", queries[i], vectors[block[j]])
        fits = scores >= bar[i]
        i, j, scores = i[fits], j[fits], scores[fits]
        best = _best(n, tuple(np.concatenate(x) for x in zip(best, (i, ids[block[j]], scores), strict=True)), settings.k)
        counts = np.bincount(best[0], minlength=n)
        full = counts >= settings.k
        last = np.cumsum(counts) - 1
        bar[full] = best[2][last[full]]
    return *best, exact


def _whole_numbers(rows: pd.Series, scale: int) -> np.ndarray:
    return np.floor(np.stack(rows.to_numpy()).astype(np.float64) * scale)


def _long_products(query_ids, queries, ids, vectors, k):
    """Cells whose sums pass 2^53: Python integers, scores kept within 64 bits."""

    least, most = -(1 << 63), (1 << 63) - 1
    whole = [[int(x) for x in v] for v in vectors]
    for q, query in zip(query_ids, queries, strict=True):
        own = [int(x) for x in query]
        scores = ((max(least, min(most, sum(map(int.__mul__, own, v)))), int(i)) for i, v in zip(ids, whole, strict=True) if i != q)
        for score, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]:
            yield int(q), i, score


def _cell(settings: Settings):
    def work(key: tuple, asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if not len(asked) or not len(rows):
            return empty
        query_ids, ids = asked["id"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
        queries, vectors = _whole_numbers(asked["vector"], settings.scale), _whole_numbers(rows["vector"], settings.scale)
        if np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1] >= 2**53:
            return pd.DataFrame(_long_products(query_ids, queries, ids, vectors, settings.k), columns=list(empty.columns))
        q, found, scores, _ = search_cell(query_ids, queries, ids, vectors, settings)
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": found, "score": scores.astype(np.int64)})

    return work


def top_products(vectors: DataFrame, is_query: F.Column, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's k highest integer products.

    Ties go to the smaller id. A query never meets its own id. Vectors that are null or empty, or
    hold null or non-finite components, and rows without an id take no part; rows with the same id
    count once (the smallest vector). Vectors of different lengths aren't compared. A query with no
    other vector has no rows.
    """

    ready(vectors.sparkSession)
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asked"))
    usable = usable.where(F.col("id").isNotNull() & valid_vector(F.col("vector")))
    usable = usable.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked")).withColumn("dims", F.size("vector"))
    sizes = usable.groupBy("dims").agg(F.count("*").alias("n"), F.count_if("asked").alias("q"))
    sizes = sizes.where("q > 0").select(
        "dims", F.ceil(F.col("n") / settings.candidates).cast("int").alias("chunks"), F.ceil(F.col("q") / settings.queries).cast("int").alias("blocks")
    )
    placed = usable.join(sizes, "dims")
    fresh = [F.col(name).alias(name) for name in ("dims", "block", "chunk", "id", "vector")]  # both sides stem from one frame
    slot = F.xxhash64("id")
    queries = placed.where("asked").select(
        "dims", F.pmod(slot, "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "id", "vector"
    ).select(*fresh)
    rows = placed.select(
        "dims", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(slot, "chunks").cast("int").alias("chunk"), "id", "vector"
    ).select(*fresh)
    keys = ["dims", "block", "chunk"]
    found = queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(_cell(settings), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score")
