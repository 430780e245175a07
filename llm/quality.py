"""Quality selection by importance resampling.

Two generative models of hashed n-grams, one of the target text (documents labelled good) and one of
all raw text, give every document the log of its importance weight, the sum over its n-grams of
``log p_target - log p_raw``. A document keeps its place in the sample if its log weight plus Gumbel
noise, fixed by its id, is among the k largest: that is sampling k documents without replacement in
proportion to the weights. k is the number of target-like documents the models expect in the corpus.

N-grams are words and word pairs, hashed to 10,000 buckets, and triples of word shapes (first
letter, capitals, digits, symbols, length, repetition of the word before), hashed to 16,384 buckets.
A document's own counts are taken out of both models when it is scored, so unlabelled text isn't
judged by whether it was in the target sample.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.sampling import sample_labels
from llm.shipping import ready
from llm.textbatch import chunks, map_rows, mix, prefix_sums, span_hashes, unit_hash, word_spans


@dataclass(frozen=True)
class Settings:
    """``target_documents`` bounds the labelled sample; ``shrink`` is the pseudo-count by which a
    bucket's ratio is drawn towards 1. The target sample is of documents, not of single n-grams, so
    shares differ by chance: log ratios down to ``-tolerance`` say nothing against a text."""

    target_documents: int = 5000
    word_buckets: int = 10_000
    shape_buckets: int = 16_384
    shrink: float = 10.0
    tolerance: float = 0.5

    @property
    def buckets(self) -> int:
        return self.word_buckets + self.shape_buckets


@dataclass
class RatioModel:
    """Counts of both models per bucket; the first family are words, the second shapes."""

    target: np.ndarray
    raw: np.ndarray
    prior: float
    settings: Settings


def _class_sums(data: np.ndarray, member: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(member[data], dtype=np.int64)])


_LOWER, _UPPER, _DIGIT, _SYMBOL = (np.zeros(256, bool) for _ in range(4))
_LOWER[97:123] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[33:127] = True
_SYMBOL &= ~(_LOWER | _UPPER | _DIGIT)


def ngrams(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every n-gram of every row."""

    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = span_hashes(prefix_sums(data), starts, ends)
    before = np.zeros(len(words), bool)  # the row has a word before this one
    before[1:] = rows[1:] == rows[:-1]
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[before[1:]]

    def many(member: np.ndarray, from_second: bool = False) -> np.ndarray:
        sums = _class_sums(data, member)
        return sums[ends] - sums[starts + from_second]

    first = data[starts]
    kind = np.where(_LOWER[first], 0, np.where(_UPPER[first], 1, np.where(first >= 128, 2, 3)))
    capitals = many(_UPPER, True) > 0
    digits = many(_DIGIT) > 0
    symbols = np.minimum(many(_SYMBOL), 2)
    same = np.zeros(len(words), bool)
    same[1:] = before[1:] & (words[1:] == words[:-1])
    size = np.digitize(ends - starts, [4, 9])
    shape = ((((kind * 2 + capitals) * 2 + digits) * 3 + symbols) * 2 + same) * 3 + size + 1
    one = np.where(before, np.concatenate([[0], shape[:-1]]), 0)
    two = np.where(before, np.concatenate([[0], one[:-1]]), 0)
    shapes = mix(((shape * 1024 + one) * 1024 + two).astype(np.uint64))
    buckets = np.concatenate(
        [
            words % np.uint64(settings.word_buckets),
            pairs % np.uint64(settings.word_buckets),
            shapes % np.uint64(settings.shape_buckets) + np.uint64(settings.word_buckets),
        ]
    ).astype(np.int64)
    return buckets, np.concatenate([rows, rows[1:][before[1:]], rows])


def fit_ratio_model(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", settings: Settings = Settings()) -> RatioModel:
    """Count the n-grams of all documents, and of the sampled ones with label 1, in one pass."""

    ready(documents.sparkSession)
    sample, counts = sample_labels(labels, id_col, label_col, settings.target_documents, "quality")
    target = sample.where("y = 1").select("id", F.lit(1).alias("is_target"))
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # about target_documents ids: the sample is bounded by that setting
    source = source.join(F.broadcast(target), "id", "left").select("text", F.coalesce("is_target", F.lit(0)).alias("is_target"))

    def count(batches):
        raw, own = np.zeros(settings.buckets, np.int64), np.zeros(settings.buckets, np.int64)
        for batch in batches:
            chosen = batch.column("is_target").to_numpy().astype(bool)
            for low, high, data, offsets, _ in chunks(batch.column("text")):
                buckets, rows = ngrams(data, offsets, settings)
                raw += np.bincount(buckets, minlength=settings.buckets)
                own += np.bincount(buckets[chosen[low:high][rows]], minlength=settings.buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": seen, "raw": raw[seen], "target": own[seen]})

    sums = source.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, own = np.zeros(settings.buckets), np.zeros(settings.buckets)
    for bucket, r, t in sums.collect():  # one row per bucket
        raw[bucket], own[bucket] = r, t
    total = sum(counts.values())
    return RatioModel(own, raw, counts.get(1, 0) / total if total else 1.0, settings)


def log_weights(model: RatioModel, data: np.ndarray, offsets: np.ndarray, in_target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log importance weight, number of n-grams) of each row; 0 without n-grams.

    A bucket's ratio is (target count + shrink) / (expected count + shrink), where the expected
    count is the raw count scaled to the size of the target.
    """

    settings, n = model.settings, len(offsets) - 1
    buckets, rows = ngrams(data, offsets, settings)
    if not len(buckets) or not model.target.sum():
        return np.zeros(n), np.bincount(rows, minlength=n)[:n]
    keys, own = np.unique(rows * settings.buckets + buckets, return_counts=True)
    rows, buckets = keys // settings.buckets, keys % settings.buckets
    total = np.zeros(n)
    family = buckets >= settings.word_buckets
    bounds = (0, settings.word_buckets, settings.buckets)
    for which in (0, 1):
        mine = family == bool(which)
        r, b, o = rows[mine], buckets[mine], own[mine]
        sizes = np.bincount(r, weights=o, minlength=n)
        span = slice(bounds[which], bounds[which + 1])
        raw_size = np.maximum(model.raw[span].sum() - sizes, 1)
        target_size = np.maximum(model.target[span].sum() - np.where(in_target, sizes, 0), 1)
        expected = (model.raw[b] - o) * (target_size / raw_size)[r]
        counted = model.target[b] - np.where(in_target[r], o, 0)
        ratio = np.log((np.maximum(counted, 0) + settings.shrink) / (np.maximum(expected, 0) + settings.shrink))
        ratio = np.where(ratio < 0, np.minimum(ratio + settings.tolerance, 0), ratio)
        total += np.bincount(r, weights=o * ratio, minlength=n)
    return total, np.bincount(rows, weights=own, minlength=n).astype(np.int64)


def _with_target(documents: DataFrame, labels: DataFrame, model: RatioModel, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """All columns as c0, c1, ... with the text, the noise of the row and whether the target sample has it."""

    sample, _ = sample_labels(labels, id_col, label_col, model.settings.target_documents, "quality")
    target = F.broadcast(sample.where("y = 1").select("id", F.lit(True).alias("is_target")))
    at, text = documents.columns.index(id_col), documents.columns.index(text_col)
    rows = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))])
    uniform = (unit_hash(F.col(f"c{at}"), "gumbel") * float(1 << 30) + 0.5) / float(1 << 30)
    rows = rows.withColumns({"text": F.col(f"c{text}").cast("string"), "noise": -F.log(-F.log(uniform))})
    rows = rows.join(target, rows[f"c{at}"] == target["id"], "left").drop("id")
    return rows.withColumn("is_target", F.coalesce("is_target", F.lit(False)))


def weigh(documents: DataFrame, labels: DataFrame, model: RatioModel, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, ``log_weight``, ``n_grams``, ``expected`` (chance to be target text) and ``sampling_key`` of every row."""

    spark = ready(documents.sparkSession)
    source = _with_target(documents.select(id_col, text_col), labels, model, id_col, text_col, label_col)
    id_type = source.schema["c0"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch):
        chosen = batch.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
        for low, high, data, offsets, _ in chunks(batch.column("text")):
            weights, sizes = log_weights(shared.value, data, offsets, chosen[low:high])
            keys = weights + batch.column("noise").slice(low, high - low).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("c0").slice(low, high - low), pa.array(weights), pa.array(sizes), pa.array(keys)],
                ["id", "log_weight", "n_grams", "sampling_key"],
            )

    scored = map_rows(source.select("c0", "text", "noise", "is_target"), score, f"id {id_type}, log_weight double, n_grams long, sampling_key double")
    return scored.select(
        F.col("id").alias(id_col),
        "log_weight",
        "n_grams",
        F.least(F.lit(1.0), F.lit(model.prior) * F.exp(F.least("log_weight", F.lit(50.0)))).alias("expected"),
        "sampling_key",
    )


def kth_largest(values: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column; None if it has fewer.

    The range is cut into 4096 parts, the part that holds the value becomes the next range, until
    all its values are equal. Only counts reach the driver.
    """

    rows = values.select(F.col(column).alias("x")).where("x is not null")
    low, high, n = rows.agg(F.min("x"), F.max("x"), F.count("*")).first()
    if k < 1 or n < k:
        return None
    rank = k
    while low < high:
        width = (high - low) / 4096
        part = F.least(F.floor((F.col("x") - low) / width), F.lit(4095))
        inside = rows.where((F.col("x") >= low) & (F.col("x") <= high))
        found = inside.groupBy(part.alias("part")).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n"))
        for row in sorted(found.collect(), key=lambda r: -r["part"]):
            if rank <= row["n"]:
                low, high = row["lo"], row["hi"]
                break
            rank -= row["n"]
    return high


def select_by_importance(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", settings: Settings = Settings(), k: int | None = None) -> DataFrame:
    """One row per input row: id, ``log_weight``, ``n_grams``, ``expected``, ``sampling_key``, ``kept``.

    ``k`` defaults to the expected number of target-like rows, the sum of ``expected``. Rows whose
    key equals the k-th largest are all kept, so repeated rows share their fate. A null or empty
    text has log weight 0. Rows with a null id are weighed like others and share one noise value.
    Without any label every log weight is 0 and every row is kept. Other columns are not read.
    """

    weighed, _, least = _threshold(documents, labels, id_col, text_col, label_col, settings, k)
    return weighed.withColumn("kept", F.col("sampling_key") >= F.lit(least))


def _threshold(documents, labels, id_col, text_col, label_col, settings, k):
    """(weighed rows, model, least key that is kept)."""

    model = fit_ratio_model(documents, labels, id_col, text_col, label_col, settings)
    weighed = weigh(documents, labels, model, id_col, text_col, label_col).checkpoint()
    if k is None:
        k = round(weighed.agg(F.coalesce(F.sum("expected"), F.lit(0.0))).first()[0])
    least = kth_largest(weighed, "sampling_key", k)
    return weighed, model, least if least is not None else (-math.inf if k > 0 else math.inf)


def keep_important(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", settings: Settings = Settings(), k: int | None = None) -> DataFrame:
    """The rows of ``documents`` that ``select_by_importance`` keeps, all columns as they are.

    Texts are weighed again instead of joined, so no text is shuffled.
    """

    _, model, least = _threshold(documents, labels, id_col, text_col, label_col, settings, k)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = _with_target(documents, labels, model, id_col, text_col, label_col)
    columns = [f"c{i}" for i in range(len(documents.columns))]

    def keep(batch: pa.RecordBatch):
        chosen = batch.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
        for low, high, data, offsets, _ in chunks(batch.column("text")):
            weights, _ = log_weights(shared.value, data, offsets, chosen[low:high])
            keys = weights + batch.column("noise").slice(low, high - low).to_numpy()
            yield batch.select(columns).slice(low, high - low).filter(pa.array(keys >= least))

    return map_rows(rows, keep, rows.select(columns).schema).toDF(*documents.columns)
