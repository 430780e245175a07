"""Toxicity with a counterfactually regularised classifier.

A document is a set of sentences, and its logit is the largest sentence logit, so a single toxic
sentence counts in a text of any length. A sentence's logit is linear in hashed features of its
words: the word, its first four and its first five bytes. Features that occur significantly more
often in toxic documents start from their log odds; others, and negative evidence, have no weight, so
ordinary words can't outweigh an insult. Adam with an L1 step then minimises the cross-entropy of the
documents, plus a penalty on the squared change of the
logit between a labelled sentence and the same sentence with its identity terms swapped for others
of their group. So a mention of a group is no evidence by itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.sampling import sample_labels
from llm.shipping import ready
from llm.textbatch import byte_set, chunks, fold_case, map_rows, mix, prefix_sums, span_hashes, word_spans

# Identity terms by group; a swap stays within a group.
IDENTITY_TERMS = (
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("ausländer", "flüchtlinge", "einheimische"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("étrangers", "immigrés", "réfugiés"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
    ("extranjeros", "inmigrantes", "refugiados"),
)

#: Word characters: ASCII letters and digits, the apostrophe, and everything beyond ASCII.
_BREAKS = byte_set(*[b for b in range(128) if not (chr(b).isalnum() or chr(b) == "'")])
_STOPS = byte_set(*b".!?\n")
_STOPS_COUNT = _STOPS.astype(np.int64)


@dataclass(frozen=True)
class Settings:
    """``documents_per_class`` bounds the training sample, ``document_sentences`` what it takes of one document
    (the sentences of smallest hash), ``sentence_words`` a sentence: together at most 0.6 GB. Features in
    fewer than ``least_documents`` of the sample have no weight. Scores read whole texts."""

    documents_per_class: int = 1500
    document_sentences: int = 256
    bits: int = 18
    sentence_words: int = 64
    steps: int = 60
    rate: float = 0.02
    sparsity: float = 2e-4
    significance: float = 10.0
    least_documents: int = 4
    fairness: float = 1.0
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    settings: Settings = field(default_factory=Settings)


def sentence_features(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(three features of every word, first word of each sentence, row of each sentence)."""

    folded = fold_case(data)
    starts, ends, rows = word_spans(folded, offsets, _BREAKS)
    if not len(starts):
        return np.zeros((0, 3), np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = prefix_sums(folded)
    mask = np.uint64((1 << settings.bits) - 1)
    features = np.empty((len(starts), 3), np.int32)
    for column, size in enumerate((None, 4, 5)):
        stop = ends if size is None else np.minimum(ends, starts + size)
        salt = np.uint64((column + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        features[:, column] = ((span_hashes(sums, starts, stop) ^ salt) >> np.uint64(20)) & mask
    stops = np.concatenate([[0], np.cumsum(_STOPS_COUNT[data])])[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (stops[1:] != stops[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    place = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
    first = np.flatnonzero(place % settings.sentence_words == 0)
    return features, first, rows[first]


def document_logits(model: ToxicityModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Largest sentence logit of each row; the bias for a row without words."""

    features, first, rows = sentence_features(data, offsets, model.settings)
    logits = np.full(len(offsets) - 1, -np.inf)
    if len(first):
        words = model.weights[features].sum(1)
        np.maximum.at(logits, rows, np.add.reduceat(words, first))
    return np.where(np.isneginf(logits), 0.0, logits) + model.bias


def swapped_sentences(text: str, settings: Settings) -> list[tuple[str, str]]:
    """(sentence, sentence with its identity terms swapped) for each sentence that names a group."""

    other = {}
    for group in settings.terms:
        for i, term in enumerate(group):
            other[term] = group[(i + 1) % len(group)]
    found = []
    for sentence in re.split(r"[.!?\n]", text.lower()):
        words = re.findall(r"[\w']+", sentence)[: settings.sentence_words]
        if any(word in other for word in words):
            found.append((" ".join(words), " ".join(other.get(word, word) for word in words)))
    return found


def _some(n: int, most: int) -> np.ndarray:
    """At most ``most`` of the places 0 to n - 1, in order, spread by a hash."""

    if n <= most:
        return np.arange(n)
    return np.sort(np.argpartition(mix(np.arange(1, n + 1, dtype=np.uint64)), most)[:most])


def training_rows(documents: DataFrame, sample: DataFrame, settings: Settings) -> DataFrame:
    """Features of the sampled documents and of the counterfactual pairs of their sentences."""

    ready(documents.sparkSession)
    source = documents.join(F.broadcast(sample), "id").select("id", "y", "text")  # bounded by documents_per_class
    id_type = source.schema["id"].dataType.simpleString()

    def encode(batch: pa.RecordBatch):
        keys, truth = batch.column("id").to_pylist(), batch.column("y").to_pylist()
        out = {"id": [], "y": [], "pair": [], "features": [], "first": []}

        def add(i, pair, features, first):
            for name, value in zip(out, (keys[i], truth[i], pair, features.tobytes(), first.astype(np.int32).tobytes()), strict=True):
                out[name].append(value)

        for low, high, data, offsets, _ in chunks(batch.column("text")):
            features, first, rows = sentence_features(data, offsets, settings)
            words = np.append(first, len(features))
            bounds = np.searchsorted(rows, np.arange(high - low + 1))
            for row in range(high - low):
                chosen = bounds[row] + _some(bounds[row + 1] - bounds[row], settings.document_sentences)
                parts = [features[words[k] : words[k + 1]] for k in chosen]
                own = np.concatenate(parts) if parts else features[:0]
                add(low + row, False, own, np.cumsum([0, *map(len, parts)])[:-1])
                text = data[offsets[row] : offsets[row + 1]].tobytes().decode()
                pairs = swapped_sentences(text, settings)
                for pair in (pairs[k] for k in _some(len(pairs), settings.document_sentences)):
                    parts = [np.frombuffer(x.encode(), np.uint8) for x in pair]
                    both = [sentence_features(x, np.array([0, len(x)]), settings)[0] for x in parts]
                    add(low + row, True, np.concatenate(both), np.array([0, len(both[0])]))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("id", batch.column("id").type), ("y", pa.int32()), ("pair", pa.bool_()), ("features", pa.binary()), ("first", pa.binary())]))

    return map_rows(source, encode, f"id {id_type}, y int, pair boolean, features binary, first binary")


def _document_frequencies(features, words_row, truth, size):
    """Positive and negative documents of each feature."""

    found = np.unique(np.repeat(words_row, 3).astype(np.int64) * size + features.reshape(-1))
    row, feature = found // size, found % size
    positive = np.bincount(feature[truth[row] == 1], minlength=size).astype(float)
    return positive, np.bincount(feature, minlength=size) - positive


def train(rows, settings: Settings) -> ToxicityModel:
    """``rows``: a pandas frame of ``training_rows``."""

    size = 1 << settings.bits
    rows = rows.sort_values(["pair", "id", "features"], kind="stable")
    documents, pairs = rows[~rows["pair"]], rows[rows["pair"]]
    truth = documents["y"].to_numpy(np.int64)
    positives, negatives = int(truth.sum()), int((1 - truth).sum())
    if not positives or not negatives:
        return ToxicityModel(np.zeros(size, np.float32), 4.0 if positives else -4.0, settings)

    def unpack(frame):
        features = [np.frombuffer(x, np.int32).reshape(-1, 3) for x in frame["features"]]
        first = [np.frombuffer(x, np.int32).astype(np.int64) for x in frame["first"]]
        begin = np.cumsum([0] + [len(x) for x in features])
        row = np.repeat(np.arange(len(frame)), [len(x) for x in first])
        return (
            np.concatenate(features) if features else np.zeros((0, 3), np.int32),
            np.concatenate([f + b for f, b in zip(first, begin, strict=False)]) if features else np.zeros(0, np.int64),
            row,
            np.repeat(np.arange(len(frame)), np.diff(begin)),
        )

    features, first, sentence_row, words_row = unpack(documents)
    # Start: smoothed log odds of significant features.
    a, b = _document_frequencies(features, words_row, truth, size)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    both = (a + b) / (positives + negatives)
    gain = 2 * (a * (log(a / positives) - log(both)) + b * (log(b / negatives) - log(both)))
    odds = log((a + 0.5) / (positives + 1)) - log((b + 0.5) / (negatives + 1))
    evidence = (gain >= settings.significance) & (odds > 0) & (a + b >= settings.least_documents)
    weights = np.where(evidence, odds / 3, 0.0)
    bias = -2.0

    pair_features, pair_first, _, _ = unpack(pairs)
    lengths = np.diff(np.append(pair_first, len(pair_features)))
    sign = np.repeat(np.where(np.arange(len(pair_first)) % 2 == 0, 1.0, -1.0), lengths)
    pair_row = np.repeat(np.arange(len(pair_first)) // 2, lengths)
    bounds = np.append(first, len(features))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    balance = np.where(truth == 1, 0.5 / positives, 0.5 / negatives)
    held = np.bincount(sentence_row, minlength=len(truth)) > 0
    for step in range(1, settings.steps + 1):
        sums = np.add.reduceat(weights[features].sum(1), first) if len(first) else np.zeros(0)
        best = np.full(len(truth), -np.inf)
        np.maximum.at(best, sentence_row, sums)
        top = np.flatnonzero(sums == best[sentence_row])
        top = top[np.unique(sentence_row[top], return_index=True)[1]]  # the first of equals
        logit = np.where(held, best, 0.0) + bias
        slope = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - truth) * balance
        gradient = np.zeros(size + 1)
        gradient[size] = slope.sum()
        counts = bounds[top + 1] - bounds[top]
        place = np.arange(counts.sum()) + np.repeat(bounds[top] - (np.cumsum(counts) - counts), counts)
        spread = np.repeat(slope[sentence_row[top]], counts)
        gradient[:size] += np.bincount(features[place].reshape(-1), np.repeat(spread, 3), size)
        if len(pair_first) and settings.fairness:
            change = np.bincount(pair_row, weights[pair_features].sum(1) * sign)
            push = 2 * settings.fairness * change[pair_row] * sign / len(change)
            gradient[:size] += np.bincount(pair_features.reshape(-1), np.repeat(push, 3), size)
        gradient[:size][~evidence] = 0
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient * gradient - v)
        move = settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        weights = weights - move[:size]
        weights = np.maximum(weights - settings.rate * settings.sparsity, 0)  # evidence only adds
        bias -= move[size]
    return ToxicityModel(weights.astype(np.float32), float(bias), settings)


def fit_toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", settings: Settings = Settings()) -> ToxicityModel:
    """Learn from a bounded sample of labelled documents. Without both labels, a constant."""

    ready(documents.sparkSession)
    sample, _ = sample_labels(labels, id_col, label_col, settings.documents_per_class, "toxicity")
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return train(training_rows(source, sample, settings).toPandas(), settings)


def score_toxicity(documents: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``score`` (0 to 1), ``predicted`` (1 from score 0.5).

    Whole texts are read. A null or empty text, or one without words, has the score of the bias.
    Repeated rows and null ids are answered like any other; other columns are not read.
    """

    spark = ready(documents.sparkSession)
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch):
        for low, high, data, offsets, _ in chunks(batch.column("text")):
            chance = 1 / (1 + np.exp(-np.clip(document_logits(shared.value, data, offsets), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(low, high - low), pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))], ["id", "score", "predicted"]
            )

    return map_rows(source, score, f"id {id_type}, score double, predicted int").withColumnRenamed("id", id_col)


def remove_toxic(documents: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns as they are, whose text isn't predicted toxic."""

    spark = ready(documents.sparkSession)
    shared, place = spark.sparkContext.broadcast(model), documents.columns.index(text_col)

    def keep(batch: pa.RecordBatch):
        for low, high, data, offsets, _ in chunks(batch.column(place)):
            yield batch.slice(low, high - low).filter(pa.array(document_logits(shared.value, data, offsets) < 0))

    return map_rows(documents, keep, documents.schema)
