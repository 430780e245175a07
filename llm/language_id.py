"""Language identification with a byte convolutional network.

The network reads windows of ``Settings.window`` bytes. Filters of several widths slide over the
(one-hot) bytes, each filter keeps its maximum over the window, and a softmax over the maxima gives
the window's language. A filter of width w over one-hot bytes is a table of w x 256 weights, so a
convolution is a sum of table rows. All windows of a text are scored, and their mean log
probabilities, weighted by bytes, decide.

Training is plain numpy on a bounded sample of windows; scoring runs in batches on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shipping import ready
from llm.textbatch import chunks, fold_case, map_rows, mix, unit_hash

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``documents_per_language`` and ``windows_per_document`` bound the training sample."""

    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    documents_per_language: int = 500
    windows_per_document: int = 4
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass
class ByteNetwork:
    languages: list[str]
    settings: Settings
    tables: dict[int, np.ndarray] = field(default_factory=dict)  # width -> (width, 256, filters)
    biases: dict[int, np.ndarray] = field(default_factory=dict)
    dense: np.ndarray | None = None
    offset: np.ndarray | None = None

    def start(self) -> None:
        rng = np.random.default_rng(self.settings.seed)
        for width in self.settings.widths:
            self.tables[width] = rng.normal(0, 0.3, (width, 256, self.settings.filters)).astype(np.float32)
            self.tables[width][:, 0] = 0  # padding says nothing
            self.biases[width] = np.zeros(self.settings.filters, np.float32)
        pooled = len(self.settings.widths) * self.settings.filters
        self.dense = rng.normal(0, pooled**-0.5, (pooled, len(self.languages))).astype(np.float32)
        self.offset = np.zeros(len(self.languages), np.float32)

    def convolve(self, windows: np.ndarray, width: int) -> np.ndarray:
        """(windows, positions, filters) before pooling."""

        positions = windows.shape[1] - width + 1
        out = self.biases[width] + self.tables[width][0][windows[:, :positions]]
        for place in range(1, width):
            out += self.tables[width][place][windows[:, place : place + positions]]
        return out

    def train(self, windows: np.ndarray, truth: np.ndarray) -> None:
        """Minibatch Adam on the cross-entropy; only a filter's maximal position has a gradient."""

        self.start()
        s, rng = self.settings, np.random.default_rng(self.settings.seed + 1)
        weights = [*self.tables.values(), *self.biases.values(), self.dense, self.offset]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        shares = np.bincount(truth, minlength=len(self.languages))
        balance = (len(truth) / (np.maximum(shares, 1) * max(1, np.count_nonzero(shares)))).astype(np.float32)
        for epoch in range(s.epochs):
            rate = s.rate * (1 - epoch / s.epochs) + 1e-4
            order = rng.permutation(len(windows))
            for low in range(0, len(order), s.batch):
                rows = order[low : low + s.batch]
                part, target = windows[rows], truth[rows]
                pooled, places = [], {}
                for width in s.widths:
                    out = self.convolve(part, width)
                    places[width] = out.argmax(1)
                    pooled.append(np.maximum(out.max(1), 0))
                hidden = np.concatenate(pooled, 1)
                slope = _softmax(hidden @ self.dense + self.offset)
                slope[np.arange(len(rows)), target] -= 1
                slope *= balance[target][:, None] / len(rows)
                back = (slope @ self.dense.T) * (hidden > 0)
                grads = []
                for i, width in enumerate(s.widths):
                    own = back[:, i * s.filters : (i + 1) * s.filters]
                    grad = np.zeros_like(self.tables[width])
                    filters = np.broadcast_to(np.arange(s.filters), own.shape)
                    for place in range(width):
                        seen = np.take_along_axis(part, places[width] + place, 1)
                        np.add.at(grad[place], (seen, filters), own)
                    grad[:, 0] = 0
                    grads.append(grad)
                grads += [back[:, i * s.filters : (i + 1) * s.filters].sum(0) for i in range(len(s.widths))]
                grads += [hidden.T @ slope, slope.sum(0)]
                step += 1
                for w, g, m, v in zip(weights, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def scorer(self) -> ByteScorer:
        return ByteScorer(self)


class ByteScorer:
    """The trained network with the tables of neighbouring bytes added up beforehand."""

    def __init__(self, net: ByteNetwork):
        self.net, self.pairs = net, {}
        for width in net.settings.widths:
            table, steps = net.tables[width], []
            for place in range(0, width - 1, 2):
                steps.append((place, (table[place][:, None, :] + table[place + 1][None, :, :]).reshape(65536, -1)))
            self.pairs[width] = (steps, table[width - 1] if width % 2 else None)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        net, size = self.net, windows.shape[1]
        codes = windows[:, :-1].astype(np.intp) * 256 + windows[:, 1:]
        pooled = []
        for width in net.settings.widths:
            positions = size - width + 1
            steps, last = self.pairs[width]
            out = None
            for place, table in steps:
                part = np.take(table, codes[:, place : place + positions], axis=0)
                out = part if out is None else np.add(out, part, out=out)
            if last is not None:
                part = np.take(last, windows[:, width - 1 : width - 1 + positions], axis=0)
                out = part if out is None else np.add(out, part, out=out)
            pooled.append(np.maximum(out.max(1) + net.biases[width], 0))
        logits = np.concatenate(pooled, 1) @ net.dense + net.offset
        logits -= logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True))

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean log probabilities of each row, over all its windows; zeros for an empty text."""

        windows, rows, sizes = cut_windows(fold_case(data), offsets, self.net.settings.window)
        total = np.zeros((len(offsets) - 1, len(self.net.languages)))
        for low in range(0, len(windows), 1024):
            part = self.log_probabilities(windows[low : low + 1024])
            np.add.at(total, rows[low : low + 1024], part * sizes[low : low + 1024, None])
        return total / np.maximum(np.diff(offsets), 1)[:, None]


def _softmax(logits: np.ndarray) -> np.ndarray:
    weights = np.exp(logits - logits.max(1, keepdims=True))
    return weights / weights.sum(1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows padded with zeros, row, bytes) covering every byte of every row exactly once."""

    lengths = np.diff(offsets)
    counts = -(-lengths // size)
    rows = np.repeat(np.arange(len(lengths)), counts)
    place = (np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)) * size
    starts = offsets[rows] + place
    sizes = np.minimum(size, lengths[rows] - place)
    padded = np.concatenate([data, np.zeros(size, np.uint8)])
    windows = padded[starts[:, None] + np.arange(size)]
    windows[np.arange(size) >= sizes[:, None]] = 0
    return windows, rows, sizes


def fit_language_network(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> ByteNetwork | None:
    """Train on the rows of ``documents`` with text and language; None if there are none.

    The sample takes each document by a hash of its id, with a share per language that gives about
    ``documents_per_language`` of them, and from each a few windows at places fixed by its length.
    """

    ready(documents.sparkSession)
    labelled = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.where("lang is not null and text is not null and length(text) > 0")
    counts = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, settings.documents_per_language / counts[lang]))])
    sample = labelled.where(unit_hash(F.col("id"), "language") < shares[F.col("lang")])
    size, most = settings.window, settings.windows_per_document

    def windows(batch: pa.RecordBatch):
        names = batch.column("lang").to_pylist()
        for low, high, data, offsets, _ in chunks(batch.column("text")):
            cut, rows, sizes = cut_windows(fold_case(data), offsets, size)
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            draw = mix((place * 1_000_003 + np.diff(offsets)[rows]).astype(np.uint64))
            order = np.lexsort((draw, rows))
            first = np.searchsorted(rows[order], rows[order])
            chosen = order[np.arange(len(order)) - first < most]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [names[low + r] for r in rows[chosen]],
                    "window": pa.array([w.tobytes() for w in cut[chosen]], pa.binary()),
                }
            )

    got = map_rows(sample.select("lang", "text"), windows, "lang string, window binary").toPandas()
    net = ByteNetwork(languages, settings)
    got = got.sort_values(["lang", "window"])  # the order of tasks has no say
    cut = np.frombuffer(b"".join(got["window"]), np.uint8).reshape(-1, size)
    net.train(cut, np.searchsorted(languages, got["lang"].to_numpy(str)))
    return net


def identify_languages(documents: DataFrame, net: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``.

    A text that is null or has no letter gets ``und`` with score 0, and so does every text if nothing
    was learned. Repeated rows and null ids are answered like any other; other columns are not read.
    """

    ready(documents.sparkSession)
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), has_letter.alias("has_letter"))
    if net is None:
        return source.select(F.col("id").alias(id_col), F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    id_type = source.schema["id"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(net)

    def score(batches):
        scorer = shared.value.scorer()
        names = np.array(shared.value.languages, dtype=object)
        for batch in batches:
            best, sure = np.full(batch.num_rows, UNDETERMINED, object), np.zeros(batch.num_rows)
            asked = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            for low, high, data, offsets, _ in chunks(batch.column("text"), 1 << 18):
                mean = scorer.texts(data, offsets)
                share = _softmax(mean)
                own = asked[low:high]
                best[low:high][own] = names[share.argmax(1)][own]
                sure[low:high][own] = share.max(1)[own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(best, pa.string()), pa.array(sure)], ["id", "lang_pred", "score"]
            )

    found = source.mapInArrow(score, f"id {id_type}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)
