"""Cross-entropy difference of two matched n-gram models, counted exactly over the whole corpus.

A target model (documents labelled good) and a background model (all documents) share one vocabulary: all
words and word pairs of the corpus, as 56-bit keys, and a boundary before the first and after the last word. Both
have the same form. An event's (a word's or the end's) loss is the weighted mean of its unigram loss and its bigram
loss, the bigram probability being the smoothed share of the pair over that of the event before. Background counts are scaled to the number of target tokens. Every document is scored
against what the *other* documents hold: its own counts are taken out of both models first. The score is
the mean over its events of target loss minus background loss; lower means more like the target.

Every word is the event before exactly one other, so a text's loss is a sum over its keys, a word weighing
2 * ``unigram`` - 1 each time and a pair 1 - ``unigram``. No task needs a model as a whole:

1. Keys that make up a share ``heavy`` of the corpus are found with bounded summaries per task; there can be at most
   2 / ``heavy`` of them, so they are broadcast with their exact counts, and no key is hot in what follows.
2. Each task turns its documents into blocks of sorted (key, document, times) and sends every block's keys
   to the bucket they belong to, compressed. What is sent grows with the corpus.
3. A bucket adds up each key over all blocks and returns, for every document that shares a key with another
   one, the logarithms of the counts without its own. Keys of one document alone have count zero and
   need no answer.
4. The answers meet their block again and are added up by document.

Texts are shuffled for the target label alone, and only those which a fixed-size filter of the good ids lets
through. Blocks are cut from rows in a fixed order, so a lost task gives the same blocks again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shipping import ready
from llm.textbatch import chunks, fold_case, mix, prefix_sums, span_hashes, word_spans


@dataclass(frozen=True)
class Settings:
    """``unigram`` is the weight of the unigram loss, ``pseudo_words`` and ``pseudo_pairs`` are added to every
    count. ``heavy`` is the share of all keys from which one is broadcast, ``bucket`` the keys and documents a
    bucket holds on average, ``summary`` the keys a task keeps to find the heavy ones, ``filter_bits`` the size of
    the filter of good ids (a power of two)."""

    unigram: float = 0.7
    pseudo_words: float = 0.1
    pseudo_pairs: float = 0.01
    heavy: float = 1e-6
    bucket: int = 1_000_000
    summary: int = 1 << 18
    filter_bits: int = 1 << 24


@dataclass
class Models:
    """What step 1 leaves: exact counts of the heavy keys, and the totals."""

    keys: np.ndarray
    counts: np.ndarray
    target: np.ndarray
    tokens: int
    target_tokens: int
    settings: Settings


@dataclass
class Postings:
    """Distinct keys of each row with the number of their occurrences, sorted by key, then row."""

    keys: np.ndarray
    rows: np.ndarray
    times: np.ndarray
    n_tokens: np.ndarray


#: The lowest bit of a key tells pairs from words; the upper byte is empty. The boundary is a word of its own.
_PAIR = np.uint64(1)
_KEY_BITS = np.uint64(56)
_BOUNDARY = np.uint64(0x5BD1E995)


def _key(hashes: np.ndarray, pair: bool) -> np.ndarray:
    return (hashes >> (np.uint64(64) - _KEY_BITS) | _PAIR) ^ (np.uint64(0) if pair else _PAIR)


def postings(data: np.ndarray, offsets: np.ndarray) -> Postings:
    """The keys of consecutive texts; a text without words has none, not even the boundary."""

    n_rows = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Postings(none.astype(np.uint64), none, none, np.zeros(n_rows, np.int64))
    n_tokens = np.bincount(rows, minlength=n_rows)
    words = span_hashes(prefix_sums(fold_case(data)), starts, ends)
    # Each text's events: its words, then the boundary; the event before the first word is the boundary too.
    last = np.flatnonzero(np.append(rows[1:] != rows[:-1], True))
    events = np.insert(words, last + 1, _BOUNDARY)
    owner = np.insert(rows, last + 1, rows[last])
    before = np.concatenate([[_BOUNDARY], events[:-1]])
    pairs = mix(before * np.uint64(0x9E3779B97F4A7C15) + events)
    keys, owner = np.concatenate([_key(events, False), _key(pairs, True)]), np.concatenate([owner, owner])
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    at = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]))
    return Postings(keys[at], owner[at], np.diff(np.append(at, len(keys))), n_tokens)


def weights(keys: np.ndarray, times: np.ndarray, settings: Settings) -> np.ndarray:
    return np.where(keys & _PAIR, 1 - settings.unigram, 2 * settings.unigram - 1) * times


def _totals(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys of sorted ones, and the sums of values by key."""

    if not len(keys):
        return keys, *values
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], *[np.add.reduceat(value, at) for value in values]


# Good ids


def _flagged(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings) -> DataFrame:
    """(id, text, target): all documents, target true for good ones.

    Good ids set bits of a filter whose size is fixed; only documents that hit a set bit are joined with the
    good ids, the others can't be good. Rows are in an order that doesn't depend on the run.
    """

    def place(ids):
        return F.pmod(F.xxhash64(ids), F.lit(settings.filter_bits))

    good = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y = 1")
    kind = documents.schema[id_col].dataType
    good = good.select(F.col("id").cast(kind).alias("id")).distinct()
    bits = good.select(place(F.col("id")).alias("p")).select(F.expr("p div 64").alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit"))
    bits = bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))  # at most filter_bits / 64 rows
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    marked = source.withColumn("p", place(F.col("id"))).withColumn("word", F.expr("p div 64"))
    marked = marked.join(F.broadcast(bits), "word", "left")
    maybe = F.col("id").isNotNull() & F.coalesce(F.expr("shiftright(bits, cast(p % 64 as int)) & 1L = 1L"), F.lit(False))
    # The same join at every size: a plan that broadcasts small label tables says nothing about large ones.
    known = marked.where(maybe).select("id", "text").join(good.withColumn("target", F.lit(True)).hint("merge"), "id", "left")
    known = known.select("id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    ordered = known.sortWithinPartitions("id", F.xxhash64("text"), "target")
    return marked.where(~maybe).select("id", "text", F.lit(False).alias("target")).unionByName(ordered)


def _flags(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("target").to_numpy(zero_copy_only=False).astype(bool)


# Heavy keys


def fit_models(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", settings: Settings = Settings()) -> tuple[Models, DataFrame]:
    """(heavy part of both models, documents with their label): what ``score_documents`` needs.

    A label of 1 makes a document good, also beside other labels; null ids are never good. Without documents or
    good ones the models are empty.
    """

    spark = ready(documents.sparkSession)
    flagged = _flagged(documents, labels, id_col, text_col, label_col, settings)

    def summarise(batches):
        """Frequent keys of the task with lower bounds of their counts; memory is bounded by the summary."""

        keys, counts, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for batch in batches:
            for _, _, data, offsets, _ in chunks(batch.column("text")):
                own = postings(data, offsets)
                seen += int(own.times.sum())
                more, n = _totals(own.keys, own.times)
                joined = np.concatenate([keys, more])
                order = np.argsort(joined, kind="stable")
                keys, counts = _totals(joined[order], np.concatenate([counts, n])[order])
                if len(keys) > settings.summary:
                    kept = np.sort(np.argpartition(counts, -settings.summary)[-settings.summary :])
                    keys, counts = keys[kept], counts[kept]
        often = counts >= seen * settings.heavy / 2
        for low in range(0, max(1, int(often.sum())), 50_000):
            part = slice(low, low + 50_000)
            yield pa.RecordBatch.from_pydict({"key": keys[often][part].view(np.int64), "n": counts[often][part]})
        yield pa.RecordBatch.from_pydict({"key": pa.array([None], pa.int64()), "n": pa.array([seen], pa.int64())})

    source = documents.select(F.col(text_col).cast("string").alias("text"))
    found = source.mapInArrow(summarise, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).checkpoint()
    total = found.where("key is null").first()
    total = total["n"] if total else 0
    # Counts are lower bounds and add up to the total at most, which bounds the number of rows.
    chosen = found.where(F.col("key").isNotNull() & (F.col("n") >= max(1.0, total * settings.heavy / 2))).select("key").toPandas()
    heavy = np.sort(chosen["key"].to_numpy(np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(heavy)

    def count(batches):
        """Exact counts of the heavy keys in the task, and its tokens under the key null."""

        keys = shared.value
        every, own, seen = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), [0, 0]
        for batch in batches:
            good = _flags(batch)
            for low, high, data, offsets, _ in chunks(batch.column("text")):
                found = postings(data, offsets)
                mine = good[low:high]
                at, hit = _positions(keys, found.keys)
                np.add.at(every, at[hit], found.times[hit])
                np.add.at(own, at[hit], found.times[hit] * mine[found.rows[hit]])
                seen = [seen[0] + int(found.n_tokens.sum()), seen[1] + int(found.n_tokens[mine].sum())]
        present = np.flatnonzero(every)
        for low in range(0, len(present), 50_000):
            part = present[low : low + 50_000]
            yield pa.RecordBatch.from_pydict({"key": keys[part].view(np.int64), "n": every[part], "target": own[part]})
        yield pa.RecordBatch.from_pydict({"key": pa.array([None], pa.int64()), "n": [seen[0]], "target": [seen[1]]})

    counts = flagged.mapInArrow(count, "key long, n long, target long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
    got = counts.toPandas()  # a row per heavy key
    sums, got = got[got["key"].isna()], got[got["key"].notna()]
    keys = got["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    tokens, target_tokens = (int(sums[name].sum()) for name in ("n", "target"))
    return Models(keys[order], got["n"].to_numpy(np.int64)[order], got["target"].to_numpy(np.int64)[order], tokens, target_tokens, settings), flagged


def _positions(held: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys are held in a sorted array, and which of them are."""

    if not len(held):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
    return at, held[at] == keys


# Scores


def log_counts(keys: np.ndarray, counts: np.ndarray, target: np.ndarray, models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of smoothed target and scaled background counts."""

    s = models.settings
    scale = models.target_tokens / max(1, models.tokens)
    pseudo = np.where(keys & _PAIR, s.pseudo_pairs, s.pseudo_words)
    return np.log(target + pseudo), np.log(counts * scale + pseudo)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as compressed bytes; the first is sorted and stored by its differences."""

    if not len(arrays[0]):
        return b""
    parts = []
    for k, values in enumerate(arrays):
        if k == 0:
            values = np.diff(values, prepend=values.dtype.type(0))
        parts.append(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())
    return pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int, *kinds) -> list[np.ndarray]:
    sizes = [np.dtype(kind).itemsize for kind in kinds]
    if not n:
        return [np.zeros(0, kind) for kind in kinds]
    raw = np.frombuffer(pa.decompress(packed, decompressed_size=n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for k, (kind, size) in enumerate(zip(kinds, sizes)):
        values = np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel()
        out.append(np.cumsum(values, dtype=kind) if k == 0 else values)
        at += n * size
    return out


_SENT = "bucket int, block long, n int, packed binary, head binary"


def _blocks(batches: Iterator[pa.RecordBatch], held: Models, buckets: int) -> Iterator[pa.RecordBatch]:
    """Step 2: the light keys of each block by bucket, and a head with ids and sums of the heavy ones."""

    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        good = _flags(batch)
        for low, high, data, offsets, _ in chunks(batch.column("text")):
            found, mine = postings(data, offsets), good[low:high]
            at, hit = _positions(held.keys, found.keys)
            sums = _row_sums(found, hit, held.counts[at[hit]], held.target[at[hit]], mine, held, high - low)
            light = ~hit
            # Unanswered keys have count zero in both models.
            alone = _row_sums(found, light, found.times[light], found.times[light] * mine[found.rows[light]], mine, held, high - low)
            head = pa.RecordBatch.from_arrays(
                [batch.column("id").slice(low, high - low), *map(pa.array, (found.n_tokens, mine, *(a + b for a, b in zip(sums, alone))))],
                ["id", "n_tokens", "mine", "target_sum", "background_sum"],
            )
            rows = [(int(block % buckets), block, 0, b"", _bytes_of(head))]
            keys, owner, times = found.keys[light], found.rows[light], found.times[light]
            # Keys are sorted, so each bucket of their upper bits is one stretch.
            home = ((keys >> (_KEY_BITS - np.uint64(32))) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(home)) + 1, [len(keys)]]) if len(keys) else [0]
            signed = np.where(mine[owner], -times, times).astype(np.int32)
            for a, b in zip(cuts, cuts[1:]):
                packed = _pack(keys[a:b], owner[a:b].astype(np.uint32), signed[a:b])
                rows.append((int(home[a]), block, b - a, packed, None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                ["bucket", "block", "n", "packed", "head"],
            )
            block += 1


def _row_sums(found: Postings, which: np.ndarray, counts, target, mine: np.ndarray, models: Models, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted logarithms by row of some keys, their own counts taken out."""

    if not which.any():
        return np.zeros(n_rows), np.zeros(n_rows)
    rows, times = found.rows[which], found.times[which]
    logs = log_counts(found.keys[which], counts - times, target - times * mine[rows], models)
    return tuple(np.bincount(rows, weights=weights(found.keys[which], times, models.settings) * log, minlength=n_rows) for log in logs)


def _bytes_of(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _answer(batches: Iterator[pa.RecordBatch], models: Models) -> Iterator[pa.RecordBatch]:
    """Step 3: for each block, the changes against count zero of its documents that share keys; heads go along."""

    blocks, parts = [], []
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = ["block", "n", "packed", "head"]
    for batch in batches:
        for block, n, packed, head in zip(*(batch.column(name).to_pylist() for name in names)):
            if head is not None:
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((block, 0, b"", head), kinds)], names)
            else:
                blocks.append(np.full(n, block, np.int64))
                parts.append(_unpack(packed, n, np.uint64, np.uint32, np.int32))
    if not parts:
        return
    block = np.concatenate(blocks)
    keys, rows, signed = (np.concatenate(values) for values in zip(*parts))
    del blocks, parts
    order = np.argsort(keys, kind="stable")
    keys, block, rows, signed = keys[order], block[order], rows[order], signed[order].astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(at, len(keys)))
    shared = np.repeat(size > 1, size)
    times, mine = np.abs(signed), signed < 0
    counts = np.repeat(np.add.reduceat(times, at), size) - times
    target = np.repeat(np.add.reduceat(times * mine, at), size) - times * mine
    keys, block, rows, times, counts, target = (v[shared] for v in (keys, block, rows, times, counts, target))
    zero = np.zeros(len(keys), np.int64)
    weight = weights(keys, times, models.settings)
    changes = [weight * (log - none) for log, none in zip(log_counts(keys, counts, target, models), log_counts(keys, zero, zero, models))]
    order = np.lexsort((rows, block))
    block, rows = block[order], rows[order]
    new = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (rows[1:] != rows[:-1])])) if len(block) else np.zeros(0, np.int64)
    if not len(new):
        return
    changes = [np.add.reduceat(change[order], new).astype(np.float32) for change in changes]
    block, rows = block[new], rows[new]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
    for low in range(0, len(cuts) - 1, 1000):
        some = list(zip(cuts[low : low + 1000], cuts[low + 1 : low + 1001]))
        out = [(int(block[a]), b - a, _pack(rows[a:b], *(change[a:b] for change in changes)), None) for a, b in some]
        yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*out), kinds)], names)


def _finish(batches: Iterator[pa.RecordBatch], models: Models, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Step 4: rows come by block, the head first; one block is held at a time."""

    head, sums = None, []

    def done() -> Iterator[pa.RecordBatch]:
        if head is None:
            return
        n, mine = (np.asarray(head.column(name).to_numpy(zero_copy_only=False)) for name in ("n_tokens", "mine"))
        # Both models have the size of the target and the document's own tokens are out of both.
        scale = models.target_tokens / max(1, models.tokens)
        sizes = [models.target_tokens - n * mine, (models.tokens - n) * scale]
        # The weights of an event's keys add up to ``unigram``.
        losses = [np.log(np.maximum(size, 0) + 1.0) * models.settings.unigram - total / (n + 1) for size, total in zip(sizes, sums)]
        one, two = (np.where(n > 0, loss, 0.0) for loss in losses)
        yield pa.RecordBatch.from_arrays([head.column("id"), *map(pa.array, (n, one, two, one - two))], schema=schema)

    for batch in batches:
        for _, n, packed, more in zip(*(batch.column(name).to_pylist() for name in ("block", "n", "packed", "head"))):
            if more is not None:
                yield from done()
                head = pa.ipc.open_stream(more).read_next_batch()
                sums = [np.array(head.column(name)) for name in ("target_sum", "background_sum")]
            else:
                rows, *changes = _unpack(packed, n, np.uint32, np.float32, np.float32)
                for total, change in zip(sums, changes):
                    total[rows] += change
    yield from done()


def score_documents(fitted: tuple[Models, DataFrame], id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, ``n_tokens``, ``target_loss``, ``background_loss``, ``score``.

    Losses are means in nats over the tokens of the whole text. A null or empty text has no tokens
    and losses 0. Repeated rows and null ids are scored like any other, each against all others; other columns
    are not read; an empty table gives no rows.
    """

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    models, flagged = fitted
    spark = ready(flagged.sparkSession)
    kind = flagged.schema["id"].dataType.simpleString()
    buckets = max(1, -(-2 * models.tokens // models.settings.bucket))
    shared = spark.sparkContext.broadcast(models)
    sent = flagged.mapInArrow(lambda batches: _blocks(batches, shared.value, buckets), _SENT)
    answered = sent.repartition(buckets, "bucket").mapInArrow(lambda batches: _answer(batches, shared.value), "block long, n int, packed binary, head binary")
    met = answered.repartition(buckets, "block").sortWithinPartitions("block", F.col("head").isNull())
    text = f"id {kind}, n_tokens long, target_loss double, background_loss double, score double"
    schema = to_arrow_schema(StructType.fromDDL(text))
    return met.mapInArrow(lambda batches: _finish(batches, shared.value, schema), text).withColumnRenamed("id", id_col)
