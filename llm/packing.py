"""Harmonic packing of token sequences.

A document's ids are cut into pieces that fit a class: class k holds pieces of at most
``capacity // k`` ids, and every bin of class k takes exactly k pieces. A remainder is kept whole
where it nearly fills its class; otherwise the largest unit ``capacity // k`` is cut off and the
rest is classed again. Pieces below ``capacity // classes`` ids go to one last class, whose bins take
the next piece while it fits.

Each worker fills the bins of all classes for its own documents in one pass, holding only the open
bins. Bins that a worker leaves open (a bounded number of pieces) are packed again by a fan-in of
workers, level by level, until one worker's leftovers go first-fit into the final bins. Nothing is
dropped, and which documents share a bin depends on their order in the input alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.bpe import BytePairIds, vocabulary_paths
from llm.shipping import ready
from llm.textbatch import chunks


@dataclass(frozen=True)
class Settings:
    """``nearly`` is the filled share from which a piece is kept whole; ``fan_in`` the workers whose
    open bins one worker packs again."""

    capacity: int = 2048
    classes: int = 32
    nearly: float = 0.97
    end_id: int = 1
    fan_in: int = 64


def cut_points(length: int, settings: Settings) -> list[int]:
    """Lengths of the pieces of a document, in order."""

    capacity, smallest = settings.capacity, settings.capacity // settings.classes
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest  # the class that holds it: rest <= capacity // k
        if rest <= smallest or rest >= settings.nearly * (capacity // k):
            pieces.append(rest)
            break
        unit = capacity // (k + 1)
        pieces.append(unit)
        rest -= unit
    return pieces


def piece_class(length: int, settings: Settings) -> int:
    """Pieces per bin: 1 to ``classes``; 0 for the last class."""

    k = settings.capacity // length
    return 0 if k > settings.classes else k


class Bins:
    """The open bins of one worker; ``put`` returns the rows of a bin that is full."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.open: dict[int, list[tuple]] = {}
        self.filled = 0

    def put(self, piece: tuple) -> list[tuple] | None:
        """A piece is a tuple whose third value is its length."""

        length, capacity = piece[2], self.settings.capacity
        kind = piece_class(length, self.settings)
        rows = self.open.setdefault(kind, [])
        if kind:
            rows.append(piece)
            if len(rows) == kind:
                del self.open[kind]
                return rows
            return None
        if self.filled + length > capacity:
            self.open[kind], self.filled = [piece], length
            return rows
        rows.append(piece)
        self.filled += length
        return None

    def left(self) -> list[tuple]:
        rows = [piece for kind in sorted(self.open) for piece in self.open[kind]]
        self.open, self.filled = {}, 0
        return rows


def first_fit(pieces: list[tuple], capacity: int) -> list[list[tuple]]:
    """Longest first into the first bin with room."""

    bins: list[list] = []
    room: list[int] = []
    for piece in sorted(pieces, key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1])):
        at = next((i for i, free in enumerate(room) if free >= piece[2]), None)
        if at is None:
            bins.append([])
            room.append(capacity)
            at = len(bins) - 1
        bins[at].append(piece)
        room[at] -= piece[2]
    return bins


_COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: A worker's sequence ids: level, then partition, then its bins in order.
_LEVEL, _WORKER = 1 << 58, 1 << 30


class _Writer:
    """Rows of full bins, numbered, in Arrow batches."""

    def __init__(self, level: int, worker: int, schema: pa.Schema):
        self.next = level * _LEVEL + worker * _WORKER
        self.schema, self.rows = schema, []

    def bin(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.rows.append((*piece[:5], self.next, offset))
            offset += piece[2]
        self.next += 1

    def open(self, pieces: list[tuple]) -> None:
        self.rows += [(*piece[:5], None, None) for piece in pieces]

    def take(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _pieces_schema(id_type: pa.DataType) -> pa.Schema:
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.schema([("id", id_type), *[(name, pa.int64()) for name in names]])


def pack_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), files: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text has the end id alone. Every row is a document of its own, also when rows
    or ids repeat or the id is null; columns besides id and text are not read. No rows give no rows.
    """

    spark = documents.sparkSession
    ready(spark)
    files = files or vocabulary_paths()
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    columns = f"id {id_type}, {_COLUMNS}"

    def encode(batches):
        from pyspark import TaskContext

        coder, bins, writer = None, Bins(settings), None
        for batch in batches:
            if coder is None:
                coder = BytePairIds(*files)
                writer = _Writer(0, TaskContext.get().partitionId(), _pieces_schema(batch.column("id").type))
            keys = batch.column("id").to_pylist()
            for low, high, data, offsets, _ in chunks(batch.column("text")):
                flat, bounds = coder.ids(data, offsets)
                flat = flat.astype("<u4")
                for row in range(high - low):
                    ids = flat[bounds[row] : bounds[row + 1]]
                    ids = np.append(ids, np.uint32(settings.end_id)).astype("<u4")
                    start = 0
                    for length in cut_points(len(ids), settings):
                        crc = zlib.crc32(ids[start : start + length])
                        full = bins.put((keys[low + row], start, length, crc, len(ids)))
                        if full:
                            writer.bin(full)
                        start += length
                yield from writer.take(5000)
        if writer:
            writer.open(bins.left())
            yield from writer.take()

    packed = source.mapInArrow(encode, columns).checkpoint()
    done, left = packed.where("sequence_id is not null"), packed.where("sequence_id is null")
    workers, level = packed.rdd.getNumPartitions(), 0
    while workers > 1:
        level, workers = level + 1, -(-workers // settings.fan_in)
        packed = _pack_again(left, level, workers, settings, columns).checkpoint()
        done = done.unionByName(packed.where("sequence_id is not null"))
        left = packed.where("sequence_id is null")
    last = _pack_again(left, level + 1, 1, settings, columns, final=True)
    return done.unionByName(last).withColumnRenamed("id", id_col)


def _pack_again(left: DataFrame, level: int, workers: int, settings: Settings, columns: str, final: bool = False) -> DataFrame:
    """The pieces of open bins, dealt to fewer workers in a fixed order."""

    order = ["id", "start", "ids_crc32"]

    def fill(batches):
        from pyspark import TaskContext

        bins, writer, held = Bins(settings), None, []
        for batch in batches:
            if writer is None:
                writer = _Writer(level, TaskContext.get().partitionId(), _pieces_schema(batch.column("id").type))
            values = [batch.column(i).to_pylist() for i in range(5)]
            for piece in zip(*values, strict=True):
                if final:
                    held.append(piece)  # at most the open bins of one worker
                elif full := bins.put(piece):
                    writer.bin(full)
            yield from writer.take(5000)
        if writer:
            for full in first_fit(held, settings.capacity):
                writer.bin(full)
            writer.open(bins.left())
            yield from writer.take()

    dealt = left.coalesce(1) if workers == 1 else left.repartition(workers, "id", "start")
    return dealt.sortWithinPartitions(*order).mapInArrow(fill, columns)


def padding(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """Sequences, ids and padding: a sequence is filled up to ``capacity`` unless its length is a
    power of two."""

    lengths = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    filled = F.when(F.col("used").bitwiseAND(F.col("used") - 1) == 0, F.lit(0)).otherwise(capacity - F.col("used"))
    return lengths.agg(F.count("*").alias("sequences"), F.sum("used").alias("ids"), F.sum(filled).alias("padding"))
