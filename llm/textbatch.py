"""Arrow batches of text as numpy bytes: whole rows in bounded chunks, word spans, 64-bit hashes.

Every helper works on UTF-8 bytes of whole texts. A null text counts as an empty one here; callers
that treat nulls apart look at the mask.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 21
_ODD = 0x9E3779B97F4A7C15


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, int64 offsets, null mask) of a string column without making Python strings."""

    nulls = np.asarray(column.is_null())
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64), nulls
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets, nulls


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Consecutive row ranges of about ``limit`` bytes: (first row, end row, bytes, offsets, nulls)."""

    raw, offsets, nulls = text_buffers(column)
    low, rows = 0, len(nulls)
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        high = min(high, rows)
        own = offsets[low : high + 1]
        yield low, high, raw[own[0] : own[-1]], own - own[0], nulls[low:high]
        low = high


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits."""

    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = np.full(length, _ODD, np.uint64), np.full(length, pow(_ODD, -1, 1 << 64), np.uint64)
    base[0] = inverse[0] = 1
    return np.cumprod(base), np.cumprod(inverse)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any span follows in constant time."""

    size = 1 << max(22, int(len(data) + 1).bit_length())
    powers, _ = _powers(size)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes in each [start, end); equal bytes have equal hashes anywhere."""

    size = 1 << max(22, len(sums).bit_length())
    _, inverses = _powers(size)
    return mix((sums[ends] - sums[starts]) * inverses[starts])


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the accented capitals U+00C0 to U+00DE, byte for byte."""

    folded = data.copy()
    capital = (data >= 65) & (data <= 90)
    folded[capital] |= 32
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    after &= (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    folded[after] |= 32
    return folded


def byte_set(*members: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Separators of the word pattern [^\x20\x09-\x0D]+.
SPACES = byte_set(0x20, *range(0x09, 0x0E))


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row of each word): maximal runs without separators, never across rows."""

    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separators[data]
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    cut = offsets[1:-1]
    both = cut[inside[cut] & inside[cut + 1]] if len(data) else cut[:0]
    begins[both] = True
    stops[both] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n)[:n] if len(rows) else np.zeros(n, np.int64)


def map_rows(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def each(batches):
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(each, schema)


def crc_bucket(ids, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""

    from pyspark.sql import functions as F

    return F.crc32(ids.cast("string").cast("binary")) % F.lit(divisor)


def unit_hash(ids, salt: str):
    """A number in [0, 1) fixed by the id, for reproducible samples."""

    from pyspark.sql import functions as F

    return F.pmod(F.xxhash64(F.lit(salt), ids), F.lit(1 << 30)) / F.lit(float(1 << 30))
