"""Periodic runs of words, by enumeration of maximal pairs.

A run is a stretch of words with smallest period q, at least ``MIN_LENGTH`` words and at least
``MIN_EXPONENT`` periods long, that can't be extended. Its first two periods start a maximal pair: the
same words begin at ``start`` and at ``start + q``, agree for length - q words and no further, and have
different words (or none) to their left. So runs need no extension step; they are read off the
LCP-interval tree of a document's word suffixes:

* Words become numbers through a dictionary, hence equal numbers mean equal words.
* Prefix doubling ranks the suffixes. An interval below ``SHORTEST`` common words can hold no run, so only
  suffixes whose first ``SHORTEST`` words occur again in their document enter the sorted order.
* LCP values come from the ranks of all doublings, the widest first.
* The tree is visited bottom-up. Every interval has its positions in order, each marked with its left-word
  class; smaller children are merged into the largest one. Of two positions whose distance is at most half
  of the common length, only neighbours can be one smallest period apart: a third occurrence between them
  would give the stretch a smaller period. So a merged position is compared with its two neighbours, and the
  pair is a run if the neighbour comes from another child, lies in another left-word class and the distance
  satisfies the length constraints. That is O(n log n) for any text.

Each document is worked on whole by one task; documents aren't compared, so nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shipping import ready
from llm.textbatch import CHUNK_BYTES, map_rows, text_buffers

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Common words of the shortest pair that makes a run: length - q with q <= length / MIN_EXPONENT.
SHORTEST = MIN_LENGTH - MIN_LENGTH // MIN_EXPONENT

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Positions:
    """Word positions in order, kept in blocks so that an insertion moves few of them."""

    BLOCK = 1024

    def __init__(self, first: int):
        self.blocks = [[first]]
        self.lasts = [first]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, position: int) -> None:
        k = min(bisect_left(self.lasts, position), len(self.blocks) - 1)
        block = self.blocks[k]
        insort(block, position)
        self.size += 1
        if len(block) > self.BLOCK:
            half = len(block) // 2
            self.blocks[k : k + 1] = [block[:half], block[half:]]
            self.lasts[k : k + 1] = [block[half - 1], block[-1]]
        else:
            self.lasts[k] = block[-1]

    def neighbours(self, position: int) -> Iterator[int]:
        """The positions before and after one that is held."""

        k = bisect_left(self.lasts, position)
        block = self.blocks[k]
        at = bisect_left(block, position)
        if at:
            yield block[at - 1]
        elif k:
            yield self.blocks[k - 1][-1]
        if at + 1 < len(block):
            yield block[at + 1]
        elif k + 1 < len(self.blocks):
            yield self.blocks[k + 1][0]


def _merge(children: list[Positions], common: int, left: np.ndarray, runs: set) -> Positions:
    """The positions of an interval with ``common`` shared words; its runs are added to ``runs``."""

    children.sort(key=lambda child: child.size)
    whole = children.pop()
    came_from = {}
    for k, child in enumerate(children):
        for position in child:
            whole.add(position)
            came_from[position] = k
    furthest = common // (MIN_EXPONENT - 1)
    for position, child in came_from.items():
        for other in whole.neighbours(position):
            distance = abs(position - other)
            if distance <= furthest and common + distance >= MIN_LENGTH and left[position] != left[other]:
                if came_from.get(other) != child:
                    runs.add((min(position, other), common + distance, distance))
    return whole


def _intervals(order: np.ndarray, common: np.ndarray, left: np.ndarray) -> set:
    """Runs of the suffixes in ``order``; common[k] words are shared by the k-th and the one before it."""

    runs: set = set()
    open_at: list[int] = [0]  # common words of the open intervals, widest interval first
    children: list[list[Positions]] = [[]]
    last: Positions | None = None
    for position, shared in zip(order.tolist(), [*common[1:].tolist(), 0]):
        last = Positions(position)
        while shared < open_at[-1]:
            children[-1].append(last)
            last = _merge(children.pop(), open_at.pop(), left, runs)
        if shared < SHORTEST:
            children, open_at = [[]], [0]
        elif shared > open_at[-1]:
            open_at.append(shared)
            children.append([last])
        else:
            children[-1].append(last)
    return runs


def _again(codes: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""

    found, _ = pd.factorize(codes)
    return np.bincount(found)[found] > 1 if len(codes) else np.zeros(0, bool)


def _repeating(ids: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions whose first ``SHORTEST`` words occur again in the same row."""

    places = np.arange(len(ids))
    codes, width = ids.astype(np.int64), 1
    while width < SHORTEST:
        step = min(width, SHORTEST - width)
        places = places[places + width + step <= ends[places]]
        values = codes[places] * (int(codes.max(initial=0)) + 1) + codes[places + step]
        found, _ = pd.factorize(values)
        codes = np.zeros(len(ids), np.int64)
        codes[places] = found
        width += step
    key = codes[places] * (int(rows.max(initial=0)) + 1) + rows[places]
    return places[_again(key)]


def _doubled(ids: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until those of each row differ."""

    places = np.arange(len(ids))
    levels, width = [ids.astype(np.int32)], 1
    longest = int((ends - places).max(initial=0))
    while width < longest:
        ranks = levels[-1].astype(np.int64)
        after = np.zeros(len(ids), np.int64)
        inside = places + width < ends
        after[inside] = ranks[places[inside] + width] + 1
        _, found = np.unique(ranks * (int(ranks.max()) + 2) + after, return_inverse=True)
        levels.append(found.astype(np.int32))
        width *= 2
        if int(found.max()) + 1 == len(ids):
            break
    return levels


def runs_of_rows(ids: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(row, start, length, period) of every run, by row, start and period.

    ``ids`` numbers the words of all rows one after the other; row r has those in
    [offsets[r], offsets[r + 1]).
    """

    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    kept_rows = np.unique(rows[_repeating(ids, offsets[1:][rows], rows)]) if len(ids) else rows
    if not len(kept_rows):
        return []
    # Only rows with a repeated stretch go on; ranks are taken among them.
    chosen = np.isin(rows, kept_rows)
    ids, rows = ids[chosen], np.searchsorted(kept_rows, rows[chosen])
    sizes = np.diff(offsets)[kept_rows]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ends = starts[1:][rows]
    places = _repeating(ids, ends, rows)
    levels = _doubled(ids, ends)
    order = places[np.lexsort((levels[-1][places], rows[places]))]
    common = np.zeros(len(order), np.int64)
    before, after = order[:-1], order[1:]
    same = rows[before] == rows[after]
    shared = np.zeros(len(before), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        low, high = before + shared, after + shared
        fits = same & (np.maximum(low, high) + (1 << k) <= ends[before])
        fits[fits] = levels[k][low[fits]] == levels[k][high[fits]]
        shared[fits] += 1 << k
    common[1:] = shared
    left = np.full(len(ids), -1, np.int64)
    left[1:] = ids[:-1]
    left[starts[:-1]] = -1 - np.arange(len(sizes))  # a row's first word has no left word
    found = _intervals(order, common, left.tolist())
    listed = ((int(kept_rows[rows[at]]), int(at - starts[rows[at]]), length, period) for at, length, period in found)
    return sorted(listed, key=lambda run: (run[0], run[1], run[3]))


def _pieces(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK_BYTES``; a longer text is a range of its own."""

    _, offsets, nulls = text_buffers(column)
    low = 0
    while low < len(nulls):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, side="right")) - 1)
        yield low, min(high, len(nulls))
        low = min(high, len(nulls))


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, offsets by row) of texts, split at runs of ASCII white space."""

    lists = pc.ascii_split_whitespace(column.fill_null(""))
    flat = pc.list_flatten(lists)
    filled = np.asarray(pc.greater(pc.binary_length(flat), 0))
    bounds = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))])
    return flat.filter(pa.array(filled)), np.concatenate([[0], np.cumsum(filled)])[bounds]


def _collapse(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(runs, text without the repeated periods) of each row."""

    words, offsets = words_of(column)
    ids = np.asarray(words.dictionary_encode().indices)
    runs: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    change = np.zeros(len(ids) + 1, np.int64)
    for row, start, length, period in runs_of_rows(ids, offsets):
        runs[row].append({"start": start, "length": length, "period": period})
        change[offsets[row] + start + period] += 1
        change[offsets[row] + start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    bounds = np.concatenate([[0], np.cumsum(kept)])[offsets]
    texts = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.filter(pa.array(kept)))
    return pa.array(runs, pa.list_(_RUN)), pc.binary_join(texts, " ")


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed) of every row.

    ``runs`` lists (start, length, period) in words, by start, then period. ``collapsed`` is the text's
    words joined by one space, without those that some run holds after its first period. A null, empty or
    blank text has no runs and collapses to an empty text; a null id stays null; repeated rows give
    repeated results; other columns play no part and aren't returned; an empty table gives no rows.
    """

    ready(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for low, high in _pieces(batch.column(1)):
            runs, texts = _collapse(batch.column(1).slice(low, high - low))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), runs, texts], ["id", "runs", "collapsed"]
            )

    found = map_rows(narrow, each, f"id {kind}, runs {RUNS}, collapsed string")
    return found.select(F.col("id").alias(id_col), "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run of most periods; the earliest, then the one of smallest period, among equals."""

    more = lambda run, best: run["length"] * best["period"] > best["length"] * run["period"]
    return F.reduce(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(more(run, best), run).otherwise(best))


def plant_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with a periodic end in the documents whose crc32 of the id is divisible by ten.

    With h that checksum, g = h // 10 and n words, word i >= a = g % n becomes word a + (i - a) % p,
    p = 1 + (n - a) // (3 + g % 8); such a text's words are joined by one space. Others, those without words
    and those without an id stay as they are.
    """

    ready(docs.sparkSession)
    sums = F.crc32(F.col(id_col).cast("string").cast("binary"))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), sums.alias("h"))
    kind = narrow.schema["id"].dataType.simpleString()

    def planted(text: str, g: int) -> str:
        words = _WORD.findall(text)
        n = len(words)
        if not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a])

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, sums = batch.column(1), batch.column(2).to_pylist()
        chosen = [k for k, h in enumerate(sums) if h is not None and h % 10 == 0 and texts[k].is_valid]
        if chosen:
            new = pa.array([planted(texts[k].as_py(), sums[k] // 10) for k in chosen], texts.type)
            mask = np.zeros(len(texts), bool)
            mask[chosen] = True
            texts = pc.replace_with_mask(texts, pa.array(mask), new)
        yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["id", "text"])

    found = map_rows(narrow, each, f"id {kind}, text string")
    return found.select(F.col("id").alias(id_col), F.col("text").alias(text_col))
