"""Sampled segmentations over the piece lattice of a public SentencePiece vocabulary.

Forward filtering sums, for every position of a text, the probability of all segmentations up to it;
backward sampling then draws pieces from the end, each with its share of that sum. Every draw uses a
number made from the row key, the seed and the position, so a row's segmentation is the same in any
partitioning.

The vocabulary has merge ranks, not probabilities; a piece of rank r gets the weight
``(r + offset) ** -exponent``. As in SentencePiece, a space is put before the text and characters
without a piece of their own become byte pieces. No piece reaches over the start of a run of spaces
or over a line end, so texts fall into independent segments there; equal segments of a chunk share
one forward pass, while every occurrence is sampled by itself.

Spaces are kept as bytes 0x20 here, so a literal U+2581 in a text is spelled in byte pieces and
decoding gives back every text unchanged.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shipping import ready
from llm.textbatch import chunks, map_rows, mix, prefix_sums, span_hashes


@dataclass(frozen=True)
class Settings:
    seed: int = 1
    exponent: float = 1.0
    offset: float = 10.0
    byte_weight: float = 1e-6
    short: int = 64


def vocabulary_path(name: str = "piece_bpe_32k") -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.model")


class PieceLattice:
    """The vocabulary as a hash table of byte strings, with log weights."""

    def __init__(self, path: str, settings: Settings):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.settings, size = settings, model.get_piece_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_ids = np.zeros(256, np.int32)
        self.log = np.zeros(size)
        self.known: dict[bytes, int] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes[i], self.log[i] = i, bytes([value]), np.log(settings.byte_weight)
                continue
            self.bytes[i] = piece.replace("▁", " ").encode()
            rank = min(-model.get_score(i), float(size))
            self.log[i] = -settings.exponent * np.log(rank + settings.offset)
            self.known[self.bytes[i]] = i
        self.sizes = np.array([len(b) for b in self.bytes])
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.lengths = sorted({len(b) for b in self.known})
        self._table()
        self.single = np.array([bytes([b]) in self.known for b in range(128)] + [False] * 128)

    def _table(self) -> None:
        words = list(self.known)
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        hashes = span_hashes(prefix_sums(data), ends - [len(w) for w in words], ends)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces have one hash")
        size = 1 << 18
        self.mask, self.keys, self.ids = np.uint64(size - 1), np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self.probes = 1
        for key, word in zip(hashes.tolist(), words, strict=True):
            at, tries = key & (size - 1), 1
            while self.ids[at] >= 0:
                at, tries = (at + 1) & (size - 1), tries + 1
            self.keys[at], self.ids[at] = key, self.known[word]
            self.probes = max(self.probes, tries)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of hashed byte strings, -1 where there is none."""

        at = (hashes & self.mask).astype(np.int64)
        ids = np.where(self.keys[at] == hashes, self.ids[at], -1)
        open_ = np.flatnonzero((ids < 0) & (self.ids[at] >= 0))
        for step in range(1, self.probes):
            if not len(open_):
                break
            place = (at[open_] + step) & int(self.mask)
            hit = self.keys[place] == hashes[open_]
            ids[open_[hit]] = self.ids[place[hit]]
            open_ = open_[~hit & (self.ids[place] >= 0)]
        return ids

    def uncovered(self, data: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Bytes of characters that no piece of one character covers."""

        bare = ~self.single[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            size = np.where(data[lead] >= 0xF0, 4, np.where(data[lead] >= 0xE0, 3, 2))
            found = self.find(span_hashes(sums, lead, lead + size)) >= 0
            for k in range(4):
                own = size > k
                bare[lead[own] + k] = ~found[own]
        return bare

    def forward(self, data: np.ndarray, sums: np.ndarray, bare: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Edges into every position of every segment.

        (base of each segment's positions, first edge of each position, cumulative share, piece, length)
        """

        base = np.concatenate([[0], np.cumsum(sizes + 1)])
        parts: list[tuple[np.ndarray, ...]] = []
        bounds = [0, 6, 10, 16, 32, self.settings.short]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if len(rows):
                parts += self._short(data, sums, bare, starts[rows], sizes[rows], base[rows], high)
        for row in np.flatnonzero(sizes > self.settings.short):
            parts += self._long(data, sums, bare, int(starts[row]), int(sizes[row]), int(base[row]))
        node, rank, share, piece, length = (np.concatenate(x) for x in zip(*parts, strict=True))
        first = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=base[-1]))])
        slot = first[node] + rank
        out = np.empty(len(node)), np.empty(len(node), np.int32), np.empty(len(node), np.int64)
        for target, values in zip(out, (share, piece, length), strict=True):
            target[slot] = values
        return base, first, *out

    def _short(self, data, sums, bare, starts, sizes, base, longest):
        alpha = np.full((longest + 1, len(starts)), -np.inf)
        alpha[0] = 0
        parts = []
        for end in range(1, longest + 1):
            inside = np.flatnonzero(sizes >= end)
            stop = starts[inside] + end
            edges = []
            for length in self.lengths:
                if length > end:
                    break
                begin = alpha[end - length][inside]
                ids = self.find(span_hashes(sums, stop - length, stop))
                hit = np.flatnonzero((ids >= 0) & (begin > -np.inf))
                if len(hit):
                    edges.append((hit, ids[hit], length, begin[hit] + self.log[ids[hit]]))
            spelled = np.flatnonzero(bare[stop - 1] & (alpha[end - 1][inside] > -np.inf))
            if len(spelled):
                ids = self.byte_ids[data[stop[spelled] - 1]]
                edges.append((spelled, ids, 1, alpha[end - 1][inside[spelled]] + self.log[ids]))
            if not edges:
                continue
            total = np.full(len(inside), -np.inf)
            for hit, _, _, weight in edges:
                total[hit] = np.logaddexp(total[hit], weight)
            alpha[end][inside] = total
            rank, share = np.zeros(len(inside), np.int64), np.zeros(len(inside))
            for hit, ids, length, weight in edges:
                share[hit] += np.exp(weight - total[hit])
                parts.append((base[inside[hit]] + end, rank[hit].copy(), share[hit].copy(), ids, np.full(len(hit), length)))
                rank[hit] += 1
        return parts

    def _long(self, data, sums, bare, start, size, base):
        """Like ``_short`` for one long segment: edges are found for blocks of positions at once, and
        only the running sum over them goes from position to position."""

        alpha = np.full(size + 1, -np.inf)
        alpha[0] = 0.0
        reach = [-np.inf] * self.lengths[-1] + [0.0]  # alphas of the last positions, the newest last
        parts = []
        for low in range(0, size, 1 << 16):
            ends = np.arange(low + 1, min(low + (1 << 16), size) + 1)
            found = []
            for length in self.lengths:
                inside = ends[ends >= length]
                ids = self.find(span_hashes(sums, start + inside - length, start + inside))
                hit = np.flatnonzero(ids >= 0)
                found.append((inside[hit], ids[hit], np.full(len(hit), length)))
            spelled = ends[bare[start + ends - 1]]
            found.append((spelled, self.byte_ids[data[start + spelled - 1]], np.ones(len(spelled), np.int64)))
            end, ids, length = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(end, kind="stable")
            end, ids, length = end[order], ids[order].astype(np.int32), length[order]
            bounds = np.searchsorted(end, np.append(ends, ends[-1] + 1))
            weight, steps, known = self.log[ids].tolist(), length.tolist(), len(reach) - 1
            for at, (one, two) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True), known + 1):
                terms = [reach[at - steps[e]] + weight[e] for e in range(one, two)]
                top = max(terms, default=-math.inf)
                if len(terms) > 1 and top > -math.inf:
                    top += math.log(sum([math.exp(x - top) for x in terms]))
                reach.append(top)
            alpha[ends] = reach[known + 1 :]
            del reach[: -self.lengths[-1] - 1]
            live = alpha[end - length] > -np.inf
            end, ids, length = end[live], ids[live], length[live]
            share = np.exp(alpha[end - length] + self.log[ids] - alpha[end])
            first = np.searchsorted(end, end)
            rank = np.arange(len(end)) - first
            for step in range(1, int(rank.max(initial=0)) + 1):
                at = np.flatnonzero(rank == step)
                share[at] += share[at - 1]
            parts.append((base + end, rank, share, ids, length))
        return parts

    def sample(self, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all rows in order, first piece of each row); an empty text has none."""

        n = len(offsets) - 1
        filled = np.flatnonzero(np.diff(offsets) > 0)
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        data = np.insert(data, offsets[filled], 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        new = np.zeros(len(data) + 1, bool)
        blank, line = data == 0x20, data == 0x0A
        new[1:-1] = (blank[1:] & ~blank[:-1]) | line[1:] | line[:-1]
        new[offsets] = True
        starts = np.flatnonzero(new[:-1])
        sizes = np.diff(np.append(starts, len(data)))
        sums = prefix_sums(data)
        bare = self.uncovered(data, sums)
        which, _ = pd.factorize(span_hashes(sums, starts, starts + sizes))
        example = np.empty(which.max() + 1, np.int64)
        example[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        base, first, share, piece, length = self.forward(data, sums, bare, starts[example], sizes[example])
        rows = np.searchsorted(offsets, starts, side="right") - 1
        seeds = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(self.settings.seed) * np.uint64(0x9E3779B97F4A7C15))
        drawn = np.full(len(data), -1, np.int32)
        left, place = np.flatnonzero(sizes <= self.settings.short), sizes.copy()

        def numbers(row, end):
            number = mix(seeds[row] + (end - offsets[row]).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
            return (number >> np.uint64(11)).astype(float) * 2.0**-53

        while len(left):
            end = starts[left] + place[left]
            number = numbers(rows[left], end)
            node = base[which[left]] + place[left]
            edge, last = first[node], first[node + 1] - 1
            ahead = np.flatnonzero((share[edge] <= number) & (edge < last))
            while len(ahead):
                edge[ahead] += 1
                ahead = ahead[(share[edge[ahead]] <= number[ahead]) & (edge[ahead] < last[ahead])]
            drawn[end - 1] = piece[edge]
            place[left] -= length[edge]
            left = left[place[left] > 0]
        # A long segment draws at every position at once, then walks over the draws.
        for segment in np.flatnonzero(sizes > self.settings.short).tolist():
            places = np.arange(1, sizes[segment] + 1)
            number = numbers(rows[segment], starts[segment] + places)
            edges = first[base[which[segment]] + np.append(places, places[-1] + 1)]
            counts = np.diff(edges)
            passed = np.concatenate([[0], np.cumsum(share[edges[0] : edges[-1]] <= np.repeat(number, counts))])
            passed = np.diff(passed[edges - edges[0]])
            edge = edges[:-1] + np.maximum(np.minimum(passed, counts - 1), 0)
            edge = np.minimum(edge, len(piece) - 1)  # no walk comes to a place without edges
            steps, at, ends = length[edge].tolist(), int(sizes[segment]), []
            while at > 0:
                ends.append(at - 1)
                at -= steps[at - 1]
            ends = np.array(ends)
            drawn[starts[segment] + ends] = piece[edge[ends]]
        ids = drawn[drawn >= 0]
        counts = np.concatenate([[0], np.cumsum(drawn >= 0)])
        return ids, counts[offsets]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, offsets): the pieces of each row without the space put first."""

        sizes = self.sizes[ids]
        places = np.arange(sizes.sum()) + np.repeat(self.begins[ids] - (np.cumsum(sizes) - sizes), sizes)
        data = self.flat[places]
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        filled = np.diff(bounds) > 0
        data = np.delete(data, ends[:-1][filled])
        return data, ends - np.concatenate([[0], np.cumsum(filled)])


def sample_pieces(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), path: str | None = None) -> DataFrame:
    """One row per input row: id, ``pieces``, ``n_pieces``, ``ids_crc32``, ``lossless``.

    ``lossless`` tells that the pieces decode to the text's bytes. A null text has null pieces, no
    count and a null ``lossless``; an empty text has none. Rows with the same id and text get the same
    pieces; null ids share one key. Other columns are not read.
    """

    ready(documents.sparkSession)
    path = path or vocabulary_path()
    source = documents.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def encode(batches):
        lattice = None
        for batch in batches:
            lattice = lattice or PieceLattice(path, settings)
            keys = batch.column("key").to_numpy()
            for low, high, data, offsets, nulls in chunks(batch.column("text")):
                ids, bounds = lattice.sample(data, offsets, keys[low:high])
                back, ends = lattice.decode(ids, bounds)
                same = np.array_equal(back, data) and np.array_equal(ends, offsets)
                if same:
                    lossless = np.ones(high - low, bool)
                else:
                    lossless = np.array([np.array_equal(back[ends[i] : ends[i + 1]], data[offsets[i] : offsets[i + 1]]) for i in range(high - low)])
                wide = ids.astype("<u4")
                crc = np.array([zlib.crc32(wide[bounds[i] : bounds[i + 1]]) for i in range(high - low)], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids), mask=pa.array(nulls))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(low, high - low),
                        lists,
                        pa.array(np.diff(bounds), mask=nulls),
                        pa.array(crc, mask=nulls),
                        pa.array(lossless, mask=nulls),
                    ],
                    ["id", "pieces", "n_pieces", "ids_crc32", "lossless"],
                )

    schema = f"id {id_type}, pieces array<int>, n_pieces long, ids_crc32 long, lossless boolean"
    return source.mapInArrow(encode, schema).withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, id_col: str = "doc_id", pieces_col: str = "pieces", path: str | None = None) -> DataFrame:
    """id and ``text`` of every row; null pieces give a null text, none an empty one."""

    ready(encoded.sparkSession)
    path = path or vocabulary_path()
    source = encoded.select(F.col(id_col).alias("id"), F.col(pieces_col).cast("array<int>").alias("pieces"))
    id_type = source.schema["id"].dataType.simpleString()

    def decode(batch: pa.RecordBatch):
        lattice = PieceLattice(path, Settings())
        column = batch.column("pieces")
        nulls = np.asarray(column.is_null())
        sizes = np.where(nulls, 0, np.diff(column.offsets.to_numpy()))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        data, ends = lattice.decode(column.flatten().to_numpy(), bounds)
        texts = [None if nulls[i] else data[ends[i] : ends[i + 1]].tobytes().decode() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return map_rows(source, decode, f"id {id_type}, text string").withColumnRenamed("id", id_col)
