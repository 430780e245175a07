"""Ids of a public byte-level BPE vocabulary for whole texts, in numpy batches.

The vocabulary's own split pattern is evaluated over byte classes, distinct pre-tokens are encoded
once, and the ids of a text are gathered from them. Texts with characters outside the classes known
here (U+0250 and above, control characters) go through the tokenizer itself, so the ids are always
those of ``tokenizers`` on the whole text.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pandas as pd

from llm.textbatch import prefix_sums, span_hashes

VOCABULARY = "byte_bpe_50k"
_LETTER, _NUMBER, _SPACE, _OTHER, _FOREIGN = 0, 1, 2, 3, 4


def vocabulary_paths(name: str = VOCABULARY) -> tuple[str, str]:
    """The tokenizer file and the same vocabulary as ranks."""

    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Classes of ASCII bytes, and of two-byte characters by their code point below U+0250."""

    ascii_class = np.full(256, _FOREIGN, np.uint8)
    wide_class = np.full(0x250, _FOREIGN, np.uint8)
    for point in range(0x250):
        c = chr(point)
        if c.isalpha():
            kind = _LETTER
        elif c.isnumeric():
            kind = _NUMBER
        elif c in "\t\n\x0b\x0c\r \xa0":
            kind = _SPACE
        elif c.isprintable():
            kind = _OTHER
        else:
            kind = _FOREIGN
        if point < 128:
            ascii_class[point] = kind
        wide_class[point] = kind
    return ascii_class, wide_class


class BytePairIds:
    """``ids(data, offsets)`` gives the flat ids of all rows and each row's first place in them."""

    def __init__(self, tokenizer_file: str, ranks_file: str, cached: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}
        self.pieces = tiktoken.Encoding(
            "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.whole = Tokenizer.from_file(tokenizer_file)
        # Texts that spell out an added token get its id, which only the whole tokenizer knows.
        self.added = [token.content.encode() for token in self.whole.get_added_tokens_decoder().values()]
        self.ascii_class, self.wide_class = _classes()
        self.cached = cached
        self.line_end = ranks[b"\n"]
        self._forget()

    def _forget(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # sorted hashes with their slots
        self.bounds, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of known pre-tokens, -1 for others."""

        slots = np.full(len(hashes), -1)
        for known, places in self.levels:
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            slots = np.where(known[at] == hashes, places[at], slots)
        return slots

    def _learn(self, hashes: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Store new pre-tokens and return their slots."""

        slots = np.arange(len(counts)) + len(self.bounds) - 1
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(counts))
        self.flat = np.append(self.flat, flat)
        self.levels.append((hashes, slots))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            hashes, slots = (np.concatenate(x) for x in zip(*self.levels[-2:], strict=True))
            self.levels = self.levels[:-2] + [(hashes, slots)]
        hashes, slots = self.levels[-1]
        order = np.argsort(hashes)
        self.levels[-1] = hashes[order], slots[order]
        return np.arange(len(counts)) + len(self.bounds) - 1 - len(counts)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(an order of the words, ids of all words in it, ids per word in it).

        Words are joined by line ends, which no match of the split pattern crosses; the line end's
        own id separates them again. White space alone is encoded by itself.
        """

        apart = [i for i, w in enumerate(words) if w[-1] in b"\t\n\x0b\x0c\r \xa0"]
        order = np.arange(len(words))
        if apart:
            order = np.append(np.delete(order, apart), apart)
        count = len(words) - len(apart)
        text = b"\n".join([words[i] for i in order[:count].tolist()] if apart else words).decode()
        ids = np.asarray(self.pieces.encode_ordinary(text), np.int32)
        ends = np.append(np.flatnonzero(ids == self.line_end), len(ids)) if count else np.zeros(0, np.int64)
        if len(ends) != count:
            raise AssertionError("a pre-token was split at another place")
        begins = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])[:count]
        alone = [self.pieces.encode_ordinary(words[i].decode()) for i in apart]
        flat = np.concatenate([ids[ids != self.line_end], *[np.asarray(x, np.int32) for x in alone]])
        return order, flat, np.concatenate([ends - begins, [len(x) for x in alone]]).astype(np.int64)

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        kinds = self.ascii_class[data]
        lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC9))
        if len(lead):
            point = ((data[lead].astype(np.int64) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
            kind = self.wide_class[point]
            kinds[lead] = kind
            kinds[lead + 1] = kind
        return kinds

    def _token_starts(self, data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the split pattern begins a match."""

        n = len(data)
        space = kinds == _SPACE
        blank = data == 0x20
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        follows = np.empty(n, bool)  # the character that ends here is followed by another class
        change = np.zeros(n, bool)
        change[1:] = kinds[1:] != kinds[:-1]
        after_blank = np.zeros(n, bool)
        after_blank[1:] = blank[:-1]
        begin = change & ~(after_blank & ~space)
        # The last white space before a word stands alone or leads the word.
        follows[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
        follows[-1] = False
        last = np.flatnonzero(follows)
        last = last - ((data[last] & 0xC0) == 0x80)  # its first byte
        begin[last] = True
        # 's 't 'm 'd 're 've 'll where a match can begin at the quote
        quote = np.flatnonzero(data == 0x27)
        if len(quote):
            inner = ~first[quote] & (quote > 0)
            before = np.maximum(quote - 1, 0)
            free = ~inner | ((kinds[before] != _OTHER) & ~blank[before])
            padded = np.concatenate([data, np.zeros(2, np.uint8)])
            one, two = padded[quote + 1], padded[quote + 2]
            one = np.where(first[quote + 1], 0, one)
            two = np.where((one == 0) | first[np.minimum(quote + 2, n)], 0, two)
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
            for found, size in ((short, 2), (long & ~short, 3)):
                at = quote[found & free]
                begin[at] = True
                begin[at + 1] = False
                stop = at + size
                begin[stop[stop < n]] = True
        begin[first[:n]] = True
        return np.flatnonzero(begin)

    def _gather(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the tokens in order, number of ids of each token)."""

        inverse, unique = pd.factorize(hashes)
        slots = self._find(unique)
        fresh = np.flatnonzero(slots < 0)
        if len(fresh):
            if len(self.bounds) + len(fresh) > self.cached and len(self.bounds) > 1:
                self._forget()
                fresh = np.arange(len(unique))
            where = np.empty(len(unique), np.int64)
            where[inverse[::-1]] = np.arange(len(inverse) - 1, -1, -1)
            raw = data.tobytes()
            words = [raw[low:high] for low, high in zip(starts[where[fresh]].tolist(), ends[where[fresh]].tolist(), strict=True)]
            order, flat, counts = self._encode(words)
            slots[fresh[order]] = self._learn(unique[fresh[order]], flat, counts)
        counts = (self.bounds[slots + 1] - self.bounds[slots])[inverse]
        place = np.arange(int(counts.sum())) + np.repeat(self.bounds[slots][inverse] - (np.cumsum(counts) - counts), counts)
        return self.flat[place], counts

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
        kinds = self._kinds(data)
        foreign = np.concatenate([[0], np.cumsum(kinds == _FOREIGN)])
        strange = (foreign[offsets[1:]] > foreign[offsets[:-1]]) | self._spells_added(data, offsets)
        if not strange.any():
            return self._plain(data, kinds, offsets)
        bounds, parts = np.zeros(rows + 1, np.int64), []
        run = 0
        while run < rows:
            end = run + 1
            while end < rows and strange[end] == strange[run]:
                end += 1
            low, high = offsets[run], offsets[end]
            if strange[run]:
                texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in range(run, end)]
                lists = [x.ids for x in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
                ids = np.fromiter((i for one in lists for i in one), np.int32)
                counts = np.array([len(one) for one in lists])
            else:
                ids, own = self._plain(data[low:high], kinds[low:high], offsets[run : end + 1] - low)
                counts = np.diff(own)
            parts.append(ids)
            bounds[run + 1 : end + 1] = counts
            run = end
        return np.concatenate(parts), np.cumsum(bounds)

    def _spells_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that hold the text of an added token."""

        rows, whole = np.zeros(len(offsets) - 1, bool), data.tobytes()
        for token in self.added:
            at = whole.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, side="right")) - 1
                rows[row] |= at + len(token) <= offsets[row + 1]
                # The rest of a row that is marked needs no search.
                at = whole.find(token, max(at + 1, int(offsets[row + 1]) if rows[row] else 0))
        return rows

    def _plain(self, data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
        starts = self._token_starts(data, kinds, offsets)
        ends = np.append(starts[1:], len(data))
        flat, counts = self._gather(span_hashes(prefix_sums(data), starts, ends), starts, ends, data)
        totals = np.concatenate([[0], np.cumsum(counts)])
        return flat, totals[np.searchsorted(starts, offsets)]
