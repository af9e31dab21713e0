"""Words, shingles and hashes of whole Arrow batches of text with numpy, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in pieces of about so many bytes; one longer text is a piece of its own.
PIECE_BYTES = 1 << 21
#: Words are hashed a stretch of text at a time.
HASHED_BYTES = 1 << 20
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
ODD = np.uint64(0x9E3779B97F4A7C15)


def gathered(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until their texts hold about ``size`` bytes."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if total >= size:
            yield pa.concat_batches(held)
            held, total = [], 0
    if held:
        yield pa.concat_batches(held)


def pieces(batch: pa.RecordBatch, column: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``size`` bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes.astype(np.int64)) // size
    cuts = np.flatnonzero(np.diff(piece, prepend=-1)) if len(piece) else np.array([], int)
    for start, stop in zip(cuts, [*cuts[1:], len(piece)]):
        yield batch.slice(start, stop - start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, one after the other, and each text's offsets; null is empty."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")]).cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column as arrays."""
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(ends) else []


@lru_cache(maxsize=4)
def _powers(exponent: int, base: int) -> np.ndarray:
    out = np.full(1 << exponent, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def byte_values(fold_case: bool) -> np.ndarray:
    """A fixed random number for every byte; A-Z share those of a-z if case is folded."""
    values = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold_case:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a piece: ``doc`` (index of the text), ``start`` and ``end`` (bytes), ``hash`` (64 bits)."""

    def __init__(self, texts: pa.Array, is_word: np.ndarray, fold_case: bool = True):
        raw, at = text_bytes(texts)
        self.raw, self.at, self.texts = raw, at, len(at) - 1
        inside = is_word[raw]
        edges = np.unique(at)
        before = np.concatenate(([False], inside[:-1])) if len(raw) else inside
        before[edges[edges < len(raw)]] = False
        after = np.concatenate((inside[1:], [False])) if len(raw) else inside.copy()
        after[edges[edges > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(at, self.start, "right") - 1
        #: Where each text's words begin among all words.
        self.first = np.searchsorted(self.doc, np.arange(self.texts + 1))
        self.hash = np.empty(len(self.start), np.uint64)
        values, base = byte_values(fold_case), 0xD1342543DE82EF95
        # Stretch by stretch, so that a very long text needs no table of its own length.
        cuts = np.unique(np.searchsorted(self.start, np.arange(0, len(raw) + HASHED_BYTES, HASHED_BYTES)))
        for low, high in zip(cuts[:-1], cuts[1:]):
            at, stop = self.start[low], self.end[high - 1]
            exponent = max(HASHED_BYTES.bit_length(), int(stop - at + 1).bit_length())
            start, end = self.start[low:high] - at, self.end[low:high] - at
            weighted = values[raw[at:stop]] * _powers(exponent, base)[: stop - at]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(weighted)))
            own = (sums[end] - sums[start]) * _powers(exponent, pow(base, -1, 1 << 64))[start]
            self.hash[low:high] = mix64(own + (end - start).astype(np.uint64))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every run of ``n`` words inside one text, and the index of the run's first word."""
        if len(self.hash) < n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        last = len(self.hash) - n + 1
        index = np.flatnonzero(self.doc[:last] == self.doc[n - 1 :])
        total = np.zeros(len(index), np.uint64)
        for k, factor in enumerate(factors(n)):
            total += self.hash[index + k] * factor
        return mix64(total), index

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``ngrams``, and one hash of the whole sequence for texts of fewer words; with the bounds of each text's own."""
        hashes, index = self.ngrams(n)
        short = np.flatnonzero((self.counts() > 0) & (self.counts() < n))
        if len(short):
            size = self.counts()[short]
            total = size.astype(np.uint64) * ODD
            for k, factor in enumerate(factors(n)[: n - 1]):
                has = size > k
                total[has] += self.hash[self.first[short[has]] + k] * factor
            hashes = np.concatenate((hashes, mix64(total)))
            docs = np.concatenate((self.doc[index], short))
            order = np.argsort(docs, kind="stable")
            return hashes[order], np.searchsorted(docs[order], np.arange(self.texts + 1))
        return hashes, np.searchsorted(self.doc[index], np.arange(self.texts + 1))


@lru_cache(maxsize=8)
def factors(n: int) -> np.ndarray:
    return np.random.default_rng(21).integers(1, 1 << 63, max(n, 16), dtype=np.uint64)[:n] * np.uint64(2) + np.uint64(1)


def between_blanks() -> np.ndarray:
    """Words are what lies between ASCII blanks."""
    out = np.ones(256, bool)
    out[list(BLANKS)] = False
    return out


def alphanumeric() -> np.ndarray:
    """Words are runs of ASCII letters, digits and all characters beyond ASCII."""
    out = np.zeros(256, bool)
    out[128:] = True
    out[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    return out
