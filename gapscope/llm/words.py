"""Vectorised text work on Arrow string columns: words, windows, hashes, n-grams.

A column chunk is handled as one byte buffer with row offsets. White space
is six ASCII bytes, which never occur inside a longer UTF-8 sequence, so
words can be cut, counted and hashed without decoding anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
_IN_WORD = np.ones(256, bool)
_IN_WORD[_SPACES] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_BLOCK = 4096
#: Bytes handled at a time when words are hashed.
_PIECE = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POWER = mix64(np.arange(1, _BLOCK + 1, dtype=np.uint64) * _MIX2) | np.uint64(1)


class Texts:
    """Bytes of consecutive texts: text i is ``data[offsets[i]:offsets[i + 1]]``; a null is empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, texts: list[str | None]) -> Texts:
        return next(cls.chunks(pa.array(texts, pa.string()), 1 << 62), cls(np.empty(0, np.uint8), np.zeros(1, np.int64)))

    @classmethod
    def chunks(cls, column: pa.Array, most_bytes: int = 2 << 20) -> Iterator[Texts]:
        """The column in order, cut into runs of rows of about ``most_bytes`` (a longer text stands alone)."""
        if isinstance(column, pa.ChunkedArray):
            for chunk in column.chunks:
                yield from cls.chunks(chunk, most_bytes)
            return
        if not len(column):
            return
        rows = max(256, 4 * most_bytes * len(column) // max(column.nbytes, 1))  # only so many are copied at a time
        if rows < len(column):
            for at in range(0, len(column), rows):
                yield from cls.chunks(column.slice(at, rows), most_bytes)
            return
        wide = column.cast(pa.large_string()).fill_null("")
        _, starts, data = wide.buffers()
        offsets = np.frombuffer(starts, np.int64)[wide.offset: wide.offset + len(wide) + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        at = 0
        while at < len(wide):
            to = int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1
            to = min(max(to, at + 1), len(wide))
            yield cls(whole[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at])
            at = to


class Words:
    """Words of ``texts`` (runs of the bytes flagged in ``in_word``): byte positions, and which text each is in."""

    def __init__(self, texts: Texts, in_word: np.ndarray = _IN_WORD):
        data, offsets = texts.data, texts.offsets
        self.texts = texts
        inside = in_word[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        first[heads] = inside[heads]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        tails = offsets[1:][np.diff(offsets) > 0] - 1
        last[tails] = inside[tails]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i]:bounds[i + 1]
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word: the same in every batch and process."""
        return segment_hashes(self.texts.data, self.starts, self.ends, lower)

    def windows(self, size: int) -> np.ndarray:
        """Indexes of the words that begin a window of ``size`` words of one text."""
        n = len(self.starts) - size + 1
        return np.flatnonzero(self.doc[:n] == self.doc[size - 1:]) if n > 0 else np.empty(0, np.int64)

    def code_points(self) -> np.ndarray:
        """Code points inside words, per text."""
        data = self.texts.data
        lead = np.concatenate([[0], np.cumsum(_IN_WORD[data] & ((data & 0xC0) != 0x80))])
        return lead[self.texts.offsets[1:]] - lead[self.texts.offsets[:-1]]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``; segments are in order, not empty, and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE)))
        low, high = int(starts[at]), int(ends[to - 1])
        piece, begin, sizes = data[low:high], starts[at:to] - low, ends[at:to] - starts[at:to]
        reach = np.diff(np.append(begin, high - low))
        place = np.arange(high - low) - np.repeat(begin, reach)
        value = _BYTE[LOWER[piece] if lower else piece] * _POWER[place & (_BLOCK - 1)]
        if sizes.max() > _BLOCK:
            value *= (place >> 12).astype(np.uint64) * _ODD | np.uint64(1)
        value[place >= np.repeat(sizes, reach)] = 0
        out[at:to] = np.add.reduceat(value, begin)
        at = to
    return mix64(out + (ends - starts).astype(np.uint64) * _ODD)


def short_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, faster for words of few bytes; not the one of ``segment_hashes``.

    Words are taken eight bytes at a time; those beyond 64 bytes go through ``segment_hashes``.
    """
    sizes = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    out = sizes.astype(np.uint64) * _ODD
    left = np.minimum(sizes, 8).astype(np.uint64) * np.uint64(8)
    whole = (~np.uint64(0)) >> (np.uint64(64) - np.maximum(left, 1)).astype(np.uint64)
    out = (out ^ (eight[starts] & whole)) * _MIX1
    out ^= out >> np.uint64(29)
    rest = np.flatnonzero(sizes > 8)
    for k in range(8, 64, 8):
        rest = rest[sizes[rest] > k]
        if not len(rest):
            break
        left = np.minimum(sizes[rest] - k, 8).astype(np.uint64) * np.uint64(8)
        value = eight[starts[rest] + k] & ((~np.uint64(0)) >> (np.uint64(64) - left))
        value = (out[rest] ^ value) * _MIX1
        out[rest] = value ^ (value >> np.uint64(29))
    long = np.flatnonzero(sizes > 64)
    if len(long):
        out[long] = segment_hashes(data, starts[long], ends[long])
    return (out * _MIX2) ^ (out >> np.uint64(32))


def sequence_hashes(word_hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the ``size``-word sequences that begin at ``at``; order matters."""
    h = np.full(len(at), np.uint64(size), np.uint64)
    for k in range(size):
        h = mix64(h * _ODD + word_hashes[at + k])
    return h


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def lines_with_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text) of the lines, split at line feeds, that hold a word."""
    data, offsets = texts.data, texts.offsets
    cuts = np.flatnonzero(data == 0x0A)
    edges = np.unique(np.concatenate([offsets, cuts, cuts + 1]))
    starts, ends = edges[:-1], edges[1:]
    words = np.concatenate([[0], np.cumsum(_IN_WORD[data])])
    some = words[ends] > words[starts]
    starts, ends = starts[some], ends[some]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def in_text(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys made different between texts."""
    return mix64(keys ^ mix64(doc.astype(np.uint64) * _ODD + _MIX1))
