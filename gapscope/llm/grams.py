"""Hashed n-grams of words and bytes, and per-text sums over them, without building a matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from gapscope.llm.words import Texts, Words, sequence_hashes

_SEED = np.uint64(0xD6E8FEB86659FD93)


def byte_grams(texts: Texts, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, valid) of the ``size``-byte sequence at each byte; sequences that leave their text are not valid."""
    data = texts.data
    n = len(data)
    code = np.zeros(n, np.uint64)
    for k in range(size):
        code[: n - k] |= data[k:].astype(np.uint64) << np.uint64(8 * k)
    bucket = ((code + np.uint64(size)) * _SEED) >> np.uint64(64 - bits)
    valid = np.ones(n, bool)
    ends = texts.offsets[1:]
    for k in range(1, size):
        at = ends - k
        valid[at[(at >= texts.offsets[:-1])]] = False
    return bucket.astype(np.int32), valid


def gram_families(texts: Texts, words: Words, bits: int, word_sizes=(1, 2), byte_sizes=(3, 4)) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket, start of each text, number per text) of each family of n-grams."""
    if word_sizes:
        hashes = words.hashes()
        for size in word_sizes:
            at = words.windows(size)
            bucket = (sequence_hashes(hashes, at, size) >> np.uint64(64 - bits)).astype(np.int32)
            bounds = np.searchsorted(at, words.bounds)
            yield bucket, bounds[:-1], np.diff(bounds)
    for size in byte_sizes:
        bucket, valid = byte_grams(texts, size, bits)
        bounds = np.concatenate([[0], np.cumsum(valid)])[texts.offsets]
        yield bucket[valid], bounds[:-1], np.diff(bounds)


def sums(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; 0 where it has none."""
    out = np.zeros(len(starts))
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = np.add.reduceat(values, starts[some])
    return out
