"""Hashed byte n-grams of words, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from spanloom.llm.words import LOWER

#: Letters in lower case and bytes beyond ASCII as they are; all others are 0, the boundary.
LETTERS = np.where(np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)]), LOWER, 0).astype(np.uint8)
#: The same, with digits, and with signs that stand for letters in misspelled words.
MARKED = np.where(np.isin(np.arange(256), [*range(48, 58), ord("@"), ord("$")]), LOWER, LETTERS).astype(np.uint8)


class Stream:
    """Rows of text as one sequence of words with single boundaries before, between and after them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        out = np.insert(table[data], offsets, 0) if len(data) else np.zeros(len(offsets), np.uint8)
        keep = out != 0
        keep[1:] |= out[:-1] != 0
        keep[0] = True
        self.bytes = out[keep]
        total = np.cumsum(keep)
        #: The index after each row's first boundary, and the end.
        self.rows = total[offsets + np.arange(len(offsets))]
        self.rows = np.maximum.accumulate(self.rows)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words, and each row's bounds among them."""
        inside = self.bytes != 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        return starts, ends, np.searchsorted(starts, self.rows)

    def grams(self, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray]]:
        """(n, bucket of the n bytes from each place): of windows within one word and its boundaries;
        all others have the bucket 2^bits."""
        s = self.bytes.astype(np.uint32)
        n, key, good = 1, s, np.ones(len(s), bool)
        inside = self.bytes != 0
        while n < max(sizes):
            if n > 1:
                good = good[:-1] & inside[n - 1 : len(inside) - 1] if len(good) > 1 else good[:0]
            else:
                good = good[:-1]
            key = key[:-1] * np.uint32(16777619) + s[n:] if len(key) else key
            n += 1
            if n in sizes:
                mixed = (key ^ (key >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
                bucket = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - bits)
                yield n, np.where(good, bucket, np.uint32(1 << bits)).astype(np.int64)
