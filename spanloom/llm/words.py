"""Words of whole Arrow text columns as 64-bit fingerprints, in numpy.

Works on the UTF-8 bytes: every byte of a character beyond ASCII is 0x80 or more, so a
class of ASCII separators splits bytes exactly as it splits characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Letters and digits after lower-casing, and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

#: Everything but ASCII white space.
SOLID = np.ones(256, bool)
SOLID[9:14] = SOLID[32] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: What is left of eight bytes read at a word of n bytes.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose result bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most` bytes, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def parts(batch: pa.RecordBatch, at: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about `most` bytes in a text column, so that what a task holds stays small."""
    for i, j in slices(text_bytes(batch.column(at))[1], most):
        yield batch.slice(i, j - i)


def spans(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of kept bytes within each row, and the first run of each row (and their number)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = keep[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < n]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    last = inside
    last[:-1] &= ~keep[data[1:]]
    stop = offsets[1:][offsets[1:] > 0] - 1
    last[stop] = keep[data[stop]]
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _lanes(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the first eight bytes of each word, the next eight of those that have more, which these are); zeros behind an end."""
    eight = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))).tobytes(), 0, (1,))
    long_ = np.flatnonzero(size > 8)
    return eight[starts] & _MASK[np.minimum(size, 8)], eight[starts[long_] + 8] & _MASK[np.minimum(size[long_] - 8, 8)], long_


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word, by its length and bytes: mixed eight bytes at a time up to 16 bytes, and a
    cryptographic hash of longer words."""
    size = ends - starts
    one, two, long_ = _lanes(data, starts, size)
    out = mix(size.astype(np.uint64) * _BASE ^ one)
    out[long_] = mix(out[long_] * _BASE + two)
    for i in np.flatnonzero(size > 16).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def normal(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """Each row's words with one blank between two of them."""
    starts, ends, bounds = spans(data, offsets, keep)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside[:-1]) > 0
    # the byte behind a word is its separator, if another word of the row follows
    last = np.zeros(len(starts), bool)
    last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    text = np.where(inside, data, np.uint8(32))
    inside[ends[~last]] = True
    place = np.concatenate(([0], np.cumsum(inside)))
    text = text[inside].tobytes()
    return [text[a:b] for a, b in zip(place[offsets[:-1]].tolist(), place[offsets[1:]].tolist())]


def shingles(word: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row, its sorted distinct k-word shingles; a row of fewer words has its whole sequence as the one."""
    n = len(word)
    if n >= k:
        every = word[: n - k + 1].copy()
        for i in range(1, k):
            every = mix(every * _BASE + word[i : n - k + 1 + i])
    none = np.zeros(0, np.uint64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            yield np.unique(every[a : b - k + 1])
        elif b > a:
            h = word[a : a + 1] + np.uint64(b - a)
            for i in range(a + 1, b):
                h = mix(h * _BASE + word[i : i + 1])
            yield mix(h)
        else:
            yield none


def grouped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first, fingerprints): the words by fingerprint, equal ones together and in their order, the places in
    order where groups of equal words begin, and each group's fingerprint. Words are equal if their bytes are, whatever
    their fingerprints."""
    code, size = fingerprints(data, starts, ends), ends - starts
    order = np.argsort(code, kind="stable")
    code = code[order]
    new = code[1:] != code[:-1]
    one, two, long_ = _lanes(data, starts, size)
    rest = np.zeros(len(starts), np.uint64)
    rest[long_] = two
    alike = np.ones(len(new), bool)
    for x in (size, one, rest):
        x = x[order]
        alike &= x[1:] == x[:-1]
    for i in np.flatnonzero(~new & alike & (size[order][1:] > 16)).tolist():
        j, k = order[i], order[i + 1]
        alike[i] = data[starts[j] : ends[j]].tobytes() == data[starts[k] : ends[k]].tobytes()
    if not (new | alike).all():
        known: dict[bytes, int] = {}
        number = np.array([known.setdefault(data[starts[k] : ends[k]].tobytes(), len(known)) for k in order.tolist()])
        again = np.lexsort((number, code))
        order, code, number = order[again], code[again], number[again]
        new = number[1:] != number[:-1]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(order)), bool), new)))
    return order, first, code[first]


def numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each word, a word of each number): numbers are equal just where the words are."""
    order, first, _ = grouped(data, starts, ends)
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    return out, order[first]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the words one behind the other."""
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    return data[np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])], offsets


def exact_shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    """For each text of words with single blanks, its sorted distinct k-word shingles as numbers that are equal
    within this call just where the words are equal; a text of fewer words has its whole sequence as the one."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    offsets[-1] = max(0, offsets[-1] - 1)
    blank = np.ones(256, bool)
    blank[32] = False
    starts, ends, bounds = spans(data, np.minimum(offsets, len(data)), blank)
    word, first = numbers(data, starts, ends)
    every, n = word.astype(np.int64), len(first)
    for i in range(1, k):
        every = every[: len(word) - i]
        if n and len(every) and int(every.max()) >= (1 << 62) // n:
            every = np.unique(every, return_inverse=True)[1]
        every = every * n + word[i:]
    out, short = [], {}
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(every[a : b - k + 1]))
        else:
            out.append(np.array([-1 - short.setdefault(tuple(word[a:b].tolist()), len(short))] if b > a else [], np.int64))
    return out
