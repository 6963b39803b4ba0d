"""Fill-in-middle transformation of whole texts, cut with succinct rank and select over boundary bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.words import parts, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Words of 64 bits to a block of the popcount directory.
BLOCK = 8

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class RankSelect:
    """A bitvector packed into 64-bit words, with a directory of the ones before each block of BLOCK words.

    rank(i) is the number of ones before bit i; select(k) is the place of the one number k, from 0, and the
    vector's length for k equal to the number of ones. Both take arrays, and touch one block for each element:
    rank adds the popcounts of the block's words before i, select finds the block by binary search in the
    directory, then the word by the block's running popcounts, then the bit."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        n = -(-max(1, len(bits)) // (64 * BLOCK)) * 64 * BLOCK
        packed = np.zeros(n // 8, np.uint8)
        own = np.packbits(bits, bitorder="little")
        packed[: len(own)] = own
        self.words = packed.view("<u8").reshape(-1, BLOCK)
        ones = np.bitwise_count(self.words).astype(np.int64)
        # the ones of a block's words before each of its words: small numbers, as bytes and a few bits would do
        self.inner = (np.cumsum(ones, axis=1) - ones).astype(np.uint16)
        self.directory = np.concatenate(([0], np.cumsum(ones.sum(axis=1))))
        self.total = int(self.directory[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        block, rest = np.divmod(at, 64 * BLOCK)
        word, bit = np.divmod(rest, 64)
        end = block == len(self.words)
        b, w = np.where(end, 0, block), np.where(end, 0, word)
        below = self.words[b, w] & ((np.uint64(1) << bit.astype(np.uint64)) - np.uint64(1))
        return np.where(end, self.total, self.directory[b] + self.inner[b, w] + np.bitwise_count(below))

    def select(self, k: np.ndarray) -> np.ndarray:
        out = np.full(len(k), self.size, np.int64)
        fine = np.flatnonzero(k < self.total)
        k = k[fine]
        block = np.searchsorted(self.directory, k, "right") - 1
        left = k - self.directory[block]
        word = (self.inner[block] <= left[:, None]).sum(axis=1) - 1
        left = left - self.inner[block, word]
        bits = np.unpackbits(np.ascontiguousarray(self.words[block, word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bit = (np.cumsum(bits, axis=1) <= left[:, None]).sum(axis=1)
        out[fine] = block * 64 * BLOCK + word * 64 + bit
        return out


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(characters, tokens): which bytes of a text column start a character, and which a token ([A-Za-z]+ or any other
    single character)."""
    characters = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    tokens = characters.copy()
    tokens[1:] &= ~(letter[1:] & letter[:-1])
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    tokens[first] = True
    return characters, tokens


def _cut(rows: pa.RecordBatch, plain: int, spm: int) -> pa.RecordBatch:
    data, offsets = text_bytes(rows.column("text"))
    characters, tokens = (RankSelect(x) for x in boundaries(data, offsets))
    start = tokens.rank(offsets)
    n = start[1:] - start[:-1]
    h1, h2, h3, h4 = (rows.column(f"h{i}").to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 5))
    one, two = h1 % (n + 1), h2 % (n + 1)
    # the token behind the last one of a text is the next text's first, which starts where this text ends
    a = np.minimum(tokens.select(start[:-1] + np.minimum(one, two)), offsets[1:])
    b = np.minimum(tokens.select(start[:-1] + np.maximum(one, two)), offsets[1:])
    seen = characters.rank(np.concatenate((offsets[:-1], a, b))).reshape(3, -1)
    raw = data.tobytes()
    form, output, sizes = [], [], []
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for i in range(len(n)):
        lo, x, y, hi = int(offsets[i]), int(a[i]), int(b[i]), int(offsets[i + 1])
        text = raw[lo:hi]
        if not text or p in text or s in text or m in text or h3[i] % 100 >= plain:
            form.append("plain")
            output.append(text)
            sizes.append((None, None))
            continue
        before, middle, after = raw[lo:x], raw[x:y], raw[y:hi]
        if h4[i] % 100 < spm:
            form.append("spm")
            output.append(b"".join((s, after, p, before, m, middle)))
        else:
            form.append("psm")
            output.append(b"".join((p, before, s, after, m, middle)))
        sizes.append((int(seen[1, i] - seen[0, i]), int(seen[2, i] - seen[1, i])))
    found = [pa.array(n, pa.int64()), pa.array(form, pa.string()), *(pa.array([x[k] for x in sizes], pa.int64()) for k in (0, 1)), pa.array(output, pa.binary()).cast(pa.string())]
    kept = [rows.column(i) for i in range(rows.num_columns - 5)]
    return pa.RecordBatch.from_arrays(kept + found, rows.schema.names[:-5] + ["n", "form", "prefix_chars", "middle_chars", "output"])


def transform(df: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all of df's, if None) and of each text: n, form, prefix_chars, middle_chars, output.

    A text is n tokens ([A-Za-z]+ or any other single character). The first four 8-digit groups of the sha256 of
    `seed:id` are numbers h1 to h4: the prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) tokens, the middle
    after the larger. h3 % 100 >= plain_from leaves a text plain, h4 % 100 < spm_below puts the suffix first (spm).
    The token boundaries of a batch are one bitvector; popcounts give each n, two selects each pair of cuts in bytes.

    A null or empty text gives form plain and an empty output with n 0; so does not change, in form plain, a text
    that contains a mark. A null id counts as an empty one. Rows are independent: repeated ids and texts each give their row, in no order, and
    an empty table an empty one. A very long text takes memory in proportion to its length, work likewise.
    Columns of df named like results are replaced by them."""
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = df.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias("__text"), *groups)
    # columns of the input may have any names: Spark's names, then positions, tell the five working columns apart
    names = [f"c{i}" for i in range(len(kept))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch.rename_columns(names + ["text", "h1", "h2", "h3", "h4"]), len(names)):
                yield _cut(part, plain_from, spm_below)

    types = [df.schema[c].dataType.simpleString() for c in kept]
    schema = ", ".join([f"c{i} {t}" for i, t in enumerate(types)] + ["n long", "form string", "prefix_chars long", "middle_chars long", "output string"])
    return rows.mapInArrow(run, schema).toDF(*kept, "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: Column, form: Column) -> Column:
    """The text that transform() made an output of: the parts between the marks in their first order. Built-in functions only.

    No text in a form other than plain contains a mark, and no end of a part joins with the mark behind it to another
    one, so a mark's first place is its own."""
    first, second = F.when(form == "spm", F.lit(PREFIX)).otherwise(F.lit(SUFFIX)), F.lit(MIDDLE)
    at = F.call_function("locate", first, output)
    end = F.call_function("locate", second, output)
    one = F.substring(output, F.lit(4), at - 4)
    two = F.substring(output, at + 3, end - at - 3)
    middle = F.substring(output, end + 3, F.length(output))
    return F.when(form == "plain", output).when(form == "spm", F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))
