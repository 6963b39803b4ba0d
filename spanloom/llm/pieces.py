"""SentencePiece BPE encoding by backtracking over longest matches, and decoding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import words

SPACE = "▁"
#: Words kept in each of the two generations of a worker's memo.
MEMO = 200_000
#: Pairs whose check is kept.
MOST_PAIRS = 600_000
#: Characters that one memo entry may have; longer pieces of text are encoded but not kept.
LONGEST_KEPT = 48


class Encoder:
    """Encodes exactly as merging would: repeatedly the adjacent pair whose joined piece scores highest,
    the leftmost of equal ones. A sequence of pieces is that result just if each piece is what its own
    text merges to and each adjacent pair is what the pair's text merges to. So the encoder walks
    forward over the longest pieces at each place (Aho-Corasick), tries the next shorter piece or steps
    back when a pair doesn't fit, and marks places from which no way on exists in a bitfield."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        self.byte = [0] * 256
        self.names = []
        pieces: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i in range(n):
            name = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(name[1:-1], 16)
                self.byte[value] = i
                self.names.append(bytes([value]))
            elif sp.is_control(i):
                self.names.append(b"")
            elif sp.is_unknown(i):
                self.names.append(" ⁇ ".encode())
            else:
                self.names.append(name.replace(SPACE, " ").encode())
                if not sp.is_unused(i):
                    pieces[name] = i
                    self.score[name] = sp.get_score(i)
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.starts_space = np.array([sp.id_to_piece(i).startswith(SPACE) and not sp.is_byte(i) for i in range(n)])
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.normalize = None if self._plain(sp) else sp.normalize
        # no piece holds a space mark behind another character, so no merge crosses such a place
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.inside = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        self.fits: dict[int, bool] = {}  # by the ids of a pair
        self.own: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for p in pieces:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.lengths = np.array([len(x) for x in self.names], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.text = np.frombuffer(b"".join(self.names), np.uint8)

    @staticmethod
    def _plain(sp) -> bool:
        """Whether the model only puts a space in front and marks spaces (probed)."""
        probe = " a ﬁ é　Å\t\r\n  b​­ "
        return sp.normalize(probe) == SPACE + probe.replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """The merges themselves, for checks of one piece or one pair."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, a: str, b: str) -> bool:
        """Whether the pair's text merges to the pair."""
        return self.merged(a + b) == [a, b]

    def whole(self, p: str) -> int:
        """The id of a piece that its own text merges to; -1 for other texts, -2 for a character without a piece."""
        i = self.pieces.get(p)
        if len(p) == 1:
            return -2 if i is None else i
        return i if i is not None and self.merged(p) == [p] else -1

    def _longest_at(self, text: str) -> list[int]:
        """The length of the longest piece that starts at each place; 0 where none does."""
        best = [0] * len(text)
        for end, n in self.automaton.iter(text):
            i = end + 1 - n
            if n > best[i]:
                best[i] = n
        return best

    def split(self, text: str) -> list[int]:
        """The ids of a text; a character without a piece becomes the ids of its bytes."""
        n = len(text)
        best = self._longest_at(text)
        own, fits = self.own, self.fits
        failed = 0  # bit i: nothing valid goes on from i
        ids: list[int] = []
        ends: list[int] = []
        i, size, last = 0, (best[0] or 1) if n else 0, -1
        while i < n:
            while size:
                p = text[i : i + size]
                t = own.get(p)
                if t is None:
                    t = self.whole(p)
                    if t != -1 or p in self.pieces:
                        own[p] = t
                if t != -1 and not failed >> (i + size) & 1:
                    if last < 0 or t < 0:
                        good = not ids or self.fit(text[ends[-2] if len(ends) > 1 else 0 : i], p)
                    else:
                        key = last << 20 | t
                        good = fits.get(key)
                        if good is None:
                            if len(fits) > MOST_PAIRS:
                                fits.clear()
                            good = fits[key] = self.fit(text[ends[-2] if len(ends) > 1 else 0 : i], p)
                    if good:
                        break
                size -= 1
            if size:
                ids.append(t)
                i += size
                ends.append(i)
                last = t
                size = (best[i] or 1) if i < n else 0
                continue
            failed |= 1 << i
            if not ids:  # never where each piece is some merge of shorter ones
                return [x for p in self.merged(text) for x in self._ids(p)]
            ids.pop()
            ends.pop()
            before = ends[-1] if ends else 0
            size, i, last = i - before - 1, before, ids[-1] if ids else -1
        if -2 in ids:
            starts = [0, *ends]
            return [x for t, a, b in zip(ids, starts, ends) for x in ((t,) if t >= 0 else self._ids(text[a:b]))]
        return ids

    def _ids(self, p: str) -> list[int]:
        i = self.pieces.get(p)
        return [self.byte[b] for b in p.encode("utf-8", "surrogatepass")] if i is None else [i]

    def _chunk(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a part of a text that no merge leaves."""
        found = self.new.get(text)
        if found is not None:
            return found
        found = self.old.get(text)
        if found is None:
            ids: list[int] = []
            start = 0
            # between characters that no piece has side by side, there is no merge
            for k in range(1, len(text)):
                if text[k - 1 : k + 1] not in self.inside:
                    ids += self.split(text[start:k])
                    start = k
            if start < len(text):
                ids += self.split(text[start:])
            found = np.array(ids, "<i4").tobytes()
        if len(text) <= LONGEST_KEPT:
            if len(self.new) >= MEMO:
                self.old, self.new = self.new, {}
            self.new[text] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian 32-bit numbers."""
        if not text:
            return b""
        if self.normalize is not None:
            marked = self.normalize(text)
        else:
            marked = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return np.array(self.split(marked), "<i4").tobytes()
        # words begin at each run of space marks
        out, chunk, run = [], self._chunk, ""
        for w in marked.split(SPACE)[1:] if marked.startswith(SPACE) else marked.split(SPACE):
            if w:
                out.append(chunk(run + SPACE + w if run or out or marked.startswith(SPACE) else w))
                run = ""
            else:
                run += SPACE
        if run:
            out.append(chunk(run))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text of ids: bytes that are no UTF-8 become U+FFFD each, and one space that
        the encoder put in front goes."""
        if not len(ids):
            return b""
        n = self.lengths[ids]
        if int(n.sum()) > 1 << 22:  # a long text in parts, for bounded memory
            cut = len(ids) // 2
            while cut and self.is_byte[ids[cut]]:
                cut -= 1
            if cut:
                head = self.decode(ids[:cut])
                tail = self.decode(ids[cut:])
                return head + (b" " if self.starts_space[ids[cut]] else b"") + tail
        at = np.cumsum(n)
        raw = self.text[np.repeat(self.first[ids] - at + n, n) + np.arange(at[-1])]
        high = self.is_byte[ids] & (self.text[self.first[ids]] > 127)
        out = raw.tobytes()
        if high.any():
            out = self._repaired(ids, out)
        return out[1:] if self.starts_space[ids[0]] else out

    def _repaired(self, ids: np.ndarray, out: bytes) -> bytes:
        try:
            out.decode()
            if not self._splits(ids):
                return out
        except UnicodeDecodeError:
            pass
        parts, run = [], bytearray()
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.names[i]
                continue
            parts.append(_valid(bytes(run)))
            run.clear()
            if i >= 0:
                parts.append(self.names[i])
        return b"".join(parts)

    def _splits(self, ids: np.ndarray) -> bool:
        """Whether some run of byte pieces alone is no UTF-8, though all together are."""
        own = self.is_byte[ids]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], own.astype(np.int8), [0]))))
        for a, b in zip(edge[::2], edge[1::2]):
            try:
                b"".join(self.names[i] for i in ids[a:b]).decode()
            except UnicodeDecodeError:
                return True
        return False


def _valid(run: bytes) -> bytes:
    try:
        run.decode()
        return run
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[i : i + n].decode().encode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�".encode())
            i += 1
    return b"".join(out)


@lru_cache(maxsize=2)
def encoder(model_path: str) -> Encoder:
    """One encoder for each worker and model; its memo lasts from task to task."""
    return Encoder(model_path)


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """df's columns (those in keep, or all) with its texts' ids (array of int) and the text that decoding the ids gives.

    Exactly the sentencepiece library's ids for a BPE model, without begin or end ids; a null text
    counts as empty. Very long texts are encoded whole; where pairs score alike the leftmost is merged first, as in the
    library. Equal rows have equal results; an empty table gives an empty one. Columns of df that have these names are
    replaced. model_path must be readable by every executor. Rows stay in their partitions; nothing is shuffled."""
    kept = [c for c in keep or df.columns if c.lower() not in (ids_col.lower(), decoded_col.lower())]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(decoded_col, T.StringType())])
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model_path)
        for batch in batches:
            for part in words.parts(batch, at, 2 << 20):
                raw = [e.encode(t or "") for t in part.column(at).to_pylist()]
                ids = [np.frombuffer(x, "<i4") for x in raw]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(raw))]))
                text = pa.array([e.decode(x) for x in ids], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:at], column, text], [*kept, ids_col, decoded_col])

    rows = df.select(*[F.col(f"`{c}`") for c in [*kept, text_col]])
    return rows.toDF(*[f"c{i}" for i in range(at + 1)]).mapInArrow(run, schema)
