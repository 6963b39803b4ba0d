"""BAM: aligned reads in blocks of compressed bytes, read by splits and written by tasks."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from spanloom.sources.formats import READ, Split, _Reader, _system, _text

#: How a compressed block begins, and the empty block at a file's end. Fixed values of the format.
BLOCK_HEAD = b"\x1f\x8b\x08\x04"
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BASES = "=ACMGRSVTWYHKDBN"
#: Bases as hexadecimal digits and back: other letters are N. Qualities as letters.
_DIGITS = {i: format(BASES.find(chr(i)), "x") if chr(i) in BASES else "f" for i in range(128)}
_LETTERS = str.maketrans("0123456789abcdef", BASES)
_QUALITIES = bytes((i + 33) % 256 for i in range(256))
CIGAR = "MIDNSHP=X"
#: Bytes of a block before compression, and records that must follow a supposed record's start.
BLOCK_BYTES, CHAIN = 60_000, 4


def block_size(head: bytes) -> int | None:
    """The size of a block from its first bytes, or None if no block begins so: a gzip member with the extra field BC."""
    if len(head) < 18 or head[:4] != BLOCK_HEAD:
        return None
    extra = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]]
    while len(extra) >= 4:
        n = struct.unpack_from("<H", extra, 2)[0]
        if extra[:2] == b"BC" and n == 2 and len(extra) >= 6:
            return struct.unpack_from("<H", extra, 4)[0] + 1
        extra = extra[4 + n :]
    return None


class Blocks:
    """The blocks of a file from a place on, which is made out by two blocks that follow each other, or one and the end."""

    def __init__(self, path: str, at: int, end: int):
        fs, inner = _system(path)
        self.file, self.end, self.at, self.held = fs.open_input_file(inner), end, at, b""
        self.size, self.step = self.file.size(), max(1 << 17, min(READ, end - at))
        self.file.seek(at)

    def _ensure(self, n: int) -> bool:
        while len(self.held) < n:
            more = self.file.read(self.step)
            if not more:
                return False
            self.held += more
        return True

    def _whole(self, at: int) -> bool:
        """Whether a block lies at this place of what is held, and unpacks to what it says."""
        self._ensure(at + 18)
        n = block_size(self.held[at : at + 18])
        if n is None or not self._ensure(at + n):
            return False
        try:
            unpack = zlib.decompressobj(31)
            unpack.decompress(self.held[at : at + n])
            return unpack.eof
        except zlib.error:
            return False

    def find(self) -> bool:
        """Goes to the first block from here on; False if there is none before the end of the split."""
        while True:
            i = self.held.find(BLOCK_HEAD)
            if i < 0:
                self.at += max(0, len(self.held) - 3)
                self.held = self.held[-3:] if len(self.held) >= 3 else self.held
                if self.at >= self.end or not self._ensure(len(self.held) + 1):
                    return False
                continue
            if self.at + i >= self.end:
                return False
            if self._whole(i):
                self.held, self.at = self.held[i:], self.at + i
                return True
            self.held, self.at = self.held[i + 1 :], self.at + i + 1

    def next(self) -> tuple[int, bytes] | None:
        """(place, bytes) of the next block, unpacked."""
        if not self._ensure(18):
            return None
        n = block_size(self.held[:18])
        if n is None or not self._ensure(n):
            raise ValueError(f"no whole block at byte {self.at}")
        place, data = self.at, zlib.decompress(self.held[:n], 31)
        self.held, self.at = self.held[n:], self.at + n
        return place, data


def read_header(path: str) -> tuple[list[tuple[str, int]], int]:
    """(names and lengths of the sequences, bytes of the header before compression)."""
    blocks = Blocks(path, 0, 1 << 62)
    data = b""

    def need(n: int) -> None:
        nonlocal data
        while len(data) < n:
            block = blocks.next()
            if block is None:
                raise ValueError(f"{path}: the header is cut off")
            data += block[1]

    need(12)
    if data[:4] != b"BAM\1":
        raise ValueError(f"{path}: no BAM file")
    at = 8 + struct.unpack_from("<i", data, 4)[0]
    need(at + 4)
    n, at, out = struct.unpack_from("<i", data, at)[0], at + 4, []
    for _ in range(n):
        need(at + 4)
        size = struct.unpack_from("<i", data, at)[0]
        need(at + 8 + size)
        out.append((_text(data[at + 4 : at + 3 + size]), struct.unpack_from("<i", data, at + 4 + size)[0]))
        at += 8 + size
    return out, at


def plausible(data: bytes, at: int, sequences: int) -> int | None:
    """Where the record behind the one at this place would begin; None if none can begin here."""
    if len(data) < at + 36:
        return None
    size, ref, pos, name, _, _, cigar, _, bases, next_ref, next_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    least = 32 + name + 4 * cigar + (bases + 1) // 2 + bases
    if size < least or size > 1 << 28 or bases < 0 or not -1 <= ref < sequences or not -1 <= next_ref < sequences or pos < -1 or next_pos < -1 or not name:
        return None
    own = data[at + 36 : at + 36 + name]
    if len(own) == name and (own[-1] or any(c < 33 or c > 126 for c in own[:-1])):
        return None
    return at + 4 + size


class BamReader(_Reader):
    """Records by the split in which the block stands that they begin in. In the first block of a split, a record's start is a place from
    which CHAIN plausible records (or all up to the end) follow each other."""

    _headers: tuple = ("", None)

    def header(self, path: str) -> tuple[list[tuple[str, int]], int]:
        """The header of a file, which is read once for splits that follow each other."""
        if self._headers[0] != path:
            self._headers = (path, read_header(path))
        return self._headers[1]

    def records(self, split: Split) -> Iterator[dict]:
        sequences, header = self.header(split.path)
        blocks, wanted = Blocks(split.path, split.lo, split.hi), set(self.names)
        if not blocks.find():
            return
        data, ends = b"", []  # what is unpacked, and up to where it comes from blocks of this split

        def more() -> bool:
            nonlocal data
            block = blocks.next()
            if block is None:
                return False
            data += block[1]
            if block[0] < split.hi:
                ends[:] = [len(data)]
            return True

        at = 0
        if split.lo == 0:
            while len(data) < header and more():
                pass
            at = header
        else:
            at = self._first(lambda: data, more, len(sequences), ends)
            if at is None:
                return
        while True:
            while len(data) < at + 4 or len(data) < at + 4 + struct.unpack_from("<i", data, at)[0]:
                if at >= ends[0] and blocks.at >= split.hi or not more():
                    if len(data) >= at + 4 and at < ends[0]:
                        raise ValueError(f"{split.path}: the last record is cut off")
                    return
            if at >= ends[0] and blocks.at >= split.hi:
                return
            size = struct.unpack_from("<i", data, at)[0]
            yield self._record(data[at + 4 : at + 4 + size], sequences, wanted)
            at += 4 + size
            if at > READ:
                ends[:] = [ends[0] - at]
                data, at = data[at:], 0

    @staticmethod
    def _first(data, more, sequences: int, ends: list[int]) -> int | None:
        more()
        start, done = 0, False
        while True:
            at, n = start, 0
            while n < CHAIN:
                if len(data()) < at + 36 and not done:
                    done = not more()
                    continue
                if at == len(data()) and done and n:
                    break
                at = plausible(data(), at, sequences)
                if at is None:
                    break
                n += 1
            else:
                return start
            if at is not None:
                return start
            start += 1
            if start >= ends[0] and (done or len(data()) > ends[0]):
                return None
            if start + 36 > len(data()) and done:
                return None

    @staticmethod
    def _record(x: bytes, sequences: list[tuple[str, int]], wanted: set[str]) -> dict:
        ref, pos, name, mapq, _, cigar, flag, bases, next_ref, next_pos, insert = struct.unpack_from("<iiBBHHHiiii", x, 0)
        at = 32 + name
        ops = x[at : at + 4 * cigar]
        at += 4 * cigar
        packed = x[at : at + (bases + 1) // 2]
        seq = packed.hex().translate(_LETTERS)[:bases] if "seq" in wanted else ""
        qual = x[at + len(packed) : at + len(packed) + bases] if "qual" in wanted else b""
        named = lambda r: sequences[r][0] if r >= 0 else "*"
        return {
            "read": _text(x[32 : 31 + name]), "flag": flag, "sequence": named(ref), "pos": pos + 1, "mapq": mapq, "cigar": _cigar_text(ops) if "cigar" in wanted else None,
            "next_sequence": "=" if next_ref == ref and ref >= 0 else named(next_ref), "next_pos": next_pos + 1, "insert": insert, "seq": seq or "*",
            "qual": "*" if not qual or qual[:1] == b"\xff" else qual.translate(_QUALITIES).decode("latin-1"), "__bytes": 2 * bases + 200,
        }


@lru_cache(4096)
def _cigar_text(ops: bytes) -> str:
    return "".join(f"{o >> 4}{CIGAR[o & 15]}" for o in struct.unpack(f"<{len(ops) // 4}I", ops)) or "*"


@lru_cache(4096)
def _cigar_bytes(text: str) -> bytes:
    return b"".join(struct.pack("<I", int(n) << 4 | CIGAR.index(c)) for n, c in re.findall(rf"(\d+)([{re.escape(CIGAR)}])", text))


class Bam(DataSource):
    """The eleven fields of an aligned read."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return "read string, flag int, sequence string, pos long, mapq int, cigar string, next_sequence string, next_pos long, insert long, seq string, qual string"

    def reader(self, schema) -> BamReader:
        return BamReader(schema, self.options)


def aligned(records: DataFrame) -> DataFrame:
    """Records of a BAM file as parse_sam() gives rows of text: aligned ones; names with rc_ in front are the reverse strand of the rest."""
    rows = records.where((F.col("flag").bitwiseAND(4) == 0) & (F.col("sequence") != "*"))
    minus = F.lower("sequence").startswith("rc_") != (F.col("flag").bitwiseAND(16) != 0)
    return rows.select("read", F.regexp_replace(F.lower("sequence"), "^rc_", "").alias("sequence"), F.col("pos").alias("start"), (F.col("pos") + F.length("seq") - 1).alias("stop"), F.when(minus, "-").otherwise("+").alias("strand"), "seq")


def read_bam(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    # a reader makes only the columns that it is given
    reader = spark.read.format("bam").schema("read string, flag int, sequence string, pos long, seq string")
    return aligned((reader.option("split_bytes", split_bytes) if split_bytes else reader).load(path))


# writing


def block(data: bytes) -> bytes:
    """One compressed block of at most BLOCK_BYTES bytes."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    return BLOCK_HEAD + b"\0\0\0\0\0\xff\6\0BC\2\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def header_bytes(sequences: list[tuple[str, int]]) -> bytes:
    text = "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in sequences).encode()
    return b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(sequences)) + b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in sequences)


def record_bytes(row: dict, numbers: dict[str, int]) -> bytes:
    """One record; a sequence that numbers lacks, `*` say, is none."""
    name, seq = (row["read"] or "*").encode() + b"\0", "" if row["seq"] in (None, "*") else row["seq"].upper()
    ops = _cigar_bytes(row.get("cigar") or "")
    codes = bytes.fromhex(seq.encode("ascii", "replace").decode().translate(_DIGITS) + "0" * (len(seq) % 2))
    qual = row.get("qual")
    quality = bytes(ord(c) - 33 for c in qual) if qual and qual != "*" and len(qual) == len(seq) else b"\xff" * len(seq)
    near = row.get("next_sequence")
    ref = numbers.get(row["sequence"], -1)
    body = struct.pack("<iiBBHHHiiii", ref, (row["pos"] or 0) - 1, len(name), row.get("mapq") or 0, 4680, len(ops) // 4, row["flag"] or 0, len(seq), ref if near == "=" else numbers.get(near, -1), (row.get("next_pos") or 0) - 1, row.get("insert") or 0)
    body += name + ops + codes + quality
    return struct.pack("<i", len(body)) + body


def _write(folder: str, sequences: list[tuple[str, int]], names: list[str], block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        numbers = {n: i for i, (n, _) in enumerate(sequences)}
        # another attempt of a task writes another file; only those that are named in the result count
        name, held, n = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bam", bytearray(header_bytes(sequences)), 0
        with fs.open_output_stream(f"{root}/{name}") as out:
            for batch in batches:
                for values in zip(*(c.to_pylist() for c in batch.columns)):
                    held += record_bytes(dict(zip(names, values)), numbers)
                    n += 1
                    while len(held) >= block_bytes:
                        out.write(block(bytes(held[:block_bytes])))
                        del held[:block_bytes]
            if held:
                out.write(block(bytes(held)))
            out.write(LAST_BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "n"])

    return run


def write_bam(rows: DataFrame, folder: str, sequences: list[tuple[str, int]], block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Writes a file for each task into a new folder, and returns the files' paths; the sequences' names and lengths are the header, so
    they are few. Rows have read, flag, sequence, pos and seq, and perhaps cigar, qual, mapq, next_sequence, next_pos and insert.

    Files that a failed attempt has left are deleted."""
    fs, root = pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    found = {r.file for r in rows.mapInArrow(_write(folder, sequences, rows.columns, min(block_bytes, BLOCK_BYTES)), "file string, n long").collect()}
    for f in fs.get_file_info(pa.fs.FileSelector(root)):
        if f.base_name not in found and f.base_name.endswith(".bam"):
            fs.delete_file(f.path)
    return sorted(f"{folder}/{f}" for f in found)
