"""FASTQ, FASTA, GFF and BAM as data sources: files are split by bytes, and each split finds where its records begin.

register(spark) once, then spark.read.format("fastq").load(path), and so on. Paths are those of Arrow's file systems (a
local path, file, hdfs, s3, gs): a file, a folder with all files in it, or a pattern in the last part. A reader makes only the
columns of the schema that it is given: spark.read.format("gff").schema("sequence string, start long")."""

from __future__ import annotations

import fnmatch
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

#: Bytes of a split, of a read, rows of a batch, bytes of a file that a task gets about, as one split or several small ones, and tasks
#: that a file of small splits is dealt to at least.
SPLIT, READ, ROWS, TASK, LEAST = 64 << 20, 1 << 20, 8192, 8 << 20, 4


@dataclass
class Split(InputPartition):
    """Bytes lo to hi of a file; number counts a file's splits."""

    path: str
    lo: int
    hi: int
    number: int


@dataclass
class Splits(InputPartition):
    """Splits that one task reads, one behind the other."""

    splits: list[Split]


def _system(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


def _full(path: str, found: str) -> str:
    head, sep, _ = path.partition("://")
    return f"{head}{sep}{found}" if sep else f"file://{found}"


def files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, of the files in a folder, or of those that match a pattern; names with _ or . in front are left out."""
    fs, inner = _system(path)
    folder, _, pattern = inner.rpartition("/")
    if any(c in pattern for c in "*?["):
        found = [f for f in fs.get_file_info(pa.fs.FileSelector(folder or ".")) if fnmatch.fnmatch(f.base_name, pattern)]
    else:
        info = fs.get_file_info(inner)
        if info.type == pa.fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.type == pa.fs.FileType.File else fs.get_file_info(pa.fs.FileSelector(inner, recursive=True))
    return sorted((_full(path, f.path), f.size) for f in found if f.type == pa.fs.FileType.File and f.size and not f.base_name.startswith(("_", ".")))


class Bytes:
    """A file read in blocks from a place on; a .gz file is read from its start and has no length."""

    def __init__(self, path: str, at: int = 0, size: int = READ):
        fs, inner = _system(path)
        self.file, self.size = fs.open_input_file(inner), size
        self.file.seek(at)
        self.unpack = zlib.decompressobj(31) if path.endswith(".gz") else None

    def blocks(self) -> Iterator[bytes]:
        while block := self.file.read(self.size):
            if self.unpack is None:
                yield block
                continue
            while block:
                out = self.unpack.decompress(block)
                if out:
                    yield out
                # files of several gzip members go on behind the end of one
                block = self.unpack.unused_data
                if self.unpack.eof:
                    self.unpack = zlib.decompressobj(31)

    def lines(self, at: int) -> Iterator[tuple[int, bytes]]:
        """(place, line) of each line, of which the first begins at `at`."""
        held: list[bytes] = []
        for block in self.blocks():
            if b"\n" not in block:
                held.append(block)
                continue
            parts = block.split(b"\n")
            parts[0] = b"".join(held) + parts[0]
            held = [parts.pop()]
            for line in parts:
                yield at, line.rstrip(b"\r")
                at += len(line) + 1
        if rest := b"".join(held):
            yield at, rest.rstrip(b"\r")


def lines_from(path: str, lo: int, hi: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin at lo or behind it; a small split, which ends at hi, is read in small blocks."""
    size = READ if hi is None else max(1 << 14, min(READ, hi - lo + (1 << 10)))
    found = Bytes(path, max(0, lo - 1), size).lines(max(0, lo - 1))
    if lo:
        # what stands before the first end of a line from lo - 1 on belongs to a line of the split before
        next(found, None)
    return found


class _Reader(DataSourceReader):
    """Splits of all files; a subclass gives the columns of a split in batches."""

    def __init__(self, schema, options):
        self.schema = schema
        self.names = schema.fieldNames()
        self.path = options["path"]
        self.size = int(options.get("split_bytes", SPLIT))
        self.options = options

    def partitions(self) -> list[Splits]:
        """Small splits of a file are dealt together, so the number of tasks goes with the bytes, not with the splits."""
        out = []
        for path, size in files(self.path):
            step = size if path.endswith(".gz") else self.size
            found = [Split(path, lo, min(size, lo + step), i) for i, lo in enumerate(range(0, size, step))]
            each = max(1, min(TASK // step, -(-len(found) // LEAST)))
            out += [Splits(found[i : i + each]) for i in range(0, len(found), each)]
        return out or [Splits([])]

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        """Rows in the order of the schema's columns."""
        types = _arrow(self.schema)
        columns = list(zip(*rows)) if rows else [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    def read(self, part: Splits) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for split in part.splits:
            for record in self.records(split):
                rows.append(tuple(record[n] for n in self.names))
                held += record.get("__bytes", 200)
                if len(rows) >= ROWS or held > READ * 4:
                    yield self.batch(rows)
                    rows, held = [], 0
        if rows:
            yield self.batch(rows)

    def records(self, split: Split) -> Iterator[dict]:
        raise NotImplementedError


def _arrow(schema) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


def _text(x: bytes) -> str:
    return x.decode("utf-8", "replace")


# FASTQ


class FastqReader(_Reader):
    """Records of four lines. A line is the first of a record if it begins with @ and the next but one with +: a line of
    qualities may begin with @ too, but two behind it stand a record's bases."""

    def records(self, split: Split) -> Iterator[dict]:
        found = lines_from(split.path, split.lo, split.hi)
        ahead: list[tuple[int, bytes]] = []
        if split.lo:
            while True:
                while len(ahead) < 3:
                    line = next(found, None)
                    if line is None:
                        break
                    ahead.append(line)
                if len(ahead) < 3 or ahead[0][0] >= split.hi:
                    return
                if ahead[0][1][:1] == b"@" and ahead[2][1][:1] == b"+":
                    break
                ahead.pop(0)
        four: list[tuple[int, bytes]] = []
        for line in _chain(ahead, found):
            if not four and (line[0] >= split.hi and not split.path.endswith(".gz")):
                return
            if not four and not line[1]:
                continue
            four.append(line)
            if len(four) == 4:
                yield {"name": _text(four[0][1][1:] if four[0][1][:1] == b"@" else four[0][1]), "seq": _text(four[1][1]), "qual": _text(four[3][1])}
                four = []
        if len(four) > 1:
            yield {"name": _text(four[0][1].removeprefix(b"@")), "seq": _text(four[1][1]), "qual": None}


def _chain(ahead, found):
    yield from ahead
    yield from found


class Fastq(DataSource):
    """(name, seq, qual) of each record."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "name string, seq string, qual string"

    def reader(self, schema) -> FastqReader:
        return FastqReader(schema, self.options)


# FASTA


class FastaReader(_Reader):
    """Whole records, by the split in which their > stands; or, with the option pieces, the lines of a split in pieces."""

    def records(self, split: Split) -> Iterator[dict]:
        pieces = int(self.options.get("pieces", 0))
        yield from self._pieces(split, pieces) if pieces else self._whole(split)

    def _whole(self, split: Split) -> Iterator[dict]:
        header, parts = None, []
        last = split.hi if not split.path.endswith(".gz") else 1 << 62
        for at, line in lines_from(split.path, split.lo, split.hi):
            if line[:1] == b">":
                if header is not None:
                    yield self._record(header, parts)
                header, parts = None, []
                if at >= last:
                    return
                header = _text(line[1:]).strip()
            elif header is not None:
                parts.append(line)
            elif at >= last:
                return
        if header is not None:
            yield self._record(header, parts)

    def _record(self, header: str, parts: list[bytes]) -> dict:
        seq = b"".join(b"".join(x.split()) for x in parts)
        return {"seq_id": header.split()[0] if header else "", "header": header, "seq": _text(seq), "__bytes": len(seq) + 200}

    def _pieces(self, split: Split, size: int) -> Iterator[dict]:
        """(path, split, run, header, at, part): run counts the headers of the split so far; its bases before the first
        header, run 0, belong to a record of a split before. A header without bases has a row with an empty part."""
        last = split.hi if not split.path.endswith(".gz") else 1 << 62
        run, header, at, held, n = 0, None, 1, [], 0

        def row(part: bytes) -> dict:
            return {"path": split.path, "split": split.number, "run": run, "header": header, "at": at, "part": _text(part), "__bytes": len(part) + 300}

        for place, line in lines_from(split.path, split.lo, split.hi):
            if place >= last:
                break
            if line[:1] == b">":
                if n or run:
                    yield row(b"".join(held))
                run, header, at, held, n = run + 1, _text(line[1:]).strip(), 1, [], 0
                continue
            line = b"".join(line.split())
            held.append(line)
            n += len(line)
            if n >= size:
                whole = b"".join(held)
                while len(whole) >= size:
                    yield row(whole[:size])
                    at, whole = at + size, whole[size:]
                held, n = [whole], len(whole)
        if n or run:
            yield row(b"".join(held))


class Fasta(DataSource):
    """(seq_id, header, seq) of each record; with the option pieces the rows that read_fasta_pieces() puts together."""

    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        if int(self.options.get("pieces", 0)):
            return "path string, split int, run int, header string, at long, part string"
        return "seq_id string, header string, seq string"

    def reader(self, schema) -> FastaReader:
        return FastaReader(schema, self.options)


def read_fasta_pieces(spark: SparkSession, path: str, size: int = 1 << 16, split_bytes: int = SPLIT) -> DataFrame:
    """(seq_id, header, at, part): sequences in pieces of at most `size` bases, without a row or a task that holds a whole one.

    Each split cuts its own lines. A record's bases in a split that it doesn't begin in get their header and their place from
    a table of one row for each split: its last header and the bases behind it, carried on along the file."""
    rows = spark.read.format("fasta").option("pieces", size).option("split_bytes", split_bytes).load(path)
    size_of = F.length("part")
    runs = rows.groupBy("path", "split", "run").agg(F.max("header").alias("header"), F.sum(size_of).alias("n"))
    tails = runs.groupBy("path", "split").agg(F.max_by(F.struct("header", "n"), "run").alias("last"), F.max("run").alias("runs"), F.sum(F.when(F.col("run") == 0, F.col("n"))).alias("early"))
    # splits of one file, in order: one without a header lengthens the record that came in
    along = Window.partitionBy("path").orderBy("split")
    tails = tails.withColumn("header", F.col("last.header")).withColumn("tail", F.when(F.col("runs") > 0, F.col("last.n")).otherwise(F.coalesce("early", F.lit(0))))
    tails = tails.withColumn("opened", F.sum((F.col("runs") > 0).cast("int")).over(along))
    tails = tails.withColumn("reach", F.sum("tail").over(Window.partitionBy("path", "opened").orderBy("split")))
    came_in = F.last("header", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    carry = tails.select("path", "split", came_in.alias("came_in"), F.lag("reach").over(along).alias("offset"))
    both = rows.join(carry.withColumnRenamed("path", "__p").withColumnRenamed("split", "__s"), (F.col("path") == F.col("__p")) & (F.col("split") == F.col("__s")))
    first = F.col("run") == 0
    header = F.when(first, F.col("came_in")).otherwise(F.col("header"))
    at = F.col("at") + F.when(first, F.coalesce("offset", F.lit(0))).otherwise(0)
    return both.select(F.regexp_extract(header, r"^(\S*)", 1).alias("seq_id"), header.alias("header"), at.alias("at"), "part").where("header is not null and part <> ''")


# GFF


class GffReader(_Reader):
    """Interval rows of nine fields, as parse_gff() takes them. Comparisons of sequence, feature, strand, start, stop and score with
    constants are made while lines are read."""

    _PLACES = {"sequence": 0, "source": 1, "feature": 2, "start": 3, "stop": 4, "score": 5, "strand": 6, "frame": 7, "attributes": 8}
    _TESTS = {EqualTo: lambda x, y: x == y, GreaterThan: lambda x, y: x > y, GreaterThanOrEqual: lambda x, y: x >= y, LessThan: lambda x, y: x < y, LessThanOrEqual: lambda x, y: x <= y}

    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.tests: list[tuple[str, int, object]] = []

    def pushFilters(self, filters):
        kinds = list(self._TESTS)
        for f in filters:
            if type(f) in kinds and len(f.attribute) == 1 and f.attribute[0] in self._PLACES and f.value is not None:
                self.tests.append((f.attribute[0], kinds.index(type(f)), f.value))
            else:
                yield f

    def records(self, split: Split) -> Iterator[dict]:
        last = split.hi if not split.path.endswith(".gz") else 1 << 62
        kinds = list(self._TESTS.values())
        wanted = [n for n in self._PLACES if n in self.names or any(n == t[0] for t in self.tests)]
        for at, line in lines_from(split.path, split.lo, split.hi):
            if at >= last:
                return
            fields = line.split(b"\t")
            if len(fields) != 9 or not fields[8] or line.lstrip()[:1] == b"#":
                continue
            row = {n: self._value(n, fields[self._PLACES[n]]) for n in wanted}
            if all(row[n] is not None and kinds[k](row[n], v) for n, k, v in self.tests):
                yield row

    @staticmethod
    def _value(name: str, x: bytes):
        if x == b".":
            return None
        try:
            if name in ("start", "stop"):
                return int(x)
            if name == "score":
                return float(x)
        except ValueError:
            return None
        return _text(x).lower() if name == "sequence" else _text(x)


class Gff(DataSource):
    """(sequence, source, feature, start, stop, score, strand, frame, attributes)."""

    @classmethod
    def name(cls) -> str:
        return "gff"

    def schema(self) -> str:
        return "sequence string, source string, feature string, start long, stop long, score double, strand string, frame string, attributes string"

    def reader(self, schema) -> GffReader:
        return GffReader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Makes the formats known to a session, and lets readers take filters."""
    from spanloom.session import ship_package
    from spanloom.sources.bam import Bam

    ship_package(spark, bound_batches=False)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for kind in (Fastq, Fasta, Gff, Bam):
        spark.dataSource.register(kind)
