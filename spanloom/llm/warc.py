"""WARC archives in the shared folder: written with an index, read back by byte ranges."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import words
from spanloom.llm.shared import broadcast_if_small, join_hot, shared_dir, write_table

#: Bytes between two selected records that one read may skip over, and bytes of one read at most.
GAP, READ = 64 << 10, 8 << 20
#: A new archive file begins after this many bytes.
FILE_BYTES = 64 << 20
#: Bytes of records of one read task (about), and of a run of records that stays together.
TASK_BYTES, RUN_BYTES = 16 << 20, 4 << 20
#: Revisits (an id, a digest and an address) that are broadcast at most: about 30 MB.
MOST_REVISITS = 200_000
DATE = "2024-01-01T00:00:00Z"
INDEX = "page_id long, url string, file string, offset long, length long, digest string, record_type string, refers_to long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in words.parts(whole, 2)):
        html = [(x.as_buffer() if x.is_valid else None) for x in batch.column(2).cast(pa.binary())]
        digest = [payload_digest(x or b"") for x in html]
        size = [len(x) if x is not None else 0 for x in html]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(digest, pa.string()), pa.array(size, pa.int64())], ["page_id", "url", "html", "digest", "bytes"])


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _record(page_id, url, payload: bytes, digest: str, refers_to, refers_url) -> bytes:
    """One gzip member: a response with its payload, or a revisit that has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to)}",
            f"WARC-Refers-To-Target-URI: {re.sub(r'[\r\n]+', ' ', refers_url or '')}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n") + pack.flush()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        task, out, name, at, count = TaskContext.get(), None, "", 0, 0
        for batch in batches:
            rows = []
            html = batch.column(2).cast(pa.binary())
            for i, (page_id, url, digest, refers_to, refers_url) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5)))):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    # a lost or repeated attempt leaves another file, which no committed index row names
                    name, at, count = f"part-{task.partitionId():05d}-{count:03d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz", 0, count + 1
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = _record(page_id, url, html[i].as_py() or b"", digest, refers_to, refers_url)
                out.write(member)
                rows.append((page_id, url, name, at, len(member), digest, "response" if refers_to is None else "revisit", refers_to))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), *[pa.string()] * 2, *[pa.int64()] * 2, *[pa.string()] * 2, pa.int64()))], [x.split()[0] for x in INDEX.split(", ")])
        if out is not None:
            out.close()

    return run


def write_archives(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> tuple[str, DataFrame]:
    """Writes a record for each row and returns (folder, index table).

    The index has each record's file, offset, length, URL and payload digest. Of records with equal
    payloads of at least min_bytes bytes, that with the largest id is the response and the others
    revisit it; smaller payloads are all responses. A null html is an empty payload. Rows of null id
    and further rows of the id that is the response are responses too: no revisit can name itself.
    Repeated rows of other ids each get their record; very long payloads are one record each; an empty table gives an
    empty index. Columns of df beside the three, whatever their names, don't matter.
    Digests are shuffled, a very common one dealt over several tasks, and the list of revisits that they give is written and counted: up to
    MOST_REVISITS rows are broadcast, so that the payloads stay where they are; a longer list is joined by id, with a shuffle of the payloads."""
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    made = pages.mapInArrow(_digests, "page_id long, url string, html string, digest string, bytes long")
    short = write_table(made.select("page_id", "url", "digest", "bytes"), "digests")
    first = short.where(f"page_id is not null and bytes >= {min_bytes}").groupBy("digest").agg(F.max_by("url", "page_id").alias("refers_url"), F.max("page_id").alias("refers_to"), F.count("*").alias("size")).where("size > 1")
    revisits = join_hot(short.select("page_id", "digest"), first, "digest", "page_id").where("page_id < refers_to").select("page_id", "digest", "refers_to", "refers_url").dropDuplicates(["page_id", "digest"])
    revisits = broadcast_if_small(write_table(revisits, "revisits"), MOST_REVISITS)
    rows = made.select("page_id", "url", "html", "digest").join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to", "refers_url")
    folder = f"{shared_dir(df.sparkSession)}/warc-{uuid.uuid4().hex}"
    return folder, write_table(rows.mapInArrow(_write(folder), INDEX), "warc-index")


def parse_record(member: bytes) -> dict:
    """The fields of one gzip member; payload is None for a revisit."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1", lines[0]
    field = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    revisit = field["WARC-Type"] == "revisit"
    return {
        "page_id": int(field["X-Page-ID"]) if field["X-Page-ID"] else None,
        "url": field["WARC-Target-URI"],
        "record_type": field["WARC-Type"],
        "digest": field["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": int(field["X-Refers-To-Page-ID"]) if revisit else None,
        "payload_bytes": length,
        "payload": None if revisit else payload,
    }


def _read(folder: str):
    def ranges(found: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
        """Neighbouring records of a file in one range: (file, start, end, records)."""
        run: list[tuple[int, int]] = []
        name = ""
        for file, at, n in found:
            if run and (file != name or at - sum(run[-1]) > GAP or at + n - run[0][0] > READ):
                yield name, run[0][0], sum(run[-1]), run
                run = []
            name = file
            run.append((at, n))
        if run:
            yield name, run[0][0], sum(run[-1]), run

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        columns = "page_id url record_type digest refers_to payload_bytes payload".split()
        types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            open_, file = "", None
            for name, start, end, records in ranges(sorted(zip(*(batch.column(k).to_pylist() for k in range(3))))):
                if name != open_:
                    open_, file = name, fs.open_input_file(f"{root}/{name}")
                data = file.read_at(end - start, start)
                rows = [parse_record(data[at - start : at - start + n]) for at, n in records]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(columns, types)], columns)

    return run


def read_archives(folder: str, index: DataFrame) -> DataFrame:
    """(page_id, url, record_type, digest, refers_to, payload_bytes, payload) of the records in index,
    which may be any selection of its rows. They are dealt by file and run of offsets to tasks of about
    TASK_BYTES of records each (index rows are small, so their own size says nothing), sorted, and read in
    ranges that join records lying close together. Revisits have a null payload."""
    total = index.agg(F.sum("length")).first()[0] or 0
    chosen = index.select("file", "offset", "length").repartition(max(1, -(-total // TASK_BYTES)), "file", F.expr(f"offset div {RUN_BYTES}")).sortWithinPartitions("file", "offset")
    return chosen.mapInArrow(_read(folder), "page_id long, url string, record_type string, digest string, refers_to long, payload_bytes long, payload binary")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payload = batch.column("payload")
        digest = [payload_digest(p.as_buffer()) if p.is_valid else d.as_py() for p, d in zip(payload, batch.column("digest"))]
        size = [len(p.as_buffer()) if p.is_valid else n.as_py() for p, n in zip(payload, batch.column("payload_bytes"))]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(size, pa.int64()), pa.array(digest, pa.string()), batch.column("record_type"), batch.column("refers_to")], names)


def round_trip(df: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from the archives
    written of df; a response's length and digest are taken from the payload that was read."""
    folder, index = write_archives(df, min_bytes=min_bytes)
    read = read_archives(folder, index)
    return read.mapInArrow(_measured, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
