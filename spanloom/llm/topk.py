"""Exact top-k inner products with a bit-sliced index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.shared import write_table

#: Rows of an index segment, and bytes of queries that one pass sends to the tasks.
SEGMENT_ROWS, PASS_BYTES = 16384, 32 << 20


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v array<long>): floor(scale * x) of each component; rows with a null id, a null vector, or
    a null or non-finite component are left out. Beyond 64 bits the numbers saturate."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    fine = rows.where("id is not null and x is not null and forall(x, e -> e is not null and not isnan(e) and abs(e) < double('infinity'))")
    return fine.select("id", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, slices): the least value of each column, and for each column its values less that as bit
    slices (columns, bits, words), the least significant bit first; a slice has one bit for each row."""
    low = values.min(axis=0)
    above = (values - low).astype(np.uint64)
    bits = max(1, int(above.max()).bit_length())
    n = -(-len(values) // 64) * 64
    out = np.empty((values.shape[1], bits, n // 64), np.uint64)
    for j in range(bits):
        bit = np.zeros((values.shape[1], n), np.uint8)
        bit[:, : len(values)] = ((above >> np.uint64(j)) & np.uint64(1)).T
        out[:, j] = np.packbits(bit, axis=1, bitorder="little").view(np.uint64)
    return low, out


def _build(table: pa.Table) -> pa.Table:
    rows = [x.values.to_numpy() for x in table["v"]]
    values = np.zeros((len(rows), max(map(len, rows))), np.int64)
    for i, r in enumerate(rows):
        values[i, : len(r)] = r
    low, bit = slices_of(values)
    out = [[table["segment"][0].as_py()], [table["id"].to_numpy().tobytes()], [low.tobytes()], [bit.tobytes()], [bit.shape[1]]]
    types = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32())
    return pa.table({c: pa.array(x, t) for c, x, t in zip(("segment", "ids", "low", "slices", "bits"), out, types)})


def build_index(vectors: DataFrame, segments: int) -> DataFrame:
    """A written table of segments of about 16384 rows, dealt by hash: ids, least values, bit slices."""
    dealt = vectors.withColumn("segment", F.pmod(F.xxhash64("id", "v"), F.lit(segments)).cast("long"))
    return write_table(dealt.groupBy("segment").applyInArrow(_build, "segment long, ids binary, low binary, slices binary, bits int"), "bsi")


def add_up(at: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """The sum of bitmaps by weight as slices, the least significant first. Three bitmaps of a weight
    become one of it and one of the next (a full adder on whole bitmaps), until one of each is left."""
    out, w = [], 0
    while w <= max(at, default=-1):
        own = at.get(w) or []
        stack = np.concatenate([x if x.ndim == 2 else x[None] for x in own]) if own else None
        carried = []
        while stack is not None and len(stack) > 1:
            if len(stack) == 2:
                carried.append((stack[0] & stack[1])[None])
                stack = (stack[0] ^ stack[1])[None]
                break
            k = len(stack) // 3
            a, b, c = stack[:k], stack[k : 2 * k], stack[2 * k : 3 * k]
            x = a ^ b
            carried.append((a & b) | (x & c))
            stack = np.concatenate((x ^ c, stack[3 * k :]))
        if carried:
            at.setdefault(w + 1, []).extend(carried)
        out.append(None if stack is None else stack[0])
        w += 1
    return out


def scores(query: np.ndarray, low: np.ndarray, bit: np.ndarray) -> tuple[list[np.ndarray], int]:
    """(slices, base): the inner product of each row with query is the slices' number plus base.

    A positive weight adds shifted slices for its set bits. A negative one adds the complements:
    -w * v = w * (top - v) - w * top with top = 2^bits - 1."""
    top = (1 << bit.shape[1]) - 1
    at: dict[int, list[np.ndarray]] = {}
    base = 0
    for d in range(len(low)):
        w = int(query[d]) if d < len(query) else 0
        base += w * int(low[d]) + (w * top if w < 0 else 0)
        own = bit[d] if w > 0 else ~bit[d]
        for s in range(abs(w).bit_length()):
            if abs(w) >> s & 1:
                for j in range(bit.shape[1]):
                    at.setdefault(j + s, []).append(own[j])
    return add_up(at), base


def top_rows(total: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """A bitmap of the rows with the k highest numbers and of all rows that tie with the last of them:
    from the most significant slice down, rows above are kept and the boundary group is cut."""
    above, group = np.zeros_like(allowed), allowed.copy()
    for s in reversed(total):
        if s is None:
            continue
        more = above | (group & s)
        n = int(np.bitwise_count(more).sum())
        if n > k:
            group &= s
        else:
            above = more
            group &= ~s
            if n == k:
                return above
    return above | group


def _values(total: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The numbers of the given rows; Python's whole numbers if they have over 62 bits."""
    out = np.zeros(len(rows), np.int64 if len(total) < 63 else object)
    for w, s in enumerate(total):
        if s is not None:
            out += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(out.dtype) << w
    return out


def _best(ids: np.ndarray, low: np.ndarray, bit: np.ndarray, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(-score, id) of a segment's k best rows of another id; the boundary's ties go to smaller ids."""
    total, base = scores(query, low, bit)
    allowed = np.zeros(bit.shape[2] * 64, np.uint8)
    allowed[: len(ids)] = ids != query_id
    allowed = np.packbits(allowed, bitorder="little").view(np.uint64)
    rows = np.flatnonzero(np.unpackbits(top_rows(total, allowed, k).view(np.uint8), bitorder="little"))
    value = _values(total, rows)
    value = value + base if abs(base) < 1 << 62 else value.astype(object) + base
    return heapq.nsmallest(k, zip((-value).tolist(), ids[rows].tolist()))


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, best = shared.value, {}
        for batch in batches:
            for row in batch.to_pylist():
                ids, low = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["low"], np.int64)
                bit = np.frombuffer(row["slices"], np.uint64).reshape(len(low), row["bits"], -1)
                for q, v in asked:
                    best[q] = heapq.nsmallest(k, best.get(q, []) + _best(ids, low, bit, q, v, k))
        # a task answers once for all its segments; what leaves 64 bits saturates
        found = [(q, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for q, own in best.items() for s, i in own]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 3)], ["query_id", "vec_id", "score"])

    return run


def _passes(asked: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The queries in passes of about PASS_BYTES."""
    size = asked.agg(F.sum(F.size("v") * 8 + 64)).first()[0] or 0
    n = max(1, -(-size // PASS_BYTES))
    for i in range(n):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(n)) == i).collect()
        if block:
            yield sorted((r.id, np.array(r.v, np.int64)) for r in block)


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products with the rows of
    df of another id, ties to smaller ids; all of them if fewer.

    Components are floor(scale * x). Queries are sent to the tasks in passes of bounded size. A task reads segments of
    the written index where they lie, adds up the slices for each query, selects rows from the most significant slice
    down, resolves the boundary exactly, and answers with the best rows of all its segments; the tasks' answers then
    meet per query. A pass is written before the next one is sent.

    Vectors that are null or hold a null or non-finite component take no part, and rows of null id neither; a shorter
    vector, also an empty one, counts as padded with zeros. Rows that repeat an id each count. A query id that occurs in
    several rows gets the rows of its first vector. Scores are exact; those beyond 64 bits saturate, and of
    more than k of these a task keeps the exactly highest. An empty table gives an empty one; other columns, whatever their names, don't matter."""
    vectors = quantised(df, id_col, vector_col, scale)
    segments = max(1, -(-vectors.count() // SEGMENT_ROWS))
    index = build_index(vectors, segments)
    asked = write_table(quantised(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v")), "queries")
    found = None
    for block in _passes(asked):
        shared = df.sparkSession.sparkContext.broadcast(block)
        part = write_table(index.mapInArrow(_search(shared, k), "query_id long, vec_id long, score long"), "found")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
