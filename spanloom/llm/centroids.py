"""Exact k-means on whole-number vectors with Drake's adaptive distance bounds."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.shared import drop_table, shared_dir, write_table

#: Blocks (a block is an Arrow batch of vectors) to a bucket of the written tables.
BUCKET_BLOCKS = 16
#: Numbers up to this size have exact products and sums in doubles; blocks with larger ones count in Python's whole numbers.
EXACT = 1 << 20
_LONGEST = (1 << 63) - 1

_VECTORS = "segment long, ids array<bigint>, vectors binary, width int"
_STATE = "segment long, nearest binary, upper binary, lower binary, rest binary, scanned long, sums array<decimal(38,0)>"
_FOUND = "id long, cluster int, distance long"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block of each batch: its ids, and its vectors in the narrowest type that holds them."""
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        v = batch.column(1).flatten().to_numpy()
        width = next(w for w in (2, 4, 8) if w == 8 or -(1 << 8 * w - 1) <= v.min() and v.max() < 1 << 8 * w - 1)
        row = ((task << 32) + number, batch.column(0), v.astype(f"i{width}").tobytes(), width)
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int32()))], ["segment", "ids", "vectors", "width"])
        number += 1


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of v and c."""
    return ((v - c) ** 2).sum(axis=-1)


def _roots(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


@dataclass
class Bounds:
    """What is known of a block's vectors: the nearest centroid and then the next ones (nearest, a column for each), an upper
    bound of the distance to the first, a lower bound for each of the next, and one (rest) for all other centroids."""

    nearest: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    rest: np.ndarray

    def moved(self, drift: np.ndarray) -> None:
        """After centroids went by these distances."""
        self.upper = self.upper + drift[self.nearest[:, 0]]
        self.lower = self.lower - drift[self.nearest[:, 1:]]
        self.rest = self.rest - drift.max()

    def needed(self, rows: np.ndarray, slack: float) -> np.ndarray:
        """How many of the bounds, from the first on, can't tell that their centroids are farther than the nearest:
        0 keeps the vector's centroid, and one more than there are lower bounds means that the rest fails too."""
        all_ = np.column_stack((self.lower[rows], self.rest[rows]))
        behind = np.minimum.accumulate(all_[:, ::-1], axis=1)[:, ::-1]
        return (behind <= (self.upper[rows] + slack)[:, None]).sum(axis=1)

    def narrowed(self, b: int) -> None:
        """Only b lower bounds are kept: the rest takes in the others."""
        if b < self.lower.shape[1]:
            self.rest = np.minimum(self.rest, self.lower[:, b:].min(axis=1))
            self.lower, self.nearest = self.lower[:, :b], self.nearest[:, : b + 1]


def _ranked(numbers: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and distances of each row by distance, ties by number."""
    first = np.argsort(numbers, axis=1, kind="stable")
    numbers, d = np.take_along_axis(numbers, first, 1), np.take_along_axis(d, first, 1)
    order = np.argsort(d, axis=1, kind="stable")
    return np.take_along_axis(numbers, order, 1), np.take_along_axis(d, order, 1)


def rescan(v: np.ndarray, c: np.ndarray, b: int) -> Bounds:
    """Exact distances to all centroids."""
    d = np.stack([squared(v, x) for x in c], axis=1)
    numbers, d = _ranked(np.broadcast_to(np.arange(len(c)), d.shape), d)
    root = _roots(d[:, : b + 2])
    rest = root[:, b + 1] if len(c) > b + 1 else np.full(len(v), np.inf)
    return Bounds(numbers[:, : b + 1], root[:, 0], root[:, 1 : b + 1], rest)


def advance(v: np.ndarray, c: np.ndarray, drift: np.ndarray, known: Bounds, slack: float) -> int:
    """Brings bounds up to date with the centroids c, which moved by `drift`; how many distances this took.

    A vector whose bounds fail first gets its exact distance to its own centroid. If they still fail, the centroids up to
    the last failing bound are measured and put in order anew; if the rest fails, all are. Fewer bounds are
    kept from then on if no vector of the block needed more."""
    known.moved(drift)
    rows = np.flatnonzero(known.needed(np.arange(len(v)), slack))
    known.upper[rows] = _roots(squared(v[rows], c[known.nearest[rows, 0]]))
    need, scanned = known.needed(rows, slack), len(rows)
    b, most = known.lower.shape[1], 0
    for m in range(1, b + 1):
        own = rows[need == m]
        if not len(own):
            continue
        numbers = known.nearest[own, : m + 1]
        d = np.stack([squared(v[own], c[numbers[:, j]]) for j in range(m + 1)], axis=1)
        numbers, d = _ranked(numbers, d)
        known.nearest[own, : m + 1] = numbers
        root = _roots(d)
        known.upper[own], known.lower[own, :m] = root[:, 0], root[:, 1:]
        scanned += len(own) * m
        most = m
    own = rows[need > b]
    if len(own):
        new = rescan(v[own], c, b)
        known.nearest[own], known.upper[own], known.lower[own], known.rest[own] = new.nearest, new.upper, new.lower, new.rest
        scanned += len(own) * len(c)
        most = b
    known.narrowed(max(most, least_bounds(len(c))))
    return scanned


def first_bounds(k: int) -> int:
    return min(k - 1, max(2, -(-k // 4)))


def least_bounds(k: int) -> int:
    return min(k - 1, max(1, k // 8))


def _vectors(row: dict, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """A block's vectors and the centroids in a type that counts exactly, and what rounding could do to bounds."""
    v = np.frombuffer(row["vectors"], f"i{row['width']}").reshape(-1, c.shape[1])
    most = max(int(v.max()), -int(v.min()), *(abs(int(x)) for x in (c.max(), c.min())))
    kind = np.int64 if most <= EXACT else object
    return v.astype(kind), c.astype(kind), 1e-12 * (1 + 2 * math.sqrt(c.shape[1]) * most)


def _known(row: dict, n: int) -> Bounds:
    shape = lambda x, kind: np.frombuffer(row[x], kind).reshape(n, -1).copy()
    return Bounds(shape("nearest", np.int32), shape("upper", np.float64)[:, 0], shape("lower", np.float64), shape("rest", np.float64)[:, 0])


def _assigned(row: dict, c: np.ndarray, drift: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, Bounds, int]:
    v, c, slack = _vectors(row, c)
    if drift is None:
        known = rescan(v, c, first_bounds(len(c)))
        return v, c, known, len(v) * len(c)
    known = _known(row, len(v))
    return v, c, known, advance(v, c, drift, known, slack)


def _round(shared):
    """Joined blocks and states to the next states, with each block's sums by cluster and component, then counts by cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, drift = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                v, _, known, scanned = _assigned(row, c, drift)
                own = known.nearest[:, 0]
                sums = [x for j in range(len(c)) for x in v[own == j].sum(axis=0).tolist()]
                sums += np.bincount(own, minlength=len(c)).tolist()
                out = (row["segment"], known.nearest.astype(np.int32).tobytes(), known.upper.tobytes(), known.lower.tobytes(), known.rest.tobytes(), scanned, [int(x) for x in sums])
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(out, kinds)], [x.split()[0] for x in _STATE.split(", ")])

    return run


def _last(shared):
    """Joined blocks and states to each vector's cluster and exact distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, drift = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                v, exact, known, _ = _assigned(row, c, drift)
                own = known.nearest[:, 0]
                d = [min(_LONGEST, int(x)) for x in squared(v, exact[own]).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(own, pa.int32()), pa.array(d, pa.int64())], ["id", "cluster", "distance"])

    return run


class _Buckets:
    """Tables in the shared folder whose files lie by a hash of the segment, so that a join on it moves no row."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.paths = spark, buckets, {}

    def write(self, df: DataFrame) -> DataFrame:
        name = f"spanloom_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, "segment").sortBy("segment").option("path", f"{shared_dir(self.spark)}/{name}").saveAsTable(name)
        table = self.spark.table(name)
        self.paths[id(table)] = (table, name)
        return table

    def drop(self, table: DataFrame) -> None:
        _, name = self.paths.pop(id(table))
        drop_table(table)
        self.spark.sql(f"drop table {name}")

    def drop_all(self) -> None:
        for table, _ in list(self.paths.values()):
            self.drop(table)


def seeds(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the k smallest sha256 of `seed:id`, in that order; ties by vector, null ids last."""
    lot = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return np.array([r.v for r in rows.orderBy(lot.asc_nulls_last(), "v").limit(k).collect()], np.int64)


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, seed: int = 3, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", report: list | None = None) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of `size` components.

    Components are floor(scale * x). The first centroids are vectors chosen by hash. Each round assigns every vector to the nearest centroid
    (squared distance; ties to the smaller number) and replaces a centroid by the exact floor of its vectors' mean; one without vectors stays. A last
    assignment follows. Distances and sums are whole numbers, so results don't depend on how rows are dealt.

    Vectors are packed into blocks and written once, in buckets by block; the bounds of each round are a table with the same
    buckets, so a round is a join without a shuffle, a scan, and a sum of k * size numbers, which are all that the driver gets. Only
    vectors whose bounds fail are measured. report gets each round's number of distances.

    Vectors that are null, of another size, or hold a null or non-finite component are left out; other columns don't matter. Null and repeated ids each
    count as a vector (null ones are the last to be seeds). With fewer than k vectors there are as many centroids. Values, distances and inertias beyond
    64 bits saturate. An empty table gives an empty one."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    fine = rows.where(f"size(x) = {size} and forall(x, e -> e is not null and not isnan(e) and abs(e) < double('infinity'))")
    vectors = fine.select("id", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))
    c = seeds(vectors, k, seed)
    if not len(c):
        empty = f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    packed = write_table(vectors.mapInArrow(_pack, _VECTORS), "blocks")
    store = _Buckets(spark, min(10_000, max(1, -(-packed.count() // BUCKET_BLOCKS))))
    blocks = store.write(packed.repartition(store.buckets, "segment"))
    drop_table(packed)
    state, drift = None, None
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((c, drift))
        new = store.write(_joined(blocks, state).mapInArrow(_round(shared), _STATE))
        shared.destroy()
        if state is not None:
            store.drop(state)
        state = new
        moved = means(state, c)
        drift = _roots(squared(moved.astype(object), c.astype(object)))
        c = moved
        if report is not None:
            report.append(state.agg(F.sum("scanned")).first()[0])
    shared = spark.sparkContext.broadcast((c, drift))
    found = write_table(_joined(blocks, state).mapInArrow(_last(shared), _FOUND), "clusters")
    shared.destroy()
    store.drop_all()
    total = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)"))).collect()}
    whole = min(_LONGEST, sum(total.values()))
    digest = lambda x: hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest()
    about = [(j, min(_LONGEST, total.get(j, 0)), whole, digest(c[j])) for j in range(len(c))]
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _joined(blocks: DataFrame, state: DataFrame | None) -> DataFrame:
    if state is None:
        return blocks
    return blocks.join(state.select("segment", "nearest", "upper", "lower", "rest").hint("shuffle_hash"), "segment")


def means(state: DataFrame, c: np.ndarray) -> np.ndarray:
    """The exact floors of the means by cluster, from the sums and counts of all blocks."""
    found = state.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("total")).collect()
    total = {r.pos: int(r.total) for r in found}
    k, d = c.shape
    return np.array([[total[j * d + i] // total[k * d + j] for i in range(d)] if total[k * d + j] else c[j] for j in range(k)], np.int64)
