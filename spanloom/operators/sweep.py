"""Overlaps by a sweep along sorted starts, with a pool of the intervals that are still open."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators import ordering
from spanloom.operators.joins import prefixed
from spanloom.storage import write_table

#: Ranges of starts at most; beyond that ranges get longer.
MOST_RANGES = 10_000
#: Pairs of an output batch (about).
PAIRS = 1 << 16


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): for each i, every j with first[i] <= j < last[i]."""
    n = np.maximum(last - first, 0)
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def _meet(a: np.ndarray, a_stop: np.ndarray, b: np.ndarray, b_stop: np.ndarray, a_old: int, b_old: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of overlapping intervals of which the one that starts later is new. Starts are sorted within old and
    new ones, and no old one starts behind a new one."""
    # new b that start within a, then new a that start within b, and behind it if both are new: no pair comes twice
    for i, j in _split(np.maximum(np.searchsorted(b[b_old:], a, "left"), 0), np.searchsorted(b[b_old:], a_stop, "right")):
        yield i, j + b_old
    side = np.where(np.arange(len(b)) < b_old, np.searchsorted(a[a_old:], b, "left"), np.searchsorted(a[a_old:], b, "right"))
    for j, i in _split(side, np.searchsorted(a[a_old:], b_stop, "right")):
        yield i + a_old, j


def _split(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """_runs() in batches of about PAIRS, or of one interval's pairs."""
    ends = np.cumsum(np.maximum(last - first, 0))
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        i, j = _runs(first[at:to], last[at:to])
        if len(i):
            yield i + at, j
        at = to


class Pool:
    """Rows of one side that may still meet others: of one sequence, with their bounds."""

    def __init__(self):
        self.rows, self.start, self.stop = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, rows: pa.Array, start: np.ndarray, stop: np.ndarray) -> int:
        """How many were there before."""
        old = len(self.start)
        self.rows = rows if self.rows is None else pa.concat_arrays([self.rows, rows])
        self.start, self.stop = np.concatenate((self.start, start)), np.concatenate((self.stop, stop))
        return old

    def drop_before(self, place: int) -> None:
        keep = self.stop >= place
        if not keep.all():
            self.rows = self.rows.filter(pa.array(keep))
            self.start, self.stop = self.start[keep], self.stop[keep]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (range, sequence, start, stop, carried, a, b), of which one of a and b is null, to the pairs (a, b)."""
    now, pools = None, (Pool(), Pool())
    for batch in batches:
        key = pc.binary_join_element_wise(batch.column(0).cast(pa.string()), batch.column(1), ":")
        cuts = [0, *(np.flatnonzero(pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), len(key)] if len(key) else []
        for lo, hi in zip(cuts, cuts[1:]):
            part, own = batch.slice(lo, hi - lo), key[lo].as_py()
            if own != now:
                now, pools = own, (Pool(), Pool())
            start, stop = (part.column(c).to_numpy() for c in (2, 3))
            carried = part.column(4).to_numpy(zero_copy_only=False)
            sides = [part.column(c).is_valid().to_numpy(zero_copy_only=False) for c in (5, 6)]
            # those carried over from ranges before come first: they only wait in the pool
            for fresh in (False, True):
                old = []
                for k, pool in enumerate(pools):
                    own_rows = sides[k] & (carried != fresh)
                    if fresh and len(start):
                        pool.drop_before(int(start[~carried].min()) if (~carried).any() else int(start[-1]))
                    old.append(pool.add(part.column(5 + k).filter(pa.array(own_rows)), start[own_rows], stop[own_rows]))
                if fresh:
                    a, b = pools
                    for i, j in _meet(a.start, a.stop, b.start, b.stop, *old):
                        yield pa.RecordBatch.from_arrays([a.rows.take(pa.array(i)), b.rows.take(pa.array(j))], ["a", "b"])


def sweep_join(a: DataFrame, b: DataFrame, rows: int | None = None) -> DataFrame:
    """Every pair of rows of the same sequence whose closed intervals share a base; b's columns get `b_`. The same pairs as overlap_join().

    Both sides are dealt together by ranges of (sequence, start), so no row is repeated for the bins that it covers; a row that reaches
    over the end of its range is carried over to the ranges that it reaches. Each range is swept in the order of starts, with
    a pool of the rows of both sides that are still open, and a pair is made where the later of both starts. The ranges are
    cut and written when this is called; a task holds a batch and the rows that cover one place, and rows that start at one base lie in one range,
    so where much of a table covers one place, overlap_join() with salts is the better one. Rows of null or
    reversed bounds, and of a null sequence, pair with nothing."""
    fine = "sequence is not null and start <= stop"
    x, y = a.where(fine), b.where(fine)
    left = x.select("sequence", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.struct(*[F.col(f"`{c}`") for c in a.columns]).alias("a"))
    right = y.select("sequence", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.struct(*[F.col(f"`{c}`") for c in b.columns]).alias("b"))
    both = write_table(left.unionByName(right, allowMissingColumns=True), "sides")
    n = both.count()
    parts = max(1, min(MOST_RANGES, -(-n // (rows or ordering.RANGE_ROWS))))
    dealt = both.repartitionByRange(parts, "sequence", "start") if parts > 1 else both.coalesce(1)
    dealt = write_table(dealt.withColumn("range", F.spark_partition_id()), "ranges")
    # where each range begins: at most MOST_RANGES rows
    borders = dealt.groupBy("range").agg(F.min(F.struct("sequence", "start")).alias("x")).select(F.col("range").alias("to"), F.col("x.sequence").alias("sequence"), F.col("x.start").alias("border"))
    reach = dealt.join(F.broadcast(borders), "sequence").where("to > range and stop >= border")
    over = reach.select("sequence", "start", "stop", "a", "b", F.col("to").alias("range"), F.lit(True).alias("carried"))
    rows_ = dealt.withColumn("carried", F.lit(False)).unionByName(over).select("range", "sequence", "start", "stop", "carried", "a", "b")
    swept = rows_.repartition(parts, "range").sortWithinPartitions("range", "sequence", F.desc("carried"), "start")
    types = ", ".join(f"{c} {rows_.schema[c].dataType.simpleString()}" for c in ("a", "b"))
    found = swept.mapInArrow(_sweep, types)
    return found.select("a.*", *[F.col(f"b.`{c}`").alias("b_" + c) for c in b.columns])
