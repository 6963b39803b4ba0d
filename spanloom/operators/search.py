"""Overlaps with a small table that every task holds, searched as nested containment lists."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.joins import best_per, overlap_join, prefixed
from spanloom.operators.sweep import _split

#: Rows of the small table that are sent to every task at most; with more the tables are joined by bins.
MOST_ROWS = 100_000


class NestedLists:
    """The intervals of one sequence in layers, in each of which starts and stops both rise: none lies inside another, so those that overlap a
    query stand in a row, and two binary searches find them. There are as many layers as intervals nest."""

    def __init__(self, start: np.ndarray, stop: np.ndarray, rows: np.ndarray):
        order = np.lexsort((-stop, start))
        ends: list[int] = []  # the last stop of each layer, negated: from the first layer on they fall
        layer = np.empty(len(order), np.int64)
        for k, i in enumerate(order.tolist()):
            at = bisect.bisect_left(ends, -int(stop[i]))
            if at == len(ends):
                ends.append(0)
            ends[at] = -int(stop[i])
            layer[k] = at
        self.layers = [(start[own], stop[own], rows[own]) for own in (order[layer == d] for d in range(len(ends)))]

    def find(self, start: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) of all overlaps, in batches."""
        for starts, stops, rows in self.layers:
            for i, j in _split(np.searchsorted(stops, start, "left"), np.searchsorted(starts, stop, "right")):
                yield i, rows[j]


def lists_of(table: pa.Table) -> dict[str, NestedLists]:
    """Lists by sequence of a table with sequence, start and stop."""
    names = table["sequence"].combine_chunks().dictionary_encode()
    codes = names.indices.to_numpy()
    start, stop = (table[c].combine_chunks().to_numpy() for c in ("start", "stop"))
    return {n: NestedLists(start[own], stop[own], own) for n, own in ((n, np.flatnonzero(codes == k)) for k, n in enumerate(names.dictionary.to_pylist()))}


def _searched(shared, first: bool):
    """Batches of (sequence, start, stop, row) to (row, the small table's row); with first only the first match by the small table's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, rows = shared.value
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            codes = names.indices.to_numpy(zero_copy_only=False)
            start, stop = (batch.column(c).to_numpy() for c in (1, 2))
            for k, n in enumerate(names.dictionary.to_pylist()):
                if n not in lists:
                    continue
                own = np.flatnonzero(codes == k)
                best = np.full(len(own), rows.num_rows, np.int64)
                for i, j in lists[n].find(start[own], stop[own]):
                    if first:
                        np.minimum.at(best, i, j)
                    else:
                        yield pa.RecordBatch.from_arrays([batch.column(3).take(pa.array(own[i])), _struct(rows, j)], ["a", "b"])
                found = np.flatnonzero(best < rows.num_rows)
                if first and len(found):
                    yield pa.RecordBatch.from_arrays([batch.column(3).take(pa.array(own[found])), _struct(rows, best[found])], ["a", "b"])

    return run


def _struct(rows: pa.Table, j: np.ndarray) -> pa.Array:
    part = rows.take(pa.array(j)).combine_chunks()
    return pa.StructArray.from_arrays([c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in part.columns], fields=list(part.schema))


def search_join(large: DataFrame, small: DataFrame, order: list[str] | None = None, most_rows: int = MOST_ROWS) -> DataFrame:
    """Every pair of rows of the same sequence whose closed intervals share a base; small's columns get `b_`. The same pairs as
    overlap_join(large, small), but large stays where it is. With order, each row of large is paired only with the first of its matches by these columns of
    small (and then by all others).

    small is counted when this is called. Up to most_rows it is collected, put in lists, and broadcast; else both tables are joined by
    bins. Rows of null or reversed bounds, and of a null sequence, pair with nothing. A search takes two binary searches for each layer, of which there
    are as many as intervals of small lie within each other."""
    fine = small.where("sequence is not null and start <= stop")
    if fine.limit(most_rows + 1).count() > most_rows:
        if not order:
            return overlap_join(large, small)
        # rows of large that are alike have the same first match, so one of them stands for all
        alike = large.where("sequence is not null and start <= stop").groupBy(*large.columns).agg(F.count("*").alias("__n"))
        rest = [f"b_{c}" for c in small.columns if c not in order]
        first = best_per(overlap_join(alike, small), [*large.columns, "__n"], [*[f"b_{c}" for c in order], *rest])
        return first.withColumn("__k", F.explode(F.expr("sequence(1L, __n)"))).drop("__k", "__n")
    if order:
        fine = fine.orderBy(*order, *[c for c in small.columns if c not in order])
    table = fine.withColumn("start", F.col("start").cast("long")).withColumn("stop", F.col("stop").cast("long")).toArrow()
    shared = large.sparkSession.sparkContext.broadcast((lists_of(table) if table.num_rows else {}, table))
    rows = large.where("sequence is not null and start <= stop").select("sequence", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.struct(*[F.col(f"`{c}`") for c in large.columns]).alias("a"))
    kind = prefixed(fine.withColumn("start", F.col("start").cast("long")).withColumn("stop", F.col("stop").cast("long")), "").schema
    found = rows.mapInArrow(_searched(shared, bool(order)), f"a {rows.schema['a'].dataType.simpleString()}, b {kind.simpleString()}")
    return found.select("a.*", *[F.col(f"b.`{c}`").cast(small.schema[c].dataType).alias("b_" + c) for c in small.columns])
