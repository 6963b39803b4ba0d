"""Sums, neighbours and reaches along an order without one task that holds a table or a group.

A table is dealt once by ranges of its order. Within a range, windows do the work; what a row needs from
the ranges before or after it is carried over by a table of a range's first and last group. What is asked for
together is carried by one such table, and the ranges lie in buckets, so that windows and sums move no row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from spanloom.storage import broadcast_if_small, drop_table, write_buckets, write_table

#: Rows of a range (about); a table of fewer stays one range.
RANGE_ROWS = 200_000
#: Buckets that the ranges lie in at most, and rows of a carried table that are broadcast at most.
MOST_BUCKETS, MOST_CARRIED = 10_000, 1_000_000
PART = "__part"


def ranged(df: DataFrame, order: list[str], rows: int | None = None, where: str | None = None) -> tuple[DataFrame, int]:
    """(df, or those of its rows that a condition holds for, with the number of its range in __part, number of ranges).

    df is written, so that it is made once, and counted as it is written; the ranges are cut once, on a table that is written: a plan that
    deals the same rows twice may cut them at other places each time."""
    counted = Observation()
    written = write_table(df.observe(counted, (F.count_if(F.expr(where)) if where else F.count("*")).alias("n")), "rows")
    whole = written.where(where) if where else written
    parts = -(-counted.get["n"] // (rows or RANGE_ROWS))
    if parts <= 1:
        return whole.withColumn(PART, F.lit(0)), 1
    cut = whole.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id())
    out = write_buckets(cut, "ranges", PART, min(MOST_BUCKETS, parts))
    drop_table(written)
    return out, parts


@dataclass
class _Step:
    """A column to be added: its value within the range, what a range contributes, how that is carried to other
    ranges, and both together (the carried value is None where there is one range)."""

    name: str
    local: Column
    own: Column
    carried: Callable[[Column], Column]
    both: Callable[[Column, Column | None], Column]


class Along:
    """Windows over the rows of each group in a total order, by ranges.

    Rows are dealt by ranges of (keys, order), so a group's rows lie in neighbouring ranges; each method adds a column. Columns are
    added when `rows` is read: those asked for since it was last read share one scan of the ranges, which makes the table that is
    carried over. A column that is made of added ones can so be summed in its turn, by one more scan."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], rows: int | None = None, where: str | None = None):
        self.keys, self.order = keys, order
        self._rows, self.parts = ranged(df, [*keys, *order], rows, where)
        self._steps: list[_Step] = []
        self.here = Window.partitionBy(PART, *keys).orderBy(*order)
        self.ranges = Window.partitionBy(*keys).orderBy(PART)

    @property
    def rows(self) -> DataFrame:
        steps, self._steps = self._steps, []
        if not steps:
            return self._rows
        if self.parts == 1:
            self._rows = self._rows.withColumns({s.name: s.both(s.local, None) for s in steps})
            return self._rows
        groups = [f"__g{i}" for i in range(len(self.keys))]
        table = self._outer(self._rows.groupBy(PART, *self.keys).agg(*[s.own.alias(f"__own{i}") for i, s in enumerate(steps)]))
        table = table.select(PART, *self.keys, *[s.carried(F.col(f"__own{i}")).alias(f"__carried{i}") for i, s in enumerate(steps)])
        table = write_table(table.toDF("__p", *groups, *[f"__carried{i}" for i in range(len(steps))]), "carried")
        local = self._rows.withColumns({f"__local{i}": s.local for i, s in enumerate(steps)})
        on = F.col(PART) == F.col("__p")
        for g, k in zip(groups, self.keys):
            on = on & F.col(f"`{k}`").eqNullSafe(F.col(g))
        joined = local.join(broadcast_if_small(table, MOST_CARRIED), on, "left")
        added = joined.withColumns({s.name: s.both(F.col(f"__local{i}"), F.col(f"__carried{i}")) for i, s in enumerate(steps)})
        self._rows = added.drop("__p", *groups, *[f"__{c}{i}" for i in range(len(steps)) for c in ("local", "carried")])
        return self._rows

    def _outer(self, sums: DataFrame) -> DataFrame:
        """Of a table by range and group, the first and the last group of each range: rows lie in the order of the groups, so no other
        group reaches into another range, and what is carried has two rows a range, however many groups there are."""
        if not self.keys:
            return sums
        row, group = F.struct(*sums.columns), F.struct(*self.keys)
        ends = sums.groupBy(PART).agg(F.min_by(row, group).alias("first"), F.max_by(row, group).alias("last"), F.count("*").alias("n"))
        return ends.select(F.inline(F.when(F.col("n") == 1, F.array("first")).otherwise(F.array("first", "last"))))

    @rows.setter
    def rows(self, df: DataFrame) -> None:
        self._rows = df

    def _add(self, *step) -> Along:
        self._steps.append(_Step(*step))
        return self

    def total(self, value: str, name: str, before: bool = False) -> Along:
        """The sum of a column over the group's rows up to this one, or (before) over those ahead of it; 0 for none."""
        local = F.sum(value).over(self.here.rowsBetween(Window.unboundedPreceding, -1 if before else 0))
        nought = lambda x: F.lit(0) if x is None else F.coalesce(x, F.lit(0))
        return self._add(name, local, F.sum(value), lambda own: F.sum(own).over(self.ranges.rowsBetween(Window.unboundedPreceding, -1)), lambda x, y: nought(x) + nought(y))

    def highest_before(self, value: str, name: str) -> Along:
        """The highest value of the group's rows ahead of this one; null for none."""
        ahead = Window.unboundedPreceding, -1
        local = F.max(value).over(self.here.rowsBetween(*ahead))
        return self._add(name, local, F.max(value), lambda own: F.max(own).over(self.ranges.rowsBetween(*ahead)), lambda x, y: x if y is None else F.greatest(x, y))

    def neighbour(self, value: str, name: str, following: bool = False) -> Along:
        """The value of the row ahead of this one, or of the following one; null for none."""
        edge, step = (F.min_by, F.lead) if following else (F.max_by, F.lag)
        held = F.struct(F.col(value).alias("v"))
        return self._add(name, step(held).over(self.here), edge(held, F.struct(*self.order)), lambda own: step(own).over(self.ranges), lambda x, y: (x if y is None else F.coalesce(x, y))["v"])

    def done(self) -> DataFrame:
        return self.rows.drop(PART)


def running_total(df: DataFrame, order: list[str], value: str, name: str, rows: int | None = None) -> DataFrame:
    """df with the sum of `value` over all rows up to this one in the given (total) order."""
    return Along(df, [], order, rows).total(value, name).done()
