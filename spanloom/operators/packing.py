"""Greedy packing of scaffolds, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.storage import write_table
from spanloom.operators.ordering import ranged, running_total


def pack_in_order(df: DataFrame, sequence: str, order: list[str], length: str, least: int) -> DataFrame:
    """Rows of each sequence in order, in groups: a group ends once its lengths reach `least`. Adds pack, the offset
    within it and its end. Lengths are 0 or more, least is at least 1.

    No task holds a sequence. Rows are numbered and summed by ranges of the whole table's order; each row then finds
    the row that would begin the next group if it began one, and these pointers are followed from every sequence's
    first row by doubling, in as many joins as the number of groups has binary digits."""
    if least < 1:
        raise ValueError("least must be at least 1")
    rows = df.select(F.struct(sequence, *order, length).alias("__row"), F.col(sequence).alias("__seq"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], F.col(length).cast("long").alias("__n"), F.lit(1).alias("__one"))
    keys = ["__seq", *[f"__o{i}" for i in range(len(order))]]
    summed = running_total(rows, keys, "__n", "__sum")
    summed = write_table(summed.withColumn("__at", F.col("__sum") - F.col("__n")).drop("__sum"), "packing")
    # rows of equal keys get one order here, and numbers follow the sums
    rows = write_table(running_total(summed, ["__seq", "__at", "__n", *keys[1:]], "__one", "__k"), "packing")
    starts = write_table(rows.groupBy("__seq").agg(F.min("__k").alias("__k")).select("__k"), "packing")
    jumps = write_table(_next_starts(rows, least), "packing")
    while True:
        here = jumps.select(F.col("__next").alias("__k"), F.col("__k").alias("__from"))
        found = starts.join(jumps, "__k").select(F.col("__next").alias("__k"))
        starts = write_table(starts.union(found).distinct(), "packing")
        jumps = write_table(here.join(jumps, "__k").select(F.col("__from").alias("__k"), "__next"), "packing")
        if jumps.isEmpty():
            break
    marked = rows.join(starts.withColumn("__start", F.lit(1)), "__k", "left").withColumn("__start", F.coalesce("__start", F.lit(0)))
    groups = write_table(running_total(marked, ["__k"], "__start", "__group"), "packing")
    begun = groups.where("__start = 1").select("__group", F.col("__at").alias("__base"))
    first = groups.groupBy("__seq").agg(F.min("__group").alias("__first"))
    out = groups.join(begun, "__group").join(first, groups["__seq"].eqNullSafe(first["__seq"]))
    out = out.select("__row.*", (F.col("__group") - F.col("__first")).alias("pack"), (F.col("__at") - F.col("__base")).alias("pack_offset"))
    return out.withColumn("pack_end", F.col("pack_offset") + F.col(length))


def _next_starts(rows: DataFrame, least: int) -> DataFrame:
    """(__k, __next): the first row of the same sequence that has `least` or more between its start and row __k's.

    Rows and the places looked for are sorted together by ranges; each place takes the first row behind it, from a
    later range by a table of the ranges' first rows."""
    both = rows.select("__seq", "__at", F.lit(1).alias("__is_row"), "__k").unionByName(rows.select("__seq", (F.col("__at") + least).alias("__at"), F.lit(0).alias("__is_row"), "__k"))
    cut, _ = ranged(both, ["__seq", "__at", "__is_row", "__k"])
    place = F.when(F.col("__is_row") == 1, F.struct("__k", "__seq"))
    # from the last row back, so that the window only grows: one that shrinks is folded anew for every row
    back = Window.partitionBy("__part").orderBy(*[F.desc(c) for c in ("__seq", "__at", "__is_row", "__k")]).rowsBetween(Window.unboundedPreceding, 0)
    found = cut.withColumn("__here", F.last(place, ignorenulls=True).over(back))
    firsts = cut.groupBy("__part").agg(F.min(place).alias("__place"))
    later = firsts.withColumn("__later", F.last("__place", ignorenulls=True).over(Window.orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1))).select("__part", "__later")
    found = found.where("__is_row = 0").join(F.broadcast(later), "__part").withColumn("__found", F.coalesce("__here", "__later"))
    return found.where(F.col("__found.__seq").eqNullSafe(F.col("__seq"))).select("__k", F.col("__found.__k").alias("__next"))
