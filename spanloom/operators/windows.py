"""Windows over sequences: fixed, annotated, merged, offset and end-anchored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators.joins import BIN, overlap_join
from spanloom.operators.ordering import Along, running_total
from spanloom.operators.scoring import scored
from spanloom.storage import broadcast_if_small, write_table


#: Sequences whose ends are broadcast at most.
MOST_SEQUENCES = 500_000


def last_stop(df: DataFrame) -> DataFrame:
    """(sequence, upper): the end of each sequence's last row by start, then by end.

    Both are packed in one decimal, whose maximum is kept in a hash table; a struct's would need a sort."""
    packed = F.expr("cast(start as decimal(18, 0)) * 1000000000000000000BD + stop")
    return df.groupBy("sequence").agg(F.max(packed).alias("__last")).select("sequence", F.expr("cast(pmod(__last, 1000000000000000000BD) as bigint)").alias("upper"))


def fixed_windows(uppers: DataFrame, width: int, step: int) -> DataFrame:
    """Windows [i, i + width - 1] for i = 1, 1 + step, ... up to each sequence's upper end; the last may be cut."""
    at = uppers.where("upper >= 1").withColumn("win_start", F.explode(F.expr(f"sequence(1L, upper, {step}L)")))
    return at.where(f"win_start <= upper - {width} + 1 or win_start < upper").select("sequence", "win_start", F.least(F.col("win_start") + width - 1, F.col("upper")).alias("win_stop"))


def window_fixed(df: DataFrame, width: int, step: int, scorer: str, uppers: DataFrame | None = None, keep_empty: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Scores of fixed windows, of each value of the columns `by` apart (which keep_empty does not go with). Each row
    names the windows it reaches by arithmetic, so there is no join with windows; only keep_empty makes all windows and
    joins the scores to them. Sequences' ends are found, written and counted when this is called, and broadcast up to
    MOST_SEQUENCES."""
    # the rows stay where they are: a few sequences would make a few tasks of them
    uppers = write_table(last_stop(df) if uppers is None else uppers, "uppers")
    rows = df.join(broadcast_if_small(uppers, MOST_SEQUENCES), "sequence").where("start <= stop and stop >= 1")
    first = F.expr(f"greatest(0L, ceil((start - {width}) / {step}))")
    last = F.expr(f"(least(stop, upper) - 1) div {step}")
    rows = rows.withColumn("__a", first).withColumn("__b", last).where("__a <= __b")
    rows = rows.withColumn("__k", F.explode(F.sequence("__a", "__b"))).withColumn("win_start", F.col("__k") * step + 1)
    rows = rows.where(f"win_start <= upper - {width} + 1 or win_start < upper")
    rows = rows.withColumn("win_stop", F.least(F.col("win_start") + width - 1, F.col("upper")))
    rows = rows.where(X.overlaps("start", "stop", "win_start", "win_stop"))
    rows = rows.withColumn("overlap", X.overlap_size("start", "stop", "win_start", "win_stop")).withColumn("length", X.span_length()).withColumn("window_length", X.span_length("win_start", "win_stop"))
    out = scored(rows, [*by, "sequence", "win_start", "win_stop"], scorer)
    return fixed_windows(uppers, width, step).join(out, ["sequence", "win_start", "win_stop"], "left") if keep_empty else out


def window_annotation(df: DataFrame, loci: DataFrame, scorer: str, width: int = BIN, keep_empty: bool = False) -> DataFrame:
    """Scores of annotated loci (sequence, locus, start, stop)."""
    rows = overlap_join(df, loci, width)
    rows = rows.withColumn("overlap", X.overlap_size("start", "stop", "b_start", "b_stop")).withColumn("length", X.span_length()).withColumn("window_length", X.span_length("b_start", "b_stop"))
    out = scored(rows, ["b_sequence", "b_locus", "b_start", "b_stop"], scorer)
    out = out.select(F.col("b_sequence").alias("sequence"), F.col("b_locus").alias("locus"), F.col("b_start").alias("win_start"), F.col("b_stop").alias("win_stop"), *[c for c in out.columns if not c.startswith("b_")])
    if not keep_empty:
        return out
    every = loci.select("sequence", "locus", F.col("start").alias("win_start"), F.col("stop").alias("win_stop"))
    return every.join(out, ["sequence", "locus", "win_start", "win_stop"], "left")


def sliding_by_start(df: DataFrame, width: int, step: int) -> DataFrame:
    """Sums of rows whose start lies in [i, i + width - 1], i = 1, 1 + step, ...; over_c and over_t are the sums of
    rows that lie in the next window too."""
    rows = df.where("start >= 1").withColumn("__k", F.explode(F.expr(f"sequence(greatest(0L, ceil((start - {width}) / {step})), (start - 1) div {step})")))
    rows = rows.withColumn("win_start", F.col("__k") * step + 1)
    over = lambda c: F.sum(F.when(F.col("start") >= F.col("win_start") + step, F.col(c)).otherwise(0))
    out = rows.groupBy("sequence", "win_start").agg(F.sum("c").alias("sum_c"), F.sum("t").alias("sum_t"), over("c").alias("over_c"), over("t").alias("over_t"))
    return out.withColumn("score", F.try_divide("sum_c", F.expr("sum_c + sum_t")))


def by_coordinate(df: DataFrame, *more: str) -> Along:
    """The rows of each sequence by start and end; `more` completes the order."""
    return Along(df, ["sequence"], ["start", "stop", *more])


def _islands(along: Along, distance: int, also: Column | None = None) -> DataFrame:
    new = F.col("__reach").isNull() | (F.col("start") - F.col("__reach") > distance)
    if also is not None:
        new = new | F.coalesce(also, F.lit(False))
    along.highest_before("stop", "__reach")
    along.rows = along.rows.withColumn("__new", new.cast("int"))
    return along.total("__new", "island").done().drop("__reach", "__new")


def islands(df: DataFrame, distance: int, *more: str) -> DataFrame:
    """df with an island number for each sequence: a row starts a new one if it begins more than `distance`
    after all rows before it end. `more` completes the order."""
    return _islands(by_coordinate(df, *more), distance)


def merge_adjacent(df: DataFrame, distance: int, *more: str, log: bool = False) -> DataFrame:
    """Islands as single rows: bounds, rows, and the sum of scores (of powers of two if they are logarithms)."""
    score = F.log2(F.sum(F.pow(F.lit(2.0), "score"))) if log else F.sum("score")
    return islands(df, distance, *more).groupBy("sequence", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n"), score.alias("score")).withColumn("length", X.span_length())


def merge_windows(df: DataFrame, distance: int, *more: str, max_gap: int = 1, log: bool = False) -> tuple[DataFrame, DataFrame]:
    """(merged, empty): windows with a score merged over at most max_gap empty ones in a row, and the empty ones that no
    merged window covers. A window is empty without a score, or with score 0 unless scores are logarithms.

    Windows are merged while each begins at most `distance` behind the end of those before it. merged has bounds, the
    number of windows, the sum of scores, length, the feature with merged_ in front, and the attributes (other than `.`)
    in order, joined by `; `."""
    blank = F.col("score").isNull() if log else F.coalesce(F.col("score"), F.lit(0.0)) == 0
    along = by_coordinate(df.withColumn("__blank", blank.cast("int")), *more).highest_before("stop", "__reach")
    along.rows = along.rows.withColumn("__apart", (F.col("__reach").isNull() | (F.col("start") - F.col("__reach") > distance)).cast("int"))
    rows = along.total("__apart", "__steps").total("__blank", "__blanks").done()
    full = by_coordinate(rows.where("__blank = 0"), *more).neighbour("__steps", "__step").neighbour("__blanks", "__gap")
    full.rows = full.rows.withColumn("__new", F.coalesce((F.col("__step") != F.col("__steps")) | (F.col("__blanks") - F.col("__gap") > max_gap), F.lit(True)).cast("int"))
    full = full.total("__new", "island").done()
    score = F.log2(F.sum(F.pow(F.lit(2.0), "score"))) if log else F.sum("score")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "stop", *more, F.nullif("attributes", F.lit(".")).alias("__a")))), lambda x: x["__a"]), "; ")
    merged = full.groupBy("sequence", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n"), score.alias("score"), F.concat(F.lit("merged_"), F.min_by("feature", F.struct("start", "stop", *more))).alias("feature"), text.alias("attributes"))
    # the last merged window that begins before an empty one: both in one order, so no join by range is needed
    ends = merged.select("sequence", "start", F.col("stop").alias("__end"), F.lit(None).cast("string").alias("__mark"))
    empty = rows.where("__blank = 1").drop("__blank", "__reach", "__apart", "__steps", "__blanks")
    both = ends.unionByName(empty.select("sequence", "start", F.struct(*empty.columns).alias("__row")), allowMissingColumns=True)
    both = both.withColumn("__is_row", F.col("__row").isNotNull().cast("int")).withColumn("__order", F.to_json("__row"))
    covered = Along(both, ["sequence"], ["start", "__is_row", "__order"]).highest_before("__end", "__cover").done()
    left = covered.where("__is_row = 1 and (__cover is null or start > __cover)").select("__row.*")
    return merged.withColumn("length", X.span_length()), left


def collapse_adjacent(df: DataFrame, distance: int, tolerance: float, *more: str) -> DataFrame:
    """Rows joined to the one before while they are near and their scores differ by at most `tolerance`."""
    along = by_coordinate(df, *more).neighbour("score", "__before")
    rows = _islands(along, distance, F.abs(F.col("score") - F.col("__before")) > tolerance)
    return rows.groupBy("sequence", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.avg("score").alias("score"), F.count("*").alias("n"))


def gaps(df: DataFrame, *more: str) -> DataFrame:
    """Stretches between rows, and before the first one: [end before + 1, start - 1], with score 0."""
    rows = by_coordinate(df, *more).highest_before("stop", "__reach").done()
    return rows.withColumn("__reach", F.coalesce("__reach", F.lit(0).cast("long"))).where("start > __reach + 1").select("sequence", (F.col("__reach") + 1).alias("start"), (F.col("start") - 1).alias("stop"), F.lit(0.0).alias("score"))


def partition_slices(df: DataFrame, column: str, parts: int, *more: str) -> DataFrame:
    """df with the slice (from 0) of each row in the order of a column: slices of int(n / parts) rows; rows left
    over fall into further slices."""
    size = max(1, df.count() // parts)
    numbered = running_total(df.withColumn("__one", F.lit(1)), [column, *more], "__one", "__row")
    return numbered.withColumn("slice", F.floor((F.col("__row") - 1) / size)).drop("__one", "__row")


def offset_regions(loci: DataFrame, distance: int, five_prime: bool, strategy: int = 0, keep_off: int = 0, drop_last: bool = False) -> DataFrame:
    """Regions around the 5' or 3' ends. Strategy 0: end -+ distance; 2: also not beyond the locus's other end
    nor into its neighbours; 6: also keep_off bases away from the other end. A missing neighbour bounds nothing,
    unless drop_last asks for the loss of each sequence's last locus. Regions turned round are left out."""
    if strategy in (2, 6):
        loci = by_coordinate(loci, "locus").neighbour("stop", "__previous").neighbour("start", "__following", following=True).done()
    previous, following = F.col("__previous"), F.col("__following")
    plus = F.col("strand") != "-"
    at_start = plus if five_prime else ~plus
    anchor = F.when(at_start, F.col("start")).otherwise(F.col("stop"))
    low, high = F.greatest(F.lit(0).cast("long"), anchor - distance), anchor + distance
    if strategy in (2, 6):
        off = keep_off if strategy == 6 else 0
        low = F.when(at_start, F.greatest(low, F.coalesce(previous + 1, low))).otherwise(F.greatest(low, F.col("start") + off))
        high = F.when(at_start, F.least(high, F.col("stop") - off)).otherwise(F.least(high, F.coalesce(following - 1, F.lit(0).cast("long") if drop_last else high)))
    elif strategy != 0:
        raise ValueError(f"stop strategy {strategy} is not defined")
    out = loci.withColumn("anchor", anchor).withColumn("flag_start", low).withColumn("flag_stop", high)
    return out.where("flag_start <= flag_stop").drop("__previous", "__following")


def ends_bins(df: DataFrame, regions: DataFrame, distance: int, bin_width: int, width: int = BIN) -> DataFrame:
    """(locus, bin, score): means of scores, weighted by the overlapping share of each row, in bins of
    bin_width around each region's anchor, from 5' to 3'; starts outside the bins are left out."""
    n = 2 * (distance // bin_width)
    box = regions.select("sequence", "locus", "strand", "anchor", F.col("flag_start").alias("start"), F.col("flag_stop").alias("stop"))
    pairs = overlap_join(df, box, width)
    lowest = F.col("b_anchor") - bin_width * (n // 2)
    bin_ = F.floor((F.col("start") - lowest) / bin_width)
    share = X.overlap_size("start", "stop", "b_start", "b_stop") / X.span_length()
    rows = pairs.withColumn("bin", bin_).where(f"bin >= 0 and bin < {n}").withColumn("bin", F.when(F.col("b_strand") == "-", n - 1 - F.col("bin")).otherwise(F.col("bin")))
    return rows.groupBy(F.col("b_locus").alias("locus"), "bin").agg(F.avg(F.col("score") * share).alias("score"), F.count("*").alias("n"))


def dense_bins(bins: DataFrame, loci: DataFrame, n: int) -> DataFrame:
    """One row for each locus with its n bins as an array, null where empty."""
    grid = loci.select("locus").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("bin", F.col("bin").cast("long"))
    return grid.join(bins, ["locus", "bin"], "left").groupBy("locus").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "score"))), lambda x: x["score"]).alias("scores"))


def running_offset(df: DataFrame, group: str, order: list[str], length: str) -> DataFrame:
    """df with the sum of the lengths of the rows before it in its group."""
    return Along(df, [group], order).total(length, "offset", before=True).done().withColumn("offset", F.col("offset").cast("long"))


def frequency_windows(df: DataFrame, width: int, every_base: bool = False) -> DataFrame:
    """Rows (by centre) or bases (every_base) in each window [k * width + 1, (k + 1) * width]."""
    if not every_base:
        at = F.floor((F.col("start") + F.col("stop")) / 2)
        return df.groupBy("sequence", (F.floor((at - 1) / width) * width + 1).alias("win_start")).agg(F.count("*").alias("n"))
    cut = df.withColumn("__k", F.explode(F.expr(f"sequence((start - 1) div {width}, (stop - 1) div {width})")))
    bases = X.overlap_size("start", "stop", F.col("__k") * width + 1, (F.col("__k") + 1) * width)
    return cut.groupBy("sequence", (F.col("__k") * width + 1).alias("win_start")).agg(F.sum(bases).alias("n"))


def is_sorted(df: DataFrame, column: str, order: list[str], strict: bool = False) -> DataFrame:
    """(sequence, sorted): whether a column never falls (or always rises) in the given order."""
    rows = Along(df, ["sequence"], order).neighbour(column, "__before").done()
    bad = F.col("__before") >= F.col(column) if strict else F.col("__before") > F.col(column)
    return rows.withColumn("__bad", F.coalesce(bad, F.lit(False))).groupBy("sequence").agg((F.count_if("__bad") == 0).alias("sorted"))


def extend_loci(loci: DataFrame, windows: DataFrame, width: int = BIN) -> DataFrame:
    """Loci stretched to the outermost windows that overlap them; extension counts the added bases."""
    pairs = overlap_join(loci, windows, width).groupBy("sequence", "locus", "start", "stop").agg(F.min("b_start").alias("a"), F.max("b_stop").alias("b"))
    all_ = loci.join(pairs, ["sequence", "locus", "start", "stop"], "left")
    a, b = F.least("start", F.coalesce("a", "start")), F.greatest("stop", F.coalesce("b", "stop"))
    return all_.select("sequence", "locus", a.alias("new_start"), b.alias("new_stop"), ((b - a) - (F.col("stop") - F.col("start"))).alias("extension"))


def extended_rows(rows: DataFrame, windows: DataFrame, feature: str | None = None, width: int = BIN) -> DataFrame:
    """Annotation rows (sequence, locus, feature, start, stop, attributes, ...) stretched as by extend_loci(): the feature
    gets ext_ in front, or is the given one; stretched rows' attributes get `Target=` with the locus and its bounds
    before, and `extension=`."""
    keys = ["sequence", "locus", "start", "stop"]
    reach = overlap_join(rows.select(*keys), windows, width).groupBy(*keys).agg(F.min("b_start").alias("__a"), F.max("b_stop").alias("__b"))
    both = rows.join(reach, keys, "left").withColumn("__a", F.least("start", F.coalesce("__a", "start"))).withColumn("__b", F.greatest("stop", F.coalesce("__b", "stop")))
    more = F.expr("(__b - __a) - (stop - start)")
    text = F.concat("attributes", F.when(more > 0, F.concat(F.lit("; Target="), F.concat_ws(" ", "locus", "start", "stop"), F.lit("; extension="), more.cast("string"))).otherwise(""))
    named = F.lit(feature) if feature else F.concat(F.lit("ext_"), "feature")
    return both.withColumn("attributes", text).withColumn("feature", named).withColumn("start", F.col("__a")).withColumn("stop", F.col("__b")).drop("__a", "__b")
