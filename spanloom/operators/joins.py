"""Interval and key joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.storage import broadcast_if_small, write_table

#: Bases of a bin of the overlap join, and bins that an interval may cover before it moves to coarse bins.
BIN, MOST_BINS, COARSE = 1024, 64, 64


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


#: Kinds of pairs by the lengths of the left and right side: both short, right long, left long, both long.
SS, SL, LS, LL = range(4)


def _keys(start: str, stop: str, width: int, left: bool, meets_long: bool = True) -> Column:
    """The keys 4 * bin + kind of an interval. Short ones meet short ones in bins of `width`; where one side is long,
    both sides use bins COARSE times as wide. meets_long=False leaves out the keys for a side without long intervals."""

    def bins(w: int, *kinds: int) -> str:
        return "concat(" + ", ".join(f"transform(sequence({start} div {v}, {stop} div {v}), b -> 4 * b + {k})" for v, k in zip((w, width * COARSE), kinds)) + ")"

    short = bins(width, SS, *([SL if left else LS] if meets_long else []))
    long_ = bins(width * COARSE, LS if left else SL, *([LL] if meets_long else []))
    return F.expr(f"case when {_short(start, stop, width)} then {short} else {long_} end")


def _short(start: str, stop: str, width: int) -> str:
    return f"{stop} - {start} < {MOST_BINS * width}"


def _bins(df: DataFrame, start: str, stop: str, width: int) -> tuple[int, int, int]:
    """Counts of df's rows by bin: short intervals in bins of `width`, these in coarse bins, and long ones in coarse bins."""
    fine, coarse = (f"{stop} div {w} - {start} div {w} + 1" for w in (width, width * COARSE))
    short = _short(start, stop, width)
    sums = [F.expr(f"coalesce(sum({n}) filter (where {kind}), 0)") for n, kind in ((fine, short), (coarse, short), (coarse, f"not ({short})"))]
    return tuple(df.agg(*sums).first())


#: Rows of one side of the overlap join, with a row for each bin, that are broadcast at most.
MOST_BROADCAST = 200_000

#: Rows by bin, of both sides, that a task of the overlap join gets about.
TASK_ROWS = 1_000_000


def overlap_join(a: DataFrame, b: DataFrame, width: int = BIN, long_intervals: bool = True, salts: int | None = 1) -> DataFrame:
    """Every pair of rows of the same sequence whose closed intervals share a base; b's columns get `b_`.

    Both sides are exploded to the bins they cover and joined on (sequence, bin), so rows of one sequence are dealt
    over many tasks; a pair counts only in the first bin that both cover. Intervals over MOST_BINS bins would be
    repeated too often: they, and what they meet, are joined in bins COARSE times as wide in the same join.
    long_intervals=False leaves that out where none is so long. Where a few bins hold much of a (repeats, organelles),
    salts=None finds these bins by a count when this is called and deals the rows of each over as many tasks as they need; a number of
    salts deals the rows of every bin over so many tasks without a count. b's rows by bin are counted when this is called, up to MOST_BROADCAST: so many are
    broadcast, as Spark knows only the size of a file, not how often its rows are repeated. With more, the rows by bin of both sides are counted and shuffled;
    if spark.sql.shuffle.partitions is too few for tasks of TASK_ROWS, frequent bins are found and more partitions are made, so that what a
    task holds does not grow with the tables. Rows of null or reversed bounds pair with nothing."""
    a, b = a.where("start <= stop"), prefixed(b.where("start <= stop"), "b_")
    first = "greatest(start, b_start)"
    in_first = f"__key = {first} div {width}"
    if long_intervals:
        in_first = f"__key = 4 * ({first} div (case when pmod(__key, 4) = {SS} then {width}L else {width * COARSE}L end)) + pmod(__key, 4)"

    def by_bin(df: DataFrame, start: str, stop: str, left: bool, meets_long: bool = True) -> DataFrame:
        if long_intervals:
            return df.withColumn("__key", F.explode(_keys(start, stop, width, left, meets_long)))
        return df.withColumn("__key", F.explode(F.expr(f"sequence({start} div {width}, {stop} div {width})")))

    x, y = by_bin(a, "start", "stop", True), by_bin(b, "b_start", "b_stop", False)
    keys, parts, small = ["sequence", "__key"], 0, False
    if salts is not None:
        small = y.limit(MOST_BROADCAST // salts + 1).count() <= MOST_BROADCAST // salts
    if salts is not None and not small:
        (fine, coarse, long_), (b_fine, b_coarse, b_long) = _bins(a, "start", "stop", width), _bins(b, "b_start", "b_stop", width)
        x, y = by_bin(a, "start", "stop", True, b_long > 0), by_bin(b, "b_start", "b_stop", False, long_ > 0)
        rows = fine + long_ + (coarse + long_ if b_long else 0) + salts * (b_fine + b_long + (b_coarse + b_long if long_ else 0))
        parts = -(-rows // TASK_ROWS)
    y = y.withColumn("sequence", F.col("b_sequence"))
    if salts is not None and salts > 1:
        x = x.withColumn("__salt", F.pmod(F.xxhash64(*a.columns), F.lit(salts)))
        y = y.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        keys.append("__salt")
    if small:
        pairs = x.join(F.broadcast(y), keys)
    elif salts is None or parts > int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        pairs = dealt_join(x, y, keys, parts=parts)
    else:
        pairs = x.join(y.hint("merge"), keys)
    return pairs.where(X.overlaps("start", "stop", "b_start", "b_stop") & F.expr(in_first)).select(*a.columns, *b.columns)


#: Rows of one key that a task of dealt_join() gets about, and keys above that which are broadcast at most.
HOT_ROWS, MOST_KEYS = 100_000, 1_000_000


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], most: int | None = None, parts: int = 0) -> DataFrame:
    """left joined to right on keys, with the rows of keys that are frequent in left dealt over several tasks.

    Such keys are counted and written when this is called. Their rows of left go to tasks by a hash of the whole row, and their rows of right to
    each of these tasks; of other keys nothing is repeated. With parts both sides are shuffled to so many partitions and sorted."""
    most = most or HOT_ROWS
    hot = left.groupBy(*keys).agg(F.ceil(F.count("*") / most).cast("int").alias("__parts")).where("__parts > 1")
    hot = write_table(hot, "hot")
    few = broadcast_if_small(hot, MOST_KEYS)
    own = F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("__parts")), F.lit(0)).cast("int")
    dealt = left.join(few, keys, "left").withColumn("__part", own).drop("__parts")
    copies = right.join(few, keys, "left").withColumn("__part", F.explode(F.expr("sequence(0, coalesce(__parts, 1) - 1)"))).drop("__parts")
    keys = [*keys, "__part"]
    if parts:
        dealt, copies = dealt.repartition(parts, *keys), copies.repartition(parts, *keys).hint("merge")
    return dealt.join(copies, keys).drop("__part")


def overlaps_literal(df: DataFrame, sequence: str | None, ranges: list[tuple[int, int]], feature: str | None = None) -> DataFrame:
    """Rows that overlap any of the given ranges of a sequence."""
    hit = F.lit(False)
    for start, stop in ranges:
        hit = hit | X.overlaps("start", "stop", F.lit(start), F.lit(stop))
    if sequence is not None:
        hit = hit & (F.lower("sequence") == sequence.lower())
    if feature is not None:
        hit = hit & (F.col("feature") == feature)
    return df.where(hit)


def overlaps_by_ratio(a: DataFrame, b: DataFrame, least: float, width: int = BIN) -> DataFrame:
    """Overlapping pairs whose shared bases are at least the given share of a's row."""
    return overlap_join(a, b, width).where(X.overlap_ratio("b_start", "b_stop", "start", "stop") >= least)


def overlap_counts(a: DataFrame, loci: DataFrame, least: float, width: int = BIN, all_loci: bool = False) -> DataFrame:
    """Rows of a for each locus; with all_loci also the loci without any."""
    n = overlaps_by_ratio(a, loci, least, width).groupBy(F.col("b_locus").alias("locus")).agg(F.count("*").alias("n"))
    return loci.select("locus").distinct().join(n, "locus", "left").fillna(0, ["n"]) if all_loci else n


def best_per(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def max_in_peak(windows: DataFrame, peaks: DataFrame, width: int = BIN) -> DataFrame:
    """For each peak the window of the highest score that overlaps it (ties: the first)."""
    pairs = overlap_join(peaks, windows, width)
    return best_per(pairs, ["peak"], [F.desc("b_score"), "b_start", "b_stop"])


def best_target(targets: str) -> Column:
    """The best of an array of structs (id, distance, side), folded in order: if distances differ by over 100 the
    nearer; else a 5p one takes the place of one that isn't, or is farther."""
    return F.expr(
        f"aggregate(slice({targets}, 2, size({targets})), {targets}[0], (a, x) -> case"
        " when abs(x.distance - a.distance) > 100 then case when x.distance < a.distance then x else a end"
        " when x.side = '5p' and (a.side <> '5p' or x.distance < a.distance) then x else a end)"
    )


def assign_loci(peaks: DataFrame, loci: DataFrame, flank: int, mode: str = "centre", width: int = BIN) -> DataFrame:
    """Loci near each peak: (peak, targets, best). mode: centre (centre -+ flank), span, or span_flank.

    Each target is a struct (id, distance, side, spans) from the peak's centre to the nearer end."""
    p, q = F.col("p_start"), F.col("p_stop")
    centre = F.floor((p + q) / 2)
    a, b = {"centre": (centre - flank, centre + flank), "span": (p, q), "span_flank": (p - flank, q + flank)}[mode]
    region = peaks.withColumn("p_start", F.col("start")).withColumn("p_stop", F.col("stop")).withColumn("start", F.greatest(F.lit(0).cast("long"), a)).withColumn("stop", b)
    pairs = overlap_join(region, loci, width)
    five, three, spans = X.centre_distance("p_start", "p_stop", "b_start", "b_stop", "b_strand")
    side = F.when(five <= three, "5p").otherwise("3p")
    target = F.struct(F.col("b_start").alias("at"), F.col("b_locus").alias("id"), F.least(five, three).alias("distance"), side.alias("side"), spans.alias("spans"))
    found = pairs.groupBy("peak").agg(F.array_sort(F.collect_list(target)).alias("targets"))
    return found.withColumn("best", best_target("targets"))


def keyed_pairs(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both with equal keys; b's other columns get `b_`."""
    return a.join(b.select(*keys, *[F.col(c).alias("b_" + c) for c in b.columns if c not in keys]), keys)


def unpaired(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a whose keys b lacks: what a positional merge would have stopped at."""
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def winner_reads(a: DataFrame, b: DataFrame) -> DataFrame:
    """(read, winner, coordinates_differ) where one genome has strictly fewer mismatches; null mismatches are
    no match. Ties and reads without a match in both are left out."""
    both = a.select("read", F.col("mismatches").alias("mm_a"), F.col("coord").alias("coord_a")).join(b.select("read", F.col("mismatches").alias("mm_b"), F.col("coord").alias("coord_b")), "read")
    x, y = F.coalesce("mm_a", F.lit(1 << 30)), F.coalesce("mm_b", F.lit(1 << 30))
    both = both.withColumn("winner", F.when(x < y, "a").when(y < x, "b")).where("winner is not null")
    return both.select("read", "winner", "mm_a", "mm_b", F.coalesce(F.col("coord_a") != F.col("coord_b"), F.lit(False)).alias("coordinates_differ"))


def pair_mates(left: DataFrame, right: DataFrame, offset: int, distance: int, trust_right: bool = False, seed: int | None = None) -> DataFrame:
    """Mates of two tables of hits (read, chrom, coord, length, chrom_length, strand, hit), read by read.

    (read, tag, left_coord, right_coord, score, left_random, right_random): tag names how many hits each end has (NM
    none, U one, R many). One hit on both ends: the right end is placed if the pair fits. One against many, or many
    against many: the nearest pair that fits within [offset, offset + distance]; others stay unplaced, or with a seed
    are placed at one of their hits by chance (the right end only with trust_right) and marked. A single left end is
    placed, a single right end without a left one only with trust_right. The chance depends on read, hit and seed
    alone, so a repeated task places the same."""
    hit = F.struct("hit", "coord", "chrom", "strand", "chrom_length")
    own = lambda df, end: df.select("read", F.lit(end).alias("end"), F.when(F.col("hit").isNotNull(), hit).alias("h"))
    ends = lambda end: F.collect_list(F.when(F.col("end") == end, F.col("h"))).alias(end)
    # both ends of a read meet once; an aligner bounds the hits of a read
    reads = own(left, "a").unionByName(own(right.withColumn("chrom_length", F.lit(None).cast(left.schema["chrom_length"].dataType)), "b")).groupBy("read").agg(ends("a"), ends("b"))
    apart = "abs((x.chrom_length - x.coord + 1) - y.coord)"
    near = f"filter(b, y -> x.chrom = y.chrom and x.strand <> y.strand and {apart} <= {offset + distance})"
    pairs = f"flatten(transform(a, x -> transform({near}, y -> struct({apart} as score, x.hit as a_hit, y.hit as b_hit, x.coord as a_coord, y.coord as b_coord))))"
    first = lambda end: f"array_min(transform({end}, x -> struct(x.hit as hit, x.coord as coord))).coord as only_{end}"
    lot = lambda end: f"array_min(transform({end}, x -> struct(xxhash64(read, x.hit, {seed or 0}) as lot, x.hit as hit, x.coord as coord))).coord as any_{end}"
    found = reads.selectExpr("read", "cast(size(a) as bigint) as l", "cast(size(b) as bigint) as r", f"array_min({pairs}) as best", first("a"), lot("a"), first("b"), lot("b"))
    found = found.select("*", "best.score", "best.a_coord", "best.b_coord")
    kind = lambda c: F.when(F.col(c) == 0, "NM").when(F.col(c) == 1, "U").otherwise("R")
    fits = F.col("score").isNotNull() & ((F.col("score") >= offset) | ((F.col("l") == 1) & (F.col("r") == 1)))
    by_chance = F.lit(seed is not None) & ~F.coalesce(fits, F.lit(False))
    left_random = by_chance & (F.col("l") > 1)
    right_random = by_chance & (F.col("r") > 1) & F.lit(trust_right)
    at_left = F.when(F.col("l") == 1, F.col("only_a")).when(fits, F.col("a_coord")).when(left_random, F.col("any_a"))
    at_right = F.when(fits, F.col("b_coord")).when((F.col("l") == 0) & (F.col("r") == 1) & F.lit(trust_right), F.col("only_b")).when(right_random, F.col("any_b"))
    return found.select("read", F.concat(kind("l"), F.lit("/"), kind("r")).alias("tag"), at_left.alias("left_coord"), at_right.alias("right_coord"), F.when(fits, F.col("score")).alias("score"), left_random.alias("left_random"), right_random.alias("right_random"))


def mate_rows(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Two interval rows for each pair of pair_mates(), left end first: (read, end, sequence, source, feature, start,
    stop, score, strand, frame). An end without a place has `.` for its sequence, and zeros; the source is the tag, with
    `*` where the place was taken by chance; the score counts the end's hits. Hits also have seq and mismatches."""
    parts = []
    for end, hits in (("left", left), ("right", right)):
        count = hits.groupBy("read").agg(F.count("hit").alias("hits"), F.max("seq").alias("seq"))
        placed = hits.where("hit is not null").select("read", F.col("coord").alias(f"{end}_coord"), "chrom", "length", "strand", "mismatches").dropDuplicates(["read", f"{end}_coord"])
        rows = pairs.join(placed, ["read", f"{end}_coord"], "left").join(count, "read", "left")
        there = F.col(f"{end}_coord").isNotNull()
        zero = F.lit(0).cast("long")
        parts.append(rows.select(
            "read", F.lit(end).alias("end"), F.when(there, F.col("chrom")).otherwise(".").alias("sequence"),
            F.concat("tag", F.when(F.col(f"{end}_random"), "*").otherwise("")).alias("source"), F.concat_ws(":", "read", "seq").alias("feature"),
            F.coalesce(f"{end}_coord", zero).alias("start"), F.coalesce(F.expr(f"{end}_coord + length - 1"), zero).alias("stop"),
            F.coalesce("hits", zero).alias("score"), F.when(there, F.col("strand")).otherwise(".").alias("strand"), F.when(there, F.col("mismatches").cast("string")).otherwise(".").alias("frame"),
        ))
    return parts[0].unionByName(parts[1])


def mate_products(left: DataFrame, right: DataFrame, insert: int, variance: int) -> DataFrame:
    """Pairs of alignments of one read on one sequence and opposite strands with insert sizes within
    insert -+ variance; unique says whether the read has just one."""
    b = right.select("read", *[F.col(c).alias("b_" + c) for c in ("sequence", "start", "stop", "strand")])
    size = F.greatest("stop", "b_stop") - F.least("start", "b_start") + 1
    pairs = left.join(b, "read").where("sequence = b_sequence and strand <> b_strand").withColumn("insert", size).where(F.abs(F.col("insert") - insert) <= variance)
    return pairs.withColumn("unique", F.count("*").over(Window.partitionBy("read")) == 1)


def choose_mates(products: DataFrame, seed: int | None = None) -> DataFrame:
    """One pair of mate_products() for each read: the only one, and of several, with a seed, one by a chance that
    depends on the pair and the seed alone; without a seed such reads are left out."""
    if seed is None:
        return products.where("unique")
    lot = F.xxhash64("read", "start", "b_start", F.lit(seed))
    return best_per(products, ["read"], [lot, "start", "b_start"])
