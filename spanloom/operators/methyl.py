"""Methylation calls of aligned reads, counts by position and context, and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators.ordering import Along

#: Positions with more calls than this in sequences other than organelles are masked.
MASK_ABOVE = 20


def base_calls(alignments: DataFrame, dinucleotides: bool = False) -> DataFrame:
    """(sequence, pos, strand, context, methylated) of each call.

    Alignments have read_no (1 or 2), bases, target (the reference with two more bases on either side),
    sequence, start, stop, strand and length (of the sequence). Read 1 calls where the reference has C: C is
    methylated, T not. Read 2 calls where it has G: G or A, for the other strand. The last base makes no
    call. Rows on the reverse strand have reverse coordinates, turned here. With dinucleotides the context is that of
    the next base alone: CG, CA, CC or CT."""
    r = alignments.select("*", F.posexplode(F.split("bases", "")).alias("j", "base")).where("base <> '' and j < stop - start")
    at = lambda k: F.substring("target", (F.col("j") + k).cast("int"), 1)
    first = F.col("read_no") == 1
    ref = F.upper(at(3))
    base = F.upper("base")
    site = F.when(first, (ref == "C") & base.isin("C", "T")).otherwise((ref == "G") & base.isin("G", "A"))
    near, far = F.when(first, F.upper(at(4))).otherwise(F.upper(at(2))), F.when(first, F.upper(at(5))).otherwise(F.upper(at(1)))
    wanted = F.when(first, "G").otherwise("C")
    kind = F.when(near == wanted, "CG").when(far == wanted, "CHG").otherwise("CHH")
    if dinucleotides:
        kind = F.concat(F.lit("C"), F.when(first, near).otherwise(F.translate(near, "ACGT", "TGCA")))
    other = F.when(F.col("strand") == "+", "-").otherwise("+")
    place = F.when(F.col("strand") == "-", X.flip(F.col("start") + F.col("j"), "length")).otherwise(F.col("start") + F.col("j"))
    called = r.where(site).select("sequence", place.alias("pos"), F.when(first, F.col("strand")).otherwise(other).alias("strand"), kind.alias("context"), base.isin("C", "G").alias("methylated"))
    return called


def count_positions(calls: DataFrame) -> DataFrame:
    """One row for each (sequence, pos): c, t, ratio, and its context and strand, `.` where calls disagree;
    masked marks positions with too many calls outside organelles."""
    g = calls.groupBy("sequence", "pos").agg(
        F.count_if("methylated").alias("c"),
        F.count_if(~F.col("methylated")).alias("t"),
        F.min("context").alias("__a"),
        F.max("context").alias("__b"),
        F.min("strand").alias("__s"),
        F.max("strand").alias("__u"),
    )
    masked = (F.col("c") + F.col("t") > MASK_ABOVE) & ~F.col("sequence").rlike("^chr[cm]$")
    return g.select(
        "sequence", "pos",
        F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise(".").alias("context"),
        F.when(F.col("__s") == F.col("__u"), F.col("__s")).otherwise(".").alias("strand"),
        "c", "t", F.try_divide("c", F.col("c") + F.col("t")).alias("ratio"), masked.alias("masked"),
    )


def context_summary(counts: DataFrame, contexts: tuple[str, ...] = ("CG", "CHG", "CHH")) -> DataFrame:
    """One row: c, t and ratio of each context, over all positions and over those that aren't masked."""
    cols = []
    for k in contexts:
        own = F.col("context") == k
        for name, keep in ((k, own), (f"{k}_filtered", own & ~F.col("masked"))):
            c, t = (F.coalesce(F.sum(F.when(keep, F.col(x))), F.lit(0)) for x in ("c", "t"))
            cols += [c.alias(f"{name}_c"), t.alias(f"{name}_t"), F.try_divide(c, c + t).alias(f"{name}_ratio")]
    return counts.agg(*cols)


def context_counts(counts: DataFrame, by: list[str], context: str = "context") -> DataFrame:
    """c and t for each context as columns, by the given keys."""
    contexts = ("CG", "CHG", "CHH")
    return counts.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col(context) == k, F.col(x))), F.lit(0)).alias(f"{k}_{x}") for k in contexts for x in ("c", "t")])


def merge_frequencies(freq: DataFrame, contexts: tuple[str, ...], by: list[str] | None = None) -> DataFrame:
    """Sums rows of a frequency table and computes the ratios again, and those of all contexts together."""
    sums = freq.groupBy(*(by or [])).agg(*[F.sum(f"{k}_{x}").alias(f"{k}_{x}") for k in contexts for x in ("c", "t")])
    for k in contexts:
        sums = sums.withColumn(f"{k}_ratio", F.try_divide(f"{k}_c", F.col(f"{k}_c") + F.col(f"{k}_t")))
    total = lambda x: sum((F.col(f"{k}_{x}") for k in contexts[1:]), F.col(f"{contexts[0]}_{x}"))
    return sums.withColumn("C_c", total("c")).withColumn("C_t", total("t")).withColumn("C_ratio", F.try_divide(total("c"), total("c") + total("t")))


def read_contexts(df: DataFrame, seq: str = "seq") -> list:
    """Counts of C, CG, CHG and CHH in reads, from the read alone."""
    return [
        F.regexp_count(seq, F.lit("C")).alias("c"),
        F.regexp_count(seq, F.lit("CG")).alias("cg"),
        F.regexp_count(seq, F.lit("C(?=[ACT]G)")).alias("chg"),
        F.regexp_count(seq, F.lit("C(?=[ACT][ACT])")).alias("chh"),
    ]


def seeker_counts(calls: DataFrame) -> DataFrame:
    """c and t of single-character calls by (sequence, context, pos): X, Y, Z methylated in CG, CHG, CHH, small ones not."""
    kind = F.when(F.lower("call") == "x", "CG").when(F.lower("call") == "y", "CHG").otherwise("CHH")
    upper = F.col("call") == F.upper("call")
    return calls.where("call in ('x', 'y', 'z', 'X', 'Y', 'Z')").groupBy("sequence", kind.alias("context"), "pos").agg(F.count_if(upper).alias("c"), F.count_if(~upper).alias("t"))


def paired_neighbours(single_c: DataFrame) -> DataFrame:
    """Rows with c > 1 of which a neighbouring row has c > 1 too; organelles are left out."""
    rows = Along(single_c.where(~F.lower("sequence").rlike("^chr[cm]")), ["sequence"], ["start", "stop", "id", "ln"])
    rows = rows.neighbour("c", "__l").neighbour("c", "__r", following=True).done()
    return rows.where("c > 1 and (coalesce(__l, 0) > 1 or coalesce(__r, 0) > 1)").drop("__l", "__r")


def adjacency_runs(rows: DataFrame, least_score: float, least_total: int, gap: int, *more: str) -> DataFrame:
    """(size, n): how many runs of neighbouring well-covered, highly methylated rows have each size."""
    from spanloom.operators.windows import islands

    good = rows.where((F.col("c") + F.col("t") > least_total) & (F.col("score") > least_score))
    runs = islands(good, gap, *more).groupBy("sequence", "island").agg(F.count("*").alias("size"))
    return runs.groupBy("size").agg(F.count("*").alias("n"))


def audit(single_c: DataFrame, order: list[str] | None = None) -> DataFrame:
    """For each sequence: rows, rows with bad attributes, repeated starts, and a verdict. With order (columns that give
    the rows' places in their file) also whether starts never fall in it; unsorted sequences are bad too."""
    per = single_c.groupBy("sequence", "start").agg(F.count("*").alias("k"), F.count_if(F.col("c").isNull() | F.col("t").isNull()).alias("bad"))
    out = per.groupBy("sequence").agg(F.sum("k").alias("n"), F.sum("bad").alias("bad_attributes"), F.count_if(F.expr("k > 1")).alias("repeated_starts"))
    good = (F.col("bad_attributes") == 0) & (F.col("repeated_starts") == 0)
    if order:
        from spanloom.operators.windows import is_sorted

        own = is_sorted(single_c, "start", order).withColumnRenamed("sequence", "__s")
        out = out.join(own, F.col("sequence").eqNullSafe(F.col("__s"))).drop("__s")
        good = good & F.col("sorted")
    return out.withColumn("verdict", F.when(good, "OK").otherwise("BAD"))


def collapse_repeats(df: DataFrame) -> DataFrame:
    """Rows of equal coordinates as one, scored with the number of the others."""
    return df.groupBy("sequence", "start", "stop", "strand").agg((F.count("*") - 1).alias("score"))


def alignment_stats(hits: DataFrame) -> DataFrame:
    """ALL, NM, U0, U1, U2, repeats and all unique ones of reads with ranks (hits of 0, 1 and 2 mismatches)."""
    best = F.when(F.col("r0") > 0, F.col("r0")).when(F.col("r1") > 0, F.col("r1")).otherwise(F.col("r2"))
    nm = F.expr("r0 + r1 + r2 = 0")
    unique = lambda k: F.count_if((best == 1) & (F.expr(" and ".join(["true", *[f"r{i} = 0" for i in range(k)], f"r{k} = 1"]))))
    return hits.agg(F.count("*").alias("ALL"), F.count_if(nm).alias("NM"), *[unique(k).alias(f"U{k}") for k in range(3)], F.count_if(best > 1).alias("R"), F.count_if((best == 1) & ~nm).alias("UT"))


def correlated_stats(mates: DataFrame) -> DataFrame:
    """One row of counts of mate rows (source as mate_rows() tags it, score: hits of the end): ALL, NM without a hit, UT
    with one, RT with more, and of those with one UU for ends unique by themselves and RR for resolved repeats, which
    count half where only one end was a repeat."""
    one = F.col("score") == 1
    tag = F.col("source")
    half = F.when(one & tag.rlike("U/R|R/U"), 0.5).when(one & tag.contains("R/R"), 1.0).otherwise(0.0)
    return mates.agg(F.count("*").alias("ALL"), F.count_if(F.col("score") < 1).alias("NM"), F.count_if(one).alias("UT"), F.count_if(F.col("score") > 1).alias("RT"), F.count_if(one & tag.contains("U/U")).alias("UU"), F.coalesce(F.sum(half), F.lit(0.0)).alias("RR"))
