"""Composite operators, made of the operators below them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators import joins as J
from spanloom.operators import methyl as M
from spanloom.operators import relational as R
from spanloom.operators import stats as S
from spanloom.operators import windows as W
from spanloom.sources import text as T
from spanloom.storage import write_table


def bisulfite_run(alignments: DataFrame, width: int = 50) -> dict[str, DataFrame]:
    """From aligned reads to calls, single-base counts, context summary, and windows of each context. The counts, which
    the others are made of, are written when this is called."""
    calls = M.base_calls(alignments)
    counts = write_table(M.count_positions(calls), "counts")
    rows = counts.select("sequence", F.col("pos").alias("start"), F.col("pos").alias("stop"), F.col("ratio").alias("score"), "c", "t", "context")
    return {
        "counts": counts,
        "summary": M.context_summary(counts),
        "windows": W.window_fixed(rows.where("context <> '.'"), width, width, "fractional_methylation"),
    }


def bowtie_run(left_lines: DataFrame, right_lines: DataFrame, lengths: DataFrame, offset: int, distance: int) -> DataFrame:
    """Bowtie lines of both ends to paired mates."""

    def hits(lines: DataFrame) -> DataFrame:
        b = T.parse_bowtie(lines).join(lengths, F.lower("target") == F.col("sequence"))
        return b.select("read", F.lower("target").alias("chrom"), "coord", F.length("seq").alias("length"), F.col("chrom_length"), "strand", F.lit(0).alias("hit"))

    return J.pair_mates(hits(left_lines), hits(right_lines), offset, distance)


def two_genome_ratio(a: DataFrame, b: DataFrame) -> DataFrame:
    """Reads won by either genome by chromosome and mismatches, and their ratio."""
    won = J.winner_reads(a, b).join(a.select("read", "chrom"), "read")
    counts = won.groupBy("chrom").agg(F.count_if(F.expr("winner = 'a'")).alias("a"), F.count_if(F.expr("winner = 'b'")).alias("b"))
    return S.mismatch_ratio(counts, "a", "b")


def imprinting_table(counts: dict[str, DataFrame], loci: DataFrame) -> DataFrame:
    """A column of counts for each table, for every locus."""
    parts = [t.select("locus", F.col("n").alias(name)) for name, t in counts.items()]
    return reduce(lambda x, y: x.join(y, "locus", "left"), parts, loci.select("locus").distinct()).fillna(0)


def concat_and_window(batches: list[DataFrame], width: int) -> DataFrame:
    """Batches of single-base rows merged by context and coordinate, then in windows of each context and sequence."""
    rows = reduce(DataFrame.unionByName, [b.select("context", "sequence", "start", "stop", "c", "t") for b in batches])
    merged = rows.groupBy("context", "sequence", "start", "stop").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    uppers = merged.groupBy("sequence").agg((F.floor(F.max("stop") / width) * width + width).alias("upper"))
    return W.window_fixed(merged, width, width, "fractional_methylation", uppers, by=("context",))


def ends_matrix(groups: dict[str, DataFrame], loci: DataFrame, distance: int, bin_width: int, strategies: tuple[int, ...] = (0,), width: int = J.BIN) -> DataFrame:
    """Mean profiles of each group at both ends under each strategy."""
    parts = []
    for name, rows in groups.items():
        for five in (True, False):
            for s in strategies:
                bins = W.ends_bins(rows, W.offset_regions(loci, distance, five, s), distance, bin_width, width)
                parts.append(S.bin_profile(bins).select(F.lit(name).alias("group"), F.lit("5p" if five else "3p").alias("side"), F.lit(s).alias("strategy"), "bin", "mean", "n"))
    return reduce(DataFrame.unionByName, parts)


def frequency_coverage(sites: DataFrame, organelles: list[str], genome: int) -> DataFrame:
    """Ratios by context, and calls over the genome's size, of nuclear and organelle sequences."""
    rows = sites.withColumn("part", F.when(F.col("sequence").isin(organelles), "organelle").otherwise("nuclear"))
    freq = M.merge_frequencies(M.context_counts(rows, ["part"]), ("CG", "CHG", "CHH"), ["part"])
    return freq.select("part", *[F.round(f"{k}_ratio", 9).alias(f"{k}_ratio") for k in ("CG", "CHG", "CHH")], F.round((F.col("C_c") + F.col("C_t")) / genome, 9).alias("coverage"))
