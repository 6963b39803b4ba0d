"""Scores of the rows in a window, by name. Rows have score, c, t, id and, for diluted scores,
overlap (shared bases), length (of the row) and window_length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fractional() -> list[Column]:
    c, t = F.sum("c"), F.sum("t")
    return [F.count("*").alias("n"), c.alias("sum_c"), t.alias("sum_t"), F.try_divide(c, c + t).alias("score")]


def summed() -> list[Column]:
    return [F.count("*").alias("n"), F.sum(F.coalesce("score", F.lit(0.0))).alias("score")]


def _moments(value: Column) -> list[Column]:
    return [F.count("*").alias("n"), F.avg(value).alias("score"), F.stddev_samp(value).alias("std"), F.var_samp(value).alias("var")]


def average() -> list[Column]:
    return _moments(F.col("score"))


def half_diluted() -> list[Column]:
    return _moments(F.col("score") * F.col("overlap") / F.col("window_length"))


def fully_diluted() -> list[Column]:
    return _moments(F.col("score") * (F.col("overlap") / F.col("length")) * (F.col("overlap") / F.col("window_length")))


def loci() -> list[Column]:
    """The ids of a window's rows in one list, which is the result asked for and as long as the window has rows."""
    ids = F.transform(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("start", "id")))), lambda x: x["id"])
    return [F.count("*").alias("n"), F.array_join(ids, ",").alias("ids"), F.count_if(F.col("id").isNull()).alias("unknown")]


SCORERS = {
    "fractional_methylation": fractional,
    "sum": summed,
    "average": average,
    "half_weighed_average": half_diluted,
    "full_weighed_average": fully_diluted,
    "locus_collector": loci,
}


def scored(df: DataFrame, keys: list[str], scorer: str) -> DataFrame:
    """df's rows grouped by keys and scored; fractional groups without any c or t are left out."""
    out = df.groupBy(*keys).agg(*SCORERS[scorer]())
    return out.where("sum_c + sum_t > 0") if scorer == "fractional_methylation" else out


def base_frequencies(reads: DataFrame, seq: str = "bases") -> DataFrame:
    """(pos, a, c, g, t, n): shares of the bases at each position of sequences."""
    cut = reads.select(F.posexplode(F.split(F.upper(F.col(seq)), "")).alias("pos", "base")).where("base in ('A', 'C', 'G', 'T')")
    share = lambda b: (F.count_if(F.col("base") == b) / F.count("*")).alias(b.lower())
    return cut.groupBy("pos").agg(*[share(b) for b in "ACGT"], F.count("*").alias("n"))
