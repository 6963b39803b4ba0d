"""Filters, sets, sorts and coordinate rewrites of interval rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.storage import broadcast_if_small, write_table


def column_or_attribute(df: DataFrame, name: str, attributes: str = "attrs") -> Column:
    """A column of df by name, else an entry of its attribute map."""
    return F.col(name) if name in df.columns else F.try_element_at(F.col(attributes), F.lit(name))


def extract_column(df: DataFrame, name: str, distinct: bool = False, ordered: bool = False) -> DataFrame:
    out = df.select(column_or_attribute(df, name).alias("value")).dropna()
    out = out.distinct() if distinct else out
    return out.orderBy("value") if ordered else out


def rename_feature(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("feature", F.lit(name))


def equal_to(df: DataFrame, **values) -> DataFrame:
    """Rows equal to all given values, where null equals null."""
    return df.where(reduce(lambda a, b: a & b, (column_or_attribute(df, k).eqNullSafe(F.lit(v)) for k, v in values.items()), F.lit(True)))


def exists(df: DataFrame, **values) -> DataFrame:
    """One row: whether such a row exists."""
    return equal_to(df, **values).limit(1).agg((F.count("*") > 0).alias("found"))


def score_filter(df: DataFrame, include: bool, low: float = 0, high: float = 0, shortest: int = 0, longest: int = 0, feature: str | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Keeps (include) or drops the rows within all bounds that aren't 0; lengths are stop - start. Rows of
    null score always pass. ids (id) narrows the matching rows to those listed."""
    hit = F.lit(True)
    for bound, test in ((low, F.col("score") >= low), (high, F.col("score") <= high), (shortest, F.expr("stop - start") >= shortest), (longest, F.expr("stop - start") <= longest)):
        hit = hit & test if bound else hit
    if feature is not None:
        hit = hit & (F.col("feature") == feature)
    if ids is not None:
        df = df.join(ids.select("id").distinct().withColumn("__listed", F.lit(True)), "id", "left")
        hit = hit & F.col("__listed").isNotNull()
    keep = hit if include else ~hit
    return df.where(F.col("score").isNull() | F.coalesce(keep, F.lit(not include))).drop("__listed")


def sample_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Exactly n rows at random; an error if there are fewer, as a count shows when the sample is asked for."""
    if (found := df.limit(n).count()) < n:
        raise ValueError(f"a sample of {n} rows was asked of {found}")
    return df.orderBy(F.rand(seed)).limit(n)


def listed_rows(df: DataFrame, ids: DataFrame, low: float = 0, high: float = 0, in_order: bool = False) -> DataFrame:
    """Rows whose id is listed with a score within bounds that aren't 0; in the list's order if asked."""
    wanted = ids.where(F.col("list_score").isNotNull())
    wanted = wanted.where(F.col("list_score") >= low) if low else wanted
    wanted = wanted.where(F.col("list_score") <= high) if high else wanted
    out = df.join(wanted, "id")
    return out.orderBy("ordinal") if in_order else out


def unseen_ids(ids: DataFrame, df: DataFrame) -> DataFrame:
    return ids.join(df, "id", "left_anti")


def offset_coordinates(df: DataFrame, upstream: int, downstream: int) -> DataFrame:
    """Rows with flanks by strand; starts under 0 become 0, and rows turned round are dropped."""
    minus = F.col("strand") == "-"
    start = F.col("start") - F.when(minus, downstream).otherwise(upstream)
    stop = F.col("stop") + F.when(minus, upstream).otherwise(downstream)
    return df.withColumn("__a", F.greatest(F.lit(0).cast("long"), start)).withColumn("stop", stop).withColumn("start", F.col("__a")).drop("__a").where("start <= stop")


def flip_coordinates(df: DataFrame, lengths: DataFrame, most_sequences: int = 500_000) -> DataFrame:
    """Coordinates on the other strand: length + 1 - x; start and stop keep their places. lengths is written and counted
    when this is called, and broadcast up to most_sequences: a few sequences would make a few tasks of df."""
    both = df.join(broadcast_if_small(write_table(lengths, "lengths"), most_sequences), "sequence")
    return both.withColumn("start", F.col("length") + 1 - F.col("start")).withColumn("stop", F.col("length") + 1 - F.col("stop")).withColumn("strand", F.lit("-")).drop("length")


def expand(df: DataFrame) -> DataFrame:
    """One row for each base."""
    return df.withColumn("pos", F.explode(F.sequence("start", "stop"))).withColumn("start", F.col("pos")).withColumn("stop", F.col("pos")).drop("pos")


def ensure_all(loci: DataFrame, scores: DataFrame, missing: float = 0.0) -> DataFrame:
    """All loci with their scores, or the given one."""
    return loci.select("locus").distinct().join(scores, "locus", "left").fillna(missing, ["score"])


def combinations(lists: DataFrame) -> DataFrame:
    """(id, combo): the lists (list, id) that each id is in, sorted and joined by `&`."""
    return lists.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("list")), "&").alias("combo"))


def membership(lists: DataFrame) -> DataFrame:
    """(combo, n): how many ids are in exactly each combination of lists (list, id)."""
    return combinations(lists).groupBy("combo").agg(F.count("*").alias("n"))


def distinct_ranges(df: DataFrame) -> DataFrame:
    return df.select("sequence", "start", "stop").distinct()


def score_table(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """A column of scores for each table, by key."""
    parts = [t.select(key, F.col("score").alias(name)) for name, t in tables.items()]
    return reduce(lambda a, b: a.join(b, key, "full"), parts)


def compile_loci(df: DataFrame) -> DataFrame:
    """Equal coordinates as one row: sums of c and t, their ratio, and the least of other columns."""
    c, t = F.sum("c"), F.sum("t")
    return df.groupBy("sequence", "start", "stop").agg(c.alias("c"), t.alias("t"), F.try_divide(c, c + t).alias("score"), F.min("feature").alias("feature"), F.min("strand").alias("strand"))


def sort_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


def collect_rows(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The rows of each group as an array of structs, sorted: the result asked for is as long as the group, so keys
    should tell small groups apart."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))
