"""Tables in the shared folder, and rows left out by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.storage import broadcast_if_small, drop_table, shared_dir, write_table

__all__ = ["broadcast_if_small", "drop_table", "join_hot", "shared_dir", "without_ids", "write_table"]


def without_ids(df: DataFrame, id_col: str, ids: DataFrame, most_rows: int = 2_000_000) -> DataFrame:
    """df without the rows whose id is in ids. The ids are written and counted first: up to most_rows (16 MB of
    longs) they are broadcast and the rows of df stay where they are; more are joined by a shuffle."""
    gone = write_table(ids.select(id_col).distinct(), "ids")
    return df.join(broadcast_if_small(gone, most_rows), id_col, "left_anti")


def join_hot(left: DataFrame, right: DataFrame, key: str, spread: str, size: str = "size", most: int = 2048, most_keys: int = 1_000_000) -> DataFrame:
    """left joined to right on key, where right has one row for each key and in `size` how many rows of left have it.

    A key of more than `most` rows is dealt over several tasks by a hash of left's column `spread`; its row of right is
    repeated for each. The list of such keys is written and counted: up to most_keys are broadcast to left."""
    salts = F.ceil(F.col(size) / most)
    heavy = write_table(right.where(F.col(size) > most).select(key, salts.cast("int").alias("__salts")), "heavy")
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.col("__salts")), F.lit(0)).cast("int")
    dealt = left.join(broadcast_if_small(heavy, most_keys), key, "left").withColumn("__salt", salt).drop("__salts")
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), salts.cast("int")) - 1)))
    return dealt.join(copies, [key, "__salt"]).drop("__salt")
