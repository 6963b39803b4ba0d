"""Incremental ingest: new interval files become rows of a table and windows are updated.

The batch operators are the main path; this is for folders that grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom.sources.text import parse_gff


def stream_gff(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the interval rows of files that appear in a folder."""
    return parse_gff(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder))


def ingest(stream: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Appends all rows there are now to a Parquet table dealt by sequence, then stops."""
    rows = stream.withColumn("c", F.try_element_at("attrs", F.lit("c")).try_cast("long")).withColumn("t", F.try_element_at("attrs", F.lit("t")).try_cast("long"))
    return rows.drop("attrs").writeStream.format("parquet").partitionBy("sequence").option("path", table_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_windows(stream: DataFrame, width: int) -> DataFrame:
    """Sums of c and t of single-base rows by window, kept up to date in complete or update mode."""
    at = (F.floor((F.col("start") - 1) / width) * width + 1).alias("win_start")
    c, t = (F.try_element_at("attrs", F.lit(k)).try_cast("long") for k in "ct")
    return stream.groupBy("sequence", at).agg(F.sum(c).alias("sum_c"), F.sum(t).alias("sum_t"))
