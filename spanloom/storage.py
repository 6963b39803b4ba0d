"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a local master (tests) gets a new local one; a
    cluster gets an error, as its executors would each write to a disk of their own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jdir.get() if jdir.isDefined() else None
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        found = "file://" + tempfile.mkdtemp(prefix="spanloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: its lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_buckets(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """df as a table in the shared folder whose files lie by a hash of a column: what is then grouped, joined or put in
    order by that column, or by it and others, is not shuffled. The table is known to the session under a name of its own."""
    spark = df.sparkSession
    own = f"spanloom_{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", f"{shared_dir(spark)}/{own}").saveAsTable(own)
    return spark.table(own)


def drop_table(df: DataFrame) -> None:
    """Deletes the files of a table made by write_table()."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """df with a broadcast hint if a count shows at most most_rows rows, else df for a shuffled join.

    df is counted here, so it should be a written table."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
