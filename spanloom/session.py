"""The package in Python workers, and scans of few splits."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_BYTES = 16 << 20
_shipped: set[str] = set()


def ship_package(spark: SparkSession, bound_batches: bool = True) -> None:
    """Sends the package's modules to the executors, once for each Spark application.

    bound_batches also bounds the batches that Python workers get to 16 MB, for what the session runs from then on,
    unless it has a lower bound: workers and executors hold several at a time, and texts may be long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(-?\d+)b?", str(spark.conf.get(key)))
    if bound_batches and now and not 0 < int(now[1]) <= ARROW_BYTES:
        spark.conf.set(key, f"{ARROW_BYTES}b")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="spanloom-"), "spanloom_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("spanloom", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


#: Rows of a scan that a task gets about.
SCAN_ROWS = 400_000


def spread(df: DataFrame, by_place: bool = False) -> DataFrame:
    """A scan of fewer splits than there are cores, or of splits of many rows, dealt to all cores and to tasks of about SCAN_ROWS rows, so
    that what a task holds does not grow with a table; others stay as they are. The rows are counted when this is called (of Parquet, in the footers).

    repartition(n) holds and sorts a whole split so that a repeated task deals its rows alike. by_place (Parquet only) deals them in turn
    by their place in their file, which is the same in a repeated task without a sort."""
    splits = df.rdd.getNumPartitions()
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SCAN_ROWS))
    if splits >= wanted:
        return df
    if not by_place:
        return df.repartition(wanted)
    file = df.metadataColumn("_metadata")
    turn = F.pmod(F.xxhash64(file["file_path"]) % wanted + file["row_index"], F.lit(wanted)).cast("int")
    return df.withColumn("__turn", turn).repartitionById(wanted, "__turn").drop("__turn")
