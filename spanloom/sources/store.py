"""Interval rows kept in a folder: loaded in commits, laid out by place, and read by range."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bases of a bin of the layout.
BIN = 1 << 17


class IntervalStore:
    """Rows with sequence, start and stop in Parquet files under rows/load=.../sequence=..., sorted by bin and start.

    A load is written to a folder of its own and counts once the manifest names it. A manifest is a file of one line for each
    load; a new version is a new file, which only one writer can make, so a load that fails leaves nothing that is
    read, and a reader sees whole loads. A load whose name is in the manifest is not loaded again.

    A row lies in the bin of its start, one longer than a bin in bin -1, so a range is in few bins: reads prune folders by sequence,
    and files, row groups and pages by the bounds of bin and start. A load has about a file for each task that writes it, however many
    bins there are. Rows of a null sequence or start are kept, the former in a folder of their own."""

    def __init__(self, spark: SparkSession, root: str, bin_size: int = BIN):
        self.spark, self.root, self.bin = spark, root.rstrip("/"), bin_size

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        path, fs = self._path("manifest")
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n) for n in names if re.fullmatch(r"\d{12}", n))

    def loads(self) -> list[str]:
        """The names of the loads that are committed, in order."""
        versions = self._versions()
        if not versions:
            return []
        return [r.value for r in self.spark.read.text(f"{self.root}/manifest/{versions[-1]:012d}").collect()]

    def _commit(self, change) -> list[str]:
        """The next version of the manifest: change(names of loads) as of when it is made."""
        while True:
            versions = self._versions()
            names = change(self.loads())
            # a file is written under another name and then renamed, which fails where that version is there already
            path, fs = self._path(f"manifest/{(versions[-1] if versions else 0) + 1:012d}")
            part, _ = self._path(f"manifest/part-{uuid.uuid4().hex}")
            out = fs.create(part)
            out.write(bytearray("".join(n + "\n" for n in names).encode()))
            out.close()
            try:
                done = not fs.exists(path) and fs.rename(part, path)
            except Py4JJavaError:
                done = False
            if done:
                return names
            fs.delete(part, False)

    def _write(self, df: DataFrame, name: str) -> None:
        at = F.when(F.col("stop") - F.col("start") >= self.bin, F.lit(-1).cast("long")).otherwise(F.floor(F.col("start") / self.bin))
        rows = df.withColumn("bin", at)
        rows = rows.repartitionByRange("sequence", "bin", "start").sortWithinPartitions("sequence", "bin", "start")
        rows.write.mode("overwrite").partitionBy("sequence").parquet(f"{self.root}/rows/load={name}")

    def load(self, df: DataFrame, name: str) -> bool:
        """Adds the rows of df as the load of that name; False if it is there already."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
            raise ValueError(f"a load's name has letters, digits and _ . - only: {name}")
        if name in self.loads():
            return False
        self.schema_of(df)
        self._write(df, name)
        self._commit(lambda names: names if name in names else [*names, name])
        return True

    def schema_of(self, df: DataFrame | None = None):
        """The schema of the rows; a load must have that of the first one."""
        path, fs = self._path("schema.json")
        if df is not None and not fs.exists(path):
            out = fs.create(path, False)
            out.write(bytearray(df.schema.json().encode()))
            out.close()
        from pyspark.sql.types import StructType
        import json

        text = self.spark.read.text(f"{self.root}/schema.json", wholetext=True).first()
        schema = StructType.fromJson(json.loads(text.value))
        if df is not None and [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"rows of {df.schema.simpleString()}, but the store has {schema.simpleString()}")
        return schema

    def rows(self) -> DataFrame:
        """All rows of committed loads, with the columns load and bin."""
        schema = self.schema_of()
        paths = [f"{self.root}/rows/load={n}" for n in self.loads()]
        wide = schema.add("bin", "long").add("load", "string")
        if not paths:
            return self.spark.createDataFrame([], wide)
        return self.spark.read.schema(wide).option("basePath", f"{self.root}/rows").parquet(*paths)

    def overlapping(self, sequence: str, ranges: list[tuple[int, int]]) -> DataFrame:
        """Rows of a sequence that overlap any of the ranges (closed, from 1): only bins near them are read."""
        hit = F.lit(False)
        for start, stop in ranges:
            near = F.col("bin").between((start - self.bin) // self.bin, stop // self.bin) | (F.col("bin") == -1)
            hit = hit | (near & (F.col("start") <= stop) & (F.col("stop") >= start))
        return self.rows().where((F.col("sequence") == sequence) & hit)

    def compact(self) -> None:
        """Makes one load of all, so that many small ones don't add up; the loads before are no longer named, and their
        names can be loaded again. Their files stay for readers that have begun: see clean()."""
        before = self.loads()
        name = f"compact-{uuid.uuid4().hex}"
        self._write(self.rows().drop("bin", "load"), name)
        self._commit(lambda names: [name, *[n for n in names if n not in before]])

    def clean(self) -> int:
        """Deletes the files of loads that the manifest doesn't name, when nobody loads or reads old versions; how many."""
        path, fs = self._path("rows")
        kept = {f"load={n}" for n in self.loads()}
        gone = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName() not in kept] if fs.exists(path) else []
        for p in gone:
            fs.delete(p, True)
        return len(gone)
