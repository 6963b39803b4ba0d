"""Renderers of rows to the lines of text formats, and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import exprs as X


def _text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("."))


def gff_line(df: DataFrame, source: str | None = None) -> DataFrame:
    """(value) of interval rows: null as `.`, scores as %g writes them."""
    return df.select(gff_line_of(df, source).alias("value"))


def gff_line_of(df: DataFrame, source: str | None = None) -> Column:
    """The interval line of df's rows as a column."""
    have = lambda c: F.col(c) if c in df.columns else F.lit(None)
    fields = [have("sequence"), F.lit(source) if source else have("source"), have("feature"), have("start"), have("stop"), X.format_g("score") if "score" in df.columns else F.lit(None), have("strand"), have("frame"), have("attributes")]
    return F.concat_ws("\t", *[_text(x) for x in fields])


def with_header(lines: DataFrame, header: list[str]) -> DataFrame:
    """The lines after comment lines that tell where they come from."""
    spark = lines.sparkSession
    return spark.createDataFrame([(f"# {h}",) for h in header], "value string").unionByName(lines)


def fasta_record(df: DataFrame, width: int = 80) -> DataFrame:
    """(value) of records: `>id`, then lines of `width` bases."""
    body = F.regexp_replace(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"), "\n$", "")
    return df.select(F.concat(F.lit(">"), "seq_id", F.lit("\n"), body).alias("value"))


def fastq_record(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual").alias("value"))


def soft_table(df: DataFrame, order: list[str], value: str) -> DataFrame:
    """(id_ref, value) with a running reference number in the given order."""
    from spanloom.operators.ordering import running_total

    return running_total(df.withColumn("__one", F.lit(1)), order, "__one", "id_ref").select("id_ref", F.col(value).alias("value"))


#: Lines of a SOFT table before and behind its rows, as fixed values.
SOFT_HEAD = (
    "#ID_REF = ",
    "#VALUE = Fractional methylation: c / (c + t)",
    "#NoC = Number of sequenced methylated cytosines",
    "#NoT = Number of sequenced non-methylated cytosines",
    "Coord = Forward strand position",
    "Strand = Orientation of alignment",
    "!Sample_table_begin",
    "ID_REF\tVALUE\tNoC\tNoT\tChr\tCoord\tStrand",
)
SOFT_TAIL = "!Sample_table_end"


def soft_lines(df: DataFrame, order: list[str]) -> DataFrame:
    """(line, value): numbered lines of a SOFT table of rows (sequence, start, score, c, t, strand) in the given order,
    with the header lines first and the closing line last; write them sorted by line."""
    rows = soft_table(df.withColumn("__row", F.struct("sequence", "start", "score", "c", "t", "strand")), order, "__row")
    text = F.concat_ws("\t", "id_ref", X.format_g("value.score"), "value.c", "value.t", "value.sequence", "value.start", "value.strand", F.lit(""))
    spark = df.sparkSession
    head = spark.createDataFrame([(i - len(SOFT_HEAD) + 1, t) for i, t in enumerate(SOFT_HEAD)], "line long, value string")
    tail = rows.agg((F.count("*") + 1).alias("line"), F.lit(SOFT_TAIL).alias("value"))
    return head.unionByName(rows.select(F.col("id_ref").alias("line"), text.alias("value"))).unionByName(tail)


def attribute_table(gff: DataFrame, keys: list[str]) -> DataFrame:
    """Fixed columns and the attributes named in keys, for a table with a header."""
    return gff.select("sequence", "source", "feature", "start", "stop", "score", "strand", *[F.try_element_at("attrs", F.lit(k)).alias(k) for k in keys])


def eland_line(df: DataFrame) -> DataFrame:
    """(value) of ELAND rows from reads (read, seq, chrom, coord, strand, mismatches); no chrom is NM."""
    ranks = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.when(k == F.col("mismatches"), "1").otherwise("0")), ":")
    hit = F.concat(F.col("chrom"), F.lit(":"), F.col("coord").cast("string"), F.when(F.col("strand") == "-", "R").otherwise("F"), F.col("mismatches").cast("string"))
    return df.select(F.when(F.col("chrom").isNull(), F.concat_ws("\t", "read", "seq", F.lit("NM"))).otherwise(F.concat_ws("\t", "read", "seq", ranks, hit)).alias("value"))


def fragments(bowtie: DataFrame) -> DataFrame:
    """Interval rows of single Bowtie hits."""
    return bowtie.select(F.lower("target").alias("sequence"), F.lit("bowtie").alias("source"), F.col("read").alias("feature"), (F.col("coord") + 1).alias("start"), (F.col("coord") + F.length("seq")).alias("stop"), F.col("mismatches").cast("double").alias("score"), "strand")


def paired_fragments(left: DataFrame, right: DataFrame) -> DataFrame:
    """Interval rows of Bowtie mates: a fragment from the left end's coordinate to the right end's last base, named by
    the read; ends are paired by read, or, with a column hit on both sides, by read and hit."""
    keys = ["read", "hit"] if "hit" in left.columns and "hit" in right.columns else ["read"]
    b = right.select(*keys, F.col("coord").alias("__coord"), F.length("seq").alias("__length"))
    both = left.join(b, keys)
    return both.select(F.lower("target").alias("sequence"), F.lit("bowtie").alias("source"), F.lit("frag").alias("feature"), F.col("coord").alias("start"), (F.col("__coord") + F.col("__length") - 1).alias("stop"), F.lit(None).cast("double").alias("score"), F.lit("+").alias("strand"), F.concat(F.lit("alt="), F.col("alternatives").cast("string")).alias("attributes"))


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lines.select("value").write.mode(mode).text(path)


def write_split(df: DataFrame, path: str, by: str, files: int = 8) -> None:
    """One folder of files for each value of a column; rows are sorted by it, so a task has one file open.

    The rows of a value are dealt over up to `files` tasks, by start: a hot value is no single task."""
    df.repartition(F.col(by), F.pmod(F.xxhash64("start"), F.lit(files))).sortWithinPartitions(by, "start").write.partitionBy(by).parquet(path)


def write_memberships(combos: DataFrame, path: str) -> None:
    """Ids with the combination of lists that they are in (id, combo), as lines in one folder for each combination."""
    combos.select("combo", F.col("id").alias("value")).repartition("combo", F.pmod(F.xxhash64("value"), F.lit(8))).sortWithinPartitions("combo", "value").write.partitionBy("combo").text(path)


def write_slices(sliced: DataFrame, path: str, column: str = "slice") -> None:
    """Rows as interval lines in one folder for each number of their slice, as partition_slices() gives them."""
    lines = sliced.select(column, gff_line_of(sliced).alias("value"))
    lines.repartition(column, F.pmod(F.xxhash64("value"), F.lit(8))).write.partitionBy(column).text(path)
