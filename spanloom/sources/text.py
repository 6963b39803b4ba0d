"""Readers of line formats: functions of a DataFrame of lines (value), and of a path."""

from __future__ import annotations

import re
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import exprs as X


def lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def _missing(x: Column) -> Column:
    return F.nullif(x, F.lit("."))


#: A line of nine tab-separated fields, the last not empty, that is no comment and not blank. One condition, as it is moved ahead of the
#: shuffle in which a scan is dealt, and makes the line again there for each time that it names it.
_GFF_ROW = r"^(?!\s*(#.*)?$)([^\t]*+\t){8}[^\t]++\z"


def parse_gff(df: DataFrame, attributes: bool = True) -> DataFrame:
    """Interval rows of nine tab-separated fields; comments, blank lines and other widths are left out.

    Sequence names are in lower case, `.` is null; attrs is the attribute map and asterisk marks a trailing `*`."""
    rows = df.where(F.col("value").rlike(_GFF_ROW)).select(F.split("value", "\t").alias("f"))
    at = lambda k: _missing(F.col("f")[k])
    out = rows.select(
        F.lower(at(0)).alias("sequence"), at(1).alias("source"), at(2).alias("feature"),
        at(3).try_cast("long").alias("start"), at(4).try_cast("long").alias("stop"), at(5).try_cast("double").alias("score"),
        at(6).alias("strand"), at(7).alias("frame"), at(8).alias("attributes"),
    )
    return out.withColumn("attrs", X.attribute_map("attributes")).withColumn("asterisk", X.has_asterisk("attributes")) if attributes else out


def read_gff(spark: SparkSession, path) -> DataFrame:
    return parse_gff(lines(spark, path))


def row_kinds(df: DataFrame) -> DataFrame:
    """(kind, text): pragma with the text behind ##, comment for others and blanks, bad for other widths, row."""
    pragma = F.regexp_extract("value", r"^\s*##(.*)$", 1)
    kind = F.when(F.col("value").rlike(r"^\s*##"), "pragma").when(F.col("value").rlike(r"^\s*(#.*)?$"), "comment").when(F.size(F.split("value", "\t")) == 9, "row").otherwise("bad")
    return df.select(kind.alias("kind"), F.when(kind == "pragma", F.trim(pragma)).otherwise(F.col("value")).alias("text"))


def promoted(gff: DataFrame, keys: list[str]) -> DataFrame:
    """Attributes as columns."""
    return gff.select("*", *[F.try_element_at("attrs", F.lit(k)).alias(k) for k in keys])


def attribute_keys(gff: DataFrame) -> DataFrame:
    return gff.select(F.explode(F.map_keys("attrs")).alias("key")).distinct()


def list_attributes(gff: DataFrame) -> DataFrame:
    """attrs with arrays as values, split at commas."""
    return gff.withColumn("attrs", F.transform_values("attrs", lambda _, v: F.split(v, ",")))


def parse_fasta(df: DataFrame, upper: bool = True) -> DataFrame:
    """Records (value is one record, its `>` optional): id up to the first blank, and the sequence without blanks."""
    text = F.regexp_replace("value", r"^\s*>", "")
    head = F.regexp_extract(text, r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace(text, r"^[^\r\n]*", ""), r"\s", "")
    case = F.upper if upper else F.lower
    return df.select(case(F.regexp_extract(head, r"^(\S*)", 1)).alias("seq_id"), F.trim(head).alias("header"), case(body).alias("seq")).where("seq_id <> ''")


def read_fasta(spark: SparkSession, path, upper: bool = True) -> DataFrame:
    """Records are cut where a line begins with `>`, so files are read in parallel splits."""
    return parse_fasta(spark.read.option("lineSep", "\n>").text(path), upper)


def parse_fastq(df: DataFrame) -> DataFrame:
    """Records of four lines (value): name, bases, quality."""
    f = F.split("value", "\n")
    return df.select(F.regexp_replace(f[0], "^@", "").alias("name"), f[1].alias("seq"), F.get(f, F.lit(3)).alias("qual"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """Files of four-line records, by byte ranges that find where records begin (sources.formats): no line is numbered or moved."""
    from spanloom.sources.formats import register

    register(spark)
    return spark.read.format("fastq").load(path)


def parse_scarf(df: DataFrame) -> DataFrame:
    """Solexa lines machine:lane:tile:x:y:bases:qualities (characters or blank-separated numbers)."""
    f = F.split("value", ":")
    numbers = F.trim(f[6]).rlike(r"^-?\d+(\s+-?\d+)*$")
    return df.where(F.size(f) == 7).select(F.array_join(F.slice(f, 1, 5), ":").alias("name"), f[5].alias("seq"), F.when(numbers, X.solexa_numbers_to_sanger(F.when(numbers, f[6]).otherwise("0"))).otherwise(X.solexa_to_sanger(f[6])).alias("qual"))


def parse_qseq(df: DataFrame, keep_bad: bool = False) -> DataFrame:
    """Eleven fields; the last one flags reads that passed. Unknown bases `.` become N."""
    f = F.split("value", "\t")
    rows = df.where(F.size(f) == 11)
    rows = rows if keep_bad else rows.where(f[10] == "1")
    name = F.concat(F.concat_ws("_", f[0], f[1]), F.lit(":"), F.concat_ws(":", f[2], f[3], f[4], f[5]), F.lit("#"), f[6], F.lit("/"), f[7])
    return rows.select(name.alias("name"), F.translate(f[8], ".", "N").alias("seq"), f[9].alias("qual"))


def parse_bowtie(df: DataFrame) -> DataFrame:
    """Eight fields of verbose output; mismatches counts the entries of the last."""
    f = F.split("value", r"\s+")
    snp = F.get(f, F.lit(7))
    return df.where(F.size(f) >= 7).select(
        f[0].alias("read"), f[1].alias("strand"), f[2].alias("target"), f[3].try_cast("long").alias("coord"), f[4].alias("seq"), f[5].alias("qual"), f[6].try_cast("int").alias("alternatives"),
        F.when(F.coalesce(snp, F.lit("")) == "", 0).otherwise(F.size(F.split(snp, ","))).alias("mismatches"),
    )


def parse_eland(df: DataFrame, max_hits: int | None = None, best_stratum: bool = False) -> DataFrame:
    """id, seq, ranks (hits of 0, 1, 2, ... mismatches) and hits (chrom, coord, strand, mismatches), best first.

    NM is no hit. With max_hits, a read of which any rank has more hits loses all; best_stratum keeps only hits of
    the fewest mismatches."""
    f = F.split("value", "\t")
    ranks = F.when(f[2] == "NM", F.array(F.lit(0))).otherwise(F.transform(F.split(f[2], ":"), lambda x: x.try_cast("int")))
    part = lambda x, k: F.regexp_extract(x, r"^(.+?):(\d+)([FR])(\d)$", k)
    hit = lambda x: F.struct(part(x, 4).cast("int").alias("mismatches"), part(x, 1).alias("chrom"), part(x, 2).cast("long").alias("coord"), F.when(part(x, 3) == "R", "-").otherwise("+").alias("strand"))
    texts = F.filter(F.split(F.coalesce(F.get(f, F.lit(3)), F.lit("")), ","), lambda x: x.rlike(r"^.+?:\d+[FR]\d$"))
    out = df.where(F.size(f) >= 3).select(F.regexp_replace(f[0], r"^>|/\d+$", "").alias("read"), f[1].alias("seq"), ranks.alias("ranks"), F.array_sort(F.transform(texts, hit)).alias("hits"))
    none = F.array().cast(out.schema["hits"].dataType)
    if max_hits is not None:
        out = out.withColumn("hits", F.when(F.exists("ranks", lambda x: x > max_hits), none).otherwise(F.col("hits")))
    if best_stratum:
        out = out.withColumn("hits", F.filter("hits", lambda h: h["mismatches"] == F.col("hits")[0]["mismatches"]))
    return out


def explode_hits(eland: DataFrame) -> DataFrame:
    """One row for each hit, numbered from 0; reads without one have a null hit."""
    return eland.select("read", "seq", F.posexplode_outer("hits").alias("hit", "h")).select("read", "seq", "hit", "h.*")


def parse_export(df: DataFrame, read_size: int, library_size: int | None = None) -> DataFrame:
    """22 fields; rows of QC, NM or several matches are dropped. centre is the middle of the read.

    With library_size the reads are pairs: the 20th field is the other end's offset, centre is the middle of the
    fragment, and fragments longer than library_size are dropped; attributes names both ends and the fragment's length."""
    f = F.split("value", "\t", -1)
    rows = df.where((F.size(f) == 22) & ~f[10].rlike(r"^(QC|NM|\d+:\d+:\d+)$") & f[12].rlike(r"^\d+$"))
    strand = F.when(f[13] == "R", "-").otherwise("+")
    start, mate = f[12].cast("long"), f[12].cast("long") + f[19].try_cast("long")
    first, lib = F.least(start, mate), F.abs(mate - start) + read_size
    out = rows.select(
        F.lower(F.regexp_replace(f[10], r"\.fa$", "")).alias("sequence"), start.alias("start"), (start + read_size - 1).alias("stop"), strand.alias("strand"), f[8].alias("seq"),
        (first + lib / 2 if library_size else start + F.lit(read_size) / 2).alias("centre"),
        (F.concat(F.lit("/1="), start, F.lit(";/2="), mate, F.lit(";lib="), lib) if library_size else F.concat(F.lit("/1="), start)).alias("attributes"), lib.alias("__lib"),
    )
    return (out.where(F.col("__lib") <= library_size) if library_size else out).drop("__lib")


def parse_seeker(df: DataFrame) -> DataFrame:
    """Eight or nine fields of a bisulfite aligner; the fourth is strand, chromosome (2) and coordinate; on the
    reverse strand the coordinate is moved to the read's other end. calls is its string of one sign for each base."""
    f = F.split("value", "\t")
    place = F.when(F.size(f) == 9, f[3]).otherwise(f[2])
    seq = F.when(F.size(f) == 9, f[5]).otherwise(f[4])
    calls = F.when(F.size(f) == 9, f[6]).otherwise(f[5])
    strand = F.substring(place, 1, 1)
    coord = F.regexp_extract(place, r"(\d+)$", 1).cast("long")
    return df.where(F.size(f).isin(8, 9)).select(
        f[0].alias("read"), strand.alias("strand"), F.concat(F.lit("chr"), F.regexp_extract(place, r"^[+-]0*(\d+)", 1)).alias("sequence"),
        F.when(strand == "-", coord + F.length(seq) - 1).otherwise(coord).alias("start"), seq.alias("seq"), calls.alias("calls"),
    )


def explode_calls(seeker: DataFrame) -> DataFrame:
    """(sequence, pos, call) of each sign that isn't `-`."""
    cut = seeker.select("sequence", "start", "strand", F.posexplode(F.split("calls", "")).alias("j", "call")).where("call not in ('', '-')")
    return cut.select("sequence", F.when(F.col("strand") == "-", F.col("start") - F.col("j")).otherwise(F.col("start") + F.col("j")).alias("pos"), "call")


def parse_peaks(df: DataFrame) -> DataFrame:
    """Seven fields: chromosome, start, stop, height, area, p, corrected p."""
    f = F.split("value", "\t")
    names = ("height", "area", "p", "p_corrected")
    return df.where((F.size(f) == 7) & f[1].rlike(r"^\d+$")).select(F.lower(f[0]).alias("sequence"), f[1].cast("long").alias("start"), f[2].cast("long").alias("stop"), *[f[3 + k].try_cast("double").alias(n) for k, n in enumerate(names)])


def parse_cross_match(df: DataFrame) -> DataFrame:
    """13 blank-separated fields for the forward strand, 14 with a C for the reverse one."""
    f = F.split(F.trim("value"), r"\s+")
    minus = F.size(f) == 14
    return df.where(F.size(f).isin(13, 14)).select(f[0].try_cast("double").alias("score"), F.lower(f[4]).alias("sequence"), f[5].try_cast("long").alias("start"), f[6].try_cast("long").alias("stop"), F.when(minus, "-").otherwise("+").alias("strand"), F.when(minus, f[9]).otherwise(f[8]).alias("feature"))


def parse_agp(df: DataFrame) -> DataFrame:
    """Assembly rows: types N and U (any case) are gaps of a length, others components with bounds from 0."""
    f = F.split("value", "\t")
    gap = F.upper(f[4]).isin("N", "U")
    rows = df.where(~F.col("value").startswith("#") & (F.size(f) >= 8))
    return rows.select(f[0].alias("object"), (f[1].cast("long") - 1).alias("start"), f[2].cast("long").alias("stop"), f[3].cast("int").alias("part_no"), F.upper(f[4]).alias("type"), F.when(gap, f[5].try_cast("long")).alias("length"), F.when(~gap, f[5]).alias("component"), F.when(~gap, F.get(f, F.lit(8))).alias("orientation"))


def parse_segments(df: DataFrame) -> DataFrame:
    """Segments of XML texts (value): (sequence, start, stop, score), one row each."""
    kind = "struct<segment: array<struct<chrom: string, start: long, stop: long, score: double>>>"
    return df.select(F.explode(F.from_xml("value", kind)["segment"]).alias("s")).select(F.lower("s.chrom").alias("sequence"), "s.start", "s.stop", "s.score")


def parse_read_table(df: DataFrame, organelles: tuple[str, ...] = ("c", "m")) -> DataFrame:
    """Positional tables with a header: chromosome, position, strand, c, t of given chromosomes only."""
    f = F.split("value", "\t")
    return df.where((F.size(f) >= 5) & F.lower(f[0]).isin(*organelles)).select(F.concat(F.lit("chr"), F.lower(f[0])).alias("sequence"), f[1].cast("long").alias("pos"), f[2].alias("strand"), f[3].cast("long").alias("c"), f[4].cast("long").alias("t"))


def parse_sam(df: DataFrame) -> DataFrame:
    """Aligned rows; names with rc_ in front are the reverse strand of the rest."""
    f = F.split("value", "\t")
    rows = df.where(~F.col("value").startswith("@") & (F.size(f) >= 11)).where((f[1].cast("int").bitwiseAND(4) == 0) & (f[2] != "*"))
    reverse = F.lower(f[2]).startswith("rc_")
    minus = reverse != (f[1].cast("int").bitwiseAND(16) != 0)
    return rows.select(f[0].alias("read"), F.regexp_replace(F.lower(f[2]), "^rc_", "").alias("sequence"), f[3].cast("long").alias("start"), (f[3].cast("long") + F.length(f[9]) - 1).alias("stop"), F.when(minus, "-").otherwise("+").alias("strand"), f[9].alias("seq"))


def grouped_alignments(sam: DataFrame) -> DataFrame:
    """All alignments of each read as one sorted array."""
    return sam.groupBy("read").agg(F.array_sort(F.collect_list(F.struct("sequence", "start", "strand"))).alias("alignments"))


def parse_list(df: DataFrame) -> DataFrame:
    """Id lists: `id`, `id score`, `id score alternative`, or interval rows whose id is an attribute."""
    f = F.split("value", "\t")
    wide = F.size(f) >= 9
    score = F.when(wide, F.get(f, F.lit(5))).otherwise(F.get(f, F.lit(1)))
    return df.where("trim(value) <> '' and not startswith(value, '#')").select(F.when(wide, X.attribute(F.get(f, F.lit(8)), "ID")).otherwise(f[0]).alias("id"), _missing(score).try_cast("double").alias("list_score"), F.when(~wide, F.get(f, F.lit(2))).alias("alternative"))


def eland_role(gff: DataFrame) -> DataFrame:
    """Reads named in features as id/N:BASES."""
    pair, read, seq = X.read_parts("feature")
    return gff.select("*", pair.alias("pair_id"), read.alias("read_no"), seq.alias("read_seq"))


#: Lengths of the chromosomes of two plant genomes and a fish's, as fixed values.
CHROMOSOME_LENGTHS = {
    "arabidopsis": {"chr1": 30432563, "chr2": 19705359, "chr3": 23470805, "chr4": 18585042, "chr5": 26992728, "chrc": 154478, "chrm": 366924},
    "rice": {
        "chr01": 43596771, "chr02": 35925388, "chr03": 36345490, "chr04": 35244269, "chr05": 29874162, "chr06": 31246789, "chr07": 29688601,
        "chr08": 28309179, "chr09": 23011239, "chr10": 22876596, "chr11": 28462103, "chr12": 27497214, "chrc": 134525, "chrm": 490520,
    },
    "puffer": {
        "1": 22981688, "1_random": 1180980, "2": 21591555, "2_random": 2082209, "3": 15489435, "4": 9874776, "5": 13390619, "6": 7024381, "7": 11693588,
        "8": 10512681, "9": 10554956, "10": 13272281, "11": 11954808, "12": 12622881, "13": 13302670, "14": 10246949, "15": 7320470, "15_random": 3234215,
        "16": 9031048, "17": 12136232, "18": 11077504, "19": 7272499, "20": 3798727, "21": 5834722, "21_random": 3311323, "mt": 16462,
    },
}


def chromosome_lengths(spark: SparkSession, genome: str = "arabidopsis") -> DataFrame:
    return spark.createDataFrame(list(CHROMOSOME_LENGTHS[genome].items()), "sequence string, length long")


def rows_without(gff: DataFrame, key: str) -> DataFrame:
    """One row: how many rows lack a column or attribute, and so are in no group of indexed_by()."""
    from spanloom.operators.relational import column_or_attribute

    return gff.agg(F.count_if(column_or_attribute(gff, key).isNull()).alias("n"))


def indexed_by(gff: DataFrame, key: str, *more: str) -> DataFrame:
    """Rows with their key (a column or attribute) and their rank (from 1) by start within it; `more` completes the
    order. Rows without the key are left out, as rows_without() counts. No group is held as a whole."""
    from spanloom.operators.ordering import Along
    from spanloom.operators.relational import column_or_attribute

    # the rows are written by Along; a condition on the key before that would be moved ahead of the deal of scans, and lines parsed twice
    rows = gff.withColumn("key", column_or_attribute(gff, key)).withColumn("__one", F.lit(1))
    return Along(rows, ["key"], ["start", "stop", *more], where="key is not null").total("__one", "rank").done().drop("__one")


def by_sequence(gff: DataFrame) -> DataFrame:
    """Rows dealt by ranges of (sequence, start) and sorted within each task, so a large sequence takes several tasks."""
    return gff.repartitionByRange("sequence", "start").sortWithinPartitions("sequence", "start")


def find_files(spark: SparkSession, root: str, pattern: str = "*", parts: tuple[str, ...] = ()) -> DataFrame:
    """(path, length) of the files under root, in any folder, whose names match a glob and hold all parts, one behind
    the other in any order and any case. Only names and lengths are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length")
    if not parts:
        return files
    orders = ("|".join(".*".join(re.escape(p) for p in order) for order in permutations(parts)))
    return files.where(F.regexp_extract("path", r"[^/]*$", 0).rlike(f"(?i){orders}"))


def one_file(spark: SparkSession, root: str, parts: tuple[str, ...], default: str | None = None) -> str:
    """The path of the one file that find_files() finds; the default where there is none. More than one is an error."""
    found = [r.path for r in find_files(spark, root, parts=parts).limit(2).collect()]
    if len(found) > 1 or not (found or default):
        raise ValueError(f"expected one file with {parts} under {root}, found {'several' if found else 'none'}")
    return found[0] if found else default
