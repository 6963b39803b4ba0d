import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import relational as R
from spanloom.sources import sinks as K
from spanloom.sources import text as T


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_comments_pragmas_and_bad_rows(spark):
    df = lines(spark, "", "   ", "# x", "   # y", "## version 3", "##", "a\tb", "chr1\t.\t.\t1\t2\t.\t.\t.\tID=x")
    assert T.parse_gff(df).count() == 1
    kinds = {r.kind: r.n for r in T.row_kinds(df).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"comment": 4, "pragma": 2, "bad": 1, "row": 1}
    assert "version 3" in [r.text for r in T.row_kinds(df).where("kind = 'pragma'").collect()]


def test_attributes(spark):
    row = "CHR1\tTAIR\tmRNA\t10\t20\t.\t+\t.\t"
    texts = ["c=123;n=1234;t=4", " c = 123 ; n=1234 ;t= 4 ", "ID=mRNA0001.3;Note=a;free", "bare", "c=1;c=2*", "k=a,b"]
    got = T.parse_gff(lines(spark, *[row + t for t in texts])).collect()
    by = {r.attributes: r for r in got}
    assert by[texts[0]].attrs == by[texts[1]].attrs == {"c": "123", "n": "1234", "t": "4"}
    assert by[texts[2]].attrs["Note"] == "free" and by[texts[3]].attrs == {"Note": "bare"}
    assert by[texts[4]].attrs == {"c": "2"} and by[texts[4]].asterisk and not by[texts[0]].asterisk
    r = got[0]
    assert (r.sequence, r.source, r.start, r.stop, r.score, r.frame) == ("chr1", "TAIR", 10, 20, None, None)
    loci = T.parse_gff(lines(spark, row + texts[2])).select(X.locus_prefix(X.attribute("attributes", "ID")).alias("p"), X.locus_suffix(X.attribute("attributes", "ID")).alias("s")).first()
    assert (loci.p, loci.s) == ("mRNA0001", "3")


def test_null_predicates(spark):
    df = T.parse_gff(lines(spark, *[f"chr{i % 2 + 1}\t.\tgene\t{i}\t{i + 5}\t.\t+\t.\tID=g{i}" for i in range(1, 11)]))
    assert R.equal_to(df, frame=None).count() == 10 and R.equal_to(df, frame="").count() == 0
    assert R.equal_to(df, start=3).count() == 1 and R.equal_to(df, ID="g4").count() == 1 and R.exists(df, ID="none").first().found is False


def test_fasta_round_trip(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"SEQ{i}", "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 79, 80, 81, 400])))) for i in range(40)]
    df = spark.createDataFrame(rows, "seq_id string, seq string")
    K.write_lines(K.fasta_record(df).coalesce(1), str(tmp_path / "fa"))
    got = {r.seq_id: r.seq for r in T.read_fasta(spark, str(tmp_path / "fa")).collect()}
    assert got == dict(rows)


def test_fastq_of_many_records(spark, tmp_path):
    """Several files and splits, and several ranges of the numbering: no record mixes lines of others."""
    n = 500_000
    df = spark.range(0, n, 1, 3).selectExpr("concat('r', id) as name", "repeat('A', int(id % 5 + 1)) as seq", "repeat('I', int(id % 5 + 1)) as qual")
    K.write_lines(K.fastq_record(df), str(tmp_path / "fq"))
    got = T.read_fastq(spark, str(tmp_path / "fq"))
    r = got.agg(F.count("*").alias("n"), F.count_distinct("name").alias("d"), F.sum(F.length("seq")).alias("s"), F.count_if(F.expr("length(seq) <> int(substring(name, 2)) % 5 + 1 or length(qual) <> length(seq)")).alias("bad")).first()
    assert (r.n, r.d, r.s, r.bad) == (n, n, 3 * n, 0)


def test_fastq_round_trip(spark, tmp_path):
    rows = [(f"r{i}", "ACGT"[: i % 4 + 1], "IIII"[: i % 4 + 1]) for i in range(50)]
    K.write_lines(K.fastq_record(spark.createDataFrame(rows, "name string, seq string, qual string")).coalesce(1), str(tmp_path / "fq"))
    got = {tuple(r) for r in T.read_fastq(spark, str(tmp_path / "fq")).collect()}
    assert got == set(rows)


def test_gff_file_round_trip_and_split(spark, tmp_path):
    rows = [("chr1", "s", "gene", 5 * i, 5 * i + 3, float(i) / 4, "+", None, f"ID=g{i}") for i in range(20)] + [(None, None, None, 1, 2, None, ".", None, "x")]
    df = spark.createDataFrame(rows, "sequence string, source string, feature string, start long, stop long, score double, strand string, frame string, attributes string")
    K.write_lines(K.gff_line(df), str(tmp_path / "gff"))
    back = T.read_gff(spark, str(tmp_path / "gff"))
    assert {(r.sequence, r.start, r.score) for r in back.collect()} == {(r[0], r[3], r[5]) for r in rows}
    K.write_split(df, str(tmp_path / "split"), "sequence")
    assert spark.read.parquet(str(tmp_path / "split")).where("sequence = 'chr1'").count() == 20
    K.write_lines(K.gff_line(df), str(tmp_path / "gff"), mode="append")
    assert T.read_gff(spark, str(tmp_path / "gff")).count() == 2 * len(rows)
    assert T.find_files(spark, str(tmp_path), "*.parquet").count() >= 1


def test_files_by_parts_of_names(spark, tmp_path):
    for name in ("x/a_chr1_CG.gff", "x/y/CG.chr1.gff", "chr1.gff", "x/CG.gff", "x/CHR1-cg.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    found = {r.path.rsplit("/", 1)[1] for r in T.find_files(spark, str(tmp_path), parts=("chr1", "CG")).collect()}
    assert found == {"a_chr1_CG.gff", "CG.chr1.gff", "CHR1-cg.txt"}
    assert T.one_file(spark, str(tmp_path), ("CHR1-cg", "txt")).endswith("CHR1-cg.txt") and T.one_file(spark, str(tmp_path), ("nothing",), "none") == "none"
    for parts in (("chr1",), ("nothing",)):
        with pytest.raises(ValueError):
            T.one_file(spark, str(tmp_path), parts)


def test_memberships_and_slices_as_files(spark, tmp_path):
    lists = spark.createDataFrame([("a", "1"), ("b", "1"), ("a", "2"), ("b", "2"), ("c", "2")], "list string, id string")
    K.write_memberships(R.combinations(lists), str(tmp_path / "sets"))
    assert {(r.combo, str(r.value)) for r in spark.read.text(str(tmp_path / "sets")).collect()} == {("a&b", "1"), ("a&b&c", "2")}
    rows = spark.createDataFrame([("c", i, i + 1, i // 4) for i in range(10)], "sequence string, start long, stop long, slice long")
    K.write_slices(rows, str(tmp_path / "slices"))
    got = spark.read.text(str(tmp_path / "slices"))
    assert {r["slice"]: r["count"] for r in got.groupBy("slice").count().collect()} == {0: 4, 1: 4, 2: 2}
    K.write_split(rows, str(tmp_path / "split"), "sequence", files=3)
    assert spark.read.parquet(str(tmp_path / "split")).where("sequence = 'c'").count() == 10


def test_a_sample_of_too_few_rows_is_an_error(spark):
    assert R.sample_rows(spark.range(5), 5, 1).count() == 5
    with pytest.raises(ValueError):
        R.sample_rows(spark.range(5), 6, 1)


def test_numbers_as_g(spark):
    values = [0.5, 0.0, 100000.0, 1000000.0, 1234567.0, 0.0001, 0.00001234, -2.5, 123456.5, 1e-300, 3.0]
    got = [r.g for r in spark.createDataFrame([(v,) for v in values], "v double").select(X.format_g("v").alias("g")).collect()]
    assert got[:8] == ["%g" % v for v in values[:8]] and got[9:] == ["%g" % v for v in values[9:]]


def test_streaming_ingest(spark, tmp_path):
    from spanloom.streaming.ingest import ingest, stream_gff

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.gff").write_text("chr1\t.\tCG\t5\t5\t.\t+\t.\tc=2;t=3\nchr2\t.\tCG\t7\t7\t.\t+\t.\tc=1;t=0\n")
    args = (str(tmp_path / "out"), str(tmp_path / "check"))
    ingest(stream_gff(spark, str(tmp_path / "in")), *args).awaitTermination()
    (tmp_path / "in" / "b.gff").write_text("chr1\t.\tCG\t9\t9\t.\t+\t.\tc=4;t=4\n")
    ingest(stream_gff(spark, str(tmp_path / "in")), *args).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 3 and got.agg(F.sum("c")).first()[0] == 7


def test_odd_lines_are_told_apart_as_by_their_fields(spark):
    """One condition stands for: no comment, not blank, nine fields, the last not empty."""
    import itertools

    head = "chr1\ts\tf\t1\t2\t.\t+\t."
    odd = ["", " ", "\t", "\t" * 8, " \t" * 8 + " ", "\t" * 8 + "x", "\t" * 9, "#", " # x", "#" + "\t" * 8 + "x", "  #a\rb" + "\t" * 8 + "x", "#a b" + "\t" * 8 + "x", "#a" + "\t" * 8 + "\r", " #" + "\t" * 8 + "x"]
    ends = ["", "x", ".", "#", "*", " ", "\r", "\n", "x\n", "x\ty", "\t", " ", "ID=a;ID=b", "a = b = c ; =d;e=;=;;\t"]
    found = lines(spark, None, *odd, *[head + "\t" + x for x in ends], *["\n" + head + "\t" + x for x in ends], head, *map("".join, itertools.product("#\t \rx", repeat=4)))
    f = F.split("value", "\t")
    want = found.where(~F.col("value").rlike(r"^\s*(#.*)?$") & (F.size(f) == 9) & (f[8] != ""))
    assert sorted(map(str, T.parse_gff(found, False).collect())) == sorted(map(str, T.parse_gff(want, False).collect())) and T.parse_gff(found).count() == want.count() > 20


def test_odd_attributes(spark):
    """A key goes up to the first `=`, a value to the next; the last of equal keys wins, and a token without `=` is a note."""
    texts = {"a=b=c": {"a": "b"}, " a = b ;\tc\t": {"a": "b", "Note": "c"}, "a=": {"a": ""}, "=a": {"": "a"}, "=": {"": ""}, "==x": {"": ""}, "a=1;a=2;b;a=3;c": {"a": "3", "Note": "c"}, ";; ;": {}, "*": {}, "a=b*": {"a": "b"}, "a*b": {"Note": "a*b"}, None: {}}
    got = spark.createDataFrame([(t,) for t in texts], "value string").select("value", X.attribute_map("value").alias("attrs")).collect()
    assert {r.value: r.attrs for r in got} == texts
