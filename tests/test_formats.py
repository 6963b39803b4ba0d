import gzip
import random

import pytest
from pyspark.sql import functions as F

from spanloom.sources import bam, formats
from spanloom.sources import text as T


@pytest.fixture(scope="module")
def read(spark):
    formats.register(spark)
    return lambda kind, path, schema=None, **options: (spark.read.format(kind).schema(schema) if schema else spark.read.format(kind)).options(**options).load(str(path))


def fastq_rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.randrange(1, 60)
        qual = "".join(rng.choice("@+IJ#") for _ in range(size))
        out.append((f"r{i} lane:1", "".join(rng.choices("ACGTN", k=size)), "@" + qual[1:] if i % 3 == 0 else "+" + qual[1:] if i % 3 == 1 else qual))
    return out


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 20])
def test_fastq_by_splits(read, tmp_path, split):
    rows = fastq_rows(120)
    (tmp_path / "a.fastq").write_text("".join(f"@{n}\n{s}\n+{n if i % 5 == 0 else ''}\n{q}\n" for i, (n, s, q) in enumerate(rows)))
    (tmp_path / "_SUCCESS").write_text("")
    got = read("fastq", tmp_path, split_bytes=split if split > 1 else 11)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.rdd.getNumPartitions() > 1 or split > 1000


def test_fastq_columns_and_forms(read, tmp_path):
    rows = fastq_rows(40, 2)
    text = "".join(f"@{n}\r\n{s}\r\n+\r\n{q}\r\n" for n, s, q in rows)
    with gzip.open(tmp_path / "a.fastq.gz", "wt", newline="") as f:
        f.write(text)
    got = read("fastq", tmp_path / "*.gz", "seq string", split_bytes=50)
    assert got.columns == ["seq"] and sorted(r.seq for r in got.collect()) == sorted(s for _, s, _ in rows)
    (tmp_path / "empty.fastq").write_text("")
    assert read("fastq", tmp_path / "empty.fastq").count() == 0


@pytest.mark.parametrize("split", [9, 64, 333, 1 << 20])
def test_fasta_by_splits(read, spark, tmp_path, split):
    rng = random.Random(split)
    rows = [(f"s{i}", f"s{i} some words", "".join(rng.choices("acgtN", k=rng.randrange(0, 400)))) for i in range(30)]
    text = "".join(f">{h}\n" + "".join(s[k : k + 17] + "\n" for k in range(0, len(s), 17)) for _, h, s in rows)
    (tmp_path / "g.fa").write_text(text)
    (tmp_path / "h.fa").write_text(">only\nacgt")
    want = sorted([*rows, ("only", "only", "acgt")])
    assert sorted(map(tuple, read("fasta", tmp_path, split_bytes=split).collect())) == want
    pieces = formats.read_fasta_pieces(spark, str(tmp_path), 10, split).collect()
    assert max(len(p.part) for p in pieces) <= 10
    whole = {}
    for p in sorted(pieces, key=lambda p: (p.seq_id, p.at)):
        assert p.at == len(whole.get((p.seq_id, p.header), "")) + 1
        whole[p.seq_id, p.header] = whole.get((p.seq_id, p.header), "") + p.part
    assert sorted((i, h, s) for (i, h), s in whole.items()) == [w for w in want if w[2]]


def test_gff_takes_filters(read, spark, tmp_path):
    lines = ["##gff-version 3", "# x", "", "bad\tline"] + [f"Chr{i % 3}\tsrc\tgene\t{i * 10}\t{i * 10 + 5}\t{'.' if i % 4 == 0 else i / 2}\t+\t.\tID=g{i}" for i in range(200)]
    (tmp_path / "a.gff").write_text("\n".join(lines) + "\n")
    got = read("gff", tmp_path, split_bytes=100)
    want = T.read_gff(spark, str(tmp_path)).select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 200
    part = read("gff", tmp_path, "sequence string, start long", split_bytes=100).where("sequence = 'chr1' and start >= 500 and start % 20 = 0")
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, want.where("sequence = 'chr1' and start >= 500 and start % 20 = 0").select("sequence", "start").collect()))
    reader = formats.GffReader(formats_schema(spark, "sequence string, start long"), {"path": str(tmp_path)})
    assert list(reader.pushFilters([formats.EqualTo(("sequence",), "chr1"), formats.GreaterThan(("start",), 1500)])) == []
    assert sum(b.num_rows for s in reader.partitions() for b in reader.read(s)) == sum(1 for i in range(200) if i % 3 == 1 and i * 10 > 1500)


def formats_schema(spark, text):
    return spark.createDataFrame([], text).schema


SEQUENCES = [("chr1", 100000), ("RC_chr1", 100000), ("chrM", 5000)]


def sam_rows(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        size = rng.choice((1, 2, 35, 36, 150))
        name = rng.choice(("chr1", "RC_chr1", "chrM", "*"))
        qual = "".join(chr(33 + rng.randrange(60)) for _ in range(size))
        yield {"read": f"read{i // 2}/x", "flag": 4 if name == "*" else rng.choice((0, 16)), "sequence": name, "pos": rng.randrange(1, 5000) if name != "*" else 0, "mapq": rng.randrange(60), "cigar": f"{size}M", "next_sequence": "*", "next_pos": 0, "insert": 0, "seq": "".join(rng.choices("ACGTN", k=size)), "qual": qual}


def sam_line(r):
    return "\t".join(str(r[c]) for c in ("read", "flag", "sequence", "pos", "mapq", "cigar", "next_sequence", "next_pos", "insert", "seq", "qual"))


@pytest.mark.parametrize("block, split", [(60000, 1 << 20), (60000, 3000), (900, 700), (100, 333), (37, 64)])
def test_bam_equals_sam(read, spark, tmp_path, block, split):
    rows = list(sam_rows(400, block))
    data = bam.header_bytes(SEQUENCES) + b"".join(bam.record_bytes(r, {n: i for i, (n, _) in enumerate(SEQUENCES)}) for r in rows)
    (tmp_path / "a.bam").write_bytes(b"".join(bam.block(data[i : i + block]) for i in range(0, len(data), block)) + bam.LAST_BLOCK)
    got = read("bam", tmp_path / "a.bam", split_bytes=split)
    assert sorted(sam_line(r.asDict()) for r in got.collect()) == sorted(map(sam_line, rows))
    sam = T.parse_sam(spark.createDataFrame([("@HD\tVN:1.0",)] + [(sam_line(r),) for r in rows], "value string"))
    assert sorted(map(tuple, bam.read_bam(spark, str(tmp_path / "a.bam"), split).collect())) == sorted(map(tuple, sam.collect()))


def test_bam_written_by_tasks(spark, read, tmp_path):
    rows = list(sam_rows(300, 5))
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "read string, flag int, sequence string, pos long, mapq int, cigar string, next_sequence string, next_pos long, insert long, seq string, qual string").repartition(4)
    folder = f"file://{tmp_path}/out"
    assert len(bam.write_bam(df, folder, SEQUENCES, 500)) == 4
    assert sorted(sam_line(r.asDict()) for r in read("bam", folder, split_bytes=1000).collect()) == sorted(map(sam_line, rows))
    with pytest.raises(Exception, match="no BAM file|no whole block"):
        (tmp_path / "x.bam").write_bytes(b"not a bam file at all, but some bytes")
        bam.read_header(str(tmp_path / "x.bam"))
    assert read("bam", folder).select(F.max("pos")).first()[0] <= 5000
