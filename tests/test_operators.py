import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import joins as J
from spanloom.operators import methyl as M
from spanloom.operators import seqops as Q
from spanloom.operators import stats as S
from spanloom.operators import windows as W
from spanloom.operators.ordering import Along, running_total

INTERVAL = "sequence string, start long, stop long, id long"


def ranges(spark, n, seed, longest):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.randrange(-2_000, 10_000)
        rows.append((f"chr{rng.randrange(3)}", a, a + rng.choice([0, 1, rng.randrange(longest)]), i))
    return spark.createDataFrame(rows + [("chr0", None, 5, -1), ("chr0", 9, 3, -2), (None, 1, 9, -3)], INTERVAL)


@pytest.mark.parametrize("width, longest", [(16, 5000), (64, 40), (1024, 3000)])
def test_overlap_join_equals_the_plain_join(spark, width, longest):
    a, b = ranges(spark, 300, 1, longest), ranges(spark, 250, 2, 60)
    got = sorted((r.id, r.b_id) for r in J.overlap_join(a, b, width).collect())
    y = J.prefixed(b, "b_")
    want = sorted((r.id, r.b_id) for r in a.join(y, (F.col("sequence") == F.col("b_sequence")) & (F.col("start") <= F.col("b_stop")) & (F.col("stop") >= F.col("b_start")) & F.expr("start <= stop and b_start <= b_stop")).select("id", "b_id").collect())
    assert got == want and got
    assert sorted((r.id, r.b_id) for r in J.overlap_join(a, b, width, salts=3).collect()) == want


def test_range_predicates(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        a, b = sorted(rng.sample(range(60), 2))
        c, d = sorted(rng.sample(range(60), 2))
        rows.append((a, b, c, d))
    df = spark.createDataFrame(rows, "a long, b long, c long, d long")
    for r in df.select("*", X.before("b", "c").alias("before"), X.after("a", "d").alias("after"), X.overlaps("a", "b", "c", "d").alias("over"), X.overlap_ratio("a", "b", "c", "d").alias("ratio")).collect():
        assert r.before + r.after + r.over == 1 and 0 <= r.ratio <= 1 and (r.ratio > 0) == r.over


def test_windows_share_out_single_bases(spark):
    rng = random.Random(4)
    rows = [("chr1", p, p, rng.randrange(5), rng.randrange(5), f"i{p}", 1.0) for p in rng.sample(range(1, 3000), 500)]
    df = spark.createDataFrame(rows, "sequence string, start long, stop long, c long, t long, id string, score double")
    out = W.window_fixed(df, 50, 50, "fractional_methylation", keep_empty=False)
    total = out.agg(F.sum("sum_c"), F.sum("sum_t")).first()
    assert tuple(total) == (sum(r[3] for r in rows), sum(r[4] for r in rows))


def test_running_total(spark):
    rows = [(i, i % 7) for i in range(500)]
    got = {r.k: r.s for r in running_total(spark.createDataFrame(rows, "k long, v long").repartition(9), ["k"], "v", "s", 60).collect()}
    s = 0
    for k, v in rows:
        s += v
        assert got[k] == s


def test_running_total_of_a_large_table_with_other_columns(spark):
    """Skewed keys, columns beside the order, and several ranges: every row number comes once."""
    n = 1_200_000
    df = spark.range(0, n, 1, 12).selectExpr("case when id % 3 = 0 then 7 else xxhash64(id) % 1000 end as k", "id", "repeat('x', int(id % 9)) as text", "1 as one")
    out = running_total(df, ["k", "id"], "one", "n", 150_000)
    r = out.agg(F.count_distinct("n").alias("d"), F.max("n").alias("m"), F.sum(F.length("text")).alias("t")).first()
    assert (r.d, r.m, r.t) == (n, n, sum(i % 9 for i in range(n)))
    first = out.orderBy("n").limit(3).collect()
    assert [(x.k, x.id) for x in first] == [(x.k, x.id) for x in df.orderBy("k", "id").limit(3).collect()]


@pytest.mark.parametrize("rows", [10**6, 7])
def test_along_ranges_equals_plain_windows(spark, rows):
    """Sums, reaches and neighbours in one range and in many, with a hot group, a null group and null values."""
    rng = random.Random(8)
    data = [(rng.choice(["hot", "hot", "hot", "a", None]), i * 3 % 101, i, rng.choice([None, 1, 2, 30])) for i in range(150)]
    df = spark.createDataFrame(data, "sequence string, start long, id long, v long")
    got = Along(df, ["sequence"], ["start", "id"], rows).total("v", "s").total("v", "b", before=True).highest_before("v", "h").neighbour("v", "l").neighbour("v", "f", following=True).done()
    w = Window.partitionBy("sequence").orderBy("start", "id")
    ahead = w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumns({"s": F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)), "b": F.coalesce(F.sum("v").over(ahead), F.lit(0)), "h": F.max("v").over(ahead), "l": F.lag("v").over(w), "f": F.lead("v").over(w)})
    key = lambda r: r.id
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=lambda r: r[2]) == [tuple(r) for r in sorted(want.collect(), key=key)]


def test_reverse_complement_twice(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select(F.translate("text", "bdefhijklmnopqrsuvwxyz", "ACGTACGTACGTACGTACGTAC").alias("s"))
    assert df.where(X.reverse_complement(X.reverse_complement("s")) != F.col("s")).count() == 0


def test_base_calls_by_hand(spark):
    # the target has two bases more on either side; the last base makes no call
    rows = [
        (1, "TGCA", "NN" + "CGCA" + "TT", "chr1", 11, 14, "+", 100),  # C read as T before G; C before A, T
        (2, "AGTT", "CC" + "GGTT" + "NN", "chr1", 21, 24, "+", 100),  # G after C read as A; G after G
        (1, "CGAA", "NN" + "CGAA" + "NN", "chr1", 31, 34, "-", 100),
    ]
    df = spark.createDataFrame(rows, "read_no int, bases string, target string, sequence string, start long, stop long, strand string, length long")
    got = {(r.pos, r.strand, r.context, r.methylated) for r in M.base_calls(df).collect()}
    assert got == {(11, "+", "CG", False), (13, "+", "CHH", True), (21, "-", "CG", False), (22, "-", "CHG", True), (70, "-", "CG", True)}


def test_quartiles_take_elements(spark):
    rows = [(0, f"l{i}", float(i + 1)) for i in range(4)]
    r = S.bin_quartiles(spark.createDataFrame(rows, "bin int, locus string, score double")).first()
    assert (r.q1, r.q2, r.q3) == (2.0, 3.0, 4.0)


def test_offset_strategies(spark):
    loci = spark.createDataFrame([("c", "a", 100, 200, "+"), ("c", "b", 250, 300, "+"), ("c", "d", 320, 400, "-")], "sequence string, locus string, start long, stop long, strand string")
    plain = {r.locus: (r.flag_start, r.flag_stop) for r in W.offset_regions(loci, 100, True, 0).collect()}
    assert plain == {"a": (0, 200), "b": (150, 350), "d": (300, 500)}
    clipped = {r.locus: (r.flag_start, r.flag_stop) for r in W.offset_regions(loci, 100, True, 2).collect()}
    assert clipped == {"a": (0, 200), "b": (201, 300), "d": (320, 500)}
    with pytest.raises(ValueError):
        W.offset_regions(loci, 100, True, 3)


def test_mates(spark):
    kind = "read string, chrom string, coord long, length long, chrom_length long, strand string, hit long"
    left = spark.createDataFrame([("p", "c", 100, 36, 1000, "+", 0), ("q", "c", 10, 36, 1000, "+", 0), ("n", None, None, None, None, None, None), ("o", "c", 5, 36, 1000, "+", 0)], kind)
    right = spark.createDataFrame([("p", "c", 700, 36, 1000, "-", 0), ("q", "c", 100, 36, 1000, "-", 0), ("q", "c", 900, 36, 1000, "-", 1), ("n", "c", 50, 36, 1000, "-", 0)], kind)
    got = {r.read: (r.tag, r.left_coord, r.right_coord, r.score) for r in J.pair_mates(left, right, 50, 200).collect()}
    assert got == {"p": ("U/U", 100, 700, 201), "q": ("U/R", 10, 900, 91), "n": ("NM/U", None, None, None), "o": ("U/NM", 5, None, None)}
    assert {r.read: r.right_coord for r in J.pair_mates(left, right, 50, 200, trust_right=True).collect()}["n"] == 50
    far = J.pair_mates(left, right, 5000, 1, trust_right=True, seed=3).where("read = 'q'").first()
    assert far.right_random and far.right_coord in (100, 900) and not far.left_random and far.left_coord == 10
    rows = J.mate_rows(J.pair_mates(left, right, 50, 200), *(h.withColumns({"seq": F.lit("ACGT"), "mismatches": F.lit(1)}) for h in (left, right)))
    got = {(r.read, r.end): (r.sequence, r.start, r.stop, r.score, r.strand) for r in rows.collect()}
    assert len(got) == 8 and got["p", "right"] == ("c", 700, 735, 1, "-") and got["n", "left"] == (".", 0, 0, 0, ".") and got["q", "right"] == ("c", 900, 935, 2, "-")


def test_fisher_of_large_tables_needs_little_memory():
    """Counts of billions: no table of factorials is built, and ranges are gone through in parts."""
    a = S._fisher([3, 5], [1, 0], [1, 0], [3, 5], "two", cells=7)
    assert abs(a[0] - 0.4857142857) < 1e-9 and abs(a[1] - 2 / 252) < 1e-9
    assert abs(S._fisher([10**9], [10**9], [10**9], [10**9], "point")[0] - 2.52313252e-05) < 1e-8
    assert S._fisher([10**6], [10**6], [10**6], [10**6], "two")[0] > 0.99999


def test_extract_over_pieces_and_for_repeated_rows(spark):
    rng = random.Random(6)
    seq = "".join(rng.choice("ACGT") for _ in range(300))
    fa = spark.createDataFrame([("s", seq), ("t", "ACGT")], "seq_id string, seq string")
    rows = [("s", a, b, rng.choice("+-")) for a, b in [(1, 300), (1, 1), (300, 300), (64, 65), (60, 200), (64, 128), (0, 5), (290, 301), (9, 4)]] * 2 + [("t", 2, 3, "+"), ("gone", 1, 2, "+")]
    out = Q.extract(spark.createDataFrame(rows, "sequence string, start long, stop long, strand string"), fa, size=64).collect()
    want = []
    for s, a, b, strand in rows[:-1]:
        text = {"s": seq, "t": "ACGT"}[s]
        part = text[a - 1 : b] if 1 <= a <= b <= len(text) else None
        want.append((s, a, b, strand, part[::-1].translate(str.maketrans("ACGT", "TGCA")) if part and strand == "-" else part))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)


def test_patch_and_difference(spark):
    fa = spark.createDataFrame([("s", "ACGT" * 50)], "seq_id string, seq string")
    snps = spark.createDataFrame([("s", 3, "T"), ("s", 128, "A"), ("s", 200, "C")], "seq_id string, pos long, base string")
    new = Q.patch(fa, snps, 64)
    got = {(r.pos, r.a, r.b) for r in Q.differences(fa, new, 50).collect()}
    assert got == {(3, "G", "T"), (128, "T", "A"), (200, "T", "C")}


def test_kmers_do_not_depend_on_pieces(spark):
    fa = spark.createDataFrame([("s", "ACGTTGCA" * 30), ("e", ""), ("x", "AC")], "seq_id string, seq string")
    whole = {r.kmer: r.n for r in Q.kmers(fa, 3).collect()}
    assert whole == {r.kmer: r.n for r in Q.kmers(fa, 3, 7).collect()} and sum(whole.values()) == 238


def test_pushed_down_scan(spark, sf):
    """Reading two columns with a filter reads two columns and pushes the filter down."""
    df = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_quantity > 10").select("l_partkey", "l_quantity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan and "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_ranges_are_scanned_once_and_not_moved(spark, monkeypatch):
    """In the plan of a result each table of ranges is read once, and what is carried over is broadcast."""
    from spanloom.operators import ordering

    monkeypatch.setattr(ordering, "RANGE_ROWS", 50)
    df = ranges(spark, 400, 5, 60).where("start <= stop").withColumn("score", F.col("id") % 7 * 1.0)
    for found, scans in ((W.islands(df, 3, "id"), 1), (W.gaps(df, "id"), 1), (W.by_coordinate(df, "id").total("id", "a").highest_before("stop", "b").neighbour("start", "c").done(), 1)):
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len([x for x in plan.splitlines() if "FileScan" in x and "spanloom_ranges" in x]) == scans
        assert "hashpartitioning(__part" not in plan
