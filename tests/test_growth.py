"""What a task holds or does must not grow with the table."""

import re

import pytest
from pyspark.sql import functions as F


def text_of(df):
    return df._jdf.queryExecution().toString().lower()


def test_packing_folds_no_window_anew_for_every_row(spark):
    from spanloom.operators import packing

    rows = spark.createDataFrame([("a", 3 * i, i) for i in range(20)], "__seq string, __at long, __k long")
    found = packing._next_starts(rows, 10)
    assert {(r["__k"], r["__next"]) for r in found.collect()} == {(i, i + 4) for i in range(16)}
    # a frame that reaches to the end is computed anew for each row: quadratic in a range
    assert "unboundedfollowing" not in text_of(found)


def test_point_probabilities_on_a_bound_are_flagged_as_by_sql():
    import duckdb

    from spanloom.operators.stats import _fisher

    p = "exp(lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(a + b + c + d + 1) - lgamma(a + 1) - lgamma(b + 1) - lgamma(c + 1) - lgamma(d + 1))"
    t = duckdb.sql(f"select a, b, c, d, {p} as p from range(20) x(a), range(20) y(b), range(20) z(c), range(17) w(d)").fetchnumpy()
    own = _fisher(t["a"], t["b"], t["c"], t["d"], "point")
    assert ((own < 0.05) == (t["p"] < 0.05)).all()
    assert abs(own - t["p"]).max() < 1e-12


OVERLAPS = ["a1_fractional_loci", "a3_score_sum", "a4_average", "a5_fully_diluted", "a6_half_diluted", "a7_locus_collector", "a36_average_over_annotation", "f20_best_target", "j23_extend_loci", "j23_extended_rows", "w7_dense_bins", "w7_ends_profile", "x6_ends_matrix", "j7_point_in_region"]


@pytest.mark.parametrize("name", OVERLAPS)
def test_large_sides_of_the_overlap_join_are_not_broadcast(spark, name, monkeypatch):
    """A side with many rows by bin is shuffled, however small its file is; results are as by SQL."""
    import os

    import duckdb

    from spanloom.operators import joins, search
    from spanloom.plans import registry
    from tests.test_oracle import SF, check

    monkeypatch.setattr(joins, "MOST_BROADCAST", 0, raising=False)
    monkeypatch.setattr(search.search_join, "__defaults__", (None, 10))
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    keyed = [line for line in plan.splitlines() if "Join" in line and "__key" in line]
    assert keyed and not any("Broadcast" in line for line in keyed)
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    check(spark, con, name)


@pytest.mark.parametrize("name", ["a3_score_sum", "a5_fully_diluted"])
def test_tasks_of_the_overlap_join_are_as_many_as_rows_ask_for(spark, name, monkeypatch):
    """The session's shuffle partitions do not set what a task holds: 8 of them, and a few thousand rows by bin."""
    import os

    import duckdb

    from spanloom.operators import joins
    from spanloom.plans import registry
    from tests.test_oracle import SF, check

    monkeypatch.setattr(joins, "MOST_BROADCAST", 0)
    monkeypatch.setattr(joins, "TASK_ROWS", 500, raising=False)
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    dealt = [int(n) for n in re.findall(r"hashpartitioning\(sequence[^)]*, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert len(dealt) == 2 and len(set(dealt)) == 1 and dealt[0] > 16
    assert re.search(r"SortMergeJoin \[sequence[^\]]*__key[^\]]*\]", plan)
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    check(spark, con, name)


@pytest.mark.parametrize("left, right, rows", [(9, 9, 1), (9, 90000, 2), (90000, 9, 22), (90000, 90000, 44)])
def test_coarse_bins_are_made_only_for_long_intervals_to_meet(spark, monkeypatch, left, right, rows):
    """An interval of 10 bases in bins of 64 is one row, if no interval of the other side is long."""
    from spanloom.operators import joins

    seen = []
    plain = joins._keys
    monkeypatch.setattr(joins, "MOST_BROADCAST", 0)
    monkeypatch.setattr(joins, "_keys", lambda *a: (seen.append(a), plain(*a))[1])
    a = spark.createDataFrame([("c", 0, left, "x")], "sequence string, start long, stop long, id string")
    b = spark.createDataFrame([("c", 5, 5 + right, "y"), ("c", 5, 9, "z")], "sequence string, start long, stop long, locus string")
    found = joins.overlap_join(a, b, 64)
    assert sorted(r.b_locus for r in found.collect()) == ["y", "z"]
    key = plain(*next(k for k in reversed(seen) if k[3]))
    assert a.withColumn("__key", F.explode(key)).count() == rows


def test_scans_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    from spanloom import session

    monkeypatch.setattr(session, "SCAN_ROWS", 100, raising=False)
    spark.range(5000).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = session.spread(spark.read.parquet(str(tmp_path / "t")))
    assert rows.rdd.getNumPartitions() == 50 and rows.agg(F.sum("id")).first()[0] == 5000 * 4999 // 2


def test_scans_are_dealt_without_a_split_being_sorted(spark, tmp_path, monkeypatch):
    """repartition(n) sorts a split's rows before it deals them, in memory that no task metric shows."""
    from spanloom import session
    from spanloom.plans import registry

    monkeypatch.setattr(session, "SCAN_ROWS", 100)
    spark.range(5000).selectExpr("id", "'wide' as wide").repartition(3).write.parquet(str(tmp_path / "t"))
    rows = session.spread(spark.read.parquet(str(tmp_path / "t")), by_place=True)
    sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert rows.columns == ["id", "wide"] and len(sizes) == 50 and max(sizes) <= 103
    assert sorted(r.id for r in rows.select("id").collect()) == list(range(5000))
    assert "wide" not in rows.select("id")._jdf.queryExecution().executedPlan().toString()
    plan = text_of(registry.queries()["a5_fully_diluted"](spark, "/root/testdata/sf0.001"))
    assert "roundrobin" not in plan and "l_discount" not in plan.split("physical plan")[1]


def test_contexts_are_counted_without_a_row_for_each_base(spark):
    from spanloom.plans import q_reads  # noqa: F401
    from spanloom.plans.registry import queries

    plan = text_of(queries()["f14_contexts"](spark, "/root/testdata/sf0.001"))
    assert "explode(sequence(1" not in plan and "least(length(" not in plan.split("generate")[0]


def test_repeats_cost_no_row_for_each_read_and_place(spark):
    """Reads of a repeat are compared once with each kind of bases there."""
    from spanloom.operators import align

    genome = spark.createDataFrame([("g", "TA" * 3000)], "seq_id string, seq string")
    near = spark.createDataFrame([(x, x) for x in ("TA" * i + "TG" + "TA" * (19 - i) for i in range(20))], "read string, seq string")
    found, _ = align._hits(near.select("seq"), genome, 1, 24, lambda x: x)
    per = {r.seq: r.n for r in found.groupBy("seq").agg(F.sum("n").alias("n")).collect()}
    assert len(per) == 20 and set(per.values()) == {2981} and found.count() < 100
    assert align.align(near, genome, 1, max_hits=10).where("hits = 0").count() == 20


def test_small_splits_are_dealt_by_bytes(spark, tmp_path):
    from spanloom.sources import formats

    (tmp_path / "x.fa").write_bytes(b">a\n" + b"ACGT" * 19 + b"\n" + (b"ACGT" * 20 + b"\n") * 4000)
    formats.register(spark)
    pieces = formats.read_fasta_pieces(spark, f"file://{tmp_path}/x.fa", 100, 1 << 10)
    assert pieces.agg(F.sum(F.length("part"))).first()[0] == 76 + 80 * 4000
    assert spark.read.format("fasta").option("pieces", 100).option("split_bytes", 1 << 10).load(f"file://{tmp_path}/x.fa").rdd.getNumPartitions() <= 4


def test_a_load_has_no_file_for_each_bin(spark, tmp_path):
    import glob

    from spanloom.sources.store import IntervalStore

    rows = spark.range(3000).selectExpr("concat('chr', id % 3) as sequence", "id * 7 as start", "id * 7 + 5 as stop", "id")
    store = IntervalStore(spark, f"file://{tmp_path}/store", 16)
    store.load(rows, "one")
    assert len(glob.glob(f"{tmp_path}/store/rows/**/*.parquet", recursive=True)) < 40
    assert store.overlapping("chr1", [(70, 84)]).count() == rows.where("sequence = 'chr1' and start <= 84 and stop >= 70").count() > 0


def test_alignments_of_bam_make_their_own_columns_only(spark, tmp_path):
    from spanloom.sources import bam, formats

    rows = spark.createDataFrame([("r", 16, "chr1", 5, "ACGTN", "5M")], "read string, flag int, sequence string, pos long, seq string, cigar string")
    bam.write_bam(rows, f"file://{tmp_path}/b", [("chr1", 100)])
    formats.register(spark)
    found = bam.read_bam(spark, f"file://{tmp_path}/b")
    assert "qual" not in text_of(found) and tuple(found.first()) == ("r", "chr1", 5, 9, "-", "ACGTN")


@pytest.mark.parametrize("name, heavy", [("s5_indexed_rows", {"attrs", "attributes", "source"}), ("w15_concat_runs", {"seq"})])
def test_ranges_of_an_order_hold_no_wide_columns(spark, name, heavy, monkeypatch):
    """A range has a number of rows, so what is not needed in order is left out of it; lines are parsed once, not for a condition ahead of a shuffle too."""
    from spanloom.operators import ordering
    from spanloom.plans import registry

    written = []
    plain = ordering.write_table
    monkeypatch.setattr(ordering, "write_table", lambda df, kind: (written.append(df), plain(df, kind))[1])
    assert registry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert written and not heavy & set(written[0].columns)
    assert "key is not null" not in text_of(written[0]) and "isnotnull(try_element_at" not in text_of(written[0])


def test_ranges_carry_two_rows_each_and_are_counted_as_they_are_written(spark, monkeypatch):
    """A group that lies in one range takes nothing from another, so what is carried does not grow with the groups; a table is not read to be counted."""
    from pyspark.sql import Window

    from spanloom.operators import ordering

    many = [(f"k{i % 400:03d}", i // 400, i) for i in range(2000)]
    hot, none, again = [("k200", i, i) for i in range(700)], [(None, i % 7, None) for i in range(130)], [("k017", 2, 5)] * 3
    df = spark.createDataFrame(many + hot + none + again, "k string, v long, w long")
    written = []
    plain = ordering.write_table
    monkeypatch.setattr(ordering, "write_table", lambda df, kind: (written.append((kind, plain(df, kind))), written[-1][1])[1])
    with monkeypatch.context() as m:
        m.setattr(type(df), "count", lambda self: pytest.fail("read to be counted"))
        along = ordering.Along(df, ["k"], ["v", "w"], 100)
    got = along.total("w", "s").total("w", "b", before=True).highest_before("w", "h").neighbour("v", "p").neighbour("v", "f", following=True).done()
    own = Window.partitionBy("k").orderBy("v", "w")
    to, ahead = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.coalesce(F.sum("w").over(to), F.lit(0)), F.coalesce(F.sum("w").over(ahead), F.lit(0)), F.max("w").over(ahead), F.lag("v").over(own), F.lead("v").over(own))
    in_order = lambda rows: sorted(map(tuple, rows), key=str)
    assert in_order(got.collect()) == in_order(want.collect())
    carried = [table.count() for kind, table in written if kind == "carried"]
    assert along.parts > 20 and len(carried) == 1 and 0 < carried[0] <= 2 * along.parts


@pytest.mark.parametrize("where", [None, "k is not null"])
def test_ranges_of_an_empty_table(spark, where):
    from spanloom.operators import ordering

    for df in (spark.createDataFrame([], "k string, v long"), spark.createDataFrame([(None, 1)], "k string, v long").where("v > 1")):
        assert ordering.Along(df, ["k"], ["v"], 3, where).total("v", "s").done().collect() == []


def test_a_line_is_made_once_for_the_condition_of_the_parser(spark):
    """The condition is moved ahead of the deal of a scan, where the line is made again each time that the condition names it."""
    from spanloom.plans import registry

    plan = registry.queries()["s6_promoted_columns"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if "Filter" in line]
    assert conditions and all(line.count("concat_ws") == 1 for line in conditions)
