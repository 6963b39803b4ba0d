import random
import time

import pytest
from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import align, joins, search, seqops, states
from spanloom.sources import parsers
from spanloom.sources.store import IntervalStore
from tests.test_sweep import made


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def plain_hits(reads, genome, most, convert, best, max_hits):
    """Every place of every read by comparing all bases."""
    out = []
    for name, seq in reads:
        own = convert((seq or "").upper())
        found = []
        for seq_id, g in genome if len(own) >= 12 else []:
            g = g.upper()
            c = convert(g)
            for i in range(len(g) - len(own) + 1):
                n = sum(a != b or a not in "ACGT" for a, b in zip(own, c[i : i + len(own)]))
                if n <= most:
                    found.append((n, seq_id, i + 1, ("NN" + g + "NN")[i : i + len(own) + 4]))
        if best and found:
            found = [f for f in found if f[0] == min(found)[0]]
        if max_hits is not None and len(found) > max_hits:
            found = []
        out += [(name, seq, s, p, n, len(found), t) for n, s, p, t in found] or [(name, seq, None, None, None, 0, None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("most, best, max_hits", [(2, True, None), (2, True, 3), (1, False, None), (0, True, 2), (3, False, 40)])
def test_alignment_equals_all_places(spark, most, best, max_hits):
    rng = random.Random(most * 7 + best)
    genome = [(f"g{i}", "".join(rng.choices("ACGT", k=rng.choice((5, 300, 700))))) for i in range(5)]
    genome += [("copy", genome[1][1]), ("poly", "T" * 200 + "C" * 30), ("holes", genome[2][1][:90] + "NNN" + genome[2][1][90:]), ("small", genome[3][1][:200].lower())]
    reads = []
    for i in range(150):
        _, g = rng.choice(genome)
        at, n = rng.randrange(max(1, len(g) - 30)), rng.choice((12, 20, 33, 36))
        s = list(g[at : at + n])
        for _ in range(rng.randrange(4)):
            if s:
                s[rng.randrange(len(s))] = rng.choice("ACGTN")
        reads.append((f"r{i}", "".join(s)))
    reads += [("same", reads[0][1]), ("none", None), ("empty", ""), ("short", "ACGT"), ("ns", "N" * 20), ("ts", "T" * 20)]
    df = spark.createDataFrame(reads, "read string, seq string")
    g = spark.createDataFrame(genome, "seq_id string, seq string")
    convert = lambda s: s.replace("C", "T")
    got = align.align(df, g, most, seed=9, shortest=12, convert=X.c_to_t, best=best, max_hits=max_hits)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_hits(reads, genome, most, convert, best, max_hits)


def test_alignment_of_nothing(spark):
    g = spark.createDataFrame([("g", "ACGTACGTAAAC")], "seq_id string, seq string")
    reads = spark.createDataFrame([("a", "ACG"), ("b", None)], "read string, seq string")
    assert [(r.read, r.hits, r.start) for r in sorted(align.align(reads, g).collect())] == [("a", 0, None), ("b", 0, None)]
    assert align.align(reads.limit(0), g).count() == 0
    assert align.align(reads.withColumn("seq", F.lit("ACGTACGTAAACACGTACGTAAAC")), g.limit(0)).where("hits = 0").count() == 2


def test_bisulfite_reads_of_both_strands(spark):
    rng = random.Random(8)
    g = "".join(rng.choices("ACGT", k=400))
    fasta = spark.createDataFrame([("chr1", g)], "seq_id string, seq string")
    plus, minus = g[100:140].replace("C", "T"), rc(g)[50:90].replace("C", "T")
    second = g[200:240].replace("G", "A")
    reads = spark.createDataFrame([("p", 1, plus), ("m", 1, minus), ("s", 2, second)], "read string, read_no int, seq string")
    got = {r.read: r for r in align.bisulfite_alignments(reads, fasta).collect()}
    assert [(got[k].strand, got[k].start, got[k].stop, got[k].length, got[k].hit) for k in "pms"] == [("+", 101, 140, 400, 0), ("-", 51, 90, 400, 0), ("+", 201, 240, 400, 0)]
    assert got["p"].target == g[98:142] and got["m"].target == rc(g)[48:92]


def test_pieces_in_proportion_to_length(spark):
    took = []
    for n in (2, 8):
        df = spark.range(1).select(F.lit("a").alias("seq_id"), F.expr(f"repeat('ACGTACGGTA', {n * 100000})").alias("seq")).cache()
        df.count()
        began = time.time()
        got = seqops.chunks(df, 300, 3).agg(F.count("*"), F.sum(F.length("part")), F.max("at")).first()
        took.append(time.time() - began)
        size = n * 1000000
        assert tuple(got) == (-(-size // 300), sum(min(303, size - i) for i in range(0, size, 300)), (size - 1) // 300 * 300 + 1)
        df.unpersist()
    assert took[1] < 8 * took[0] + 3


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 1 << 21])
def test_pieces(spark, size, monkeypatch):
    monkeypatch.setattr(seqops, "PIECE", 100)
    rows = [("a", "ACGT" * 60), ("b", ""), ("c", None), ("d", "T")]
    got = seqops.chunks(spark.createDataFrame(rows, "seq_id string, seq string"), size, 5).collect()
    assert sorted(map(tuple, got)) == sorted((i, k + 1, s[k : k + size + 5]) for i, s in rows if s for k in range(0, len(s), size))


def test_differences_and_lengths(spark):
    rng = random.Random(1)
    a = "".join(rng.choices("ACGT", k=500))
    b = "".join(c if rng.random() > 0.05 else rng.choice("ACGT") for c in a)
    x = spark.createDataFrame([("s", a), ("t", a)], "seq_id string, seq string")
    y = spark.createDataFrame([("s", b), ("t", b[:300])], "seq_id string, seq string")
    got = sorted(map(tuple, seqops.differences(x, y, 90).collect()))
    assert got == sorted((i, k + 1, p, q) for i, n in (("s", 500), ("t", 300)) for k, (p, q) in enumerate(zip(a[:n], b[:n])) if p != q)
    with pytest.raises(Exception, match="lengths 500 and 300 do not match"):
        seqops.differences(x, y, 90, equal_lengths=True).collect()
    assert seqops.differences(x.where("seq_id = 's'"), y, 90, equal_lengths=True).count() == sum(p != q for p, q in zip(a, b))


@pytest.mark.parametrize("size", [3, 64, 4096])
def test_marked_differences(spark, size):
    a = [(1, "one", "acgtACGTac"), (2, "two", "aaaa"), (3, "three", "ccc")]
    b = [(1, "uno", "acgaACGTa"), (2, "dos", "aaaa")]
    frame = lambda rows: spark.createDataFrame(rows, "rank long, header string, seq string")
    marked, report = seqops.marked_differences(frame(a), frame(b), size)
    whole = {}
    for r in sorted(marked.collect(), key=lambda r: r["at"]):
        whole[r.rank, r.side, r.header] = whole.get((r.rank, r.side, r.header), "") + r.part
    assert whole == {(1, "a", "one"): "acgTacgtaC", (1, "b", "uno"): "acgAacgta", (2, "a", "two"): "aaaa", (2, "b", "dos"): "aaaa", (3, "a", "three"): "CCC"}
    assert sorted(map(tuple, report.collect())) == [(1, "one", "uno", 2, "strings have different sizes: 10, 9"), (2, "two", "dos", 0, None)]


@pytest.mark.parametrize("most", [1000, 10])
def test_search_equals_join(spark, most):
    (a, x), (b, y) = made(spark, 3, 400), made(spark, 4, 150, 0.4, "other")
    a, b = a.withColumn("start", F.col("start").cast("int")).withColumn("__row", F.lit(1)).drop("__row"), b.unionByName(b.limit(20))
    got = search.search_join(a, b, most_rows=most)
    want = joins.overlap_join(a, b, 64)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    first = search.search_join(a.unionByName(a.limit(5)), b, order=["other"], most_rows=most).groupBy("id", "start", "stop", "sequence").agg(F.min("b_other").alias("x"), F.max("b_other").alias("y"), F.count("*").alias("n")).collect()
    best = {(r.id, r.start, r.stop, r.sequence): r.x for r in want.groupBy("id", "start", "stop", "sequence").agg(F.min("b_other").alias("x")).collect()}
    assert {(r.id, r.start, r.stop, r.sequence): r.x for r in first} == best and all(r.x == r.y for r in first) and sum(r.n for r in first) >= len(best)
    if most == 1000:
        assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert search.search_join(a, b.limit(0)).count() == 0


def test_nested_lists_of_rows_that_lie_within_each_other():
    import numpy as np

    rng = np.random.default_rng(2)
    start = rng.integers(0, 60, 300)
    stop = start + rng.integers(0, 40, 300) * (rng.random(300) < 0.5)
    lists = search.NestedLists(start, stop, np.arange(300))
    for s, t, _ in lists.layers:
        assert (np.diff(s) >= 0).all() and (np.diff(t) >= 0).all()
    q = rng.integers(0, 100, 50)
    r = q + rng.integers(0, 9, 50)
    got = sorted((int(i), int(j)) for x, y in lists.find(q, r) for i, j in zip(x, y))
    assert got == sorted((i, j) for i in range(50) for j in range(300) if q[i] <= stop[j] and r[i] >= start[j])


def test_store_commits_and_prunes(spark, tmp_path):
    rows, _ = made(spark, 5, 300)
    rows = rows.where("start <= stop")
    store = IntervalStore(spark, f"file://{tmp_path}/store", 256)
    assert store.load(rows.where("id < 100"), "one") and not store.load(rows, "one")
    bad = rows.withColumn("start", F.when(F.col("id") == 150, F.raise_error(F.lit("bad line"))).otherwise(F.col("start")).cast("long"))
    with pytest.raises(Exception, match="bad line"):
        store.load(bad.where("id >= 100"), "two")
    assert store.rows().count() == rows.where("id < 100").count() and store.loads() == ["one"]
    # files of an attempt that didn't come to its commit are not read, and are replaced
    store._write(rows.limit(7), "two")
    assert IntervalStore(spark, store.root, 256).rows().count() == rows.where("id < 100").count()
    assert store.load(rows.where("id >= 100"), "two") and store.loads() == ["one", "two"]
    key = lambda df: sorted(map(repr, df.select("sequence", "start", "stop", "id").collect()))
    assert key(store.rows()) == key(rows)
    near = store.overlapping("chr1", [(700, 720), (2000, 2100)])
    assert key(near) == key(rows.where("sequence = 'chr1' and ((start <= 720 and stop >= 700) or (start <= 2100 and stop >= 2000))"))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sequence" in plan and "PushedFilters: [Or(" in plan
    assert len(set(near.inputFiles())) < len(set(store.rows().inputFiles())) or near.select(F.input_file_name()).distinct().count() < store.rows().select(F.input_file_name()).distinct().count()
    store.compact()
    assert key(store.rows()) == key(rows) and len(store.loads()) == 1 and store.clean() == 2 and key(store.rows()) == key(rows)
    with pytest.raises(ValueError, match="but the store has"):
        store.load(rows.drop("id"), "three")
    with pytest.raises(ValueError, match="name"):
        store.load(rows, "a/b")


def test_two_writers_lose_no_load(spark, tmp_path):
    store = IntervalStore(spark, f"file://{tmp_path}/store", 256)
    rows, _ = made(spark, 5, 20)
    store.load(rows, "one")
    raced = []

    def change(names):
        if not raced:
            raced.append(1)
            IntervalStore(spark, store.root, 256).load(rows, "other")
        return [*names, "mine"]

    store._write(rows, "mine")
    store._commit(change)
    assert sorted(store.loads()) == ["mine", "one", "other"]


class Longest:
    """The longest text, and the first of those by order."""

    def start(self):
        return None

    def update(self, state, texts):
        found = [t for t in texts.to_pylist() if t is not None] + ([state] if state is not None else [])
        return min(found, key=lambda t: (-len(t), t)) if found else None

    def merge(self, a, b):
        return min((x for x in (a, b) if x is not None), key=lambda t: (-len(t), t), default=None)

    def finish(self, state):
        return state


def test_user_aggregates(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(3), "x" * rng.randrange(9) + str(i % 10) if i % 7 else None, rng.randrange(20) if i % 5 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, n int, text string, v long").repartition(6)
    groups = {}
    for k, n, t, v in rows:
        groups.setdefault((k, n), []).append((t, v))
    for most in (50_000, 1):
        monkeypatch.setattr(states, "MOST_GROUPS", most)
        got = states.aggregate(df, ["k", "n"], ["text"], Longest(), "string", "longest")
        assert got.columns == ["k", "n", "longest"]
        assert {(r.k, r.n): r.longest for r in got.collect()} == {g: min((t for t, _ in own if t is not None), key=lambda t: (-len(t), t), default=None) for g, own in groups.items()}
    median = states.aggregate(df, ["k"], ["v"], states.CountedQuantile(), "long")
    for r in median.collect():
        own = sorted(v for (k, _), g in groups.items() if k == r.k for _, v in g if v is not None)
        assert r.value == own[(len(own) + 1) // 2 - 1]
    assert states.aggregate(df, [], ["v"], states.CountedQuantile(1.0), "long").collect()[0].value == 19
    assert states.aggregate(df.limit(0), ["k"], ["v"], states.CountedQuantile(), "long").count() == 0


def test_parser_named_in_sql(spark):
    parsers.register_parser(spark, "pairs_of", lambda line: [tuple(x.split("=")) for x in line.split(";") if "=" in x] or None, "key string, value string")
    lines = spark.createDataFrame([("a=1;b=2",), ("none",), (None,), ("c=3",)], "value string")
    got = spark.sql("select l.value as line, t.key, t.value as v from {l} l, lateral pairs_of(l.value) t", l=lines)
    assert sorted((r.line, r.key, r.v) for r in got.collect()) == [("a=1;b=2", "a", "1"), ("a=1;b=2", "b", "2"), ("c=3", "c", "3")]
