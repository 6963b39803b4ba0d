import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanloom.llm import components, decontam, neardup, sketch, topk, warc, words
from spanloom.llm.components import connected_components
from tests.llm import brute


@given(st.lists(st.text(max_size=40), max_size=12))
@settings(max_examples=60, deadline=None)
def test_fingerprints_split_as_the_patterns_do(texts):
    import pyarrow as pa

    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    low = words.LOWER[data]
    for keep, split in ((words.ALNUM, brute.words), (words.SOLID, lambda t: __import__("re").findall(r"[^\x20\x09-\x0D]+", brute.lower(t)))):
        starts, ends, bounds = words.spans(low, offsets, keep)
        own = [[low[a:b].tobytes().decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(bounds, bounds[1:])]
        assert own == [split(t) for t in texts]
        h = words.fingerprints(low, starts, ends)
        flat = [w for ws in own for w in ws]
        assert len(set(h.tolist())) == len(set(flat)) and all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(min(5, len(flat))) for j in range(len(flat)))


def morse(n):
    """Two different words of 2^n letters that a polynomial modulo a power of two can't tell apart."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_long_words_have_fingerprints_of_their_own():
    for n in (3, 4, 11):
        data = np.frombuffer(" ".join(morse(n)).encode(), np.uint8)
        starts, ends, _ = words.spans(data, np.array([0, len(data)]), words.SOLID)
        assert len(set(words.fingerprints(data, starts, ends).tolist())) == 2


@pytest.mark.parametrize("weak", [False, True])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "ab", "longer words\0".replace(" ", ""), "x" * 17, "x" * 16 + "y", "\0", "a\0"]), max_size=9), max_size=8), st.integers(1, 5))
@settings(max_examples=80, deadline=None)
def test_exact_shingles_do_not_rest_on_fingerprints(weak, docs, k):
    real = words.fingerprints
    try:
        if weak:
            words.fingerprints = lambda data, starts, ends: real(data, starts, ends) & np.uint64(1)
        got = words.exact_shingles([" ".join(d).encode() for d in docs], k)
    finally:
        words.fingerprints = real
    want = [{tuple(d[i : i + k]) for i in range(max(1, len(d) - k + 1))} if d else set() for d in docs]
    for x, s in zip(got, want):
        assert len(x) == len(s)
        for y, t in zip(got, want):
            assert len(set(x.tolist()) & set(y.tolist())) == len(s & t)


def test_search_does_not_rest_on_fingerprints(monkeypatch):
    """Segments and items whose words nearly all share a fingerprint give the same matches."""
    import pyarrow as pa

    docs = ["a b c d e f", "b a", "c c c a b c d", ""]
    items = [(1, "b c d"), (2, "a b"), (3, "zz"), (4, "c c"), (5, "d e f zz")]
    for weak in (False, True):
        if weak:
            real = words.fingerprints
            monkeypatch.setattr(words, "fingerprints", lambda *x: real(*x) & np.uint64(1))
        data, offsets = words.text_bytes(pa.array(docs))
        row = decontam.segment_row(data, offsets, [1, 2, 3, 4])
        p = decontam.Phrases(items, 10)
        lists = decontam._Lists(row, p.terms, p.names)
        order = p.order(np.zeros(len(p.terms), np.int64))
        window, start = lists.occurrences(p, order, np.concatenate(list(decontam._steps(lists, p, order))))
        assert {(int(p.items[w]), int(lists.document(np.array([s]))[0])) for w, s in zip(window, start)} == {(1, 0), (1, 2), (2, 0), (2, 2), (4, 2)}


def test_words_of_one_polynomial_hash_are_told_apart(spark):
    a, b = morse(11)
    df = spark.createDataFrame([(1, a), (2, b), (3, f"{a} x"), (4, f"{b} x")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, shingle=2).collect()} == {i: i for i in range(1, 5)}
    got = decontam.contamination(df, spark.createDataFrame([(7, a)], "item_id long, text string")).collect()
    assert {r.doc_id: r.n_hit for r in got} == {1: 1, 2: 0, 3: 1, 4: 0}


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    seed = sketch.seeds(512)
    a, b = (rng.integers(0, 1 << 62, 3000, dtype=np.uint64) for _ in "ab")
    b[:2000] = a[:2000]
    ra, rb = sketch.registers(a, seed), sketch.registers(b, seed)
    assert (sketch.merge(ra, rb) == sketch.registers(np.union1d(a, b), seed)).all()
    got = sketch.similarity(ra[None], rb[None], np.array([3000.0]), np.array([3000.0]))[0]
    assert abs(got - 0.5) < 0.1
    assert sketch.registers(a[:0], seed).sum() == 0


@pytest.mark.parametrize("most", [0, 250_000])
def test_components(spark, monkeypatch, most):
    monkeypatch.setattr(components, "BROADCAST_LINKS", most)
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)] + [(2000, 2000 + i) for i in range(1, 50)]
    root = {x: x for p in links for x in p if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    want = {x: find(x) for p in links for x in p if None not in p and p[0] != p[1]}
    assert {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_against_brute_force(docs, k):
    rows = docs.select("doc_id", "text").collect()
    want = brute.components([(r.doc_id, r.text) for r in rows], k, 80)
    got = neardup.near_duplicates(docs, shingle=k).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    n = {r.doc_id: r.n_shingles for r in got}
    assert all(n[r.doc_id] == len(brute.shingles(r.text, k)) for r in rows) and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_buckets_are_exact(spark, monkeypatch):
    """A group in which neighbours are alike and ends are not, with small limits so that hot blocks are used."""
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 4)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(5)
    text, rows = [f"w{rng.randrange(10**6)}" for _ in range(60)], []
    for i in range(120):
        for _ in range(rng.randrange(0, 5)):
            text[rng.randrange(60)] = f"w{rng.randrange(10**6)}"
        rows.append((i * 7 % 120, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, shingle=2).collect()}
    assert got == brute.components(rows, 2, 80) and len(set(got.values())) > 1


def test_near_duplicate_edges(odd, clashing, none):
    got = neardup.near_duplicates(odd, shingle=2).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [by[i][0].component_id for i in (1, 2, 6, 7, 8, 9)] == [1, 1, 6, 6, 8, 8]
    assert all(by[i][0].n_shingles == 0 and by[i][0].kept for i in (3, 4, 5)) and by[None][0].kept and len(by[10]) == 2
    assert neardup.near_duplicates(none).count() == 0
    left = neardup.drop_near_duplicates(clashing, shingle=2)
    assert left.columns == ["doc_id"] + [c for c in clashing.columns if c != "doc_id"] and left.count() == odd.count() - 3


def test_contamination_against_brute_force(spark, docs, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in decontam.contamination(docs, bench).collect():
        n, hit, found = brute.contamination(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, set(r["items"]), r.contaminated) == (n, hit, found, hit > 0)


def test_contamination_in_several_passes(spark, docs, sf, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = lambda: {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontam.contamination(docs, bench).collect()}
    whole = rows()
    monkeypatch.setattr(decontam, "PASS_BYTES", 1500)
    assert rows() == whole


def test_contamination_edges(spark, clashing, none):
    items = spark.createDataFrame([(1, "brown fox"), (1, "SOLO"), (2, None), (None, "lazy dog"), (3, ""), (4, "word0 tail word1 tail word2 tail word3 tail word4 tail word5 tail"), (5, "...")], "item_id long, text string")
    got = decontam.contamination(clashing, items).collect()
    assert len(got) == clashing.count()
    by = {r.doc_id: r for r in got}
    assert (by[1].n_hit, by[6].n_hit, by[4].n_words, by[3].contaminated) == (2, 1, 0, False) and by[8]["items"] == [4]
    assert decontam.contamination(none, items).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(clashing, items.limit(0)).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "c b a"), (3, "a q q q q q b c"), (4, "a b"), (5, None), (6, "")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c"), (8, "b a"), (9, None), (None, "a"), (10, ""), (11, "a b c d e f g")], "item_id long, text string")
    index = decontam.build_index(docs)
    got = {(r.doc_id, r.item_id) for r in decontam.proximity_matches(index, items, within=5).collect()}
    assert got == {(1, 7), (2, 7), (1, 8), (2, 8), (4, 8)}


def _brute_top(rows, k):
    q = {i: [int(np.floor(1024 * float(x))) for x in v] for i, v in rows}
    out = set()
    for a in (i for i in q if i % 100 == 0):
        best = sorted(((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a))[:k]
        out |= {(a, n + 1, b, -s) for n, (s, b) in enumerate(best)}
    return out


def test_top_k_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(320, 12)).round(1).astype(np.float32)
    base[50:90] = base[50]
    rows = [(i, base[i].tolist()) for i in range(320)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for size, bytes_ in ((16384, 1 << 20), (37, 300)):
        monkeypatch.setattr(topk, "SEGMENT_ROWS", size)
        monkeypatch.setattr(topk, "PASS_BYTES", bytes_)
        got = {(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id % 100 = 0")).collect()}
        assert got == _brute_top(rows, 10)


def test_top_k_edges(spark):
    rows = [(0, [1.0, -0.5]), (100, [0.3, 0.2]), (7, None), (8, [None, 1.0]), (9, [float("nan"), 1.0]), (10, [float("inf"), 0.0]), (11, []), (None, [1.0, 1.0]), (12, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id % 100 = 0")).collect()}
    assert got == _brute_top([(i, v) for i, v in rows if i in (0, 100, 11, 12)], 10)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_huge_components(spark):
    """Components beyond 64 bits saturate, and scores beyond 64 bits are ranked and then saturate: nothing overflows."""
    rows = [(0, [1e6, 1.0]), (100, [-1e300, 1.0]), (1, [1e300, 0.0]), (2, [1e10, 5.0]), (3, [-1e300, 0.0]), (4, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(topk.top_k(df, df.where("vec_id % 100 = 0")).collect(), key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    top, low = 2**63 - 1, -(2**63)
    assert got[0] == [(1, top), (2, top), (4, 0), (3, low), (100, low)]
    assert got[100] == [(3, top), (4, 0), (0, low), (1, low), (2, low)]


def test_slices_add_up():
    rng = np.random.default_rng(4)
    values, weight = rng.integers(-300, 300, (130, 9)), rng.integers(-400, 400, 9)
    low, bit = topk.slices_of(values)
    total, base = topk.scores(weight, low, bit)
    assert (topk._values(total, np.arange(130)) + base == values @ weight).all()


def test_warc_round_trip(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    extra = [(9001, "u", "same é"), (9002, "u\r\nX: y", "same é"), (9003, None, None), (9004, "w", ""), (None, "n", "same é"), (9002, "again", "same é"), (9005, "z", "x" * 3_000_000)]
    df = pages.unionByName(spark.createDataFrame(extra, "page_id long, url string, html string")).withColumn("digest", F.lit(1)).withColumn("file", F.lit(2))
    folder, index = warc.write_archives(df)
    got = warc.read_archives(folder, index).collect()
    rows = df.select("page_id", "html").collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[9002].record_type == "response" and bytes(by[9002].payload) == "same é".encode() and by[9001].refers_to == 9002 and by[9001].payload is None
    assert by[9003].refers_to == 9004 and by[9005].payload_bytes == 3_000_000 and by[None].record_type == "response"
    for r in rows:
        if r.page_id is not None and by[r.page_id].record_type == "response":
            assert bytes(by[r.page_id].payload) == (r.html or "").encode()
    some = warc.read_archives(folder, index.where("page_id % 7 = 0")).collect()
    assert {r.page_id for r in some} == {r.page_id for r in got if r.page_id is not None and r.page_id % 7 == 0}
    out = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert out[9001].payload_digest == warc.payload_digest("same é".encode()) == out[9002].payload_digest and out[9001].payload_bytes == 7
    assert all(r.record_type == "response" for r in warc.round_trip(df, min_bytes=10**9).collect())
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_members_are_records(spark):
    import gzip

    df = spark.createDataFrame([(1, "http://a", "<p>")], "page_id long, url string, html string")
    folder, index = warc.write_archives(df)
    row = index.first()
    raw = open(f"{folder.removeprefix('file://')}/{row.file}", "rb").read()
    text = gzip.decompress(raw[row.offset : row.offset + row.length])
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"<p>\r\n\r\n")
    assert row.digest == warc.base64.b32encode(hashlib.sha1(b"<p>").digest()).decode()


@pytest.mark.parametrize("most", [0, 100])
def test_rows_without_ids(odd, most):
    from spanloom.llm.shared import without_ids

    gone = odd.where("doc_id in (2, 10) or doc_id is null")
    left = without_ids(odd, "doc_id", gone, most)
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 1, 3, 4, 5, 6, 7, 8, 9, 12]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) or most == 0
