import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanloom.llm import centroids, fim, license, registry
from tests.llm import brute

AUTOMATON = license.build()
WORDS = [[w.decode() for w in license.words_of(t.encode())] for _, t in license.TEMPLATES]
NAMED = [(brute.words(p), label) for p, label in license.PHRASES]


def rows(df):
    return sorted(df.collect(), key=repr)


# licences


def plain_scan(text, least=4, gap=24, coverage=0.7, enough=30):
    """Every step by plain comparison of word lists: (places of phrases, spans, score)."""
    w = brute.words(text)
    base = [(label, i, i + len(p)) for i in range(len(w)) for p, label in NAMED if w[i : i + len(p)] == p]
    grams = {tuple(t[i:j]) for t in WORDS for i in range(len(t)) for j in range(i + 1, len(t) + 1)} | {tuple(p[i:j]) for p, _ in NAMED for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
    longest = [0]
    for i in range(1, len(w) + 1):
        longest.append(next((n for n in range(longest[-1] + 1, 0, -1) if tuple(w[i - n : i]) in grams), 0))
    chains = []
    for end in range(1, len(w) + 1):
        n = longest[end]
        if n < least or (end < len(w) and longest[end + 1] == n + 1):
            continue
        for t, template in enumerate(WORDS):
            for at in range(n, len(template) + 1):
                if template[at - n : at] != w[end - n : end]:
                    continue
                before = []
                for c in chains:
                    over = max(0, c[2] - (end - n), c[3] - (at - n))
                    if c[0] == t and c[2] < end and c[3] < at and over < n and end - n - c[2] < gap and at - n - c[3] < gap:
                        before.append((c[4] + n - over, c[1]))
                value, start = max(before, default=(n, end - n))
                chains.append((t, start, end, at, value))
    score = 1.0 if base else max((c[4] / len(WORDS[c[0]]) for c in chains), default=0.0)
    fine = sorted({(-c[4], len(WORDS[c[0]]), c[1], c[2], c[0]) for c in chains if c[4] >= min(enough, coverage * len(WORDS[c[0]]))})
    spans = []
    for value, size, s, e, t in fine:
        if all(e <= x[1] or x[2] <= s for x in spans):
            spans.append((license.TEMPLATES[t][0], s, e, -value, size))
    return len(w), sorted(base), sorted(spans, key=lambda x: x[1]), score


def scanned(df, **more):
    out = {}
    for r in license.scan(df, AUTOMATON, **more).collect():
        out.setdefault(r.doc_id, []).append((r.n_words, sorted(map(tuple, r.base)), [tuple(s) for s in r.spans], r.score))
    return out


def worn_texts(seed, n):
    """Texts of licence parts with words lost, changed and put in, and of prose."""
    rng = random.Random(seed)
    prose = "the river this software of a copy lorem license version to use MIT und der CC by-nc".split()
    for _ in range(n):
        out = []
        for _ in range(rng.randrange(1, 5)):
            t = list(rng.choice(WORDS))
            i = rng.randrange(len(t))
            t = t[i : i + rng.randrange(1, 60)] if rng.random() < 0.5 else t
            worn = rng.choice((0, 0.03, 0.1))
            for x in t:
                r = rng.random()
                out += [x] if r >= worn else [] if r < worn / 3 else [rng.choice(prose)] if r < 2 * worn / 3 else [x, rng.choice(prose)]
            out += rng.choices(prose, k=rng.randrange(30))
        yield "".join(x.upper() + rng.choice((" ", "\n", ", ")) if rng.random() < 0.2 else x + " " for x in out)


def test_licenses_equal_a_plain_version(spark):
    texts = [*worn_texts(5, 60), "", None, "cc by cc by", "the MIT License", "gnu general public license apache license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = scanned(df)
    for i, t in enumerate(texts):
        assert got[i] == [plain_scan(t or "")], t
    assert sum(bool(x[0][2]) for x in got.values()) > 30 and any(len(x[0][2]) > 1 for x in got.values())


def test_matching_statistics_of_random_sequences():
    rng = random.Random(2)
    templates = [("x", " ".join(rng.choices("abc", k=rng.randrange(1, 14)))) for _ in range(12)]
    a = license.build(templates, [("a b", "p"), ("b", "q")], least=2)
    split = [t.split() for _, t in templates]
    for _ in range(40):
        w = rng.choices("abcz", k=30)
        n, hits, _ = license.scan_text(" ".join(w).encode(), a, least=2)
        want = [(k, i) for k, p in enumerate((["a", "b"], ["b"])) for i in range(len(w)) if w[i : i + len(p)] == p]
        assert n == len(w) and sorted(hits) == sorted(want)
    # every place of every substring is known to its state
    for t in split:
        for i, j in itertools.combinations(range(len(t) + 1), 2):
            s = 0
            for x in t[i:j]:
                s = a.step[s][a.words[x.encode()]]
            if j - i >= 2:
                assert set(a.places[s]) == {(k, e) for k, u in enumerate(split) for e in range(j - i, len(u) + 1) if u[e - (j - i) : e] == t[i:j]}


def test_licenses_are_streamed_over_pieces(monkeypatch):
    text = "".join(worn_texts(9, 8)).encode()
    whole = license.scan_text(text, AUTOMATON)
    monkeypatch.setattr(license, "pieces_of", lambda t, f=license.pieces_of: f(t, 7))
    assert license.scan_text(text, AUTOMATON) == whole


def test_time_grows_with_the_text():
    import time

    text = " ".join(t for _, t in license.TEMPLATES).encode() * 20
    took = []
    for n in (1, 4):
        began = time.process_time()
        found = license.scan_text(text * n, AUTOMATON)
        license.best_spans(found[2], AUTOMATON, 0.7, 30)
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0]


def test_license_edges(spark, odd, clashing, none):
    got = scanned(clashing)
    assert got == scanned(odd) and sum(map(len, got.values())) == odd.count()
    assert got[4] == got[3] == [(0, [], [], 0.0)] and got[8][0][0] == 60000 and len(got[10]) == 2
    assert license.scan(none, AUTOMATON).count() == 0
    with pytest.raises(ValueError):
        license.build([("x", "a " * (license.MOST_WORDS + 1))])


def test_registered_licenses(spark, sf, docs):
    got = {r.doc_id: r for r in registry.queries()["op11_license_scan"](spark, sf).collect()}
    assert len(got) == docs.count()
    for d in docs.collect():
        n, base, spans, score = plain_scan(d.text or "")
        r, own = got[d.doc_id], sorted({x[0] for x in base})
        starts = [x[1] for x in base]
        assert (r.n_words, r.n_base, r.base_labels, r.score) == (n, len(base), ",".join(own), score)
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.labels == ",".join(sorted({*own, *(x[0] for x in spans)}))


# fill in the middle


@given(st.lists(st.booleans(), min_size=1, max_size=3000), st.integers(0, 3))
@settings(max_examples=40, deadline=None)
def test_rank_and_select(bits, pad):
    bits = np.array(bits + [False] * (pad * 512))
    v = fim.RankSelect(bits)
    ones = np.flatnonzero(bits)
    assert v.total == len(ones)
    assert v.rank(np.arange(len(bits) + 1)).tolist() == np.concatenate(([0], np.cumsum(bits))).tolist()
    assert v.select(np.arange(len(ones) + 1)).tolist() == ones.tolist() + [len(bits)]


def plain_middle(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_a_plain_version(spark, odd, clashing, none, docs):
    rng = random.Random(4)
    made = [(k, "".join(rng.choices(["ab", "Z", " ", "\n", "é", "中", "😀", "1", "<", "S>", "<S", "P>", "<M", "̀", "\x00"], k=rng.randrange(60)))) for k in range(400)]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string")).union(docs.select("doc_id", "text"))
    got = fim.transform(df)
    again = fim.restored(F.col("output"), F.col("form"))
    found = got.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", again.alias("again")).collect()
    assert len(found) == df.count() and {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert tuple(r[2:7]) == plain_middle(r.doc_id, r.text) and r.again == (r.text or "")
    assert fim.transform(none).count() == 0
    wide = fim.transform(clashing)
    assert wide.count() == odd.count() and wide.columns == [c for c in clashing.columns if c != "n"] + ["n", "form", "prefix_chars", "middle_chars", "output"]


def test_registered_fill_in_middle(spark, sf, docs):
    got = {r.doc_id: r for r in registry.queries()["op13_fill_in_middle"](spark, sf).collect()}
    for d in docs.collect():
        n, form, p, m, out = plain_middle(d.doc_id, d.text)
        r = got[d.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, brute.sha(out), brute.sha(d.text or ""))


# clusters


def plain_clusters(found, k, rounds, seed):
    """found: (id, vector of whole numbers)."""
    lot = sorted(found, key=lambda x: (x[0] is None, hashlib.sha256(f"{seed}:{x[0]}".encode()).hexdigest(), x[1]))
    c = [v for _, v in lot[:k]]
    for step in range(rounds + 1):
        at = [min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c)) for _, v in found]
        if step < rounds:
            for j in range(len(c)):
                own = [v for (_, v), (_, x) in zip(found, at) if x == j]
                if own:
                    c[j] = [sum(x) // len(own) for x in zip(*own)]
    whole, most = sum(d for d, _ in at), 2**63 - 1
    return sorted(((i, j, min(most, d), min(most, sum(x for x, y in at if y == j)), min(most, whole), brute.sha(",".join(map(str, c[j])))) for (i, _), (d, j) in zip(found, at)), key=repr)


def vectors(spark, values, parts=3):
    return spark.createDataFrame([(i, [float(x) / 1024 for x in v]) for i, v in values], "vec_id long, embedding array<double>").repartition(parts)


@pytest.mark.parametrize("k, size, spread, n", [(8, 4, 40, 900), (20, 3, 2, 400), (1, 2, 9, 30), (2, 2, 3, 50), (12, 5, 1 << 22, 300), (8, 3, 9, 5)])
def test_clusters_equal_plain_ones(spark, k, size, spread, n):
    rng = random.Random(k * n)
    middle = [[rng.randrange(-spread, spread) for _ in range(size)] for _ in range(k)]
    values = [(i, [x + rng.randrange(-spread, spread) // 3 for x in rng.choice(middle)]) for i in range(n)]
    values += [(i % 7, v) for i, v in values[:40]] + [(None, values[0][1])]
    report = []
    got = rows(centroids.cluster(vectors(spark, values), k=k, rounds=6, size=size, report=report))
    assert [tuple(r) for r in got] == plain_clusters(values, k, 6, 3)
    if k >= 8 and n > 100:
        assert sum(report[1:]) < 0.8 * 5 * len(values) * k


def test_bounds_hold_whatever_moves():
    """Against all distances, over rounds in which centroids jump, meet and stay."""
    rng = np.random.default_rng(3)
    for k in (2, 9, 33):
        v = rng.integers(-50, 50, (300, 3))
        c = rng.integers(-50, 50, (k, 3))
        known = centroids.rescan(v, c, centroids.first_bounds(k))
        for step in range(12):
            new = c + rng.integers(-40, 41, c.shape) * (rng.random((k, 1)) < 0.5) // (step + 1)
            new[rng.integers(k)] = new[0]
            centroids.advance(v, new, np.sqrt(((new - c) ** 2).sum(axis=1).astype(float)), known, 1e-9)
            c = new
            d = ((v[:, None] - c) ** 2).sum(axis=2)
            assert (known.nearest[:, 0] == d.argmin(axis=1)).all()
            root = np.sqrt(d.astype(float))
            assert (known.upper >= root[np.arange(300), known.nearest[:, 0]] - 1e-9).all()
            assert (known.lower <= np.take_along_axis(root, known.nearest[:, 1:], 1) + 1e-9).all()
            np.put_along_axis(root, known.nearest, np.inf, 1)
            assert (known.rest <= root.min(axis=1) + 1e-9).all()


def test_cluster_edges(spark):
    rows_ = [(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [1.0, 2.0]), (None, [0.5, 0.5]), (9, [1e300, -1e300]), (9, [1e15, 3.0])]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "cluster", "distance", "segment", "v", "inertia")})
    most = 2**63 - 1
    values = [(i, [max(-most - 1, min(most, int(np.floor(1024 * x)))) for x in v]) for i, v in rows_ if i in (1, 8, None) or (i == 9)]
    got = rows(centroids.cluster(df, k=3, rounds=4, size=2))
    assert [tuple(r) for r in got] == plain_clusters(values, 3, 4, 3)
    none = centroids.cluster(df.limit(0), k=3, size=2)
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_a_round_shuffles_no_block(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024)).alias("v"))
    store = centroids._Buckets(spark, 3)
    blocks = store.write(e.repartition(6).mapInArrow(centroids._pack, centroids._VECTORS).repartition(3, "segment"))
    c = centroids.seeds(e, 8, 3)
    state = store.write(blocks.mapInArrow(centroids._round(spark.sparkContext.broadcast((c, None))), centroids._STATE))
    joined = centroids._joined(blocks, state)
    assert joined.count() == 6 and "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    store.drop_all()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("spanloom_")]


@pytest.mark.parametrize("name", ["op12_centroids", "op13_fill_in_middle"])
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = registry.queries()[name](spark, sf)
    want = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)
