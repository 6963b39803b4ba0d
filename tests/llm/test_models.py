import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanloom.llm import boosting, langid, pieces, quality, registry, toxicity
from tests.llm import brute

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@given(st.text(alphabet=st.one_of(st.sampled_from("aeinorst the▁  \n.,é中😀0123"), st.characters(exclude_categories=["Cs"])), max_size=60))
@settings(max_examples=300, deadline=None)
def test_pieces_equal_the_library(text):
    import sentencepiece

    e = pieces.encoder(MODEL)
    sp = test_pieces_equal_the_library.__dict__.setdefault("sp", sentencepiece.SentencePieceProcessor(model_file=MODEL))
    ids = sp.encode(text)
    assert np.frombuffer(e.encode(text), "<i4").tolist() == ids
    assert e.decode(np.array(ids, np.int64)).decode() == sp.decode(ids)


@given(st.lists(st.integers(3, 700), max_size=14))
@settings(max_examples=200, deadline=None)
def test_any_ids_decode_as_in_the_library(ids):
    import sentencepiece

    sp = test_any_ids_decode_as_in_the_library.__dict__.setdefault("sp", sentencepiece.SentencePieceProcessor(model_file=MODEL))
    assert pieces.encoder(MODEL).decode(np.array(ids, np.int64)).decode() == sp.decode(ids)


def test_long_texts_decode_in_parts(library):
    text = "The \n thé 😀 " * 500_000
    e = pieces.encoder(MODEL)
    raw = e.encode(text)
    assert e.decode(np.frombuffer(raw, "<i4")).decode() == text


def test_pieces_of_documents(docs, clashing, none, library):
    got = pieces.encode(docs.unionByName(clashing.select(*docs.columns)), MODEL).collect()
    for r in got:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    out = pieces.encode(clashing, MODEL)
    assert sorted(out.columns) == sorted(clashing.columns) and out.where("doc_id = 4").first().ids == []
    assert pieces.encode(none, MODEL).count() == 0


def _held(rows, column, folds, held):
    return [r for r in rows if r[column] is not None and r.text and zlib.crc32(str(r.doc_id).encode()) % folds == held]


def test_language_of_held_out_documents(spark, sf):
    sf = sf.replace("0.001", "0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = registry.op2_language_id(spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and np.mean([r.rejected for r in got]) < 0.01
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_texts_of_no_language_are_rejected(spark, sf):
    """Texts that the model hasn't seen: nearly all are kept as they are, and rejected with their letters dealt anew."""
    rows = [r for r in spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet").collect() if r.text and r.lang]
    learned, held = ([r for r in rows if (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == h] for h in (False, True))
    model = langid.fit([r.text for r in learned], [r.lang for r in learned])
    texts = [r.text for r in held if any(c.isalpha() for c in r.text)]
    rng = np.random.default_rng(2)
    rejected = lambda some: model.judge(*langid._bytes(some))[1].mean()
    assert 0 < model.reject <= 0.5
    assert rejected(texts) < 0.005
    assert rejected([langid._shuffled(t, rng) for t in texts]) > 0.95
    assert rejected(["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz   "), 300)) for _ in range(200)]) > 0.99


def test_rejection_in_edge_cases():
    few = langid.fit(["uno dos tres", "one two three"] * 20, ["es", "en"] * 20)
    assert few.reject == 0 and not few.judge(*langid._bytes(["qzx vvk"]))[1].any()
    assert langid._shuffled("", np.random.default_rng(1)) == "" and langid._shuffled("12 3", np.random.default_rng(1)) == "12 3"
    many = langid.fit(["uno dos tres", "one two three", "12 34"] * 120, ["es", "en", "en"] * 120)
    assert not many.judge(*langid._bytes(["uno dos tres", "one two three"]))[1].any()


def test_language_edges(clashing, none):
    model = langid.train(clashing)
    assert langid.train(none).languages == []
    got = langid.identify(clashing, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == clashing.count() and {by[i].lang_pred for i in (3, 4, 5, 12)} == {"und"} and by[4].rejected and by[1].lang_pred in model.languages
    assert all(r.rejected and r.lang_pred == "und" for r in langid.identify(clashing, langid.train(none)).collect())


@pytest.mark.parametrize("query, label, least", [("op4_toxicity", "toxic", 0.9), ("op9_quality", "quality", 0.95)])
def test_classifiers_on_held_out_documents(spark, sf, query, label, least):
    sf = sf.replace("0.001", "0.01")
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = registry.queries()[query](spark, sf).collect()
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and np.mean([r.predicted == truth[r.doc_id] for r in held]) >= least
    limit = 0.5 if label == "toxic" else 0.3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= limit) for r in got) and len(got) == 1000


def test_toxic_held_out_documents_are_found(spark, sf):
    """Precision and recall of the toxic label: calling nothing toxic would be right for most rows."""
    sf = sf.replace("0.001", "0.1")
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in registry.op4_toxicity(spark, sf).where("held_out").select("doc_id", "predicted").collect() if truth.get(r.doc_id) is not None]
    both, called, toxic = sum(p and t for p, t in held), sum(p for p, _ in held), sum(t for _, t in held)
    assert toxic > 80 and both / called >= 0.9 and both / toxic >= 0.8


def test_misspelled_words_share_subwords():
    texts = [f"the cat sat on {w} mat {i}" for i, w in enumerate(["idiot", "moron", "clown"] * 60)] + [f"the cat sat on {w} mat {i}" for i, w in enumerate(["table", "chair", "sofa"] * 60)]
    label = np.array([1] * 180 + [0] * 180)
    model = toxicity.fit(texts, label, {0: 180, 1: 180})
    import pyarrow as pa

    from spanloom.llm.words import text_bytes

    p = model.scores(*text_bytes(pa.array(["you idiott here", "a moronn is here", "the cat sat on a couch", ""])))
    assert p[0] > 0.5 and p[1] > 0.5 and p[2] < 0.5 and p[3] < 0.5


TEXTS = ["", "one", "You IDIOT, 1d10t and 12345 fools of été", "  a b\n" * 9, "x" * 400, "12 34 56 78", "Ünïcode wörds här und dort, sometimes"]


def test_toxicity_equals_plain_averages():
    import pyarrow as pa

    from spanloom.llm.subwords import LETTERS, MARKED
    from spanloom.llm.words import text_bytes

    rng = np.random.default_rng(0)
    model = toxicity.Model(np.append(rng.normal(size=1 << toxicity.BITS), 0).astype(np.float32), -0.3, 0.1, 0.7)
    got = model.scores(*text_bytes(pa.array(TEXTS)))
    for text, p in zip(TEXTS, got):
        found = [w for w in text.encode().translate(MARKED.tobytes()).split(b"\0") if w]
        bags = []
        for a in range(0, max(1, len(found) - toxicity.WINDOW + 1), toxicity.STEP) if found else ():
            ids = [g for w in found[a : a + toxicity.WINDOW] if any(LETTERS[c] for c in w) for g in brute.grams(w, toxicity.SIZES, toxicity.BITS)]
            bags.append(model.bias + (np.mean([float(model.table[i]) for i in ids]) if ids else 0.0))
        odds = max(bags) if bags else toxicity.EMPTY
        assert abs(p - 1 / (1 + np.exp(-(0.1 + 0.7 * odds)))) < 1e-6


def test_language_equals_plain_averages():
    import pyarrow as pa

    from spanloom.llm.subwords import LETTERS
    from spanloom.llm.words import text_bytes

    rng = np.random.default_rng(1)
    table = np.vstack((rng.normal(size=(1 << langid.BITS, 4)), np.zeros(4))).astype(np.float32)
    model = langid.Model(["a", "b", "c"], table, rng.normal(size=3), 1.7, np.zeros(4), 0.0)
    got = model.probabilities(*text_bytes(pa.array(TEXTS)))
    for text, p in zip(TEXTS, got):
        ids = [g for w in text.encode().translate(LETTERS.tobytes()).split(b"\0") if w for g in brute.grams(w, langid.SIZES, langid.BITS)]
        mean = np.mean([table[i].astype(float) for i in ids], axis=0) if ids else np.zeros(4)
        assert np.allclose(p, langid.softmax((1.7 * (mean[:3] + model.bias))[None])[0], atol=1e-6)


def test_votes_equal_plain_votes_with_ties():
    rng = np.random.default_rng(2)
    labelled = quality.unit(rng.integers(-1, 2, (60, 4)).astype(float) + 0.01)
    label = rng.integers(0, 2, 60)
    model = quality.Model(None, None, None, labelled, label, np.array([1.0, 0.4]))
    asked = quality.unit(rng.integers(-1, 2, (600, 4)).astype(float) + 0.02)
    got = model.vote(asked)
    for v, p in zip(asked, got):
        alike = [round(float(v @ u), quality.PLACES) for u in labelled]
        near = sorted(range(60), key=lambda i: (-alike[i], i))[: quality.NEIGHBOURS]
        w = [max(alike[i], 1e-3) ** quality.POWER * model.weight[label[i]] for i in near]
        assert abs(p - sum(x for x, i in zip(w, near) if label[i]) / sum(w)) < 1e-8
    assert (model.vote(asked[::-1])[::-1] == got).all() and (model.vote(asked[:1]) == got[:1]).all()


def test_training_samples_cover_languages_and_long_texts(spark):
    """No language and no long text is left out, and equal ids don't fill a sample by themselves."""
    rows = [(i, f"word{i % 300} text of its own kind", f"l{i % 300}") for i in range(900)] + [(10_000, "start " + "middle " * 60_000 + "end", "long")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=2)
    assert len(model.languages) == 301


@pytest.mark.parametrize("mod", [toxicity, quality])
def test_classifier_edges(spark, clashing, none, mod):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (6, 1, 0), (7, 0, 1), (8, 1, 0), (8, 1, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for rows in (labels, labels.limit(0)):
        model = mod.train(clashing, rows)
        out = mod.score(clashing, model)
        got = out.collect()
        assert len(got) == clashing.count() and all(0 <= r.score <= 1 for r in got) and sorted(out.columns) == sorted(clashing.columns)
        assert mod.score(none, model).count() == 0


def test_trees_in_sql_equal_trees_in_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3)).round(2)
    model = boosting.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float))
    model.scale, model.shift = 1.3, -0.2
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "p double, q double, r double")
    got = [r.v for r in df.select(F.expr(model.sql(["p", "q", "r"])).alias("v")).collect()]
    assert np.allclose(got, model.probability(x)) and ((np.array(got) > 0.5) == (x[:, 0] * x[:, 1] > 0)).mean() > 0.9
