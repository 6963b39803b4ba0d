import importlib

import numpy as np
import pytest

from spanloom.llm import langid, secretscan
from spanloom.llm.subwords import LETTERS
from tests.llm import brute

corpus_pipeline = importlib.import_module("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")


def test_pipeline_against_brute_force(spark, sf):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    # the models are trained as in the stages; what they do to texts is worked out plainly here
    model = langid.train(docs)
    kept = {r.doc_id: r.text for r in docs.collect() if not brute.rejected(r.text, model, LETTERS.tobytes(), langid.SIZES, langid.BITS)}
    comp = brute.components(list(kept.items()), 5, 80)
    kept = {i: t for i, t in kept.items() if comp[i] == i}
    kept = {i: t for i, t in kept.items() if not brute.contamination(t, bench)[1]}
    left = spark.createDataFrame(list(kept.items()), "doc_id long, text string")
    found = secretscan.train(left)
    clean = {i: brute.redacted(t, found, secretscan.TOKEN) for i, t in kept.items()}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(clean)
    same = np.mean([r.ids == sp.encode(clean[r.doc_id] or "") for r in got])
    assert same == 1.0 and all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_columns(spark, odd, clashing, sf):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns, name
        assert stage(spark, clashing, sf).columns == clashing.columns, name
        assert stage(spark, odd.limit(0), sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() == odd.count()
