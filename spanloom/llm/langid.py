"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import words
from spanloom.llm.learn import excerpt, first_by_hash, logistic, sample_by_label, sigmoid
from spanloom.llm.subwords import LETTERS, Stream

SIZES, BITS, DIM = (2, 3, 4), 15, 16
#: Texts of each language that the model is fitted on (about), and passes over them.
PER_LANGUAGE, EPOCHS = 400, 4
#: Share of held-out texts of known language that rejection may turn away, and held-out texts below which nothing is rejected.
REJECTED_SHARE, LEAST_HELD = 0.001, 50
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    #: For each bucket, what one n-gram adds to each language, and how common it is in the training texts (log share);
    #: the last row, for no n-gram, is zero.
    table: np.ndarray
    bias: np.ndarray
    #: The factor of the scores before the softmax.
    sharpness: float
    #: Weights that turn known()'s features into the odds of a known language, and the probability below which a text is rejected.
    weights: np.ndarray
    reject: float

    def averages(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the mean of the n-grams' rows of table, number of n-grams) of each text."""
        out, count = np.empty((len(offsets) - 1, self.table.shape[1])), np.empty(len(offsets) - 1)
        for i, j in words.slices(offsets, max(1 << 14, (1 << 20) // max(4, len(self.languages)))):
            sums, n = _sums(self.table, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            out[i:j], count[i:j] = sums / np.maximum(n, 1)[:, None], n
        return out, count

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the languages' calibrated probabilities, whether it is rejected) of each text."""
        mean, count = self.averages(data, offsets)
        return softmax(self.sharpness * (mean[:, :-1] + self.bias)), sigmoid(features(mean, count) @ self.weights) < self.reject

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row for each text with the languages' calibrated probabilities."""
        return self.judge(data, offsets)[0]


def features(mean: np.ndarray, count: np.ndarray) -> np.ndarray:
    """What tells a text of a known language from others: how common its n-grams are, more surely in longer texts."""
    common = np.maximum(mean[:, -1], -16) / 4
    sure = 1 / np.sqrt(np.maximum(count, 1))
    return np.stack((np.ones(len(mean)), common, sure, common * sure), axis=1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sums(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the sum of its n-grams' rows of table, and their number."""
    stream = Stream(data, offsets, LETTERS)
    total, count = np.zeros((len(offsets) - 1, table.shape[1])), np.zeros(len(offsets) - 1)
    first, last = stream.rows[:-1] - 1, stream.rows[1:] - 1
    for _, bucket in stream.grams(SIZES, BITS):
        edge = np.minimum(np.stack((first, last)), len(bucket))
        some = edge[0] < edge[1]
        if some.any():
            # rows follow each other, so each sum runs to the next row's start
            total[some] += np.add.reduceat(table[bucket], edge[0][some], axis=0, dtype=np.float64)
            count[some] += np.add.reduceat((bucket < 1 << BITS).astype(np.float64), edge[0][some])
    return total, count


def _parts(text: str, rng: np.random.Generator) -> tuple[str, ...]:
    """The whole text and two short excerpts, so that short texts are learned too."""
    cut = text.split()
    return (text, *(" ".join(cut[a : a + int(rng.integers(1, 12))]) for a in rng.integers(0, max(1, len(cut)), 2)))


def _examples(text: str, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each part of a text that has n-grams."""
    for part in _parts(text, rng):
        raw = np.frombuffer(part.encode(), np.uint8)
        stream = Stream(raw, np.array([0, len(raw)]), LETTERS)
        found = [b[b < 1 << BITS] for _, b in stream.grams(SIZES, BITS)]
        bucket, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64), np.zeros(0))
        if len(bucket):
            yield bucket, n


def _shuffled(text: str, rng: np.random.Generator) -> str:
    """A text of no language: the letters of text dealt anew over the same places."""
    chars = np.array(list(text))
    letters = np.flatnonzero([c.isalpha() for c in chars])
    chars[letters] = chars[rng.permutation(letters)]
    return "".join(chars)


def fit(texts: list[str], langs: list[str], seed: int = 3) -> Model:
    """Trains embeddings and softmax together by stochastic gradient descent, on four fifths of the texts;
    the others set the sharpness (least log loss) and the rejection. For this, held-out texts, whole and as excerpts, stand against
    texts of no language, which are the same with their letters dealt anew: a logistic regression on how common the
    n-grams are gives the probability of a known language. A text is rejected where it is under a half, or under what
    turns away REJECTED_SHARE of the held-out texts, if that is less. With few held-out texts nothing is rejected."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    number = {k: i for i, k in enumerate(names)}
    order = rng.permutation(len(texts))
    held = order[: len(order) // 5]
    train = [(e, number[langs[i]]) for i in order[len(held) :] for e in _examples(texts[i], rng)]
    emb = (rng.random((1 << BITS, DIM)) - 0.5) / DIM
    out, bias = np.zeros((len(names), DIM)), np.zeros(len(names))
    for epoch in range(EPOCHS):
        rate = 0.4 * (1 - epoch / EPOCHS)
        for k in rng.permutation(len(train)):
            (bucket, n), y = train[k]
            share = n / n.sum()
            h = share @ emb[bucket]
            p = out @ h + bias
            p = np.exp(p - p.max())
            p /= p.sum()
            p[y] -= 1
            back = out.T @ p
            out -= rate * np.outer(p, h)
            bias -= 0.05 * rate * p
            emb[bucket] -= (rate / (share @ share)) * share[:, None] * back[None] * 0.25
    seen = np.full(1 << BITS, 0.5)
    for (bucket, n), _ in train:
        seen[bucket] += n
    table = np.column_stack((emb @ out.T, np.log(seen / seen.sum())))
    model = Model(names, np.vstack((table, np.zeros(len(names) + 1))).astype(np.float32), bias, 1.0, np.zeros(4), 0.0)
    if len(held):
        y = np.array([number[langs[i]] for i in held])
        raw = np.log(np.maximum(model.probabilities(*_bytes([texts[i] for i in held])), 1e-300))
        grid = np.geomspace(0.2, 10, 40)
        loss = [-np.log(np.maximum(softmax(g * raw)[np.arange(len(y)), y], 1e-12)).mean() for g in grid]
        model.sharpness = float(grid[int(np.argmin(loss))])
    if len(held) >= LEAST_HELD:
        known = [part for i in held for part in _parts(texts[i], rng)]
        known = [part for part in known if any(c.isalpha() for c in part)]
        x = features(*model.averages(*_bytes(known + [_shuffled(part, rng) for part in known])))
        y = np.repeat([1, 0], len(known))
        model.weights = logistic(x, y, np.ones(len(y)))
        model.reject = float(min(0.5, np.quantile(sigmoid(x[: len(known)] @ model.weights), REJECTED_SHARE)))
    return model


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return words.text_bytes(pa.array(texts, pa.large_string()))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fits a model on about per_language texts of each language of docs, however many languages there are.

    Rows of null id, text or language take no part; of very long texts excerpt() is learned. Repeated rows may each be
    learned. Without rows the model knows no language."""
    rows = docs.select(F.col(id_col).alias("key"), excerpt(F.col(text_col)).alias("text"), F.col(lang_col).alias("label")).where(F.col("text").isNotNull())
    sample, counts = sample_by_label(rows, "label", "key", per_language)
    got = first_by_hash(sample, max(1, 2 * per_language * len(counts)))
    return fit([r.text for r in got], [r.label for r in got])


def identify(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df's columns (those in keep, or all) with lang_pred, score (the calibrated probability of lang_pred) and rejected.

    A null text or one without a letter is `und` with score 0 and is rejected, and so is every text if the
    model knows no language; other texts are rejected when, by the model, they are in none of its languages. Of equally
    likely languages the first by name is named. Very long texts are read whole, in slices of rows; repeated rows have
    equal results; an empty table gives an empty one. Columns of df that have these names are replaced."""
    kept = [c for c in keep or df.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`"), F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False)))
    rows = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    shared, at = df.sparkSession.sparkContext.broadcast(model), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in (part for whole in batches for part in words.parts(whole, at)):
            letter = batch.column(at + 1).to_numpy(zero_copy_only=False)
            if m.languages:
                p, none = m.judge(*words.text_bytes(batch.column(at)))
                best = p.argmax(axis=1)
                name, score = np.array(m.languages, object)[best], p[np.arange(len(p)), best]
            else:
                letter, none = np.zeros(len(letter), bool), np.ones(len(letter), bool)
                name, score = np.full(len(letter), UNDETERMINED, object), np.zeros(len(letter))
            name, score = np.where(letter, name, UNDETERMINED), np.where(letter, score, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(name, pa.string()), pa.array(score), pa.array(~letter | none)], [*kept, "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, schema)
