"""Toxicity: bags of subword embeddings averaged into a linear softmax, trained together."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import words
from spanloom.llm.learn import labelled_texts, logistic, sigmoid
from spanloom.llm.subwords import LETTERS, MARKED, Stream

SIZES, BITS, DIM = (3, 4, 5, 6), 16, 12
#: Words of a bag, and words from one bag of a text to the next: a text of up to WINDOW words is one bag.
WINDOW, STEP = 3, 1
#: Labelled texts of each label that the model is fitted on (about).
PER_LABEL = 1500
#: Bags at random of a text, and its likeliest bags, that a training takes.
BAGS, TOP = 24, 4
#: Rounds in which each half of the texts picks the other's bags; passes over the bags of a training, bags below which
#: there are more, and the rate of the first pass.
ROUNDS, EPOCHS, LEAST_BAGS, RATE = 3, 4, 6000, 0.5
#: The log odds of a text without words.
EMPTY = -12.0


@dataclass
class Model:
    #: For each bucket, what one n-gram adds to the log odds of its bag; the last, for no n-gram, is zero.
    table: np.ndarray
    bias: float
    #: Platt's shift and scale of a text's highest log odds.
    shift: float
    scale: float

    def bags(self, stream: Stream) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, first byte, last byte, log odds) of each bag of WINDOW words; words without a letter add nothing."""
        starts, ends, bounds = stream.words()
        total, count = np.zeros(len(starts)), np.zeros(len(starts))
        for n, bucket in stream.grams(SIZES, BITS):
            run = np.concatenate(([0.0], np.cumsum(self.table[bucket], dtype=np.float64)))
            # windows of n bytes from the boundary before the word to the one after it
            lo, hi = starts - 1, ends + 1 - n + 1
            some = hi > lo
            total[some] += run[hi[some]] - run[lo[some]]
            count[some] += hi[some] - lo[some]
        letters = np.concatenate(([0], np.cumsum(LETTERS[stream.bytes] != 0)))
        plain = letters[ends] == letters[starts]
        total[plain] = count[plain] = 0
        first, stop = bounds[:-1], bounds[1:]
        n = np.where(stop > first, 1 - (-np.maximum(stop - first - WINDOW, 0) // STEP), 0)
        row = np.repeat(np.arange(len(n)), n)
        a = first[row] + STEP * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
        b = np.minimum(a + WINDOW, stop[row])
        total, count = (np.concatenate(([0.0], np.cumsum(x))) for x in (total, count))
        odds = (total[b] - total[a]) / np.maximum(count[b] - count[a], 1) + self.bias
        return row, starts[a] - 1, ends[b - 1] + 1, odds

    def odds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Each text's highest log odds of a bag."""
        out = np.full(len(offsets) - 1, EMPTY)
        for i, j in words.slices(offsets, 1 << 18):
            row, _, _, odds = self.bags(Stream(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], MARKED))
            if len(row):
                first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                out[i + row[first]] = np.maximum.reduceat(odds, first)
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return sigmoid(self.shift + self.scale * self.odds(data, offsets))


def _grams(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, bounds): the n-grams of each bag, one bag after the other."""
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in bags]))).astype(np.int64)
    stream = Stream(np.frombuffer(b"".join(bags), np.uint8), offsets, np.arange(256, dtype=np.uint8))
    where, bucket = [], []
    for _, b in stream.grams(SIZES, BITS):
        good = np.flatnonzero(b < 1 << BITS)
        where.append(np.searchsorted(stream.rows[:-1] - 1, good, "right") - 1)
        bucket.append(b[good])
    where, bucket = np.concatenate(where), np.concatenate(bucket)
    order = np.argsort(where, kind="stable")
    return bucket[order], np.searchsorted(where[order], np.arange(len(bags) + 1))


def _chosen(model: Model | None, data: np.ndarray, offsets: np.ndarray, label: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[bytes, int]]:
    """Bags to learn from, with their texts' labels: some at random, and the TOP likeliest by a model that has not seen
    the texts; of a toxic text these only, if there is such a model."""
    for i, j in words.slices(offsets, 1 << 18):
        stream = Stream(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], MARKED)
        row, lo, hi, odds = (model or Model(np.zeros((1 << BITS) + 1, np.float32), 0.0, 0.0, 1.0)).bags(stream)
        bounds = np.searchsorted(row, np.arange(j - i + 1))
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if b > a:
                toxic = int(label[i + k])
                picks = set() if model is None else set((a + np.argsort(-odds[a:b], kind="stable")[:TOP]).tolist())
                if model is None or not toxic:
                    picks |= set(rng.integers(a, b, BAGS).tolist())
                for p in sorted(picks):
                    yield stream.bytes[lo[p] : hi[p]].tobytes(), toxic


def _learned(bags: list[tuple[bytes, int]], rng: np.random.Generator) -> Model:
    """Embeddings and softmax trained together by stochastic gradient descent on bags."""
    emb, out, bias = rng.normal(0, 0.1, (1 << BITS, DIM)), rng.normal(0, 0.3, (2, DIM)), np.zeros(2)
    bucket, bounds = _grams([b for b, _ in bags])
    y = np.array([t for _, t in bags], np.int64)
    size = np.diff(bounds)
    chosen = np.flatnonzero(size > 0)
    # a small sample is gone through more often
    epochs = EPOCHS * max(1, min(10, LEAST_BAGS // max(1, len(chosen))))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        rng.shuffle(chosen)
        for start in range(0, len(chosen), 128):
            w = chosen[start : start + 128]
            n = size[w]
            first = np.concatenate(([0], np.cumsum(n)[:-1]))
            idx = bucket[np.repeat(bounds[w] - first, n) + np.arange(n.sum())]
            h = np.add.reduceat(emb[idx], first, axis=0) / n[:, None]
            p = h @ out.T + bias
            p = np.exp(p - p.max(axis=1, keepdims=True))
            g = p / p.sum(axis=1, keepdims=True)
            g[np.arange(len(w)), y[w]] -= 1
            back = g @ out
            moved, place, often = np.unique(idx, return_inverse=True, return_counts=True)
            step = np.stack([np.bincount(place, np.repeat(back[:, d], n), len(moved)) for d in range(DIM)], axis=1)
            emb[moved] -= rate * step / np.sqrt(often)[:, None]
            out -= 0.2 * rate * (g.T @ h) / np.sqrt(len(w))
            bias -= 0.02 * rate * g.mean(axis=0)
    return Model(np.append(emb @ (out[1] - out[0]), 0.0).astype(np.float32), float(bias[1] - bias[0]), 0.0, 1.0)


def fit(texts: list[str], label: np.ndarray, counts: dict, seed: int = 5) -> Model:
    """Trains on bags of three quarters of the texts. Most words of a toxic text are ordinary, so each half of them
    first learns from bags at random; what it learned then picks the likeliest bags of the other half's toxic texts,
    twice, and the model is trained on these. The last quarter turns log odds into probabilities at the labels' true rates."""
    rng = np.random.default_rng(seed)
    if len(set(label.tolist())) < 2:
        rate = float(label.mean()) if len(label) else 0.0
        return Model(np.zeros((1 << BITS) + 1, np.float32), 0.0, 20.0 * rate - 10.0, 0.0)
    order = rng.permutation(len(texts))
    held, own = order[: len(order) // 4], order[len(order) // 4 :]
    if len(set(label[held].tolist())) < 2 or len(set(label[own].tolist())) < 2:
        held = own = order
    halves = []
    for part in (own[::2], own[1::2]):
        halves.append((*words.text_bytes(pa.array([texts[i] for i in part], pa.large_string())), label[part]))
    models: list[Model | None] = [None, None]
    for _ in range(ROUNDS):
        models = [_learned(list(_chosen(models[1 - k], *halves[k], rng)), rng) for k in (0, 1)]
    model = _learned([bag for k in (0, 1) for bag in _chosen(models[1 - k], *halves[k], rng)], rng)
    odds = model.odds(*words.text_bytes(pa.array([texts[i] for i in held], pa.large_string())))
    z = label[held]
    true = np.array([counts.get(k, 1) / max(1, (z == k).sum()) for k in (0, 1)], float)
    shift, scale = logistic(np.stack((np.ones(len(z)), odds), axis=1), z, true[z] / true[z].mean())
    model.shift, model.scale = float(shift), float(max(scale, 0.0))
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL, folds: int = 5, held_out: int = 0) -> Model:
    """Fits a model on about per_label texts of each label whose crc32(doc_id as text) mod folds isn't held_out, as
    labelled_texts() samples them. Without labelled texts the score is near 0, with one label only near its value."""
    return fit(*labelled_texts(docs, labels, label, per_label, folds, held_out))


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", keep: list[str] | None = None) -> DataFrame:
    """df's columns (those in keep, or all) with the probability that a whole text is toxic: that of its likeliest bag of
    words. Null and empty texts, and those without words, get the score of a text without words. Very long texts are
    read whole, in parts. Equal texts have equal scores, so ties and repeated rows stay ties. An empty table gives an
    empty one. A column of the name score_col is replaced; others stay, whatever their names."""
    kept = [c for c in keep or df.columns if c.lower() != score_col.lower()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(score_col, T.DoubleType())])
    shared, at = df.sparkSession.sparkContext.broadcast(model), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in words.parts(whole, at)):
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(shared.value.scores(*words.text_bytes(batch.column(at))))], [*kept, score_col])

    rows = df.select(*[F.col(f"`{c}`") for c in [*kept, text_col]])
    return rows.toDF(*[f"c{i}" for i in range(at + 1)]).mapInArrow(run, schema)
