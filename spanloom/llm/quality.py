"""Quality: votes of labelled neighbours among latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import words
from spanloom.llm.learn import labelled_texts

#: Columns of hashed words and of hashed runs of character classes, and latent dimensions.
WORDS, SHAPES, DIM = 2048, 4096, 32
#: Labelled texts of each label (about); they are both fitted on and broadcast as neighbours.
PER_LABEL = 1500
NEIGHBOURS, POWER = 15, 8
#: Decimal places of vectors, similarities and scores.
PLACES = 9
#: Texts of one block of cosine products.
BLOCK = 512

#: Classes of bytes: other, lower case, upper case, digit, blank, line end, and some marks by themselves.
CLASS = np.zeros(256, np.uint8)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = 1, 2, 3, 1
for _k, _c in enumerate(" \n.,!?|-:;\"'()[]{}<>/\\=+*#$%&@_"):
    CLASS[ord(_c)] = 4 + min(_k, 11)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row for each text: counts of hashed words, of hashed runs of one to four character classes,
    and of words, distinct words and words that repeat the one before."""
    n = len(offsets) - 1
    out = np.zeros((n, WORDS + SHAPES + 3))
    starts, ends, bounds = words.spans(words.LOWER[data], offsets, words.SOLID)
    word = words.fingerprints(words.LOWER[data], starts, ends)
    row = np.repeat(np.arange(n), np.diff(bounds))
    out[:, :WORDS] = np.bincount(row * WORDS + (word % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    out[:, -3] = np.diff(bounds)
    again = np.flatnonzero((word[1:] == word[:-1]) & (row[1:] == row[:-1]))
    out[:, -1] = np.bincount(row[again], minlength=n)
    out[:, -2] = [len(np.unique(word[a:b])) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    kind = CLASS[data].astype(np.uint32)
    row = np.repeat(np.arange(n), np.diff(offsets))
    key = np.ones(len(kind), np.uint32)
    shapes = np.zeros(n * SHAPES)
    for k in range(4):
        key = key[: len(kind) - k] * np.uint32(17) + kind[k:]
        good = row[: len(kind) - k] == row[k:]
        bucket = (key * np.uint32(0x9E3779B1) >> np.uint32(20)).astype(np.int64)
        shapes += np.bincount((row[: len(kind) - k] * SHAPES + bucket)[good], minlength=n * SHAPES)
    out[:, WORDS : WORDS + SHAPES] = shapes.reshape(n, SHAPES)
    return out


def weighted(raw: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Square roots of shares times rarity, each of the two blocks of length one, and two shares of words."""
    out = np.empty((len(raw), WORDS + SHAPES + 2))
    for a, b, much in ((0, WORDS, 0.35), (WORDS, WORDS + SHAPES, 1.0)):
        part = np.sqrt(raw[:, a:b] / np.maximum(raw[:, a:b].sum(axis=1, keepdims=True), 1)) * rarity[a:b]
        out[:, a:b] = much * part / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    n = np.maximum(raw[:, -3], 1)
    out[:, -2] = 1 - raw[:, -2] / n
    out[:, -1] = 1.5 * raw[:, -1] / n
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return np.round(x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9), PLACES)


@dataclass
class Model:
    rarity: np.ndarray
    centre: np.ndarray
    basis: np.ndarray
    #: Unit vectors of the labelled texts, their labels, and their votes' weights by label.
    vectors: np.ndarray
    label: np.ndarray
    weight: np.ndarray

    def project(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Unit latent vectors of texts."""
        out = np.empty((len(offsets) - 1, self.basis.shape[1]))
        for i, j in words.slices(offsets, 1 << 18):
            for a in range(i, j, 64):
                b = min(j, a + 64)
                out[a:b] = (weighted(counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), self.rarity) - self.centre) @ self.basis
        return unit(out)

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """The share of label 1 in the votes of the NEIGHBOURS nearest labelled vectors, weighted by similarity. Of
        equally near vectors those with smaller numbers vote."""
        out = np.empty(len(vectors))
        k = min(NEIGHBOURS, len(self.label))
        for i in range(0, len(vectors), BLOCK):
            # rounded, so that a product's last bits, which differ with a block's shape, decide nothing
            alike = np.round(vectors[i : i + BLOCK] @ self.vectors.T, PLACES)
            least = np.partition(alike, alike.shape[1] - k, axis=1)[:, alike.shape[1] - k, None]
            tied = alike == least
            free = k - (alike > least).sum(axis=1, keepdims=True)
            near = (alike > least) | (tied & (np.cumsum(tied, axis=1) <= free))
            w = np.where(near, np.maximum(alike, 1e-3) ** POWER * self.weight[self.label], 0.0)
            out[i : i + BLOCK] = (w * self.label).sum(axis=1) / w.sum(axis=1)
        return np.round(out, PLACES)


def fit(texts: list[str], label: np.ndarray, totals: dict, seed: int = 11) -> Model:
    """Fits rarities and latent dimensions (a randomised singular value decomposition) on the labelled texts.
    Votes are weighted back to the labels' true rates. Without any labelled text, every score is 1."""
    data, offsets = words.text_bytes(pa.array(texts or [""], pa.string()))
    label = label if len(texts) else np.ones(1, np.int64)
    rows, seen = [], np.zeros(WORDS + SHAPES)
    for a in range(0, len(offsets) - 1, 64):
        b = min(len(offsets) - 1, a + 64)
        raw = counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        seen += (raw[:, : WORDS + SHAPES] > 0).sum(axis=0)
        rows.append(raw.astype(np.float32))
    rarity = np.log((1 + len(label)) / (1 + seen)) + 1
    x = np.concatenate([weighted(raw, rarity).astype(np.float32) for raw in rows])
    centre = x.mean(axis=0, dtype=np.float64)
    x -= centre.astype(np.float32)
    rng = np.random.default_rng(seed)
    q = rng.normal(size=(x.shape[1], min(DIM + 8, x.shape[1]))).astype(np.float32)
    for _ in range(3):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ vt[:DIM].T).astype(float)
    vectors = np.concatenate([(weighted(raw, rarity) - centre) @ basis for raw in rows])
    weight = np.array([totals.get(k, 1) / max(1, (label == k).sum()) for k in (0, 1)], float)
    return Model(rarity, centre, basis, unit(vectors), label, weight / weight.max())


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL, folds: int = 5, held_out: int = 0) -> Model:
    """Fits a model on about per_label texts of each label whose crc32(doc_id as text) mod folds isn't held_out, as
    labelled_texts() samples them. Without labelled texts every score is 1."""
    return fit(*labelled_texts(docs, labels, label, per_label, folds, held_out))


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", keep: list[str] | None = None) -> DataFrame:
    """df's columns (those in keep, or all) with the share of label 1 among the neighbours of each whole text; null and
    empty texts are compared as texts without words. Very long texts are read whole. Of equally near neighbours those
    with smaller numbers vote, so equal texts have equal scores. An empty table gives an empty one. A column of the name
    score_col is replaced; others stay, whatever their names."""
    kept = [c for c in keep or df.columns if c.lower() != score_col.lower()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(score_col, T.DoubleType())])
    shared, at = df.sparkSession.sparkContext.broadcast(model), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in (part for whole in batches for part in words.parts(whole, at)):
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(m.vote(m.project(*words.text_bytes(batch.column(at)))))], [*kept, score_col])

    rows = df.select(*[F.col(f"`{c}`") for c in [*kept, text_col]])
    return rows.toDF(*[f"c{i}" for i in range(at + 1)]).mapInArrow(run, schema)
