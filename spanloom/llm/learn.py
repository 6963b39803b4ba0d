"""Bounded samples of labelled rows, and calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.shared import drop_table, write_table

#: Characters of a text that a training sample holds; of a longer one it has PIECES parts from all over it.
LONGEST_SAMPLE, PIECES = 50_000, 10


def excerpt(text: Column) -> Column:
    """A text for training: itself, or PIECES parts of it at even distances with LONGEST_SAMPLE characters together."""
    piece = LONGEST_SAMPLE // PIECES
    n = F.length(text)
    parts = [F.substring(text, (1 + F.floor((n - piece) * i / (PIECES - 1))).cast("int"), F.lit(piece)) for i in range(PIECES)]
    return F.when(n > LONGEST_SAMPLE, F.concat_ws(" ", *parts)).otherwise(text)


def fold(column: str, parts: int):
    """crc32 of the text of an id, modulo parts; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % parts


def sample_by_label(df: DataFrame, label: str, key: str, per_label: int) -> tuple[DataFrame, dict]:
    """(sample, counts): about per_label + 4 * sqrt(per_label) rows of each label, or all if there are fewer, chosen by a hash of key
    from all over df; counts has every label's rows in df. Rows of null label or key are left out."""
    df = df.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    if not counts:
        return df.limit(0), counts
    share = F.create_map([x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, (per_label + 4 * per_label**0.5) / n)))])
    lot = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1_000_000_000)) / 1e9
    return df.where(lot < F.element_at(share, F.col(label))), counts


def first_by_hash(df: DataFrame, most: int) -> list:
    """At most `most` rows of (key, label, text), by a hash of all three: where keys repeat, a sample of all their rows."""
    return sorted(df.orderBy(F.xxhash64("key", "label", "text", F.lit(3)), "key", "label", "text").limit(most).collect(), key=lambda r: (r.key, r.label, r.text))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, per_label: int, folds: int, held_out: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], np.ndarray, dict]:
    """Texts (as excerpt() gives them) and labels (0 or 1) of a sample of the labelled rows that aren't held out.

    Ids are sampled from labels first; the sample, of some more than 2 * per_label ids, is broadcast to docs, so the texts are
    not shuffled. An id that has both labels counts as 1; null ids, labels and texts take no part."""
    rows = labels.where(F.col(label).isin(0, 1) & (fold(id_col, folds) != held_out)).groupBy(id_col).agg(F.max(label).cast("int").alias("label"))
    rows, counts = sample_by_label(rows.select(F.col(id_col).alias("key"), "label"), "label", "key", per_label)
    chosen = write_table(rows, "sample")
    found = docs.select(F.col(id_col).alias("key"), excerpt(F.col(text_col)).alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(chosen), "key")
    got = first_by_hash(found, 3 * per_label)
    drop_table(chosen)
    return [r.text for r in got], np.array([r.label for r in got], np.int64), counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression on the columns of x, by Newton's method; ridge holds them back."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
