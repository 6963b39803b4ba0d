"""Secrets: stated patterns, and tokens that a character model calls random.

The scan uses built-in DataFrame functions only. Two Markov models of characters are counted on
the driver from bounded labelled samples; their log-likelihood ratio is a table inside the query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.matches import add_matches, cut_out, inside_one

KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SHORTEST = 16
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{" + str(SHORTEST) + ",}"
#: Documents that words and labelled secrets are learned from (about), words and secrets of one document, words of them
#: all, and samples of each kind that the models count.
SAMPLE_DOCS, DOC_WORDS, DOC_SECRETS, CORPUS_WORDS, SAMPLES = 20_000, 20, 5, 20_000, 8000
#: Lengths from which a threshold holds, and the share of ordinary identifiers of such lengths that may pass it.
LENGTHS, FALSE_SHARE = (16, 20, 28, 44), 0.001


@dataclass
class Model:
    #: ln P(next | this) of random strings less that of ordinary ones, by places in ALPHABET.
    ratio: np.ndarray
    #: For each of LENGTHS, the mean ratio of a token's character pairs from which it is random.
    thresholds: list[float]

    def threshold(self, size: int) -> float:
        return self.thresholds[max(0, sum(size >= n for n in LENGTHS) - 1)]

    def mean_ratio(self, token: str) -> float:
        at = [ALPHABET.index(c) for c in token]
        return float(self.ratio[at[:-1], at[1:]].mean())


def _pairs(samples: list[str]) -> np.ndarray:
    count = np.full((len(ALPHABET), len(ALPHABET)), 0.5)
    place = {c: i for i, c in enumerate(ALPHABET)}
    for s in samples:
        at = [place[c] for c in s if c in place]
        np.add.at(count, (at[:-1], at[1:]), 1)
    return np.log(count / count.sum(axis=1, keepdims=True))


def made_random(rng: np.random.Generator) -> str:
    """A random string made by rule: base 62, base 64, hexadecimal, or capitals and digits."""
    sets = (ALPHABET[:62], ALPHABET[:64], "0123456789abcdef", "0123456789ABCDEF", ALPHABET[26:62])
    return "".join(rng.choice(list(sets[int(rng.integers(0, len(sets)))]), int(rng.integers(SHORTEST, 65))))


def fit(words: list[str], secrets: list[str], seed: int = 29) -> Model:
    """Counts both models. Random strings: those made by rule, and secrets that the stated patterns found. Ordinary
    ones: words, and identifiers, paths, dates and numbers made of words. One half of these teaches the model, the
    other sets the thresholds."""
    rng = np.random.default_rng(seed)
    pick = lambda x: x[int(rng.integers(0, len(x)))]
    words = [w for w in words if len(w) > 1] or ["data", "user", "index", "value", "page", "count", "file", "name"]
    random = [made_random(rng) for _ in range(SAMPLES)] + secrets[: SAMPLES // 4]

    def ordinary() -> str:
        parts = [pick(words) for _ in range(int(rng.integers(2, 6)))]
        kind = int(rng.integers(0, 6))
        if kind == 0:
            parts.append(str(rng.integers(0, 10000)))
        if kind == 1:
            parts.insert(0, f"{rng.integers(1990, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}")
        if kind == 2:
            return "".join(p.title() for p in parts) + str(rng.integers(0, 100))
        if kind == 3:
            return str(rng.integers(10**15, 10**18)) + pick(["", "", str(rng.integers(10**6, 10**9))])
        if kind == 4:
            parts.append(f"v{rng.integers(0, 30)}")
        if kind == 5:
            return "".join(parts)
        return pick("_-/=+").join(parts) + pick(["", str(rng.integers(0, 100))])

    plain = [ordinary() for _ in range(SAMPLES)]
    half, mid = len(plain) // 2, len(words) // 2
    model = Model(_pairs(random) - _pairs(plain[:half] + words[:mid]), [])
    fits = [p for p in plain[half:] + words[mid:] if len(p) >= SHORTEST and set(p) <= set(ALPHABET)]
    for n, stop in zip(LENGTHS, [*LENGTHS[1:], 10**9]):
        ratios = [model.mean_ratio(p) for p in fits if n <= len(p) < stop]
        model.thresholds.append(float(max(0.0, np.quantile(ratios, 1 - FALSE_SHARE))) if ratios else 0.0)
    return model


def _base(df: DataFrame, text: str) -> DataFrame:
    for no, (kind, regex) in enumerate(zip(KINDS, (ASSIGN, ACCESS, HEX))):
        df = add_matches(df, text, f"__{kind}", regex)
        if kind == "assign":
            df = df.withColumn(f"__{kind}", F.filter(f"__{kind}", lambda x: F.length(F.regexp_extract(x["m"], VALUE, 1)) >= 6))
        df = df.withColumn(f"__{kind}", F.expr(f"transform(__{kind}, x -> named_struct('start', x.start, 'no', {no}, 'end', x.end, 'kind', '{kind}'))"))
    return df.withColumn("__base", F.expr("array_sort(concat(" + ", ".join(f"__{k}" for k in KINDS) + "))"))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Fits the models on words of a bounded sample of the corpus, taken by hash from all over it, and on what the
    stated patterns find there: values of assignments, access keys and hexadecimal runs. A document adds few of
    either, so neither a very long one nor a hot source fills the sample. Null texts take no part; without any text the
    models learn from what is made by rule."""
    texts = docs.select(F.col(text_col).alias("t")).where(F.col("t").isNotNull()).withColumn("h", F.xxhash64("t"))
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    texts = texts.where(F.pmod(F.col("h"), F.lit(1_000_000_000)) < F.lit(int(share * 1e9)))

    def some(found: Column, most: int) -> Column:
        by_lot = F.array_sort(F.transform(F.array_distinct(found), lambda w: F.struct(F.xxhash64(w, "h").alias("k"), w.alias("w"))))
        return F.transform(F.slice(by_lot, 1, most), lambda x: x["w"])

    all_of = lambda regex, group=0: F.regexp_extract_all("t", F.lit(regex), F.lit(group))
    secrets = F.concat(F.filter(all_of(VALUE.strip("^$"), 1), lambda v: F.length(v) >= 6), all_of(ACCESS), all_of(HEX))
    rows = texts.select("h", some(all_of(r"\b[A-Za-z]{2,40}\b"), DOC_WORDS).alias("words"), some(secrets, DOC_SECRETS).alias("secrets"))
    rows = rows.orderBy("h", "words").limit(SAMPLE_DOCS).collect()
    words = [w for r in rows for w in r.words]
    rng = np.random.default_rng(31)
    return fit([words[i] for i in rng.permutation(len(words))[:CORPUS_WORDS]], [w for r in rows for w in r.secrets])


def find(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with n_assign, n_access, n_hex (spans of the stated patterns), base_spans and spans: arrays of
    structs (start, no, end, kind) by start and kind, in characters of the text, ends exclusive.

    spans holds all base spans, and as kind random the tokens of 16 or more characters that no base span holds wholly,
    whose character pairs are likelier random than ordinary by the threshold of their length (at the threshold, random);
    they may overlap base spans. A null text counts as empty. Very long texts are searched whole; equal rows have equal
    results; an empty table gives an empty one. Columns of df that have these names are replaced."""
    made = ["n_assign", "n_access", "n_hex", "base_spans", "spans"]
    kept = [F.col(f"__row.`{c}`").alias(c) for c in df.columns if c.lower() not in made]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    found = add_matches(_base(rows, "__text"), "__text", "__token", TOKEN)
    table = "array(" + ", ".join(f"{v:.4f}D" for v in model.ratio.ravel()) + ")"
    place = lambda i: f"locate(substring(x.m, {i}, 1), '{ALPHABET}')"
    total = f"aggregate(sequence(1, length(x.m) - 1), 0D, (a, i) -> a + element_at({table}, ({place('i')} - 1) * {len(ALPHABET)} + {place('i + 1')}))"
    limit = "case " + " ".join(f"when length(x.m) >= {n} then {t!r}D" for n, t in reversed(list(zip(LENGTHS, model.thresholds)))) + " end"
    held = inside_one([f"__{k}" for k in KINDS], "x.start", "x.end")
    more = f"filter(__token, x -> not ({held}) and {total} >= {limit} * (length(x.m) - 1))"
    found = found.withColumn("__more", F.expr(f"transform({more}, x -> named_struct('start', x.start, 'no', {len(KINDS)}, 'end', x.end, 'kind', 'random'))"))
    return found.select(*kept, *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS], F.col("__base").alias("base_spans"), F.array_sort(F.concat("__base", "__more")).alias("spans"))


def redact(df: DataFrame, model: Model, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """df with its texts' spans replaced by mark; null stays null."""
    found = find(df, model, text_col)
    text = F.when(F.col(f"`{text_col}`").isNotNull(), cut_out(f"`{text_col}`", "spans", mark))
    return found.withColumn(text_col, text).select(*[f"`{c}`" for c in df.columns])
