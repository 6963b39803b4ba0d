"""Contingency statistics, profiles and summaries."""

from __future__ import annotations

import ctypes
import ctypes.util
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spanloom.functions import exprs as X
from spanloom.operators.ordering import Along


def _cells() -> tuple[Column, ...]:
    return tuple(F.col(f"n{k}").cast("double") for k in ("11", "12", "21", "22"))


def _expected() -> dict[str, Column]:
    n11, n12, n21, n22 = _cells()
    n1p, n2p, np1, np2 = n11 + n12, n21 + n22, n11 + n21, n12 + n22
    npp = n1p + n2p
    return {"m11": F.try_divide(n1p * np1, npp), "m12": F.try_divide(n1p * np2, npp), "m21": F.try_divide(n2p * np1, npp), "m22": F.try_divide(n2p * np2, npp)}


def measure(name: str) -> Column:
    """An association measure of the columns n11, n12, n21, n22; null where it is undefined."""
    n11, n12, n21, n22 = _cells()
    n1p, n2p, np1, np2 = n11 + n12, n21 + n22, n11 + n21, n12 + n22
    npp = n1p + n2p
    m = _expected()
    cells = ((n11, m["m11"]), (n12, m["m12"]), (n21, m["m21"]), (n22, m["m22"]))
    phi = F.try_divide((n11 * n22 - n12 * n21) * (n11 * n22 - n12 * n21), n1p * np1 * n2p * np2)
    log_ratio = lambda n, e: F.when(n > 0, n * F.log(F.try_divide(n, e))).otherwise(0.0)
    total = sum((log_ratio(n, e) for n, e in cells[1:]), log_ratio(*cells[0]))
    positive = F.when(n11 > 0, n11)
    ways = {
        "dice": F.try_divide(2 * n11, n1p + np1),
        "jaccard": F.try_divide(n11, n11 + n12 + n21),
        "phi": phi,
        "x2": npp * phi,
        "tscore": (positive - m["m11"]) / F.sqrt(positive),
        "pmi": F.log2(positive / m["m11"]),
        "tmi": F.try_divide(total, npp) / F.log(F.lit(2.0)),
        "ll": 2 * total,
        "ps": positive * (F.log(positive / m["m11"]) - 1),
    }
    return ways[name]


MEASURES = ("dice", "jaccard", "phi", "x2", "tscore", "pmi", "tmi", "ll", "ps")


def _c_lgamma():
    """lgamma of the C library, which databases use too: where a probability lies on a bound (1/20, say), the last bit of its logarithm
    decides. Python's own differs in that bit, and takes its place where there is no such library."""
    try:
        found = ctypes.CDLL(ctypes.util.find_library("m")).lgamma
    except (OSError, AttributeError, TypeError):
        return math.lgamma
    found.restype, found.argtypes = ctypes.c_double, [ctypes.c_double]
    return found


_SMALL = np.array([_c_lgamma()(float(n)) for n in range(1, 1025)])


def _log_factorial(n: np.ndarray) -> np.ndarray:
    """ln n! of whole numbers: from a table, or by Stirling's series beyond it."""
    x = np.maximum(n, 1023) + 1.0
    far = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < len(_SMALL), _SMALL[np.minimum(n, len(_SMALL) - 1)], far)


def _fisher(a, b, c, d, tail: str, cells: int = 1 << 20) -> np.ndarray:
    """One probability for each table. The tables' ranges of possible counts lie one behind the other and are computed
    `cells` at a time, however long the range of a single table is."""
    a, b, c, d = (np.nan_to_num(np.asarray(x, float)).astype(np.int64) for x in (a, b, c, d))
    r1, r2, c1 = a + b, c + d, a + c
    fixed = _log_factorial(r1) + _log_factorial(r2) + _log_factorial(c1) + _log_factorial(b + d) - _log_factorial(r1 + r2)
    p = lambda row, k: np.exp(fixed[row] - _log_factorial(k) - _log_factorial(r1[row] - k) - _log_factorial(c1[row] - k) - _log_factorial(r2[row] - c1[row] + k))
    own = p(np.arange(len(a)), a)
    if tail == "point" or not len(a):
        return np.minimum(own, 1.0)
    low = np.maximum(0, c1 - r2)
    ends = np.cumsum(np.minimum(r1, c1) - low + 1)
    begins = np.concatenate(([0], ends[:-1]))
    out = np.zeros(len(a))
    for at in range(0, int(ends[-1]), cells):
        cell = np.arange(at, min(at + cells, int(ends[-1])))
        row = np.searchsorted(ends, cell, "right")
        k = low[row] + cell - begins[row]
        q = p(row, k)
        take = k <= a[row] if tail == "left" else k >= a[row] if tail == "right" else q <= own[row] * (1 + 1e-7)
        out += np.bincount(row, np.where(take, q, 0.0), len(a))
    return np.minimum(out, 1.0)


def fisher(tail: str = "two") -> Column:
    """Fisher's exact test of n11, n12, n21, n22: two, left or right tail, or the probability of the table (point)."""

    @pandas_udf("double")
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(_fisher(a, b, c, d, tail))

    return run("n11", "n12", "n21", "n22")


def compare(a: DataFrame, b: DataFrame, statistic: str = "x2", least_sites: int = 0, least_difference: float = 0.0, operator: str = "sub") -> DataFrame:
    """Pairs rows of two methylation tables on their coordinates: difference (or quotient) of scores and a
    statistic of the 2 x 2 table of c and t."""
    keys = ["sequence", "start", "stop"]
    pairs = a.select(*keys, F.col("c").alias("n11"), F.col("t").alias("n12"), F.col("score").alias("a_score")).join(b.select(*keys, F.col("c").alias("n21"), F.col("t").alias("n22"), F.col("score").alias("b_score")), keys)
    pairs = pairs.where((F.col("n11") + F.col("n12") >= least_sites) & (F.col("n21") + F.col("n22") >= least_sites) & (F.abs(F.col("a_score") - F.col("b_score")) >= least_difference))
    value = F.col("a_score") - F.col("b_score") if operator == "sub" else F.try_divide("a_score", "b_score")
    stat = fisher("two") if statistic == "fisher" else measure(statistic)
    return pairs.withColumn("score", value).withColumn("statistic", stat)


def compare_islands(a: DataFrame, b: DataFrame, statistic: str = "x2", operator: str = "sub", distance: int = 0, least_sites: int = 0) -> DataFrame:
    """Two methylation tables compared over contiguous windows: pairs on equal coordinates that aren't without c in both
    are joined while each begins right behind the one before (or up to `distance` bases later), c and t are summed, and
    scores, their difference (or quotient) and the statistic are taken of the sums. The feature is a:operator:b, and
    the attribute the statistic."""
    from spanloom.operators.windows import islands

    keys = ["sequence", "start", "stop"]
    pairs = a.select(*keys, F.col("feature").alias("fa"), F.col("c").alias("n11"), F.col("t").alias("n12")).join(b.select(*keys, F.col("feature").alias("fb"), F.col("c").alias("n21"), F.col("t").alias("n22")), keys)
    pairs = pairs.where((F.col("n11") + F.col("n12") >= least_sites) & (F.col("n21") + F.col("n22") >= least_sites) & ~((F.col("n11") == 0) & (F.col("n21") == 0)))
    cells = [F.sum(f"n{k}").alias(f"n{k}") for k in ("11", "12", "21", "22")]
    sums = islands(pairs, distance + 1).groupBy("sequence", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("fa").alias("fa"), F.min("fb").alias("fb"), *cells)
    x, y = F.try_divide("n11", F.col("n11") + F.col("n12")), F.try_divide("n21", F.col("n21") + F.col("n22"))
    value = fisher("two") if statistic == "fisher" else measure(statistic)
    out = sums.withColumn("score", x - y if operator == "sub" else F.try_divide(x, y)).withColumn("statistic", value)
    return out.select("sequence", "start", "stop", F.concat_ws(f":{operator}:", "fa", "fb").alias("feature"), "score", "statistic", F.concat(F.lit(f"{statistic}="), X.format_g("statistic")).alias("attributes"))


def imprinting(df: DataFrame, expected: float | None = 2 / 3) -> DataFrame:
    """Chi square of maternal and paternal counts (m, p) against control counts (cm, cp), or against expected
    shares of their sum, rounded half to even."""
    total = F.col("m") + F.col("p")
    cm, cp = (F.col("cm"), F.col("cp")) if expected is None else (F.bround(total * expected), F.bround(total * (1 - expected)))
    rows = df.withColumn("n11", F.col("m")).withColumn("n12", F.col("p")).withColumn("n21", cm).withColumn("n22", cp)
    return rows.withColumn("statistic", measure("x2"))


def bin_profile(bins: DataFrame) -> DataFrame:
    """Means over loci for each bin, with -+1.96 standard errors, deviation, variance and count."""
    out = bins.where("score is not null").groupBy("bin").agg(F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"), F.var_samp("score").alias("var"), F.count("*").alias("n"))
    ste = F.col("std") / F.sqrt("n")
    return out.withColumn("ste", ste).withColumn("low", F.col("mean") - 1.96 * ste).withColumn("high", F.col("mean") + 1.96 * ste)


def bin_quartiles(bins: DataFrame) -> DataFrame:
    """Mean and the elements int(n * q) of each bin's sorted scores, q = 1/4, 1/2, 3/4.

    Ranks are running totals by ranges of (bin, score), so no task holds a bin."""
    rows = bins.where("score is not null").withColumn("__one", F.lit(1))
    ranked = Along(rows, ["bin"], ["score", "locus"]).total("__one", "__k", before=True).done()
    size = rows.groupBy(F.col("bin").alias("__bin")).agg(F.count("*").alias("n"), F.avg("score").alias("mean"))
    ranked = ranked.join(size, F.col("bin").eqNullSafe(F.col("__bin")))
    pick = lambda q: F.max(F.when(F.col("__k") == F.floor(F.col("n") * q), F.col("score")))
    return ranked.groupBy("bin").agg(F.first("mean").alias("mean"), pick(0.25).alias("q1"), pick(0.5).alias("q2"), pick(0.75).alias("q3"), F.first("n").alias("n"))


def weighted_vector(df: DataFrame, vector: str, weight: str) -> DataFrame:
    """(pos, value, n): the weighted mean of vectors, place by place; of each row with over four elements the
    smallest is left out."""
    trimmed = F.when(F.size(vector) > 4, F.expr(f"concat(slice({vector}, 1, array_position({vector}, array_min({vector})) - 1), slice({vector}, array_position({vector}, array_min({vector})) + 1, size({vector})))")).otherwise(F.col(vector))
    cut = df.select(weight, F.posexplode(trimmed).alias("pos", "v"))
    return cut.groupBy("pos").agg((F.sum(F.col("v") * F.col(weight)) / F.sum(weight)).alias("value"), F.sum(weight).alias("n"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Counts and percentages of a column's values, and a Total row."""
    n = df.groupBy(column).agg(F.count("*").alias("n"))
    all_ = n.agg(F.sum("n").alias("total"))
    return n.select(F.col(column).cast("string").alias("value"), "n").join(F.broadcast(all_)).select("value", "n", (100.0 * F.col("n") / F.col("total")).alias("percent")).unionByName(all_.select(F.lit("Total").alias("value"), F.col("total").alias("n"), F.lit(100.0).alias("percent")))


def density(df: DataFrame, column: str, points: int = 101, bandwidth: float | None = None) -> DataFrame:
    """(x, pdf, cdf): a Gaussian kernel density on a grid over the range and three bandwidths beyond.

    Every row adds to all grid points inside its task; only the grid's sums are shuffled."""
    s = df.where(F.col(column).isNotNull()).agg(F.min(column).alias("a"), F.max(column).alias("b"), F.stddev_samp(column).alias("s"), F.count("*").alias("n")).first()
    h = bandwidth or max(1e-12, 1.06 * (s.s or 1.0) * max(1, s.n) ** -0.2)
    grid = np.linspace((s.a or 0.0) - 3 * h, (s.b or 0.0) + 3 * h, points)

    def run(batches):
        erf = np.frompyfunc(math.erf, 1, 1)
        pdf, cdf = np.zeros(points), np.zeros(points)
        for part in batches:
            values = part[column].to_numpy(float)
            for i in range(0, len(values), 2000):
                z = (grid[None] - values[i : i + 2000, None]) / h
                pdf += np.exp(-0.5 * z * z).sum(axis=0)
                cdf += (0.5 * (1 + erf(z / np.sqrt(2.0)).astype(float))).sum(axis=0)
        yield pd.DataFrame({"k": np.arange(points), "pdf": pdf, "cdf": cdf})

    sums = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias(column)).mapInPandas(run, "k int, pdf double, cdf double").groupBy("k").agg(F.sum("pdf").alias("pdf"), F.sum("cdf").alias("cdf"))
    step = float(grid[1] - grid[0])
    return sums.select((F.lit(float(grid[0])) + F.col("k") * step).alias("x"), (F.col("pdf") / (s.n * h * np.sqrt(2 * np.pi))).alias("pdf"), (F.col("cdf") / s.n).alias("cdf"))


def mismatch_ratio(counts: DataFrame, a: str, b: str) -> DataFrame:
    """counts with a / b; infinite where b is 0 and a is not."""
    return counts.withColumn("ratio", F.when(F.col(b) == 0, F.when(F.col(a) > 0, F.lit(float("inf")))).otherwise(F.col(a) / F.col(b)))
