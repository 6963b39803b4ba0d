"""Contingency statistics and densities."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import stats as S
from spanloom.plans.book import query

_TABLE = (
    ", p as (select a.id, cast(a.c as double) as n11, cast(a.t as double) as n12, cast(b.c as double) as n21, cast(b.t as double) as n22 from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start)"
    ", m as (select *, n11 + n12 as n1p, n21 + n22 as n2p, n11 + n21 as np1, n12 + n22 as np2, n11 + n12 + n21 + n22 as npp from p)"
    ", e as (select *, n1p * np1 / nullif(npp, 0) as m11, n1p * np2 / nullif(npp, 0) as m12, n2p * np1 / nullif(npp, 0) as m21, n2p * np2 / nullif(npp, 0) as m22 from m)"
)
_LL = "(" + " + ".join(f"case when n{k} > 0 then n{k} * ln(n{k} / nullif(m{k}, 0)) else 0 end" for k in ("11", "12", "21", "22")) + ")"
_PHI = "((n11 * n22 - n12 * n21) * (n11 * n22 - n12 * n21) / nullif(n1p * np1 * n2p * np2, 0))"
_SQL = {
    "dice": "2 * n11 / nullif(n1p + np1, 0)",
    "jaccard": "n11 / nullif(n11 + n12 + n21, 0)",
    "phi": _PHI,
    "x2": f"npp * {_PHI}",
    "tscore": "case when n11 > 0 then (n11 - m11) / sqrt(n11) end",
    "pmi": "case when n11 > 0 then log2(n11 / m11) end",
    "tmi": f"{_LL} / nullif(npp, 0) / ln(2.0)",
    "ll": f"2 * {_LL}",
    "ps": "case when n11 > 0 then n11 * (ln(n11 / m11) - 1) end",
}


def _tables(a, b):
    b = b.select("sequence", "start", F.col("c").alias("n21"), F.col("t").alias("n22"))
    return a.select("sequence", "start", "id", F.col("c").alias("n11"), F.col("t").alias("n12")).join(b, ["sequence", "start"])


def _measure(name: str) -> None:
    @query(f"f16_{name}", "sites sites_b", _TABLE + f" select id, round({_SQL[name]}, 6) as value from e")
    def _(a, b):
        return _tables(a, b).select("id", F.round(S.measure(name), 6).alias("value"))


for _name in S.MEASURES:
    _measure(_name)

_HYPER = (
    _TABLE
    + ", k as (select id, n11, n12, n21, n22, unnest(range(cast(greatest(0, np1 - n2p) as bigint), cast(least(n1p, np1) as bigint) + 1)) as x, n1p, n2p, np1, np2, npp from m)"
    ", h as (select id, n11, x, exp(lgamma(n1p + 1) + lgamma(n2p + 1) + lgamma(np1 + 1) + lgamma(np2 + 1) - lgamma(npp + 1) - lgamma(x + 1) - lgamma(n1p - x + 1) - lgamma(np1 - x + 1) - lgamma(n2p - np1 + x + 1)) as p from k)"
    ", o as (select id, max(p) filter (x = n11) as own from h group by 1)"
)


def _tail(name: str, cond: str) -> None:
    @query(f"f16_fisher_{name}", "sites sites_b", _HYPER + f" select h.id, round(least(1.0, sum(p) filter ({cond})), 6) as value from h join o using (id) group by 1")
    def _(a, b):
        return _tables(a, b).select("id", F.round(S.fisher(name), 6).alias("value"))


for _name, _cond in (("two", "p <= own * (1 + 1e-7)"), ("left", "x <= n11"), ("right", "x >= n11")):
    _tail(_name, _cond)


@query("f18_fisher_point", "sites sites_b", _HYPER + " select id, round(own, 6) as p, case when own < 0.05 then '+' else '' end as flag from o")
def _(a, b):
    p = S.fisher("point")
    return _tables(a, b).select("id", p.alias("q")).select("id", F.round("q", 6).alias("p"), F.when(F.col("q") < 0.05, "+").otherwise("").alias("flag"))


@query("f24_imprinting", "sites", ", r as (select id, cast(c as double) as n11, cast(t as double) as n12, cast(round_even((c + t) * 0.625, 0) as double) as n21, cast(round_even((c + t) * 0.375, 0) as double) as n22 from sites), m as (select *, n11 + n12 as n1p, n21 + n22 as n2p, n11 + n21 as np1, n12 + n22 as np2, n11 + n12 + n21 + n22 as npp from r) " + f"select id, cast(n21 as bigint) as em, cast(n22 as bigint) as ep, round(npp * {_PHI}, 6) as statistic from m")
def _(sites):
    out = S.imprinting(sites.withColumnsRenamed({"c": "m", "t": "p"}), 0.625)
    return out.select("id", F.col("n21").cast("long").alias("em"), F.col("n22").cast("long").alias("ep"), F.round("statistic", 6).alias("statistic"))


@query("a40_compare_tables", "sites sites_b", ", p as (select a.sequence, a.start, a.stop, a.score - b.score as d, cast(a.c as double) as n11, cast(a.t as double) as n12, cast(b.c as double) as n21, cast(b.t as double) as n22 from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start and a.stop = b.stop where a.c + a.t >= 5 and b.c + b.t >= 5 and abs(a.score - b.score) >= 0.1), m as (select *, n11 + n12 as n1p, n21 + n22 as n2p, n11 + n21 as np1, n12 + n22 as np2, n11 + n12 + n21 + n22 as npp from p)" + f" select 'compare' as source, sequence, start, stop, round(d, 6) as score, round(npp * {_PHI}, 6) as statistic from m where npp * {_PHI} >= 3.84")
def _(a, b):
    out = S.compare(a, b, "x2", least_sites=5, least_difference=0.1).where("statistic >= 3.84")
    return out.select(F.lit("compare").alias("source"), "sequence", "start", "stop", F.round("score", 6).alias("score"), F.round("statistic", 6).alias("statistic"))


@query(
    "a40_compare_islands",
    "sites sites_b",
    ", p as (select a.sequence, a.start, a.stop, a.c as n11, a.t as n12, b.c as n21, b.t as n22 from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start and a.stop = b.stop where not (a.c = 0 and b.c = 0))"
    ", r as (select *, max(stop) over (partition by sequence order by start, stop rows between unbounded preceding and 1 preceding) as reach from p)"
    ", n as (select *, case when reach is null or start - reach > 31 then 1 else 0 end as brk from r)"
    ", i as (select *, sum(brk) over (partition by sequence order by start, stop rows between unbounded preceding and current row) as island from n)"
    ", q as (select sequence, island, min(start) as start, max(stop) as stop, cast(sum(n11) as double) as n11, cast(sum(n12) as double) as n12, cast(sum(n21) as double) as n21, cast(sum(n22) as double) as n22 from i group by 1, 2)"
    ", m as (select *, n11 + n12 as n1p, n21 + n22 as n2p, n11 + n21 as np1, n12 + n22 as np2, n11 + n12 + n21 + n22 as npp from q)"
    f" select sequence, start, stop, 'x:sub:y' as feature, round(n11 / nullif(n1p, 0) - n21 / nullif(n2p, 0), 6) as score, round(npp * {_PHI}, 6) as statistic from m",
)
def _(a, b):
    out = S.compare_islands(a.withColumn("feature", F.lit("x")), b.withColumn("feature", F.lit("y")), "x2", distance=30)
    return out.select("sequence", "start", "stop", "feature", F.round("score", 6).alias("score"), F.round("statistic", 6).alias("statistic"))


@query("p12_pair_filters", "sites sites_b", " select a.sequence, a.start, round(a.score - b.score, 6) as difference from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start and a.stop = b.stop where a.c + a.t >= 10 and b.c + b.t >= 10 and abs(a.score - b.score) >= 0.25")
def _(a, b):
    out = S.compare(a, b, "dice", least_sites=10, least_difference=0.25)
    return out.select("sequence", "start", F.round("score", 6).alias("difference"))


@query("f25_density", "sites", ", s as (select min(score) as a, max(score) as b, count(*) as n from sites), g as (select k, a - 0.3 + k * (b - a + 0.6) / 100 as x, n from s, range(101) t(k)) select round(x, 9) as x, round(sum(exp(-0.5 * ((x - score) / 0.1) * ((x - score) / 0.1))) / (max(n) * 0.1 * sqrt(2 * pi())), 5) as pdf from g, sites group by 1")
def _(sites):
    return S.density(sites, "score", 101, 0.1).select(F.round("x", 9).alias("x"), F.round("pdf", 5).alias("pdf"))
