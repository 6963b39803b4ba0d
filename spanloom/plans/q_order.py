"""Order-dependent operators: islands, neighbours, slices, running offsets and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import genes as G
from spanloom.operators import methyl as M
from spanloom.operators import relational as R
from spanloom.operators import stats as S
from spanloom.operators import windows as W
from spanloom.operators.ordering import running_total
from spanloom.plans.book import query

_ORDER = "partition by sequence order by start, stop, id, ln"
_ISLE = (
    ", r as (select *, max(stop) over (" + _ORDER + " rows between unbounded preceding and 1 preceding) as reach from {t})"
    ", n as (select *, case when reach is null or start - reach > {d} then 1 else 0 end as brk from r)"
    ", i as (select *, sum(brk) over (" + _ORDER + " rows between unbounded preceding and current row) as island from n)"
)


@query("w3_merge_adjacent", "sites", _ISLE.format(t="sites", d=20) + " select sequence, cast(island as bigint) as island, min(start) as start, max(stop) as stop, cast(count(*) as bigint) as n, round(sum(score), 6) as score, max(stop) - min(start) + 1 as length from i group by 1, 2")
def _(sites):
    return W.merge_adjacent(sites, 20, "id", "ln").withColumn("score", F.round("score", 6))


@query("w3_merge_logarithms", "sites", _ISLE.format(t="sites", d=20) + " select sequence, cast(island as bigint) as island, min(start) as start, max(stop) as stop, cast(count(*) as bigint) as n, round(log2(sum(pow(2.0, score))), 6) as score, max(stop) - min(start) + 1 as length from i group by 1, 2")
def _(sites):
    return W.merge_adjacent(sites, 20, "id", "ln", log=True).withColumn("score", F.round("score", 6))


@query("w4_collapse", "sites", ", r as (select *, max(stop) over (" + _ORDER + " rows between unbounded preceding and 1 preceding) as reach, lag(score) over (" + _ORDER + ") as before from sites), n as (select *, case when reach is null or start - reach > 60 or coalesce(abs(score - before) > 0.4, false) then 1 else 0 end as brk from r), i as (select *, sum(brk) over (" + _ORDER + " rows between unbounded preceding and current row) as island from n) select sequence, cast(island as bigint) as island, min(start) as start, max(stop) as stop, cast(round(avg(score) * count(*) * 1000000) as bigint) as score, cast(count(*) as bigint) as n from i group by 1, 2")
def _(sites):
    return W.collapse_adjacent(sites, 60, 0.4, "id", "ln").withColumn("score", F.round(F.col("score") * F.col("n") * 1e6).cast("long"))


@query("w4_gap_rows", "sites", ", r as (select *, coalesce(max(stop) over (" + _ORDER + " rows between unbounded preceding and 1 preceding), 0) as reach from sites) select sequence, reach + 1 as start, start - 1 as stop, cast(0 as double) as score from r where start > reach + 1")
def _(sites):
    return W.gaps(sites, "id", "ln")


@query("w5_slices", "sites", ", r as (select id, row_number() over (order by score, id) as k, (select count(*) from sites) as n from sites) select id, cast((k - 1) // greatest(1, n // 7) as bigint) as slice from r")
def _(sites):
    return W.partition_slices(sites, "score", 7, "id").select("id", "slice")


@query("w5_remove_mean", "sites", ", r as (select id, score, row_number() over (order by score, id) as k, (select count(*) from sites) as n from sites), s as (select id, score, (k - 1) // greatest(1, n // 7) as slice from r) select id, cast(slice as bigint) as slice, round(score - avg(score) over (partition by slice), 6) as centred from s")
def _(sites):
    rows = W.partition_slices(sites, "score", 7, "id")
    means = rows.groupBy("slice").agg(F.avg("score").alias("mean"))
    return rows.join(F.broadcast(means), "slice").select("id", "slice", F.round(F.col("score") - F.col("mean"), 6).alias("centred"))


_NB = ", g as (select *, lag(stop) over (partition by sequence order by start, stop, locus) as prev, lead(start) over (partition by sequence order by start, stop, locus) as nxt from genes)"


@query("w6_offset_plain", "genes", " select locus, greatest(0, case when strand <> '-' then start else stop end - 100) as flag_start, case when strand <> '-' then start else stop end + 100 as flag_stop from genes")
def _(genes):
    return W.offset_regions(genes, 100, True, 0).select("locus", "flag_start", "flag_stop")


_CLIP = (
    ", a as (select *, (strand <> '-') as at_start, case when strand <> '-' then start else stop end as anchor from g)"
    ", b as (select *, greatest(0, anchor - 100) as lo, anchor + 100 as hi from a)"
    ", f as (select locus, case when at_start then greatest(lo, coalesce(prev + 1, lo)) else greatest(lo, start + {k}) end as flag_start, case when at_start then least(hi, stop - {k}) else least(hi, coalesce(nxt - 1, hi)) end as flag_stop from b) select * from f where flag_start <= flag_stop"
)


@query("w6_offset_clipped", "genes", _NB + _CLIP.format(k=0))
def _(genes):
    return W.offset_regions(genes, 100, True, 2).select("locus", "flag_start", "flag_stop")


@query("w6_offset_kept_off", "genes", _NB + _CLIP.format(k=15))
def _(genes):
    return W.offset_regions(genes, 100, True, 6, keep_off=15).select("locus", "flag_start", "flag_stop")


@query("w8_introns", "exons", ", g as (select locus, min(start) - 10 as gs from exons group by 1), r as (select e.*, coalesce(lag(stop) over (partition by e.locus, isoform order by start, stop) + 1, gs) as a from exons e join g using (locus)) select sequence, locus, isoform, a as start, start - 1 as stop, strand from r where a < start")
def _(exons):
    genes = exons.groupBy("locus").agg((F.min("start") - 10).alias("start"))
    return G.introns(exons, genes)


@query("p8_paired_neighbours", "sites", ", r as (select *, lag(c) over (" + _ORDER + ") as l, lead(c) over (" + _ORDER + ") as r from sites where not regexp_matches(lower(sequence), '^chr[cm]')) select id, sequence, start, c from r where c > 1 and (coalesce(l, 0) > 1 or coalesce(r, 0) > 1)")
def _(sites):
    return M.paired_neighbours(sites).select("id", "sequence", "start", "c")


@query("w12_adjacency_runs", "sites", ", s as (select * from sites where c + t > 10 and score > 0.4)" + _ISLE.format(t="s", d=60) + ", k as (select sequence, island, count(*) as size from i group by 1, 2) select cast(size as bigint) as size, cast(count(*) as bigint) as n from k group by 1")
def _(sites):
    return M.adjacency_runs(sites, 0.4, 10, 60, "id", "ln")


@query("a29_runs_per_megabase", "sites", ", s as (select * from sites where c + t > 10 and score > 0.4)" + _ISLE.format(t="s", d=60) + ", k as (select sequence, island, count(*) as size from i group by 1, 2), b as (select sum(m) as bases from (select max(stop) as m from sites group by sequence) x) select cast(size as bigint) as size, round(count(*) * 1000000.0 / max(bases), 6) as per_mb from k, b group by 1")
def _(sites):
    bases = sites.groupBy("sequence").agg(F.max("stop").alias("m")).agg(F.sum("m").alias("bases"))
    runs = M.adjacency_runs(sites, 0.4, 10, 60, "id", "ln")
    return runs.join(F.broadcast(bases)).select("size", F.round(F.col("n") * 1e6 / F.col("bases"), 6).alias("per_mb"))


@query("w9_best_hit", "hits_a", """ select "read", chrom, coord, hit from hits_a qualify row_number() over (partition by "read" order by mismatches, hit, chrom, coord) = 1""")
def _(hits):
    from spanloom.operators.joins import best_per

    return best_per(hits, ["read"], ["mismatches", "hit", "chrom", "coord"]).select("read", "chrom", "coord", "hit")


@query("w11_running_offset", "genes", " select locus, cast(coalesce(sum(stop - start + 1) over (partition by sequence order by start, locus rows between unbounded preceding and 1 preceding), 0) as bigint) as offset_ from genes")
def _(genes):
    return W.running_offset(genes.withColumn("length", F.expr("stop - start + 1")), "sequence", ["start", "locus"], "length").select("locus", F.col("offset").alias("offset_"))


_PACK = (
    "recursive:, o as (select sequence, locus, stop - start + 1 as length, row_number() over (partition by sequence order by locus) as k from genes)"
    ", f(sequence, locus, length, k, pack, pack_offset) as (select sequence, locus, length, k, cast(0 as bigint), cast(0 as bigint) from o where k = 1"
    " union all select o.sequence, o.locus, o.length, o.k, case when f.pack_offset + f.length >= 2000 then f.pack + 1 else f.pack end, case when f.pack_offset + f.length >= 2000 then 0 else f.pack_offset + f.length end from f join o on o.sequence = f.sequence and o.k = f.k + 1)"
    " select sequence, locus, length, pack, pack_offset, pack_offset + length as pack_end from f"
)


@query("w10_scaffold_groups", "genes", _PACK)
def _(genes):
    """Scaffolds packed in order into groups of at least 2,000 bases; each group restarts the offsets."""
    from spanloom.operators.packing import pack_in_order

    rows = genes.select("sequence", "locus", F.expr("stop - start + 1").alias("length"))
    return pack_in_order(rows, "sequence", ["locus"], "length", 2000)


@query("w13_shared_islands", "sites sites_b", ", p as (select a.*, b.c as bc, b.t as bt from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start)" + _ISLE.format(t="p", d=20) + " select sequence, cast(island as bigint) as island, min(start) as start, max(stop) as stop, round(sum(c) / nullif(sum(c + t), 0), 9) as a_score, round(sum(bc) / nullif(sum(bc + bt), 0), 9) as b_score from i group by 1, 2")
def _(a, b):
    pairs = a.join(b.select("sequence", "start", F.col("c").alias("bc"), F.col("t").alias("bt")), ["sequence", "start"])
    ratio = lambda c, t: F.round(F.try_divide(F.sum(c), F.sum(F.col(c) + F.col(t))), 9)
    return W.islands(pairs, 20, "id", "ln").groupBy("sequence", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), ratio("c", "t").alias("a_score"), ratio("bc", "bt").alias("b_score"))


@query("a35_concatenated_islands", "sites", _ISLE.format(t="sites", d=20) + " select sequence, cast(island as bigint) as island, cast(sum(c) as bigint) as c, cast(sum(t) as bigint) as t, round(sum(c) / nullif(sum(c + t), 0), 9) as score from i group by 1, 2")
def _(sites):
    return W.islands(sites, 20, "id", "ln").groupBy("sequence", "island").agg(F.sum("c").alias("c"), F.sum("t").alias("t"), F.round(F.try_divide(F.sum("c"), F.sum(F.expr("c + t"))), 9).alias("score"))


_RANK = ", r as (select *, row_number() over (partition by locus order by case when strand = '-' then -start else start end, stop) as k, count(*) over (partition by locus) as n from exons)"


@query("w14_first_exons", "exons", _RANK + " select locus, start, stop from r where k = 1")
def _(exons):
    return G.pick_exons(exons, "first").select("locus", "start", "stop")


@query("w14_middle_exons", "exons", _RANK + " select locus, start, stop from r where k > 1 and k < n")
def _(exons):
    return G.pick_exons(exons, "middle").select("locus", "start", "stop")


@query("w14_last_exons", "exons", _RANK + " select locus, start, stop from r where k = n and n > 1")
def _(exons):
    return G.pick_exons(exons, "last").select("locus", "start", "stop")


_ISOFORM = ", p as (select *, case when strand = '-' then -start else start end as way from exons), q as (select *, first_value(isoform) over (partition by locus order by way, stop, isoform) as chosen from p), r as (select *, row_number() over (partition by locus order by way, stop, isoform) as k, count(*) over (partition by locus) as n from q where isoform = chosen)"


@query("w14_last_of_first_isoform", "exons", _ISOFORM + " select locus, isoform, start, stop from r where k = n and n > 1")
def _(exons):
    return G.pick_exons(exons, "last", first_isoform=True).select("locus", "isoform", "start", "stop")


_EMPTY = (
    ", m as (select *, case when c % 4 = 0 then null else score end as s from sites), r as (select *, max(stop) over (" + _ORDER + " rows between unbounded preceding and 1 preceding) as reach from m)"
    ", b as (select *, coalesce(s, 0) = 0 as empty, case when reach is null or start - reach > 20 then 1 else 0 end as apart from r)"
    ", t as (select *, sum(apart) over (" + _ORDER + " rows between unbounded preceding and current row) as steps, sum(case when empty then 1 else 0 end) over (" + _ORDER + " rows between unbounded preceding and current row) as blanks from b)"
    ", f as (select *, lag(steps) over (" + _ORDER + ") as l, lag(blanks) over (" + _ORDER + ") as e from t where not empty)"
    ", n as (select *, case when l is null or l <> steps or blanks - e > 1 then 1 else 0 end as brk from f)"
    ", i as (select *, sum(brk) over (" + _ORDER + " rows between unbounded preceding and current row) as island from n)"
)


@query("w3_merge_over_gaps", "sites", _EMPTY + " select sequence, cast(island as bigint) as island, min(start) as start, max(stop) as stop, cast(count(*) as bigint) as n, round(sum(s), 6) as score, 'merged_site' as feature, string_agg(id, '; ' order by start, stop, id, ln) as attributes from i group by 1, 2")
def _(sites):
    rows = sites.withColumns({"score": F.when(F.col("c") % 4 == 0, None).otherwise(F.col("score")), "feature": F.lit("site"), "attributes": F.col("id")})
    merged, _ = W.merge_windows(rows, 20, "id", "ln", max_gap=1)
    return merged.select("sequence", "island", "start", "stop", "n", F.round("score", 6).alias("score"), "feature", "attributes")


@query("w3_empty_rows", "sites", _EMPTY + ", g as (select sequence, island, min(start) as a, max(stop) as z from i group by 1, 2), o as (select t.*, (select max(a) from g where g.sequence = t.sequence and g.a <= t.start) as a from t where empty) select o.sequence, o.start, o.id from o left join g on g.sequence = o.sequence and g.a = o.a where g.z is null or o.start > g.z")
def _(sites):
    rows = sites.withColumns({"score": F.when(F.col("c") % 4 == 0, None).otherwise(F.col("score")), "feature": F.lit("site"), "attributes": F.col("id")})
    return W.merge_windows(rows, 20, "id", "ln", max_gap=1)[1].select("sequence", "start", "id")


@query("w16_is_sorted", "gff", ", r as (select sequence, coalesce(lag(score) over (" + _ORDER + ") > score, false) as bad from gff) select sequence, count(*) filter (bad) = 0 as sorted from r group by 1")
def _(gff):
    return W.is_sorted(gff, "score", ["start", "stop", "id", "ln"])


@query("w16_strictly_sorted", "sites", ", r as (select sequence, coalesce(lag(start) over (partition by sequence order by start, id) >= start, false) as bad from sites) select sequence, count(*) filter (bad) = 0 as sorted from r group by 1")
def _(sites):
    return W.is_sorted(sites, "start", ["start", "id"], strict=True)


@query("o1_sort_rows", "genes", " select sequence, start, locus from genes order by sequence, start")
def _(genes):
    return R.sort_rows(genes.select("sequence", "start", "locus"), "sequence", "start")


@query("o2_sort_by_end", "genes", " select locus, stop, row_number() over (order by stop, locus) as k from genes")
def _(genes):
    return running_total(genes.withColumn("one", F.lit(1)), ["stop", "locus"], "one", "k").select("locus", "stop", "k")


@query("o4_multi_key_sort", "hits_a", """ select "read", hit, chrom, coord from hits_a order by "read", hit, coord""")
def _(hits):
    return R.sort_rows(hits.select("read", "hit", "chrom", "coord"), "read", "hit", "coord")


@query("o6_argmax", "gff", " select sequence, max_by(id || ':' || ln, struct_pack(a := score, b := id, c := ln)) as best from gff group by 1")
def _(gff):
    return gff.groupBy("sequence").agg(F.max_by(F.concat_ws(":", "id", "ln"), F.struct("score", "id", "ln")).alias("best"))


_BINS = ", b as (select cast(ln as bigint) as bin, id as locus, score from gff)"


@query("a23_bin_profile", "gff", _BINS + " select bin, round(avg(score), 6) as mean, round(stddev_samp(score), 4) as std, round(var_samp(score), 2) as var, cast(count(*) as bigint) as n, round(stddev_samp(score) / sqrt(count(*)), 4) as ste, round(avg(score) - 1.96 * stddev_samp(score) / sqrt(count(*)), 3) as low, round(avg(score) + 1.96 * stddev_samp(score) / sqrt(count(*)), 3) as high from b group by 1")
def _(gff):
    out = S.bin_profile(gff.select(F.col("ln").alias("bin"), F.col("id").alias("locus"), "score"))
    places = {"mean": 6, "std": 4, "var": 2, "ste": 4, "low": 3, "high": 3}
    return out.select("bin", "n", *[F.round(c, k).alias(c) for c, k in places.items()])


@query("a24_bin_quartiles", "gff", _BINS + ", s as (select bin, list(score order by score) as a, avg(score) as m from b group by 1) select bin, round(m, 6) as mean, a[len(a) // 4 + 1] as q1, a[len(a) // 2 + 1] as q2, a[len(a) * 3 // 4 + 1] as q3, cast(len(a) as bigint) as n from s")
def _(gff):
    return S.bin_quartiles(gff.select(F.col("ln").alias("bin"), F.col("id").alias("locus"), "score")).withColumn("mean", F.round("mean", 6))


def _ends(five: bool, strategy: int) -> str:
    """Common table expressions of the bins of one end under one stop strategy."""
    at_start = "(strand <> '-')" if five else "(strand = '-')"
    clip = (
        ", f as (select sequence, locus, strand, anchor, lo as flag_start, hi as flag_stop from b)"
        if strategy == 0
        else ", f as (select sequence, locus, strand, anchor, case when at_start then greatest(lo, coalesce(prev + 1, lo)) else greatest(lo, start) end as flag_start, case when at_start then least(hi, stop) else least(hi, coalesce(nxt - 1, hi)) end as flag_stop from b)"
    )
    return (
        _NB + f", a as (select *, {at_start} as at_start, case when {at_start} then start else stop end as anchor from g)"
        ", b as (select *, greatest(0, anchor - 100) as lo, anchor + 100 as hi from a)" + clip + ""
        ", p as (select f.locus, f.strand, x.feature, cast(floor((x.start - (f.anchor - 100)) / 20) as bigint) as bin, x.score * ((least(x.stop, f.flag_stop) - greatest(x.start, f.flag_start) + 1) / (x.stop - x.start + 1)) as s"
        " from gff x join f on x.sequence = f.sequence and x.start <= f.flag_stop and x.stop >= f.flag_start where f.flag_start <= f.flag_stop)"
        ", q as (select locus, feature, case when strand = '-' then 9 - bin else bin end as bin, s from p where bin >= 0 and bin < 10)"
    )


_DENSE = _ends(True, 0) + (
    ", m as (select locus, bin, avg(s) as score from q group by 1, 2), d as (select locus, unnest(range(0, 10)) as bin from (select distinct locus from genes) l)"
    " select locus, string_agg(coalesce(cast(cast(round(score / pi()) as bigint) as varchar), 'na'), ',' order by bin) as scores from d left join m using (locus, bin) group by 1"
)


@query("w7_dense_bins", "gff genes", _DENSE)
def _(gff, genes):
    dense = W.dense_bins(W.ends_bins(gff, W.offset_regions(genes, 100, True), 100, 20, 64), genes, 10)
    return dense.select("locus", F.array_join(F.transform("scores", lambda x: F.coalesce(F.round(x / F.pi()).cast("long").cast("string"), F.lit("na"))), ",").alias("scores"))


def _matrix_part(group: str, five: bool, strategy: int) -> str:
    rows = _ends(five, strategy).removeprefix(",")
    return f"(with {rows}, m as (select locus, bin, avg(s) as score from q where feature = '{group}' group by 1, 2) select '{group}' as \"group\", '{'5p' if five else '3p'}' as side, cast({strategy} as int) as strategy, bin, cast(round(avg(score) / pi()) as bigint) as mean, cast(count(*) as bigint) as n from m group by bin)"


@query("x6_ends_matrix", "gff genes", " select * from (" + " union all ".join(_matrix_part(k, five, s) for k in "ANR" for five in (True, False) for s in (0, 2)) + ") z")
def _(gff, genes):
    from spanloom.plans.pipelines import ends_matrix

    out = ends_matrix({k: gff.where(F.col("feature") == k) for k in "ANR"}, genes, 100, 20, (0, 2), 64)
    return out.withColumn("mean", F.round(F.col("mean") / F.pi()).cast("long"))
