"""Aggregations by coordinates, contexts and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import genes as G
from spanloom.operators import methyl as M
from spanloom.operators import relational as R
from spanloom.operators import stats as S
from spanloom.plans.book import query


@query("a10_compile_loci", "gff", " select sequence, start, stop, cast(sum(c) as bigint) as c, cast(sum(t) as bigint) as t, round(sum(c) / sum(c + t), 9) as score, min(feature) as feature, min(strand) as strand from gff group by 1, 2, 3")
def _(gff):
    return R.compile_loci(gff).withColumn("score", F.round("score", 9))


@query("a11_collected_rows", "gff", " select id, string_agg(start || '-' || stop, ' ' order by start, stop) as ranges from gff where feature = 'N' group by 1")
def _(gff):
    rows = R.collect_rows(gff.where("feature = 'N'"), ["id"], ["start", "stop"])
    return rows.select("id", F.array_join(F.transform("rows", lambda r: F.concat_ws("-", r["start"], r["stop"])), " ").alias("ranges"))


@query("a12_store_counts", "gff", " select cast(count(*) as bigint) as n, cast(count(distinct sequence) as bigint) as sequences, cast(count(distinct feature) as bigint) as features from gff")
def _(gff):
    return gff.agg(F.count("*").alias("n"), F.count_distinct("sequence").alias("sequences"), F.count_distinct("feature").alias("features"))


@query("a14_context_summary", "sites", ", m as (select *, c + t > 20 as masked from sites) select " + ", ".join(f"cast(coalesce(sum(c) filter (context = '{k}'), 0) as bigint) as {k}_c, cast(coalesce(sum(t) filter (context = '{k}'), 0) as bigint) as {k}_t, round(sum(c) filter (context = '{k}') / nullif(sum(c + t) filter (context = '{k}'), 0), 9) as {k}_ratio, cast(coalesce(sum(c) filter (context = '{k}' and not masked), 0) as bigint) as {k}_filtered_c, cast(coalesce(sum(t) filter (context = '{k}' and not masked), 0) as bigint) as {k}_filtered_t, round(sum(c) filter (context = '{k}' and not masked) / nullif(sum(c + t) filter (context = '{k}' and not masked), 0), 9) as {k}_filtered_ratio" for k in ("CG", "CHG", "CHH")) + " from m")
def _(sites):
    out = M.context_summary(sites.withColumn("masked", F.expr("c + t > 20")))
    return out.select(*[F.round(c, 9).alias(c) if c.endswith("ratio") else c for c in out.columns])


_FREQ = ", f as (select sequence, " + ", ".join(f"coalesce(sum({x}) filter (context = '{k}'), 0) as {k}_{x}" for k in ("CG", "CHG", "CHH") for x in "ct") + " from sites group by 1)"


@query("a14_context_pivot", "sites", _FREQ + " select sequence, " + ", ".join(f"cast({k}_{x} as bigint) as {k}_{x}" for k in ("CG", "CHG", "CHH") for x in "ct") + " from f")
def _(sites):
    return M.context_counts(sites, ["sequence"])


@query("a15_merge_frequencies", "sites", _FREQ + " select " + ", ".join(f"cast(sum({k}_c) as bigint) as {k}_c, cast(sum({k}_t) as bigint) as {k}_t, round(sum({k}_c) / sum({k}_c + {k}_t), 9) as {k}_ratio" for k in ("CG", "CHG", "CHH")) + ", cast(sum(CG_c + CHG_c + CHH_c) as bigint) as C_c, cast(sum(CG_t + CHG_t + CHH_t) as bigint) as C_t, round(sum(CG_c + CHG_c + CHH_c) / sum(CG_c + CHG_c + CHH_c + CG_t + CHG_t + CHH_t), 9) as C_ratio from f")
def _(sites):
    out = M.merge_frequencies(M.context_counts(sites, ["sequence"]), ("CG", "CHG", "CHH"))
    return out.select(*[F.round(c, 9).alias(c) if c.endswith("ratio") else c for c in out.columns])


_DI = ("CG", "CA", "CC", "CT")
_DINUC = ", s as (select *, case start % 4 when 0 then 'CG' when 1 then 'CA' when 2 then 'CC' else 'CT' end as di from sites), f as (select sequence, " + ", ".join(f"coalesce(sum({x}) filter (di = '{k}'), 0) as {k}_{x}" for k in _DI for x in "ct") + " from s group by 1)"


@query("a15_merge_dinucleotides", "sites", _DINUC + " select " + ", ".join(f"cast(sum({k}_c) as bigint) as {k}_c, cast(sum({k}_t) as bigint) as {k}_t, round(sum({k}_c) / sum({k}_c + {k}_t), 9) as {k}_ratio" for k in _DI) + ", cast(sum(CG_c + CA_c + CC_c + CT_c) as bigint) as C_c, cast(sum(CG_t + CA_t + CC_t + CT_t) as bigint) as C_t, round(sum(CG_c + CA_c + CC_c + CT_c) / sum(CG_c + CA_c + CC_c + CT_c + CG_t + CA_t + CC_t + CT_t), 9) as C_ratio from f")
def _(sites):
    rows = sites.withColumn("di", F.expr("case start % 4 when 0 then 'CG' when 1 then 'CA' when 2 then 'CC' else 'CT' end"))
    freq = rows.groupBy("sequence").agg(*[F.coalesce(F.sum(F.when(F.col("di") == k, F.col(x))), F.lit(0)).alias(f"{k}_{x}") for k in _DI for x in "ct"])
    out = M.merge_frequencies(freq, _DI)
    return out.select(*[F.round(c, 9).alias(c) if c.endswith("ratio") else c for c in out.columns])


@query("a18_alignment_stats", "hits_a", """, r as (select "read", count(*) filter (mismatches = 0) as r0, count(*) filter (mismatches = 1) as r1, count(*) filter (mismatches = 2 and hit > 1) as r2 from hits_a group by 1), b as (select *, case when r0 > 0 then r0 when r1 > 0 then r1 else r2 end as best from r) select cast(count(*) as bigint) as "ALL", cast(count(*) filter (r0 + r1 + r2 = 0) as bigint) as NM, cast(count(*) filter (r0 = 1) as bigint) as U0, cast(count(*) filter (r0 = 0 and r1 = 1) as bigint) as U1, cast(count(*) filter (r0 = 0 and r1 = 0 and r2 = 1) as bigint) as U2, cast(count(*) filter (best > 1) as bigint) as R, cast(count(*) filter (best = 1) as bigint) as UT from b""")
def _(hits):
    ranks = hits.groupBy("read").agg(*[F.count_if(F.expr(f"mismatches = {k}" + (" and hit > 1" if k == 2 else ""))).alias(f"r{k}") for k in range(3)])
    return M.alignment_stats(ranks)


@query("a19_histogram", "gff", ", k as (select feature as value, count(*) as n from gff group by 1) select value, cast(n as bigint) as n, round(100.0 * n / sum(n) over (), 6) as percent from k union all select 'Total', cast(sum(n) as bigint), 100.0 from k")
def _(gff):
    return S.histogram(gff, "feature").withColumn("percent", F.round("percent", 6))


@query("a20_reads_per_target", "gff genes", ", k as (select id, count(*) as n from gff group by 1) select locus, cast(coalesce(n, 0) as bigint) as n, round(1000.0 * coalesce(n, 0) / (stop - start + 1), 6) as per_kb from genes left join k on k.id = locus")
def _(gff, genes):
    n = gff.groupBy(F.col("id").alias("locus")).agg(F.count("*").alias("n"))
    both = genes.join(n, "locus", "left").fillna(0, ["n"])
    return both.select("locus", "n", F.round(1000.0 * F.col("n") / F.expr("stop - start + 1"), 6).alias("per_kb"))


@query("a21_mismatch_cube", "hits_a", " select chrom, mismatches, cast(count(*) as bigint) as n from hits_a group by cube (chrom, mismatches)")
def _(hits):
    return hits.cube("chrom", "mismatches").agg(F.count("*").alias("n"))


@query("a21_mismatch_ratio", "hits_a", ", k as (select chrom, count(*) filter (mismatches = 0) as a, count(*) filter (mismatches = 2 and hit > 5) as b from hits_a group by 1) select chrom, cast(a as bigint) as a, cast(b as bigint) as b, case when b = 0 then case when a > 0 then 'inf' end else cast(round(a / b, 6) as varchar) end as ratio from k")
def _(hits):
    counts = hits.groupBy("chrom").agg(F.count_if(F.expr("mismatches = 0")).alias("a"), F.count_if(F.expr("mismatches = 2 and hit > 5")).alias("b"))
    out = S.mismatch_ratio(counts, "a", "b")
    return out.withColumn("ratio", F.when(F.col("ratio") == float("inf"), "inf").otherwise(F.round("ratio", 6).cast("string")))


@query("a22_collapse_repeats", "hits_a", """ select chrom as sequence, coord as start, coord + 35 as stop, strand, cast(count(*) - 1 as bigint) as score from hits_a group by 1, 2, 3, 4""")
def _(hits):
    return M.collapse_repeats(hits.select(F.col("chrom").alias("sequence"), F.col("coord").alias("start"), (F.col("coord") + 35).alias("stop"), "strand"))


@query("a26_listed_groups", "gff lists", " select cast(list_score as bigint) as grp, round(avg(score), 6) as mean, round(sum(c) / sum(c + t), 9) as fraction, round(sum(score * c) / sum(c), 6) as adjusted, cast(sum(stop - start + 1) as bigint) as length, cast(count(*) as bigint) as n from gff g join lists l on l.id = g.id group by 1")
def _(gff, lists):
    rows = gff.join(lists.select("id", "list_score"), "id")
    return rows.groupBy(F.col("list_score").cast("long").alias("grp")).agg(F.round(F.avg("score"), 6).alias("mean"), F.round(F.sum("c") / F.sum(F.expr("c + t")), 9).alias("fraction"), F.round(F.sum(F.expr("score * c")) / F.sum("c"), 6).alias("adjusted"), F.sum(F.expr("stop - start + 1")).alias("length"), F.count("*").alias("n"))


@query("a27_exon_counts", "exons", " select sequence, locus, min(start) as start, max(stop) as stop, cast(count(*) as bigint) as n from exons group by 1, 2")
def _(exons):
    return G.exon_counts(exons)


@query("a28_gene_spans", "exons", " select sequence, locus, min(start) as start, max(stop) as stop, min(strand) as strand, cast(count(distinct isoform) as bigint) as isoforms from exons group by 1, 2 having count(distinct isoform) <= 1")
def _(exons):
    return G.gene_spans(exons)


@query("p14_audit", "sites", ", p as (select sequence, start, count(*) as k, count(*) filter (c is null or t is null) as bad from sites group by 1, 2) select sequence, cast(sum(k) as bigint) as n, cast(sum(bad) as bigint) as bad_attributes, cast(count(*) filter (k > 1) as bigint) as repeated_starts, case when sum(bad) = 0 and count(*) filter (k > 1) = 0 then 'OK' else 'BAD' end as verdict from p group by 1")
def _(sites):
    return M.audit(sites)


@query("p14_audit_order", "sites", ", r as (select *, lag(start) over (partition by sequence order by id) as before from sites), p as (select sequence, start, count(*) as k, count(*) filter (before > start) as falls from r group by 1, 2) select sequence, cast(sum(k) as bigint) as n, cast(count(*) filter (k > 1) as bigint) as repeated_starts, sum(falls) = 0 as sorted, case when count(*) filter (k > 1) = 0 and sum(falls) = 0 then 'OK' else 'BAD' end as verdict from p group by 1")
def _(sites):
    return M.audit(sites, order=["id"]).drop("bad_attributes")


@query("j15_exons_of_genes", "exons genes", " select e.sequence, e.locus, e.start, e.stop, g.start as gene_start, g.stop as gene_stop from exons e join genes g on g.locus = e.locus")
def _(exons, genes):
    return G.collapse_exons(exons, genes).select("sequence", "locus", "start", "stop", "gene_start", "gene_stop")


@query("a25_weighted_vectors", "gff", ", v as (select t as n, [c, ln, c + 1, ln + 2, 50] as a from gff), w as (select n, list_filter(a, lambda x, i: i <> list_position(a, list_min(a))) as a from v), e as (select n, unnest(a) as v, generate_subscripts(a, 1) - 1 as pos from w) select cast(pos as int) as pos, round(sum(v * n) / sum(n), 6) as value, cast(sum(n) as bigint) as n from e group by 1")
def _(gff):
    rows = gff.select(F.col("t").alias("n"), F.expr("array(c, ln, c + 1, ln + 2, 50L)").alias("a"))
    return S.weighted_vector(rows, "a", "n").withColumn("value", F.round("value", 6))


@query("x5_concat_and_window", "sites sites_b", ", u as (select context, sequence, start, c, t from sites union all select case start % 2 when 0 then 'CG' else 'CHH' end, sequence, start, c, t from sites_b), w as (select context, sequence, start, sum(c) as c, sum(t) as t from u group by 1, 2, 3), k as (select context, sequence, (start - 1) // 500 * 500 + 1 as win_start, sum(c) as c, sum(t) as t from w where start >= 1 group by 1, 2, 3) select context, sequence, win_start, cast(c as bigint) as sum_c, cast(t as bigint) as sum_t, round(c / (c + t), 9) as score from k where c + t > 0")
def _(a, b):
    from spanloom.plans.pipelines import concat_and_window

    out = concat_and_window([a, b.withColumn("context", F.expr("case start % 2 when 0 then 'CG' else 'CHH' end"))], 500)
    return out.select("context", "sequence", "win_start", "sum_c", "sum_t", F.round("score", 9).alias("score"))


@query("x7_frequency_coverage", "sites", _FREQ.replace("select sequence,", "select case when sequence in ('chr4', 'chr5') then 'organelle' else 'nuclear' end as part,") + " select part, " + ", ".join(f"round({k}_c / nullif({k}_c + {k}_t, 0), 9) as {k}_ratio" for k in ("CG", "CHG", "CHH")) + ", round((CG_c + CHG_c + CHH_c + CG_t + CHG_t + CHH_t) / 1000000.0, 9) as coverage from f")
def _(sites):
    from spanloom.plans.pipelines import frequency_coverage

    return frequency_coverage(sites, ["chr4", "chr5"], 1_000_000)
