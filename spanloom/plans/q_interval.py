"""Interval joins and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import joins as J
from spanloom.operators import relational as R
from spanloom.operators import windows as W
from spanloom.operators.scoring import scored
from spanloom.operators.search import search_join
from spanloom.plans.book import query

WIDTH = 64
_PAIR = ", p as (select a.*, b.locus, b.start as b_start, b.stop as b_stop from gff a join genes b on a.sequence = b.sequence and a.start <= b.stop and a.stop >= b.start)"
_W1 = (
    ", u as (select sequence, max(struct_pack(a := start, b := stop)).b as upper from gff group by 1)"
    ", w as (select sequence, upper, unnest(range(1, upper + 1, 50)) as win_start from u where upper >= 1)"
    ", v as (select sequence, win_start, least(win_start + 49, upper) as win_stop from w where win_start <= upper - 50 + 1 or win_start < upper)"
    ", p as (select v.win_start, v.win_stop, g.* from v join gff g on g.sequence = v.sequence and g.start <= v.win_stop and g.stop >= v.win_start)"
)


@query("j1_overlap_join", "gff genes", _PAIR + " select locus, cast(count(*) as bigint) as n, cast(sum(c) as bigint) as sum_c, cast(sum(least(stop, b_stop) - greatest(start, b_start) + 1) as bigint) as bases from p group by locus")
def _(gff, genes):
    p = J.overlap_join(gff, genes, WIDTH)
    return p.groupBy(F.col("b_locus").alias("locus")).agg(F.count("*").alias("n"), F.sum("c").alias("sum_c"), F.sum(X.overlap_size("start", "stop", "b_start", "b_stop")).alias("bases"))


@query("j2_overlap_ranges", "gff", " select sequence, feature, start, stop, id, ln from gff where sequence = 'chr2' and feature = 'N' and ((start <= 900 and stop >= 500) or (start <= 2200 and stop >= 2000))")
def _(gff):
    return J.overlaps_literal(gff, "chr2", [(500, 900), (2000, 2200)], "N").select("sequence", "feature", "start", "stop", "id", "ln")


@query("j3_overlap_ratio", "gff genes", _PAIR + " select id, ln, locus from p where (least(stop, b_stop) - greatest(start, b_start) + 1) >= 0.8 * (stop - start + 1)")
def _(gff, genes):
    return J.overlaps_by_ratio(gff, genes, 0.8, WIDTH).select("id", "ln", F.col("b_locus").alias("locus"))


@query("j3_overlap_counts", "gff genes", _PAIR + ", k as (select locus, count(*) as n from p where (least(stop, b_stop) - greatest(start, b_start) + 1) >= 0.5 * (stop - start + 1) group by 1) select distinct g.locus, cast(coalesce(n, 0) as bigint) as n from genes g left join k using (locus)")
def _(gff, genes):
    return J.overlap_counts(gff, genes, 0.5, WIDTH, all_loci=True)


@query("j4_start_in_window", "gff", ", w as (select sequence, start, c, t, unnest(range(cast(greatest(0, ceil((start - 100) / 40.0)) as bigint), (start - 1) // 40 + 1)) * 40 + 1 as win_start from gff) select sequence, win_start, cast(sum(c) as bigint) as sum_c, cast(sum(t) as bigint) as sum_t, cast(sum(case when start >= win_start + 40 then c else 0 end) as bigint) as over_c, cast(sum(case when start >= win_start + 40 then t else 0 end) as bigint) as over_t, round(sum(c) / sum(c + t), 9) as score from w group by 1, 2")
def _(gff):
    return W.sliding_by_start(gff, 100, 40).withColumn("score", F.round("score", 9))


@query("a38_sliding_windows", "sites", ", w as (select sequence, start, c, t, unnest(range(cast(greatest(0, ceil((start - 500) / 500.0)) as bigint), (start - 1) // 500 + 1)) * 500 + 1 as win_start from sites where start >= 1) select sequence, win_start, cast(sum(c) as bigint) as sum_c, cast(sum(t) as bigint) as sum_t, cast(0 as bigint) as over_c, cast(0 as bigint) as over_t, round(sum(c) / nullif(sum(c + t), 0), 9) as score from w group by 1, 2")
def _(sites):
    return W.sliding_by_start(sites, 500, 500).withColumn("score", F.round("score", 9))


_PEAK = ", peaks as (select sequence, id || ':' || ln as peak, start, stop from gff where t = 1)"
_NEAR = (
    _PEAK + ", r as (select peak, sequence, start as ps, stop as pe, {lo} as lo, {hi} as hi from peaks)"
    ", p as (select r.peak, g.start as pos0, g.locus as id, (ps + pe) // 2 as mid, case when g.strand = '-' then g.stop else g.start end as five, case when g.strand = '-' then g.start else g.stop end as three, g.start as gs, g.stop as ge from r join genes g on r.sequence = g.sequence and r.lo <= g.stop and r.hi >= g.start)"
    ", q as (select peak, pos0, id, least(abs(mid - five), abs(mid - three)) as distance, case when abs(mid - five) <= abs(mid - three) then '5p' else '3p' end as side, mid >= gs and mid <= ge as spans from p)"
    " select peak, string_agg(id || ':' || distance || ':' || side || case when spans then '-' else '' end, ',' order by pos0, id, distance, side) as targets from q group by peak"
)


def _named(found):
    text = F.transform("targets", lambda x: F.concat(x["id"], F.lit(":"), x["distance"].cast("string"), F.lit(":"), x["side"], F.when(x["spans"], "-").otherwise("")))
    return found.select("peak", F.array_join(text, ",").alias("targets"))


def _peaks(gff):
    return gff.where("t = 1").select("sequence", F.concat_ws(":", "id", "ln").alias("peak"), "start", "stop")


@query("j5_peak_targets_centre", "gff genes", _NEAR.format(lo="greatest(0, (start + stop) // 2 - 60)", hi="(start + stop) // 2 + 60"))
def _(gff, genes):
    return _named(J.assign_loci(_peaks(gff), genes, 60, "centre", WIDTH))


@query("j5_peak_targets_span", "gff genes", _NEAR.format(lo="start", hi="stop"))
def _(gff, genes):
    return _named(J.assign_loci(_peaks(gff), genes, 0, "span", WIDTH))


@query("j5_peak_targets_flank", "gff genes", _NEAR.format(lo="greatest(0, start - 25)", hi="stop + 25"))
def _(gff, genes):
    return _named(J.assign_loci(_peaks(gff), genes, 25, "span_flank", WIDTH))


_PICK = (
    _NEAR.format(lo="greatest(0, (start + stop) // 2 - 60)", hi="(start + stop) // 2 + 60").split(" select peak, string_agg")[0]
    + ", o as (select *, row_number() over (partition by peak order by pos0, id, distance, side) as k from q)"
    " select peak, id, distance, side from (select peak, list_reduce(list(struct_pack(id := id, distance := distance, side := side) order by k), lambda a, x:"
    " case when abs(a.distance - x.distance) > 100 then case when x.distance < a.distance then x else a end"
    " when x.side = '5p' and (a.side <> '5p' or x.distance < a.distance) then x else a end) as b from o group by peak) t, lateral (select b.id as id, b.distance as distance, b.side as side)"
)


@query("f20_best_target", "gff genes", _PICK)
def _(gff, genes):
    return J.assign_loci(_peaks(gff), genes, 60, "centre", WIDTH).select("peak", F.col("best.id").alias("id"), F.col("best.distance").alias("distance"), F.col("best.side").alias("side"))


@query("j6_max_in_peak", "gff genes", _PAIR + " select locus as peak, id, ln, round(score, 2) as score from p qualify row_number() over (partition by locus order by score desc, start, stop, id, ln) = 1")
def _(gff, genes):
    p = J.overlap_join(genes.withColumnRenamed("locus", "peak"), gff, WIDTH)
    return J.best_per(p, ["peak"], [F.desc("b_score"), "b_start", "b_stop", "b_id", "b_ln"]).select("peak", F.col("b_id").alias("id"), F.col("b_ln").alias("ln"), F.round("b_score", 2).alias("score"))


@query("w1_fixed_windows", "gff", _W1 + " select sequence, win_start, win_stop, cast(count(*) as bigint) as n, cast(sum(c) as bigint) as sum_c, cast(sum(t) as bigint) as sum_t, round(sum(c) / sum(c + t), 9) as score from p group by 1, 2, 3 having sum(c + t) > 0")
def _(gff):
    return W.window_fixed(gff, 50, 50, "fractional_methylation").withColumn("score", F.round("score", 9))


@query("w1_keep_empty", "gff", _W1 + ", s as (select sequence, win_start, win_stop, count(*) as n, sum(score) as score from p group by 1, 2, 3) select v.sequence, v.win_start, v.win_stop, cast(n as bigint) as n, round(score, 2) as score from v left join s using (sequence, win_start, win_stop)")
def _(gff):
    return W.window_fixed(gff, 50, 50, "sum", keep_empty=True).withColumn("score", F.round("score", 2))


_SLIDE = _W1.replace("range(1, upper + 1, 50)", "range(1, upper + 1, 30)").replace("+ 49", "+ 99").replace("upper - 50 + 1", "upper - 100 + 1")


@query("w1_sliding_average", "gff", _SLIDE + " select sequence, win_start, win_stop, cast(count(*) as bigint) as n, cast(round(avg(score) * count(*) * 100) as bigint) as cents, round(stddev_samp(score), 5) as std, round(var_samp(score), 1) as var from p group by 1, 2, 3")
def _(gff):
    out = W.window_fixed(gff, 100, 30, "average")
    return out.withColumn("score", F.round(F.col("score") * F.col("n") * 100).cast("long")).withColumnRenamed("score", "cents").withColumn("std", F.round("std", 5)).withColumn("var", F.round("var", 1))


@query("w2_window_ids", "gff", _W1 + " select sequence, 'WindowID=[' || win_start || ',' || win_stop || ']' as window_id, cast(count(*) as bigint) as n from p group by 1, 2")
def _(gff):
    out = W.window_fixed(gff, 50, 50, "sum")
    return out.select("sequence", F.format_string("WindowID=[%d,%d]", "win_start", "win_stop").alias("window_id"), "n")


@query("a1_fractional_loci", "gff genes", _PAIR + " select sequence, locus, b_start as win_start, b_stop as win_stop, cast(count(*) as bigint) as n, cast(sum(c) as bigint) as sum_c, cast(sum(t) as bigint) as sum_t, round(sum(c) / sum(c + t), 9) as score from p group by 1, 2, 3, 4")
def _(gff, genes):
    return W.window_annotation(gff, genes, "fractional_methylation", WIDTH).withColumn("score", F.round("score", 9))


@query("a2_fractional_zero", "sites genes", ", p as (select b.locus, a.c, a.t from genes b left join sites a on a.sequence = b.sequence and a.start <= b.stop and a.stop >= b.start) select locus, round(coalesce(sum(c) / nullif(sum(c + t), 0), 0), 9) as score from p group by 1")
def _(sites, genes):
    out = W.window_annotation(sites, genes, "fractional_methylation", WIDTH, keep_empty=True)
    return out.groupBy("locus").agg(F.round(F.coalesce(F.try_divide(F.sum("sum_c"), F.sum(F.expr("sum_c + sum_t"))), F.lit(0.0)), 9).alias("score"))


@query("a3_score_sum", "gff genes", _PAIR + " select locus, cast(count(*) as bigint) as n, round(sum(coalesce(score, 0)), 2) as score from p group by 1")
def _(gff, genes):
    return W.window_annotation(gff, genes, "sum", WIDTH).select("locus", "n", F.round("score", 2).alias("score"))


@query("a4_average", "gff genes", _PAIR + " select locus, cast(count(*) as bigint) as n, cast(round(avg(score) * count(*) * 100) as bigint) as cents, round(stddev_samp(score), 5) as std, round(var_samp(score), 1) as var from p group by 1")
def _(gff, genes):
    out = W.window_annotation(gff, genes, "average", WIDTH)
    return out.select("locus", "n", F.round(F.col("score") * F.col("n") * 100).cast("long").alias("cents"), F.round("std", 5).alias("std"), F.round("var", 1).alias("var"))


_OV = "(least(stop, b_stop) - greatest(start, b_start) + 1)"


@query("a5_fully_diluted", "gff genes", _PAIR + f" select locus, cast(count(*) as bigint) as n, round(avg(score * ({_OV} / (stop - start + 1)) * ({_OV} / (b_stop - b_start + 1))) / pi(), 6) as score from p group by 1")
def _(gff, genes):
    return W.window_annotation(gff, genes, "full_weighed_average", WIDTH).select("locus", "n", F.round(F.col("score") / F.pi(), 6).alias("score"))


@query("a6_half_diluted", "gff genes", _PAIR + f" select locus, cast(count(*) as bigint) as n, round(avg(score * {_OV} / (b_stop - b_start + 1)) / pi(), 6) as score from p group by 1")
def _(gff, genes):
    return W.window_annotation(gff, genes, "half_weighed_average", WIDTH).select("locus", "n", F.round(F.col("score") / F.pi(), 6).alias("score"))


@query("a7_locus_collector", "gff genes", _PAIR + ", q as (select locus, start, case when t > 1 then id end as id from p) select locus, cast(count(*) as bigint) as n, coalesce(string_agg(id, ',' order by start, id), '') as ids, cast(count(*) filter (id is null) as bigint) as unknown from q group by 1")
def _(gff, genes):
    return W.window_annotation(gff.withColumn("id", F.when(F.col("t") > 1, F.col("id"))), genes, "locus_collector", WIDTH).select("locus", "n", "ids", "unknown")


@query("a8_running_moments", "gff", " select sequence, cast(count(*) as bigint) as n, round(avg(score), 6) as score, round(stddev_samp(score), 5) as std, round(var_samp(score), 1) as var from gff group by 1")
def _(gff):
    out = scored(gff, ["sequence"], "average")
    return out.select("sequence", "n", F.round("score", 6).alias("score"), F.round("std", 5).alias("std"), F.round("var", 1).alias("var"))


@query("a30_centre_counts", "gff", " select sequence, cast(floor(((start + stop) // 2 - 1) / 100) as bigint) * 100 + 1 as win_start, cast(count(*) as bigint) as n from gff group by 1, 2")
def _(gff):
    return W.frequency_windows(gff, 100)


@query("a30_base_counts", "gff", ", b as (select sequence, unnest(range(start, stop + 1)) as pos from gff) select sequence, (pos - 1) // 100 * 100 + 1 as win_start, cast(count(*) as bigint) as n from b group by 1, 2")
def _(gff):
    return W.frequency_windows(gff, 100, every_base=True)


@query("a36_average_over_annotation", "gff genes", _PAIR + " select locus, cast(round(avg(score) * count(*) * 100) as bigint) as cents, cast(sum(c) as bigint) as c, cast(sum(t) as bigint) as t, cast(count(distinct feature) as bigint) as features from p group by 1")
def _(gff, genes):
    p = J.overlap_join(gff, genes, WIDTH)
    return p.groupBy(F.col("b_locus").alias("locus")).agg(F.round(F.avg("score") * F.count("*") * 100).cast("long").alias("cents"), F.sum("c").alias("c"), F.sum("t").alias("t"), F.count_distinct("feature").alias("features"))


@query("a39_two_samples", "sites sites_b genes", ", p as (select g.locus, g.stop - g.start + 1 as locus_len, a.score as a, null as b, a.c + a.t as act, 0 as bct from genes g join sites a on a.sequence = g.sequence and a.start <= g.stop and a.stop >= g.start union all select g.locus, g.stop - g.start + 1, null, b.score, 0, b.c + b.t from genes g join sites_b b on b.sequence = g.sequence and b.start <= g.stop and b.stop >= g.start) select locus, cast(max(locus_len) as bigint) as locus_len, cast(round(avg(a) * count(a) * 1000000) as bigint) as a_score, cast(round(avg(b) * count(b) * 1000000) as bigint) as b_score, round((avg(a) - avg(b)) / pi(), 6) as score, cast(sum(act) as bigint) as act, cast(sum(bct) as bigint) as bct from p group by 1")
def _(a, b, genes):
    x, y = J.overlap_join(a, genes, WIDTH), J.overlap_join(b, genes, WIDTH)
    row = lambda p, first: p.select(F.col("b_locus").alias("locus"), X.span_length("b_start", "b_stop").alias("len"), *[(F.col("score") if first == k else F.lit(None).cast("double")).alias(k) for k in "ab"], *[(F.expr("c + t") if first == k else F.lit(0).cast("long")).alias(k + "ct") for k in "ab"])
    both = row(x, "a").unionByName(row(y, "b"))
    m, n = F.avg("a"), F.avg("b")
    return both.groupBy("locus").agg(F.max("len").alias("locus_len"), F.round(m * F.count("a") * 1e6).cast("long").alias("a_score"), F.round(n * F.count("b") * 1e6).cast("long").alias("b_score"), F.round((m - n) / F.pi(), 6).alias("score"), F.sum("act").alias("act"), F.sum("bct").alias("bct"))


@query("j23_extend_loci", "genes gff", ", p as (select b.locus, min(a.start) as a, max(a.stop) as b from genes b join gff a on a.sequence = b.sequence and a.start <= b.stop and a.stop >= b.start group by 1) select sequence, g.locus, least(g.start, coalesce(p.a, g.start)) as new_start, greatest(g.stop, coalesce(p.b, g.stop)) as new_stop, greatest(g.stop, coalesce(p.b, g.stop)) - least(g.start, coalesce(p.a, g.start)) - (g.stop - g.start) as extension from genes g left join p using (locus)")
def _(genes, gff):
    return W.extend_loci(genes, gff, WIDTH)


@query("j23_extended_rows", "genes gff", ", p as (select b.locus, min(a.start) as a, max(a.stop) as b from genes b join gff a on a.sequence = b.sequence and a.start <= b.stop and a.stop >= b.start group by 1), q as (select sequence, g.locus, g.start, g.stop, least(g.start, coalesce(p.a, g.start)) as x, greatest(g.stop, coalesce(p.b, g.stop)) as y from genes g left join p using (locus)) select sequence, 'ext_gene' as feature, x as start, y as stop, 'ID=' || locus || case when x < start or y > stop then '; Target=' || locus || ' ' || start || ' ' || stop || '; extension=' || ((y - x) - (stop - start)) else '' end as attributes from q")
def _(genes, gff):
    rows = genes.withColumn("feature", F.lit("gene")).withColumn("attributes", F.concat(F.lit("ID="), "locus"))
    return W.extended_rows(rows, gff, width=WIDTH).select("sequence", "feature", "start", "stop", "attributes")


@query("j24_filtered_windows", "gff genes", _PAIR + " select 'filtered' as source, sequence, start, stop, locus as attribute from p")
def _(gff, genes):
    return J.overlap_join(gff, genes, WIDTH).select(F.lit("filtered").alias("source"), "sequence", "start", "stop", F.col("b_locus").alias("attribute"))


_REG0 = ", r as (select *, case when (strand <> '-') then start else stop end as anchor from genes), f as (select sequence, locus, strand, anchor, greatest(0, anchor - 100) as flag_start, anchor + 100 as flag_stop from r)"


@query("j7_point_in_region", "sites genes", _REG0 + " select a.id, f.locus from sites a join f on a.sequence = f.sequence and a.start <= f.flag_stop and a.stop >= f.flag_start qualify row_number() over (partition by a.id order by flag_start, locus) = 1")
def _(sites, genes):
    box = W.offset_regions(genes, 100, True).select("sequence", "locus", F.col("flag_start").alias("start"), F.col("flag_stop").alias("stop"))
    return search_join(sites, box, order=["start", "locus"]).select("id", F.col("b_locus").alias("locus"))


@query("w7_ends_profile", "gff genes", _REG0 + ", p as (select f.locus, f.strand, cast(floor((a.start - (f.anchor - 20 * 5)) / 20) as bigint) as bin, a.score * ((least(a.stop, f.flag_stop) - greatest(a.start, f.flag_start) + 1) / (a.stop - a.start + 1)) as s from gff a join f on a.sequence = f.sequence and a.start <= f.flag_stop and a.stop >= f.flag_start), q as (select locus, case when strand = '-' then 9 - bin else bin end as bin, s from p where bin >= 0 and bin < 10) select locus, bin, round(avg(s) / pi(), 4) as score, cast(count(*) as bigint) as n from q group by 1, 2")
def _(gff, genes):
    return W.ends_bins(gff, W.offset_regions(genes, 100, True), 100, 20, WIDTH).withColumn("score", F.round(F.col("score") / F.pi(), 4))


@query("p9_read_filter", "gff genes", _PAIR + " select id, ln, locus from p where strand = '+' and (least(stop, b_stop) - greatest(start, b_start) + 1) >= 0.7 * (stop - start + 1) and c >= 20")
def _(gff, genes):
    return J.overlaps_by_ratio(gff.where("strand = '+' and c >= 20"), genes, 0.7, WIDTH).select("id", "ln", F.col("b_locus").alias("locus"))


@query("x4_allele_counts", "hits_a hits_b genes", """, a as (select "read", min(mismatches) as mm, min(coord) as coord, min(chrom) as chrom from hits_a group by 1), b as (select "read", min(mismatches) as mm from hits_b group by 1), w as (select a.chrom, a.coord from a join b on a."read" = b."read" where a.mm < b.mm) select locus, cast(count(*) as bigint) as n from (select distinct chrom, coord from w) w join genes g on g.sequence = w.chrom and w.coord <= g.stop and w.coord + 35 >= g.start group by 1""")
def _(a, b, genes):
    x = a.groupBy("read").agg(F.min("mismatches").alias("mismatches"), F.min("coord").alias("coord"), F.min("chrom").alias("chrom"))
    y = b.groupBy("read").agg(F.min("mismatches").alias("mismatches"), F.min("coord").alias("coord"))
    won = J.winner_reads(x, y).where("winner = 'a'").select("read").join(x, "read")
    rows = R.distinct_ranges(won.select(F.col("chrom").alias("sequence"), F.col("coord").alias("start"), (F.col("coord") + 35).alias("stop")))
    return J.overlap_join(rows, genes, WIDTH).groupBy(F.col("b_locus").alias("locus")).agg(F.count("*").alias("n"))
