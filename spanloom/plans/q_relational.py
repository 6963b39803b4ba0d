"""Projections, filters, key joins and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import joins as J
from spanloom.operators import relational as R
from spanloom.plans.book import query


@query("p1_extract_column", "gff", " select distinct sequence as value from gff where sequence is not null")
def _(gff):
    return R.extract_column(gff, "sequence", distinct=True, ordered=True)


@query("p2_rename_feature", "gff", " select id, ln, 'exon' as feature from gff")
def _(gff):
    return R.rename_feature(gff, "exon").select("id", "ln", "feature")


@query("p3_record_equality", "gff", " select id, ln, start from gff where sequence is not distinct from 'chr1' and feature is not distinct from 'R' and strand is not distinct from '-'")
def _(gff):
    return R.equal_to(gff, sequence="chr1", feature="R", strand="-").select("id", "ln", "start")


@query("p4_exists", "gff", " select count(*) > 0 as found from gff where feature = 'A' and sequence = 'chr3'")
def _(gff):
    return R.exists(gff, feature="A", sequence="chr3")


@query("p4_null_predicate", "gff", " select sequence, cast(count(*) as bigint) as n from (select *, case when ln > 2 then feature end as f2 from gff) x where f2 is null group by 1")
def _(gff):
    return R.equal_to(gff.withColumn("f2", F.expr("case when ln > 2 then feature end")), f2=None).groupBy("sequence").agg(F.count("*").alias("n"))


_HIT = "(score >= 20000 and stop - start >= 10 and feature = 'N')"


@query("p5_score_filter_drop", "gff", f" select id, ln from (select id, ln, feature, start, stop, case when ln < 6 then score end as score from gff) x where score is null or not {_HIT}")
def _(gff):
    return R.score_filter(gff.withColumn("score", F.expr("case when ln < 6 then score end")), False, low=20000, shortest=10, feature="N").select("id", "ln")


@query("p5_score_filter_keep", "gff", f" select id, ln from gff where score is null or {_HIT}")
def _(gff):
    return R.score_filter(gff, True, low=20000, shortest=10, feature="N").select("id", "ln")


@query("p5_id_list", "gff lists", " select id, ln from gff where id not in (select id from lists where id is not null)")
def _(gff, lists):
    return R.score_filter(gff, False, ids=lists).select("id", "ln")


@query("p6_random_sample", "gff", None)
def _(gff):
    return R.sample_rows(gff, 100, 7).select("id", "ln")


@query("p7_listed_rows", "gff lists", " select g.id, ln, list_score, ordinal from gff g join lists l on g.id = l.id where list_score is not null and list_score >= 1")
def _(gff, lists):
    return R.listed_rows(gff, lists.drop("toxic"), low=1, in_order=True).select("id", "ln", "list_score", "ordinal")


@query("t6_unseen_ids", "lists gff", " select id from lists where id not in (select id from gff)")
def _(lists, gff):
    return R.unseen_ids(lists, gff).select("id")


@query("o7_list_order", "lists gff", " select l.ordinal, l.id, cast(count(*) as bigint) as n from lists l join gff g on g.id = l.id group by 1, 2")
def _(lists, gff):
    return R.listed_rows(gff, lists.drop("toxic"), in_order=False).groupBy("ordinal", "id").agg(F.count("*").alias("n")).orderBy("ordinal")


@query("p10_has_target", "gff", " select sequence, cast(count(*) as bigint) as n from (select *, case when ln % 2 = 0 then 'x;target=ACGT' else 'x' end as attributes from gff) y where attributes like '%target=%' group by 1")
def _(gff):
    rows = gff.withColumn("attributes", F.expr("case when ln % 2 = 0 then 'x;target=ACGT' else 'x' end"))
    return rows.where("attributes like '%target=%'").groupBy("sequence").agg(F.count("*").alias("n"))


@query("p11_skip_groups", "gff", " select sequence, cast(count(*) as bigint) as n from gff where not regexp_matches(sequence, 'chr[45cm]$') group by 1")
def _(gff):
    return gff.where(~F.col("sequence").rlike("chr[45cm]$")).groupBy("sequence").agg(F.count("*").alias("n"))


@query("p16_flanks", "genes", " select locus, greatest(0, start - case when strand = '-' then 30 else 100 end) as start, stop + case when strand = '-' then 100 else 30 end as stop from genes")
def _(genes):
    return R.offset_coordinates(genes, 100, 30).select("locus", "start", "stop")


@query("p16_scaffold_offsets", "genes", ", m as (select distinct sequence, cast(substr(sequence, 4) as bigint) * 1000000 as shift from genes where sequence <> 'chr5') select locus, g.sequence, start + coalesce(shift, 0) as start, stop + coalesce(shift, 0) as stop from genes g left join m using (sequence)")
def _(genes):
    shifts = genes.where("sequence <> 'chr5'").select("sequence", (F.substring("sequence", 4, 9).cast("long") * 1000000).alias("shift")).distinct()
    rows = genes.join(shifts, "sequence", "left").withColumn("shift", F.coalesce("shift", F.lit(0)))
    return rows.select("locus", "sequence", (F.col("start") + F.col("shift")).alias("start"), (F.col("stop") + F.col("shift")).alias("stop"))


@query("p17_flip", "genes", ", m as (select sequence, max(stop) + 500 as length from genes group by 1) select locus, length + 1 - start as start, length + 1 - stop as stop, '-' as strand from genes join m using (sequence)")
def _(genes):
    lengths = genes.groupBy("sequence").agg((F.max("stop") + 500).alias("length"))
    return R.flip_coordinates(genes, lengths).select("locus", "start", "stop", "strand")


@query("p18_expand", "gff", ", b as (select sequence, unnest(range(start, stop + 1)) as pos from gff) select sequence, cast(count(*) as bigint) as bases, cast(sum(pos) as bigint) as total from b group by 1")
def _(gff):
    return R.expand(gff).groupBy("sequence").agg(F.count("*").alias("bases"), F.sum("start").alias("total"))


@query("p23_ensure_all", "genes lists", " select g.locus, coalesce(l.s, 0) as score from genes g left join (select id, max(list_score) as s from lists group by 1) l on l.id = g.locus")
def _(genes, lists):
    return R.ensure_all(genes, lists.groupBy(F.col("id").alias("locus")).agg(F.max("list_score").alias("score")))


@query("j9_keyed_merge", "sites sites_b", " select a.sequence, a.start, a.stop, a.score, b.score as b_score from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start and a.stop = b.stop")
def _(a, b):
    return J.keyed_pairs(a.select("sequence", "start", "stop", "score"), b.select("sequence", "start", "stop", "score"), ["sequence", "start", "stop"])


@query("j9_unpaired", "gff genes", " select cast(count(*) as bigint) as n from gff g where not exists (select 1 from genes p where p.sequence = g.sequence and p.start = g.start)")
def _(gff, genes):
    return J.unpaired(gff, genes, ["sequence", "start"]).agg(F.count("*").alias("n"))


@query("j10_start_pairs", "sites sites_b", " select a.sequence, a.start, round(a.score - b.score, 6) as difference from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start where a.stop = b.stop and a.score is not null and b.score is not null")
def _(a, b):
    pairs = J.keyed_pairs(a.select("sequence", "start", "stop", "score"), b.select("sequence", "start", "stop", "score"), ["sequence", "start"])
    return pairs.where("stop = b_stop and score is not null and b_score is not null").select("sequence", "start", F.round(F.col("score") - F.col("b_score"), 6).alias("difference"))


@query("j16_listed_average", "gff lists", " select sequence, round(avg(score), 6) as score, cast(count(*) as bigint) as n from gff where id in (select id from lists) group by 1")
def _(gff, lists):
    return gff.join(lists.select("id"), "id", "left_semi").groupBy("sequence").agg(F.round(F.avg("score"), 6).alias("score"), F.count("*").alias("n"))


@query("j17_map_join", "gff", ", m as (select 'chr1' as sequence, 'north' as name union all select 'chr2', 'south') select coalesce(name, 'unknown') as name, cast(count(*) as bigint) as n from gff left join m using (sequence) group by 1")
def _(gff):
    names = gff.sparkSession.createDataFrame([("chr1", "north"), ("chr2", "south")], "sequence string, name string")
    return gff.join(F.broadcast(names), "sequence", "left").groupBy(F.coalesce("name", F.lit("unknown")).alias("name")).agg(F.count("*").alias("n"))


@query("t1_union_all", "sites sites_b", ", u as (select sequence, start, c, t from sites union all select sequence, start, c, t from sites_b) select sequence, cast(count(*) as bigint) as n, cast(sum(c) as bigint) as c, cast(sum(t) as bigint) as t from u group by 1")
def _(a, b):
    cols = ["sequence", "start", "c", "t"]
    return a.select(*cols).unionByName(b.select(*cols)).groupBy("sequence").agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.sum("t").alias("t"))


@query("t2_membership", "lists", ", m as (select id, 'good' as list from lists where list_score = 1 union all select id, 'toxic' from lists where toxic = 1 union all select id, 'even' from lists where ordinal % 2 = 0), k as (select id, string_agg(distinct list, '&' order by list) as combo from m group by 1) select combo, cast(count(*) as bigint) as n from k group by 1")
def _(lists):
    part = lambda cond, name: lists.where(cond).select("id", F.lit(name).alias("list"))
    return R.membership(part("list_score = 1", "good").unionByName(part("toxic = 1", "toxic")).unionByName(part("ordinal % 2 = 0", "even")))


@query("t3_distinct_ranges", "gff", " select distinct sequence, start, stop from gff")
def _(gff):
    return R.distinct_ranges(gff)


@query("t4_distinct_values", "gff", " select distinct feature as value from gff where feature is not null")
def _(gff):
    return R.extract_column(gff, "feature", distinct=True)


@query("t5_complement", "gff", " select sequence, array_to_string(list_sort(list_filter(['A', 'N', 'R', 'X'], lambda x: not list_contains(list(distinct feature), x))), ',') as missing from gff group by 1")
def _(gff):
    wanted = F.array(*[F.lit(x) for x in "ANRX"])
    return gff.groupBy("sequence").agg(F.array_join(F.array_sort(F.array_except(wanted, F.collect_set("feature"))), ",").alias("missing"))


@query("d17_score_table", "gff", ", k as (select id, feature, sum(score) as s from gff group by 1, 2) select id, round(max(case when feature = 'A' then s end), 2) as a, round(max(case when feature = 'N' then s end), 2) as n, round(max(case when feature = 'R' then s end), 2) as r from k group by 1")
def _(gff):
    sums = {k.lower(): gff.where(F.col("feature") == k).groupBy("id").agg(F.round(F.sum("score"), 2).alias("score")) for k in "ANR"}
    return R.score_table(sums, "id")


@query("f1_length", "gff", " select sequence, cast(sum(stop - start + 1) as bigint) as bases from gff group by 1")
def _(gff):
    return gff.groupBy("sequence").agg(F.sum(X.span_length()).alias("bases"))


_TWO = ", p as (select a.id, a.start as s1, a.stop as e1, b.start as s2, b.stop as e2 from gff a join sites b on a.id = b.id)"


def _two(gff, sites):
    b = sites.select("id", F.col("start").alias("s2"), F.col("stop").alias("e2"))
    return gff.select("id", F.col("start").alias("s1"), F.col("stop").alias("e1")).join(b, "id")


@query("f2_range_predicates", "gff sites", _TWO + " select id, e1 < s2 as before, s1 > e2 as after, s1 <= e2 and e1 >= s2 as overlaps from p")
def _(gff, sites):
    return _two(gff, sites).select("id", X.before("e1", "s2").alias("before"), X.after("s1", "e2").alias("after"), X.overlaps("s1", "e1", "s2", "e2").alias("overlaps"))


@query("f3_overlap_size", "gff sites", _TWO + " select id, greatest(0, least(e1, e2 + 30) - greatest(s1, s2 - 30) + 1) as bases from p")
def _(gff, sites):
    return _two(gff, sites).select("id", X.overlap_size("s1", "e1", F.col("s2") - 30, F.col("e2") + 30).alias("bases"))


@query("f4_overlap_ratio", "gff sites", _TWO + " select id, round(greatest(0, least(e1, e2 + 30) - greatest(s1, s2 - 30) + 1) / 61.0, 9) as ratio from p")
def _(gff, sites):
    return _two(gff, sites).select("id", F.round(X.overlap_ratio("s1", "e1", F.col("s2") - 30, F.col("e2") + 30), 9).alias("ratio"))


@query("f5_attribute", "gff", ", a as (select id, ln, case when ln % 3 = 0 then 'Name x;y' when ln % 3 = 1 then 'a=1;ID=' || id || '.2;b=3' else 'plain' end as s from gff) select id, ln, case when ln % 3 = 1 then id || '.2' when ln % 3 = 0 then 'Name x' else 'plain' end as value from a")
def _(gff):
    text = F.expr("case when ln % 3 = 0 then 'Name x;y' when ln % 3 = 1 then concat('a=1;ID=', id, '.2;b=3') else 'plain' end")
    return gff.select("id", "ln", X.attribute(text, "ID").alias("value"))


@query("f6_locus_parts", "exons", " select distinct locus as prefix, split_part(isoform, '.', 2) as suffix from exons")
def _(exons):
    return exons.select(X.locus_prefix("isoform").alias("prefix"), X.locus_suffix("isoform").alias("suffix")).distinct()


@query("f19_log_ratio", "sites sites_b", " select a.id, case when a.score > 0 and b.score > 0 then round(log2(a.score / b.score), 6) end as log_ratio, round(a.score - b.score, 6) as difference, round(a.score * b.score, 9) as product from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start")
def _(a, b):
    pairs = J.keyed_pairs(a.select("sequence", "start", "id", "score"), b.select("sequence", "start", "score"), ["sequence", "start"])
    way = lambda how: F.round(X.combine_scores("score", "b_score", how), 6)
    return pairs.select("id", way("log2").alias("log_ratio"), way("difference").alias("difference"), F.round(X.combine_scores("score", "b_score", "product"), 9).alias("product"))


@query("f22_centre_distance", "genes", " select locus, abs((start + stop) // 2 - case when strand = '-' then stop else start end) as five, abs((start + stop) // 2 - case when strand = '-' then start else stop end) as three from genes")
def _(genes):
    five, three, _ = X.centre_distance("start", "stop", "start", "stop", "strand")
    return genes.select("locus", five.alias("five"), three.alias("three"))


@query("f23_compare", "sites sites_b", ", p as (select a.id, a.score as a, b.score as b, case when a.start % 3 = 0 then 0.0 when a.start % 2 = 0 then 1.0 else 0.05 end as p from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start) select id, round(a - b, 6) as sub, round(a / nullif(b, 0), 6) as div, round(b - a, 6) as rev, round(case when p in (0, 1) then p else 1 / ln(p) end, 6) as inverse from p")
def _(a, b):
    pairs = J.keyed_pairs(a.select("sequence", "start", "id", "score"), b.select("sequence", "start", "score"), ["sequence", "start"])
    p = F.expr("case when start % 3 = 0 then 0D when start % 2 = 0 then 1D else 0.05D end")
    return pairs.select("id", F.round(X.compare_scores("score", "b_score"), 6).alias("sub"), F.round(X.compare_scores("score", "b_score", "div"), 6).alias("div"), F.round(X.compare_scores("score", "b_score", reverse=True), 6).alias("rev"), F.round(X.inverse_log(p), 6).alias("inverse"))


@query("f26_format_g", "gff", " select id, ln, printf('%g', floor(score)) as whole, printf('%g', floor(score) / 1000000000.0) as small, printf('%g', floor(score) * 1000.0) as large from gff")
def _(gff):
    return gff.select("id", "ln", X.format_g(F.floor("score")).alias("whole"), X.format_g(F.floor("score") / 1e9).alias("small"), X.format_g(F.floor("score") * 1000).alias("large"))


@query("u10_sql_select", "gff", " select feature, strand, cast(count(*) as bigint) as n from gff where start between 100 and 5000 group by 1, 2")
def _(gff):
    return gff.sparkSession.sql("select feature, strand, count(*) as n from {gff} where start between 100 and 5000 group by 1, 2", gff=gff)


@query("o8_first_row", "gff", " select id, ln from gff order by start, stop, id, ln limit 1")
def _(gff):
    return gff.orderBy("start", "stop", "id", "ln").select("id", "ln").limit(1)
