"""Reads: calls, mates and two genomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import align as A
from spanloom.operators import joins as J
from spanloom.operators import methyl as M
from spanloom.operators import seqops as Q
from spanloom.plans import pipelines as P
from spanloom.plans.book import query

_CALLS = (
    ", b as (select *, cast(i as bigint) as j, substr(bases, cast(i as int) + 1, 1) as base, substr(target, cast(i as int) + 1, 5) as u from reads, unnest(range(0, length(bases))) t(i) where i < stop - start)"
    ", k as (select *, case when read_no = 1 then u[3] = 'C' and base in ('C', 'T') else u[3] = 'G' and base in ('G', 'A') end as hit,"
    " case when read_no = 1 then case when u[4] = 'G' then 'CG' when u[5] = 'G' then 'CHG' else 'CHH' end else case when u[2] = 'C' then 'CG' when u[1] = 'C' then 'CHG' else 'CHH' end end as context from b)"
    ", calls as (select sequence, case when strand = '-' then length + 1 - (start + j) else start + j end as pos, case when read_no = 1 then strand when strand = '+' then '-' else '+' end as strand, context, base in ('C', 'G') as methylated from k where hit)"
)
_READS = "reads"


_CONVERT = _CALLS.replace("from reads,", "from (select * replace (case when read_no = 1 then replace(bases, 'CA', 'TA') else replace(bases, 'TG', 'TA') end as bases) from reads) reads,")


def _converted(reads):
    return reads.withColumn("bases", F.when(F.col("read_no") == 1, F.replace("bases", F.lit("CA"), F.lit("TA"))).otherwise(F.replace("bases", F.lit("TG"), F.lit("TA"))))


@query("f13_base_calls", _READS, _CONVERT + " select context, strand, methylated, cast(count(*) as bigint) as n, cast(sum(pos) as bigint) as places from calls group by 1, 2, 3")
def _(reads):
    return M.base_calls(_converted(reads)).groupBy("context", "strand", "methylated").agg(F.count("*").alias("n"), F.sum("pos").alias("places"))


_COUNTS = _CONVERT + ", counts as (select sequence, pos, case when min(context) = max(context) then min(context) else '.' end as context, case when min(strand) = max(strand) then min(strand) else '.' end as strand, count(*) filter (methylated) as c, count(*) filter (not methylated) as t from calls group by 1, 2)"


_DI = _CONVERT.replace("case when read_no = 1 then case when u[4] = 'G' then 'CG' when u[5] = 'G' then 'CHG' else 'CHH' end else case when u[2] = 'C' then 'CG' when u[1] = 'C' then 'CHG' else 'CHH' end end", "'C' || case when read_no = 1 then u[4] else translate(u[2], 'ACGT', 'TGCA') end")


@query("f14_dinucleotides", _READS, _DI + " select context, methylated, cast(count(*) as bigint) as n from calls group by 1, 2")
def _(reads):
    return M.base_calls(_converted(reads), dinucleotides=True).groupBy("context", "methylated").agg(F.count("*").alias("n"))


@query("a13_position_counts", _READS, _COUNTS + " select sequence, pos, context, strand, cast(c as bigint) as c, cast(t as bigint) as t, round(c / nullif(c + t, 0), 9) as ratio, c + t > 20 and not regexp_matches(sequence, '^chr[cm]$') as masked from counts")
def _(reads):
    return M.count_positions(M.base_calls(_converted(reads))).withColumn("ratio", F.round("ratio", 9))


@query("f15_contexts_resolved", _READS, _COUNTS + " select context, strand, cast(count(*) as bigint) as n from counts group by 1, 2")
def _(reads):
    return M.count_positions(M.base_calls(_converted(reads))).groupBy("context", "strand").agg(F.count("*").alias("n"))


@query("x1_bisulfite_windows", _READS, _COUNTS + ", r as (select sequence, pos, c, t from counts where context <> '.'), u as (select sequence, max(pos) as upper from r group by 1), w as (select r.sequence, (pos - 1) // 50 * 50 + 1 as win_start, c, t, upper from r join u using (sequence) where pos >= 1) select sequence, win_start, least(win_start + 49, upper) as win_stop, cast(sum(c) as bigint) as sum_c, cast(sum(t) as bigint) as sum_t, round(sum(c) / sum(c + t), 9) as score from w where win_start <= upper - 49 or win_start < upper group by 1, 2, 3")
def _(reads):
    out = P.bisulfite_run(_converted(reads), 50)["windows"]
    return out.select("sequence", "win_start", "win_stop", "sum_c", "sum_t", F.round("score", 9).alias("score"))


@query("x2_context_totals", _READS, _COUNTS + " select context, cast(sum(c) as bigint) as c, cast(sum(t) as bigint) as t, round(sum(c) / sum(c + t), 9) as ratio from counts group by 1")
def _(reads):
    out = P.bisulfite_run(_converted(reads), 50)["counts"]
    return out.groupBy("context").agg(F.sum("c").alias("c"), F.sum("t").alias("t"), F.round(F.sum("c") / F.sum(F.expr("c + t")), 9).alias("ratio"))


@query("a17_read_contexts", "fasta", ", p as (select seq_id, seq, unnest(range(1, greatest(length(seq), 1) + 1)) as i from fasta where length(seq) > 0), k as (select seq_id, case when seq[i] = 'C' then 1 end as hit, seq[i + 1] as x, seq[i + 2] as y from p) select seq_id, cast(count(hit) as int) as c, cast(count(hit) filter (x = 'G') as int) as cg, cast(count(hit) filter (x in ('A', 'C', 'T') and y = 'G') as int) as chg, cast(count(hit) filter (x in ('A', 'C', 'T') and y in ('A', 'C', 'T')) as int) as chh from k group by 1")
def _(fasta):
    rows = fasta.where("length(seq) > 0")
    return rows.select("seq_id", *M.read_contexts(rows))


@query("a17_bulk_contexts", "fasta", ", r as (select cast(substr(seq_id, 2) as bigint) % 2 as read_no, seq from fasta where length(seq) > 0) select read_no, cast(sum(len(regexp_extract_all(seq, 'CG'))) as bigint) as cg, cast(sum(len(regexp_extract_all(seq, 'C'))) as bigint) as c from r group by 1")
def _(fasta):
    rows = fasta.select((F.substring("seq_id", 2, 12).cast("long") % 2).alias("read_no"), "seq").where("length(seq) > 0")
    c, cg, _, _ = M.read_contexts(rows)
    return rows.groupBy("read_no").agg(F.sum(cg).alias("cg"), F.sum(c).alias("c"))


_PAIRS = """
, la as (select "read", count(*) as l from hits_a group by 1), lb as (select "read", count(*) as r from hits_b group by 1),
n as (select coalesce(la."read", lb."read") as "read", coalesce(l, 0) as l, coalesce(r, 0) as r from la full join lb on la."read" = lb."read"),
p as (select a."read", a.coord as ac, b.coord as bc, a.hit as ah, b.hit as bh, abs((a.chrom_length - a.coord + 1) - b.coord) as score from hits_a a join hits_b b on a."read" = b."read" and a.chrom = b.chrom and a.strand <> b.strand),
q as (select * from p where score <= 5000 qualify row_number() over (partition by "read" order by score, ah, bh, ac, bc) = 1),
oa as (select "read", coord from hits_a qualify row_number() over (partition by "read" order by hit, coord) = 1),
f as (select n."read", l, r, ac, bc, score, oa.coord as only_a, score is not null and (score >= 40 or (l = 1 and r = 1)) as fits from n left join q on q."read" = n."read" left join oa on oa."read" = n."read")"""


@query("j11_mate_pairs", "hits_a hits_b", _PAIRS + """ select "read", case when l = 0 then 'NM' when l = 1 then 'U' else 'R' end || '/' || case when r = 0 then 'NM' when r = 1 then 'U' else 'R' end as tag,
 case when l = 1 then only_a when fits then ac end as left_coord, case when fits then bc end as right_coord, case when fits then score end as score from f""")
def _(a, b):
    return J.pair_mates(a, b, 40, 4960).drop("left_random", "right_random")


@query("j11_mate_rows", "hits_a hits_b", _PAIRS + """, m as (select f."read", case when l = 0 then 'NM' when l = 1 then 'U' else 'R' end || '/' || case when r = 0 then 'NM' when r = 1 then 'U' else 'R' end as tag, case when l = 1 then only_a when fits then ac end as lc, case when fits then bc end as rc, l, r from f)
select "read", 'left' as "end", tag as source, coalesce(lc, 0) as start, coalesce(lc + 35, 0) as stop, cast(l as bigint) as score from m
union all select "read", 'right', tag, coalesce(rc, 0), coalesce(rc + 35, 0), cast(r as bigint) from m""")
def _(a, b):
    a, b = (h.withColumn("seq", F.lit("ACGT")) for h in (a, b))
    return J.mate_rows(J.pair_mates(a, b, 40, 4960), a, b).select("read", "end", "source", "start", "stop", "score")


@query("a18_correlated_stats", "hits_a hits_b", _PAIRS + """, m as (select case when l = 0 then 'NM' when l = 1 then 'U' else 'R' end || '/' || case when r = 0 then 'NM' when r = 1 then 'U' else 'R' end as tag, l, r from f), e as (select tag, l as s from m union all select tag, r from m)
select cast(count(*) as bigint) as "ALL", cast(count(*) filter (s < 1) as bigint) as NM, cast(count(*) filter (s = 1) as bigint) as UT, cast(count(*) filter (s > 1) as bigint) as RT, cast(count(*) filter (s = 1 and tag like '%U/U%') as bigint) as UU, coalesce(sum(case when s = 1 and (tag like '%U/R%' or tag like '%R/U%') then 0.5 when s = 1 and tag like '%R/R%' then 1.0 else 0.0 end), 0) as RR from e""")
def _(a, b):
    a, b = (h.withColumn("seq", F.lit("ACGT")) for h in (a, b))
    return M.correlated_stats(J.mate_rows(J.pair_mates(a, b, 40, 4960), a, b))


@query("j12_mate_products", "hits_a hits_b", """, p as (select a."read", a.chrom as sequence, a.coord as start, b.coord as b_start, greatest(a.coord, b.coord) + 35 - least(a.coord, b.coord) + 1 as insert_ from hits_a a join hits_b b on a."read" = b."read" and a.chrom = b.chrom and a.strand <> b.strand) select "read", sequence, start, b_start, insert_, count(*) over (partition by "read") = 1 as "unique" from p where abs(insert_ - 10000) <= 6000""")
def _(a, b):
    rows = lambda h: h.select("read", F.col("chrom").alias("sequence"), F.col("coord").alias("start"), (F.col("coord") + 35).alias("stop"), "strand")
    return J.mate_products(rows(a), rows(b), 10000, 6000).select("read", "sequence", "start", "b_start", F.col("insert").alias("insert_"), "unique")


@query("j12_unique_mates", "hits_a hits_b", """, p as (select a."read", a.coord as start, b.coord as b_start, greatest(a.coord, b.coord) + 35 - least(a.coord, b.coord) + 1 as insert_ from hits_a a join hits_b b on a."read" = b."read" and a.chrom = b.chrom and a.strand <> b.strand), q as (select *, count(*) over (partition by "read") as n from p where abs(insert_ - 18500) <= 150) select "read", start, b_start from q where n = 1""")
def _(a, b):
    rows = lambda h: h.select("read", F.col("chrom").alias("sequence"), F.col("coord").alias("start"), (F.col("coord") + 35).alias("stop"), "strand")
    return J.choose_mates(J.mate_products(rows(a), rows(b), 18500, 150)).select("read", "start", "b_start")


@query("j13_paired_stats", "hits_a hits_b", """, a as (select "read", count(*) filter (mismatches = 0) as r0, count(*) filter (mismatches = 1) as r1 from hits_a group by 1), b as (select "read", count(*) filter (mismatches = 0) as r0, count(*) filter (mismatches = 1) as r1 from hits_b group by 1) select 'left' as side, cast(count(*) as bigint) as n, cast(count(*) filter (r0 = 1) as bigint) as u0, cast(count(*) filter (r0 = 0 and r1 = 1) as bigint) as u1 from a union all select 'right', count(*), count(*) filter (r0 = 1), count(*) filter (r0 = 0 and r1 = 1) from b""")
def _(a, b):
    def one(h, side):
        ranks = h.groupBy("read").agg(*[F.count_if(F.col("mismatches") == k).alias(f"r{k}") for k in (0, 1)]).withColumn("r2", F.lit(0))
        return M.alignment_stats(ranks).select(F.lit(side).alias("side"), F.col("ALL").alias("n"), F.col("U0").alias("u0"), F.col("U1").alias("u1"))

    return one(a, "left").unionByName(one(b, "right"))


_WIN = """, a as (select "read", min(mismatches) as mm, min(coord) as coord, min(chrom) as chrom from hits_a group by 1), b as (select "read", min(mismatches) as mm, min(coord) as coord from hits_b group by 1)"""


def _first(h):
    return h.groupBy("read").agg(F.min("mismatches").alias("mismatches"), F.min("coord").alias("coord"), F.min("chrom").alias("chrom"))


@query("j14_winner_reads", "hits_a hits_b", _WIN + """ select a."read", case when a.mm < b.mm then 'a' else 'b' end as winner, a.mm as mm_a, b.mm as mm_b, a.coord <> b.coord as coordinates_differ from a join b on a."read" = b."read" where a.mm <> b.mm""")
def _(a, b):
    return J.winner_reads(_first(a), _first(b))


@query("x3_two_genome_ratio", "hits_a hits_b", _WIN + """, w as (select chrom, count(*) filter (a.mm < b.mm) as a, count(*) filter (b.mm < a.mm) as b from a join b on a."read" = b."read" where a.mm <> b.mm group by 1) select chrom, cast(a as bigint) as a, cast(b as bigint) as b, round(a / nullif(b, 0), 6) as ratio from w""")
def _(a, b):
    return P.two_genome_ratio(_first(a), _first(b)).select("chrom", "a", "b", F.when(F.col("b") > 0, F.round("ratio", 6)).alias("ratio"))


@query("p20_original_reads", "hits_a reads", """ select h."read", coord, hit, bases from hits_a h join reads r on 'R' || substr(r.name, 2) = h."read" """)
def _(hits, reads):
    own = reads.select(F.concat(F.lit("R"), F.substring("name", 2, 20)).alias("read"), "bases")
    return hits.join(own, "read").select("read", "coord", "hit", "bases")


@query("p21_unmatched_reads", "reads hits_a", """, h as (select "read", count(*) as n from hits_a group by 1) select name, coalesce(cast(n as varchar), 'NM') as rank from reads left join h on h."read" = 'R' || substr(name, 2)""")
def _(reads, hits):
    n = hits.groupBy("read").agg(F.count("*").alias("n"))
    own = reads.select("name", F.concat(F.lit("R"), F.substring("name", 2, 20)).alias("read"))
    return own.join(n, "read", "left").select("name", F.coalesce(F.col("n").cast("string"), F.lit("NM")).alias("rank"))


@query("p22_reads_listed", "hits_a reads", """ select "read", coord from hits_a where "read" in (select 'R' || substr(name, 2) from reads)""")
def _(hits, reads):
    own = reads.select(F.concat(F.lit("R"), F.substring("name", 2, 20)).alias("read"))
    return hits.join(own, "read", "left_semi").select("read", "coord")


@query("f12_quality", "part", ", q as (select p_partkey as k, i, (p_partkey * 7 + i * i) % 46 - 5 as q from part, unnest(range(0, p_size + 1)) t(i)) select k, string_agg(chr(cast(floor(33 + 10 * log10(1 + pow(10, q / 10.0)) + 0.499) as int)), '' order by i) as qual from q group by 1")
def _(part):
    """Qualities that depend on the row."""
    text = F.expr("array_join(transform(sequence(0, p_size), i -> char((p_partkey * 7 + i * i) % 46 + 59)), '')")
    return part.select(F.col("p_partkey").alias("k"), text.alias("s")).select("k", X.solexa_to_sanger("s").alias("qual"))


@query("f14_contexts", "fasta", ", p as (select seq_id, seq, unnest(range(1, length(seq) + 1)) as i from fasta where length(seq) > 0) select case when substr(seq, i + 1, 1) = 'G' then 'CG' when substr(seq, i + 2, 1) = 'G' then 'CHG' else 'CHH' end as context, cast(count(*) as bigint) as n from p where substr(seq, i, 1) = 'C' group by 1")
def _(fasta):
    # pieces with two bases more, so that each place has its context; the places of a piece are counted, not made rows
    parts = Q.chunks(fasta, 1000, 2)
    n = {"CG": "regexp_count(substring(part, 1, 1001), 'CG')", "CHG": "regexp_count(part, 'C(?=[^G]G)')", "all": "regexp_count(substring(part, 1, 1000), 'C')"}
    sums = parts.agg(*[F.sum(F.expr(x).cast("long")).alias(k) for k, x in n.items()])
    out = sums.select(F.expr("stack(3, 'CG', CG, 'CHG', CHG, 'CHH', `all` - CG - CHG) as (context, n)"))
    return out.where("n > 0")


@query("f17_pair_distance", "hits_a hits_b", """ select a."read", a.hit as ah, b.hit as bh, abs((a.chrom_length - a.coord + 1) - b.coord) as opposite, greatest(0, abs(a.coord - b.coord) - 36) as single from hits_a a join hits_b b on a."read" = b."read" and a.chrom = b.chrom""")
def _(a, b):
    y = b.select("read", "chrom", F.col("coord").alias("bc"), F.col("hit").alias("bh"))
    p = a.join(y, ["read", "chrom"])
    return p.select("read", F.col("hit").alias("ah"), "bh", X.pair_distance("coord", "bc", "chrom_length").alias("opposite"), X.pair_distance("coord", "bc", None, True, F.lit(36)).alias("single"))


@query("f21_mismatch_class", "hits_a", """, r as (select "read", count(*) filter (mismatches = 0) as r0, count(*) filter (mismatches = 1) as r1, count(*) filter (mismatches = 2) as r2 from hits_a group by 1) select "read", cast(case when r0 = 1 then 0 when r1 = 1 then 1 when r2 = 1 then 2 end as int) as class from r""")
def _(hits):
    ranks = hits.groupBy("read").agg(F.array(*[F.count_if(F.col("mismatches") == k).cast("int") for k in range(3)]).alias("ranks"))
    return ranks.select("read", X.mismatch_class("ranks").alias("class"))


@query("f27_read_parts", "reads", " select name as pair_id, cast(read_no as varchar) as read_no, bases from reads where length(bases) > 0")
def _(reads):
    feature = F.concat("name", F.lit("/"), F.col("read_no").cast("string"), F.lit(":"), "bases")
    pair, no, bases = X.read_parts(feature)
    return reads.where("length(bases) > 0").select(pair.alias("pair_id"), no.alias("read_no"), bases.alias("bases"))


@query("a16_seeker_counts", "gff", ", k as (select sequence, case ln % 3 when 0 then 'CG' when 1 then 'CHG' else 'CHH' end as context, start as pos, c > 25 as up from gff) select sequence, context, pos, cast(count(*) filter (up) as bigint) as c, cast(count(*) filter (not up) as bigint) as t from k group by 1, 2, 3")
def _(gff):
    sign = F.when(F.col("ln") % 3 == 0, "x").when(F.col("ln") % 3 == 1, "y").otherwise("z")
    rows = gff.select("sequence", F.col("start").alias("pos"), F.when(F.col("c") > 25, F.upper(sign)).otherwise(sign).alias("call"))
    return M.seeker_counts(rows)


#: Reads with as many bases changed as their place's number modulo 3 tells, at places that depend on it.
_K = "(start // 40 + start % 7)"
_PUT = "case when {k} % 3 >= {least} then concat(substr({x}, 1, cast({k} % {n} + {off} as int)), translate(substr({x}, cast({k} % {n} + {off} + 1 as int), 1), 'ACGT', 'CATG'), substr({x}, cast({k} % {n} + {off} + 2 as int))) else {x} end"
_WORN = _PUT.format(k=_K, least=2, n=19, off=20, x="(" + _PUT.format(k=_K, least=1, n=17, off=1, x="bases") + ")")
_HITS = (
    f", m as (select name as rd, read_no, case when length(bases) = 40 then {_WORN} else bases end as seq from reads)"
    ", r as (select *, case when read_no = 1 then translate(seq, 'C', 'T') else translate(seq, 'G', 'A') end as cs from m)"
    ", strands as (select seq_id, '+' as strand, seq from fasta union all select seq_id, '-', reverse(translate(seq, 'ACGT', 'TGCA')) from fasta)"
    ", cut as materialized (select read_no, seq_id, strand, i as o, substr(case when read_no = 1 then translate(seq, 'C', 'T') else translate(seq, 'G', 'A') end, i, 239) as part from strands, (values (1), (2)) n(read_no), unnest(range(1, length(seq) + 1, 200)) t(i))"
    ", w as materialized (select read_no, seq_id, strand, o + i as start, substr(part, i + 1, 40) as w from cut, unnest(range(0, least(200, length(part) - 39))) t(i))"
    ", u as materialized (select distinct read_no, cs from r where length(cs) = 40)"
    ", h as (select distinct read_no, cs, seq_id, strand, start, hamming(w, cs) as mismatches from (" + " union all ".join(f"select w.*, cs from w join u on w.read_no = u.read_no and substr(w, {13 * j + 1}, 13) = substr(cs, {13 * j + 1}, 13)" for j in range(3)) + ") where hamming(w, cs) <= 2)"
    ", b as (select *, count(*) over (partition by read_no, cs) as hits from (select * from h qualify mismatches = min(mismatches) over (partition by read_no, cs)))"
)


def _worn(reads):
    """Reads with up to two bases changed."""
    seq = F.expr(f"case when length(bases) = 40 then {_WORN.replace('//', 'div')} else bases end")
    return reads.select(F.col("name").alias("read"), "read_no", seq.alias("seq"))


@query("x1_aligned_hits", "reads fasta", _HITS + ' select r.rd as "read", seq_id as sequence, strand, start, cast(mismatches as int) as mismatches, cast(coalesce(hits, 0) as bigint) as hits from r left join (select * from b where hits <= 10) x on r.read_no = x.read_no and r.cs = x.cs')
def _(reads, fasta):
    """Bisulfite reads of 40 bases with up to two mismatches on both strands of the converted genome."""
    found = A.bisulfite_alignments(_worn(reads), fasta, mismatches=2, max_hits=10, shortest=40)
    return found.select("read", "sequence", "strand", "start", "mismatches", "hits")


@query("x1_aligned_windows", "reads fasta", _HITS + (
    ", one as (select r.rd, r.read_no, r.seq, x.seq_id as sequence, x.strand, x.start from r join (select * from b where hits = 1) x on r.read_no = x.read_no and r.cs = x.cs)"
    ", a as (select one.*, 'NN' || s.seq || 'NN' as ref, length(s.seq) as n from one join strands s on s.seq_id = one.sequence and s.strand = one.strand)"
    ", k as (select *, substr(seq, i + 1, 1) as base, substr(ref, start + i, 5) as u, i from (select sequence, strand, start, read_no, seq, n, substr(ref, start, 44) as ref0, ref from a) z, unnest(range(0, 39)) t(i))"
    ", c as (select sequence, case when strand = '-' then n + 1 - (start + i) else start + i end as pos, base in ('C', 'G') as methylated from k where case when read_no = 1 then u[3] = 'C' and base in ('C', 'T') else u[3] = 'G' and base in ('G', 'A') end)"
    " select sequence, (pos - 1) // 50 * 50 + 1 as win_start, cast(count(*) filter (methylated) as bigint) as c, cast(count(*) filter (not methylated) as bigint) as t from c group by 1, 2"
))
def _(reads, fasta):
    """From reads and a genome to alignments, calls and windows: reads of one best place only."""
    hits = A.bisulfite_alignments(_worn(reads), fasta, mismatches=2, max_hits=10, shortest=40).where("hits = 1")
    calls = M.base_calls(hits.withColumnRenamed("seq", "bases"))
    return calls.groupBy("sequence", (F.floor((F.col("pos") - 1) / 50) * 50 + 1).alias("win_start")).agg(F.count_if("methylated").alias("c"), F.count_if(~F.col("methylated")).alias("t"))
