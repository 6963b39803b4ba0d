"""Sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import seqops as Q
from spanloom.plans.book import query

_RC = "reverse(translate(seq, 'ACGTacgt', 'TGCAtgca'))"


@query("f7_reverse_complement", "fasta", f" select seq_id, {_RC} as rc from fasta")
def _(fasta):
    return fasta.select("seq_id", X.reverse_complement("seq").alias("rc"))


@query("f8_conversions", "fasta", " select seq_id, translate(seq, 'cC', 'tT') as c2t, translate(seq, 'gG', 'aA') as g2a from fasta")
def _(fasta):
    return fasta.select("seq_id", X.c_to_t("seq").alias("c2t"), X.g_to_a("seq").alias("g2a"))


@query("f9_bisulfite_genome", "fasta", f" select seq_id, translate(seq, 'cC', 'tT') as seq from fasta union all select 'RC_' || seq_id, translate({_RC}, 'cC', 'tT') from fasta")
def _(fasta):
    return Q.bisulfite_genome(fasta)


@query("f9_both_strands", "fasta", f" select seq_id, seq from fasta union all select 'RC_' || seq_id, {_RC} from fasta")
def _(fasta):
    return Q.both_strands(fasta)


@query("f10_subsequence", "fasta", " select seq_id, case when length(seq) >= 30 then substr(seq, 11, 20) end as plain, case when length(seq) >= 15 then reverse(translate(substr(seq, length(seq) - 14, 10), 'ACGT', 'TGCA')) end as tail from fasta")
def _(fasta):
    return fasta.select("seq_id", X.subsequence("seq", F.lit(11), F.lit(30)).alias("plain"), X.subsequence("seq", F.lit(-15), F.lit(-6), reverse=True).alias("tail"))


#: Intervals on every sequence: each gene lies on the sequence that has its number among all of them, in turn.
_ON = ", k as (select seq_id, seq, row_number() over (order by seq_id) - 1 as k, count(*) over () as n from fasta), i as (select k.seq_id as sequence, g.locus, g.start, g.stop, g.strand, k.seq from genes g join k on k.k = cast(substr(g.locus, 3) as bigint) % k.n)"


def _placed(genes, fasta):
    from spanloom.operators.ordering import running_total

    numbered = running_total(fasta.select("seq_id").withColumn("one", F.lit(1)), ["seq_id"], "one", "k").select("seq_id", (F.col("k") - 1).alias("k"))
    n = fasta.count()
    return genes.withColumn("k", F.expr(f"cast(substring(locus, 3) as bigint) % {n}")).join(numbered, "k").select("locus", F.col("seq_id").alias("sequence"), "start", "stop", "strand")


@query("f11_extract", "fasta genes", _ON + ", j as (select *, start % 100 + 1 as a, start % 100 + 1 + stop % 30 as b from i) select locus, case when b <= length(seq) then case when strand = '-' then reverse(translate(substr(seq, cast(a as int), cast(b - a + 1 as int)), 'ACGT', 'TGCA')) else substr(seq, cast(a as int), cast(b - a + 1 as int)) end end as bases from j")
def _(fasta, genes):
    rows = _placed(genes, fasta).selectExpr("locus", "sequence", "start % 100 + 1 as start", "start % 100 + 1 + stop % 30 as stop", "strand")
    return Q.extract(rows, fasta, size=64).select("locus", "bases")


@query("f11_around_tss", "fasta genes", _ON + ", j as (select *, start % 300 + 1 as s, start % 300 + 1 + stop % 30 as e from i), p as (select *, case when strand = '-' then e else s end - 20 as a from j where e - s > 5), q as (select *, greatest(1, a) as x, a + 40 as y from p) select locus, case when y <= length(seq) then case when strand = '-' then reverse(translate(substr(seq, cast(x as int), cast(y - x + 1 as int)), 'ACGT', 'TGCA')) else substr(seq, cast(x as int), cast(y - x + 1 as int)) end end as bases from q")
def _(fasta, genes):
    rows = _placed(genes, fasta).selectExpr("locus", "sequence", "start % 300 + 1 as start", "start % 300 + 1 + stop % 30 as stop", "strand")
    return Q.extract(rows, fasta, distance=41, anchor="tss", longer_than=5).select("locus", "bases")


@query("s14_padded", "fasta", f" select seq_id, 'NN' || seq || 'NN' as forward, 'NN' || {_RC} || 'NN' as reverse from fasta")
def _(fasta):
    return Q.padded(fasta)


@query("s15_counts", "documents", " select 'S' || doc_id as seq_id, cast(length(text) as int) as length, cast(length(regexp_replace(text, '[^acgtACGT]', '', 'g')) as int) as bp, cast(length(text) - length(regexp_replace(text, '[^acgtACGT]', '', 'g')) as int) as nonbp from documents where text is not null")
def _(documents):
    return Q.counts(documents.where("text is not null").select(F.concat(F.lit("S"), "doc_id").alias("seq_id"), F.col("text").alias("seq")))


@query("s13_lengths", "fasta", " select seq_id, cast(length(seq) as int) as length from fasta")
def _(fasta):
    return fasta.select("seq_id", F.length("seq").alias("length"))


@query("s34_groups", "fasta", " select distinct seq_id from fasta")
def _(fasta):
    return fasta.select("seq_id").distinct()


@query("a31_composition", "fasta", ", c as (select seq_id, seq, unnest(range(1, length(seq) + 1, 100)) as pos0 from fasta where length(seq) > 0), p as (select seq_id, pos0, substr(seq, pos0, 100) as part from c) select seq_id, cast(pos0 as int) as start, cast(pos0 + length(part) - 1 as int) as stop, " + ", ".join(f"cast(length(part) - length(replace(part, '{b.upper()}', '')) as int) as {b}" for b in "acgt") + " from p")
def _(fasta):
    return Q.composition(fasta, 100)


@query("a32_kmers", "fasta", ", k as (select substr(seq, i, 3) as kmer from fasta, unnest(range(1, length(seq) - 1)) t(i) where length(seq) >= 3) select kmer, cast(count(*) as bigint) as n from k group by 1")
def _(fasta):
    return Q.kmers(fasta, 3, 200)


@query("a32_observed_expected", "fasta", ", b as (select substr(seq, i, 1) as base from fasta, unnest(range(1, length(seq) + 1)) t(i)), s as (select base, count(*) / sum(count(*)) over () as share from b group by 1), k as (select substr(seq, i, 2) as kmer from fasta, unnest(range(1, length(seq))) t(i) where length(seq) >= 2), c as (select kmer, count(*) as n, sum(count(*)) over () as total from k group by 1) select kmer, cast(n as bigint) as n, round(x.share * y.share * total, 3) as expected, round(n / (x.share * y.share * total), 6) as ratio from c join s x on x.base = kmer[1] join s y on y.base = kmer[2]")
def _(fasta):
    return Q.expected_kmers(fasta, 2).select("kmer", "n", F.round("expected", 3).alias("expected"), F.round("ratio", 6).alias("ratio"))


@query("a33_kmer_difference", "fasta", ", f as (select * from fasta where seq_id like '%1'), a as (select substr(seq, i, 2) as kmer, count(*) as n from fasta, unnest(range(1, length(seq))) t(i) where length(seq) >= 2 group by 1), b as (select substr(seq, i, 2) as kmer, count(*) as n from f, unnest(range(1, length(seq))) t(i) where length(seq) >= 2 group by 1) select kmer, cast(a.n - coalesce(b.n, 0) as bigint) as n from a left join b using (kmer)")
def _(fasta):
    return Q.kmer_difference(Q.kmers(fasta, 2), Q.kmers(fasta.where("seq_id like '%1'"), 2))


@query("a34_motif_hits", "fasta", " select seq_id, cast(len(regexp_extract_all(seq, 'CA[CT]G')) as int) as hits from fasta")
def _(fasta):
    return Q.motif_hits(fasta, "CA[CT]G")


@query("a37_cg_sites", "fasta", " select seq_id, cast(len(regexp_extract_all(seq, 'CG')) as int) as hits from fasta")
def _(fasta):
    return Q.motif_hits(fasta, "CG")


@query("j21_genome_diff", "fasta", ", p as (select seq_id, seq as a, translate(seq, 'G', 'A') as b from fasta) select seq_id, cast(i as int) as pos, substr(a, i, 1) as a, substr(b, i, 1) as b, substr(a, i, 1) || '>' || substr(b, i, 1) as snp from p, unnest(range(1, length(a) + 1)) t(i) where substr(a, i, 1) <> substr(b, i, 1)")
def _(fasta):
    out = Q.differences(fasta, fasta.select("seq_id", F.translate("seq", "G", "A").alias("seq")), 500, equal_lengths=True)
    return out.withColumn("snp", X.snp_notation("a", "b"))


@query("j22_rank_diff", "fasta", ", o as (select seq, row_number() over (order by seq_id) as k, count(*) over () as n from fasta), p as (select seq, (k - 1) // 2 + 1 as rank, k % 2 as side from o), r as (select * from p where side = 1), s as (select * from p where side = 0) select rank, cast(sum(len(list_filter(range(1, least(length(r.seq), length(s.seq)) + 1), lambda i: r.seq[i] <> s.seq[i]))) as bigint) as differences from r join s using (rank) group by 1 having sum(len(list_filter(range(1, least(length(r.seq), length(s.seq)) + 1), lambda i: r.seq[i] <> s.seq[i]))) > 0")
def _(fasta):
    """Two genomes compared by the rank of their headers: the sequences of odd and of even ranks."""
    from spanloom.operators.ordering import running_total

    ranked = running_total(fasta.withColumn("one", F.lit(1)), ["seq_id"], "one", "k")
    side = lambda odd: ranked.where(f"k % 2 = {odd}").select(((F.col("k") - 1 - (F.col("k") - 1) % 2) / 2 + 1).cast("long").alias("seq_id"), "seq")
    out = Q.differences(side(1), side(0), 500)
    return out.groupBy(F.col("seq_id").alias("rank")).agg(F.count("*").alias("differences"))


_SIDES = ", o as (select seq_id, seq, row_number() over (order by seq_id) as k from fasta), p as (select r.seq_id as a_id, s.seq_id as b_id, (r.k + 1) // 2 as rank, r.seq as a, s.seq as b from o r left join o s on s.k = r.k + 1 where r.k % 2 = 1)"


def _sides(fasta):
    """The sequences of odd and of even ranks as two genomes."""
    from spanloom.operators.ordering import running_total

    ranked = running_total(fasta.withColumn("one", F.lit(1)), ["seq_id"], "one", "k")
    return [ranked.where(f"k % 2 = {odd}").select(F.expr("(k + 1) div 2").alias("rank"), F.col("seq_id").alias("header"), "seq") for odd in (1, 0)]


@query("j22_marked_sequences", "fasta", _SIDES + ", c as (select rank, a_id as header, coalesce(a, '') as x, coalesce(b, '') as y from p union all select rank, b_id, b, a from p where b_id is not null), m as (select rank, header, list_transform(range(1, length(x) + 1), lambda i: case when x[i] = y[i] and i <= length(y) then lower(x[i]) else upper(x[i]) end) as l from c where length(x) > 0) select rank, header, sha256(array_to_string(l, '')) as digest from m")
def _(fasta):
    """Both sequences of each rank with the bases in upper case where they differ."""
    marked, _ = Q.marked_differences(*_sides(fasta), 256)
    whole = marked.groupBy("rank", "header").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]), "").alias("seq"))
    return whole.select("rank", "header", F.sha2("seq", 256).alias("digest"))


@query("j22_difference_report", "fasta", _SIDES + " select rank, a_id as a, b_id as b, cast(len(list_filter(range(1, greatest(length(a), length(b)) + 1), lambda i: i > length(a) or i > length(b) or p.a[i] <> p.b[i])) as bigint) as mismatches, case when length(p.a) <> length(p.b) then 'strings have different sizes: ' || length(p.a) || ', ' || length(p.b) end as warning from p where b_id is not null")
def _(fasta):
    return Q.marked_differences(*_sides(fasta), 256)[1]


#: Places that are patched: every 97th base from one on that depends on the sequence, and one behind the end.
_SNPS = ", s as (select seq_id, seq, length(seq) as n, cast(substr(seq_id, 2) as bigint) % 97 + 1 as first from fasta where length(seq) > 0)"


@query("j20_patch", "fasta", _SNPS + " select seq_id, sha256(array_to_string(list_transform(range(1, n + 1), lambda i: case when i % 97 = first % 97 then case when i % 2 = 0 then 'x' else 'y' end else seq[i] end), '')) as digest from s")
def _(fasta):
    """Replacements all over every sequence."""
    rows = fasta.where("length(seq) > 0")
    first = "cast(substring(seq_id, 2) as bigint) % 97 + 1"
    snps = rows.select("seq_id", F.explode(F.expr(f"sequence({first}, greatest({first}, length(seq) + 97), 97)")).alias("pos")).withColumn("base", F.when(F.col("pos") % 2 == 0, "x").otherwise("y"))
    return Q.patch(rows, snps, 128).select("seq_id", F.sha2("seq", 256).alias("digest"))


@query("j18_assembly", "fasta", ", p as (select 'O' || (cast(substr(seq_id, 2) as bigint) // 5) as object, cast(substr(seq_id, 2) as bigint) as part_no, case when cast(substr(seq_id, 2) as bigint) % 3 = 0 then 'N' else 'W' end as type, seq from fasta) select object, string_agg(case when type = 'N' then repeat('N', 7) else seq end, '' order by part_no) as seq from p group by 1")
def _(fasta):
    n = F.substring("seq_id", 2, 12).cast("long")
    parts = fasta.select(F.concat(F.lit("O"), F.floor(n / 5).cast("string")).alias("object"), n.alias("part_no"), F.when(n % 3 == 0, "N").otherwise("W").alias("type"), F.lit(7).alias("length"), "seq")
    return Q.assemble(parts)


@query("w15_concat_runs", "fasta", ", r as (select cast(substr(seq_id, 2) as bigint) as ordinal, 'H' || (cast(substr(seq_id, 2) as bigint) // 3) as header, seq from fasta) select header, string_agg(seq, '' order by ordinal) as seq from r group by 1")
def _(fasta):
    n = F.substring("seq_id", 2, 12).cast("long")
    rows = fasta.select(n.alias("ordinal"), F.concat(F.lit("H"), F.floor(n / 3).cast("string")).alias("header"), "seq")
    return Q.concat_runs(rows).select("header", "seq")


@query("p13_check_bases", "fasta genes", _ON + ", p as (select locus, sequence, seq, start % 500 + 1 as pos0 from i) select locus, sequence, substr(seq, cast(pos0 as int), 1) as base from p where pos0 <= length(seq) and substr(seq, cast(pos0 as int), 1) not in ('C', 'G')")
def _(fasta, genes):
    rows = _placed(genes, fasta).selectExpr("locus", "sequence", "start % 500 + 1 as start")
    return Q.check_bases(rows, fasta, size=128).select("locus", "sequence", "base")


@query("p15_trim_adapter", "fasta", ", r as (select seq_id as name, seq from fasta), a as (select *, strpos(seq, 'CACGT') as pos0 from r) select name, case when pos0 > 0 then substr(seq, 1, pos0 - 1) else '' end as seq, case when pos0 > 0 then repeat('I', cast(pos0 - 1 as int)) else '' end as qual, case when pos0 = 0 then 'no_adapter' when pos0 - 1 < 20 then 'short' else 'kept' end as status from a")
def _(fasta):
    reads = fasta.select(F.col("seq_id").alias("name"), "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"))
    return Q.trim_adapter(reads, "CACGTTTTTT", head=5, least=20)


def _simulated(fasta):
    """Reads of up to 50 bases, one after another over each whole sequence, with random C to T conversion, for tests."""
    at = fasta.select("seq_id", "seq", F.explode(F.expr("sequence(1, greatest(length(seq), 1), 50)")).alias("at"))
    cut = at.select("seq_id", F.substring("seq", F.col("at"), F.lit(50)).alias("bases"))
    return cut.select("seq_id", F.array_join(F.transform(F.split("bases", ""), lambda b: F.when((b == "C") & (F.rand(3) < 0.7), "T").otherwise(b)), "").alias("bases"))


@query("f28_simulated_reads", "fasta", None)
def _(fasta):
    return _simulated(fasta)


@query("f28_simulated_totals", "fasta", " select seq_id, cast(length(seq) as bigint) as bases, cast(length(regexp_replace(seq, '[CT]', '', 'g')) as bigint) as others from fasta")
def _(fasta):
    """What chance can't change: simulated reads have all bases of a sequence, and all but C and T as they were."""
    reads = _simulated(fasta)
    return reads.groupBy("seq_id").agg(F.sum(F.length("bases")).cast("long").alias("bases"), F.sum(F.length(F.regexp_replace("bases", "[CT]", ""))).cast("long").alias("others"))


@query("f29_snp_parts", "gff", " select id, ln, feature as a, strand as b from gff")
def _(gff):
    a, b = X.snp_parts(X.snp_notation("feature", "strand"))
    return gff.select("id", "ln", a.alias("a"), b.alias("b"))
