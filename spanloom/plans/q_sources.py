"""Text formats: rows are written as lines and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import relational as R
from spanloom.sources import sinks as K
from spanloom.sources import text as T
from spanloom.plans.book import query


def _lines(df, *columns):
    return df.select(F.concat_ws("\t", *[c if not isinstance(c, str) else F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in columns]).alias("value"))


def _gff_lines(gff):
    """Interval lines with upper-case names, missing features on every fifth line, and attributes."""
    attributes = F.concat(F.lit("ID="), "id", F.lit("; c = "), F.col("c").cast("string"), F.lit(";free text"), F.when(F.col("ln") == 7, "*").otherwise(""))
    return _lines(gff, F.upper("sequence"), "source", F.when(F.col("ln") == 5, ".").otherwise(F.col("feature")), "start", "stop", "score", "strand", F.lit("."), attributes)


_ROWS = " select sequence, case when ln = 5 then null else feature end as feature, start, stop, score, strand, id, cast(c as varchar) as c, 'free text' as note, ln = 7 as asterisk from gff"


@query("s1_gff_rows", "gff", _ROWS)
def _(gff):
    rows = T.parse_gff(_gff_lines(gff))
    at = lambda k: F.try_element_at("attrs", F.lit(k))
    return rows.select("sequence", "feature", "start", "stop", "score", "strand", at("ID").alias("id"), at("c").alias("c"), at("Note").alias("note"), "asterisk")


@query("s2_row_kinds", "gff", ", k as (select case when ln = 1 then 'pragma' when ln = 2 then 'comment' when ln = 3 then 'bad' else 'row' end as kind from gff) select kind, cast(count(*) as bigint) as n from k group by 1")
def _(gff):
    row = F.concat_ws("\t", *[F.lit(str(k)) for k in range(9)])
    lines = gff.select(F.when(F.col("ln") == 1, "## version 3").when(F.col("ln") == 2, "  # remark").when(F.col("ln") == 3, "a\tb").otherwise(row).alias("value"))
    return T.row_kinds(lines).groupBy("kind").agg(F.count("*").alias("n"))


@query("s4_row_count", "gff", " select cast(count(*) as bigint) as n from gff")
def _(gff):
    return T.parse_gff(_gff_lines(gff)).agg(F.count("*").alias("n"))


@query("s5_indexed_rows", "gff", " select id as key, cast(count(*) as bigint) as n, min(start) as first from gff group by 1")
def _(gff):
    rows = T.indexed_by(T.promoted(T.parse_gff(_gff_lines(gff)), ["ID"]).select("ID", "start", "stop"), "ID")
    return rows.groupBy("key").agg(F.max("rank").cast("long").alias("n"), F.min(F.when(F.col("rank") == 1, F.col("start"))).alias("first"))


@query("s5_rows_without_key", "gff", " select cast(count(*) as bigint) as n from gff where ln = 3")
def _(gff):
    text = F.when(F.col("ln") == 3, F.lit("c=1")).otherwise(F.concat(F.lit("ID="), "id"))
    return T.rows_without(T.parse_gff(_lines(gff, "sequence", "source", "feature", "start", "stop", "score", "strand", F.lit("."), text)), "ID")


@query("s6_promoted_columns", "gff", " select sequence, start, id as \"ID\", cast(c as varchar) as c from gff")
def _(gff):
    return T.promoted(T.parse_gff(_gff_lines(gff)), ["ID", "c"]).select("sequence", "start", "ID", "c")


@query("s7_list_attributes", "gff", " select id, ln, cast(2 as int) as n, cast(ln as varchar) as second from gff")
def _(gff):
    text = F.concat(F.lit("ID="), "id", F.lit(";Name=a,"), F.col("ln").cast("string"))
    rows = T.list_attributes(T.parse_gff(_lines(gff, "sequence", "source", "feature", "start", "stop", "score", "strand", F.lit("."), text)))
    return rows.select(F.col("attrs")["ID"][0].alias("id"), F.col("attrs")["Name"][1].cast("long").alias("ln"), F.size(F.col("attrs")["Name"]).alias("n"), F.col("attrs")["Name"][1].alias("second"))


@query("s8_user_parser", "gff", " select id, length(id) as size from gff")
def _(gff):
    def parser(batches):
        for part in batches:
            yield part.assign(size=part["id"].str.len().astype("int64"))

    return gff.select("id").mapInPandas(parser, "id string, size long")


@query("s9_by_sequence", "gff", " select sequence, cast(count(*) as bigint) as n from gff group by 1")
def _(gff):
    return T.by_sequence(gff).groupBy("sequence").agg(F.count("*").alias("n"))


@query("s10_eland_role", "reads", " select name as pair_id, cast(read_no as varchar) as read_no, bases as read_seq from reads where length(bases) > 0")
def _(reads):
    feature = F.concat("name", F.lit("/"), F.col("read_no").cast("string"), F.lit(":"), "bases")
    return T.eland_role(reads.where("length(bases) > 0").select(feature.alias("feature"))).select("pair_id", "read_no", "read_seq")


@query("s11_fasta", "fasta", " select seq_id, seq from fasta")
def _(fasta):
    return T.parse_fasta(K.fasta_record(fasta)).select("seq_id", "seq")


@query("s12_fasta_lower", "fasta", " select lower(seq_id) as seq_id, lower(seq) as seq from fasta")
def _(fasta):
    return T.parse_fasta(K.fasta_record(fasta, 60), upper=False).select("seq_id", "seq")


@query("s16_two_line_fasta", "fasta", " select seq_id, cast(length(seq) as int) as n from fasta")
def _(fasta):
    return T.parse_fasta(fasta.select(F.concat(F.lit(">"), "seq_id", F.lit("\n"), "seq").alias("value"))).select("seq_id", F.length("seq").alias("n"))


@query("s17_fastq", "reads", " select name, bases as seq, repeat('I', length(bases)) as qual from reads")
def _(reads):
    rows = reads.select("name", F.col("bases").alias("seq"), F.expr("repeat('I', length(bases))").alias("qual"))
    return T.parse_fastq(K.fastq_record(rows))


@query("s18_scarf", "reads", " select 'm:1:2:3:' || substr(name, 2) as name, bases as seq, repeat('I', length(bases)) as qual from reads")
def _(reads):
    lines = reads.select(F.concat(F.lit("m:1:2:3:"), F.substring("name", 2, 20), F.lit(":"), "bases", F.lit(":"), F.expr("repeat('h', length(bases))")).alias("value"))
    return T.parse_scarf(lines)


@query("s19_qseq", "reads", " select 'M_7:1:2:3:' || substr(name, 2) || '#0/' || read_no as name, replace(bases, 'A', 'N') as seq from reads where start % 3 <> 0")
def _(reads):
    lit = F.lit
    lines = reads.select(F.concat_ws("\t", lit("M"), lit("7"), lit("1"), lit("2"), lit("3"), F.substring("name", 2, 20), lit("0"), F.col("read_no").cast("string"), F.translate("bases", "A", "."), F.col("bases"), F.when(F.col("start") % 3 == 0, "0").otherwise("1")).alias("value"))
    return T.parse_qseq(lines).select("name", "seq")


@query("s20_bowtie", "hits_a", """ select "read", strand, chrom as target, coord, cast(mismatches as int) as mismatches from hits_a""")
def _(hits):
    snps = F.concat_ws(",", F.transform(F.slice(F.array(F.lit("3:A>C"), F.lit("9:G>T")), F.lit(1), F.col("mismatches").cast("int")), lambda x: x))
    lines = hits.select(F.concat_ws("\t", "read", "strand", "chrom", F.col("coord").cast("string"), F.lit("ACGT"), F.lit("IIII"), F.lit("0"), snps).alias("value"))
    return T.parse_bowtie(lines).select("read", "strand", "target", "coord", "mismatches")


def _eland_lines(hits):
    hit = F.concat("chrom", F.lit(":"), F.col("coord").cast("string"), F.when(F.col("strand") == "-", "R").otherwise("F"), F.col("mismatches").cast("string"))
    g = hits.groupBy("read").agg(F.collect_list(hit).alias("h"), *[F.count_if(F.col("mismatches") == k).alias(f"r{k}") for k in range(3)])
    return g.select(F.concat_ws("\t", F.concat(F.lit(">"), "read", F.lit("/1")), F.lit("ACGT"), F.concat_ws(":", "r0", "r1", "r2"), F.array_join("h", ",")).alias("value"))


@query("s21_eland_hits", "hits_a", """ select "read", chrom, coord, strand, cast(mismatches as int) as mismatches from hits_a""")
def _(hits):
    return T.explode_hits(T.parse_eland(_eland_lines(hits))).select("read", "chrom", "coord", "strand", "mismatches")


@query("s21_eland_max_hits", "hits_a", """, r as (select "read", count(*) filter (mismatches = 0) as r0, count(*) filter (mismatches = 1) as r1, count(*) filter (mismatches = 2) as r2, count(*) as n from hits_a group by 1) select "read", cast(case when greatest(r0, r1, r2) > 1 then 0 else n end as int) as n from r""")
def _(hits):
    return T.parse_eland(_eland_lines(hits), max_hits=1).select("read", F.size("hits").alias("n"))


@query("s21_best_stratum", "hits_a", """, m as (select "read", min(mismatches) as b from hits_a group by 1) select "read", cast(count(*) as int) as n from hits_a h join m using ("read") where h.mismatches = b group by 1""")
def _(hits):
    return T.parse_eland(_eland_lines(hits), best_stratum=True).select("read", F.size("hits").alias("n"))


@query("s22_single_hits", "hits_a", """ select "read", min(chrom) as chrom, min(coord) as coord from hits_a group by 1 having count(*) = 1""")
def _(hits):
    rows = T.parse_eland(_eland_lines(hits)).where("size(hits) = 1")
    return rows.select("read", F.col("hits")[0]["chrom"].alias("chrom"), F.col("hits")[0]["coord"].alias("coord"))


@query("s23_export", "hits_a", """ select chrom as sequence, coord as start, coord + 35 as stop, strand from hits_a where mismatches > 0""")
def _(hits):
    lit = F.lit
    fields = [lit("x")] * 8 + [lit("ACGT"), lit("IIII"), F.when(F.col("mismatches") == 0, "NM").otherwise(F.concat(F.upper("chrom"), lit(".fa"))), lit(""), F.col("coord").cast("string"), F.when(F.col("strand") == "-", "R").otherwise("F")] + [lit("")] * 7 + [lit("Y")]
    return T.parse_export(hits.select(F.concat_ws("\t", *fields).alias("value")), 36).select("sequence", "start", "stop", "strand")


@query("s23_export_pairs", "hits_a", """, p as (select chrom as sequence, coord as start, coord + case when strand = '-' then -100 else 150 end + hit * 60 as mate from hits_a), q as (select *, abs(mate - start) + 36 as lib from p) select sequence, start, least(start, mate) + lib / 2 as centre, '/1=' || start || ';/2=' || mate || ';lib=' || lib as attributes from q where lib <= 300""")
def _(hits):
    lit = F.lit
    offset = F.when(F.col("strand") == "-", -100).otherwise(150) + F.col("hit") * 60
    fields = [lit("x")] * 8 + [lit("ACGT"), lit("IIII"), F.col("chrom"), lit(""), F.col("coord").cast("string"), lit("F")] + [lit("")] * 5 + [offset.cast("string"), lit(""), lit("Y")]
    return T.parse_export(hits.select(F.concat_ws("\t", *fields).alias("value")), 36, 300).select("sequence", "start", "centre", "attributes")


@query("s24_seeker", "hits_a", """ select "read", strand, 'chr' || substr(chrom, 4) as sequence, case when strand = '-' then coord + 3 else coord end as start from hits_a""")
def _(hits):
    place = F.concat("strand", F.lpad(F.substring("chrom", 4, 2), 4, "0"), F.lit("w"), F.lpad(F.col("coord").cast("string"), 10, "0"))
    lines = hits.select(F.concat_ws("\t", "read", F.lit("0"), place, F.lit("x"), F.lit("ACGT"), F.lit("-xY-"), F.lit("0"), F.lit("0")).alias("value"))
    return T.parse_seeker(lines).select("read", "strand", "sequence", "start")


@query("s24_seeker_calls", "hits_a", """, c as (select 'chr' || substr(chrom, 4) as sequence, case when strand = '-' then coord + 3 - k else coord + k end as pos, case k when 1 then 'x' else 'Y' end as call from hits_a, (values (1), (2)) v(k)) select sequence, call, cast(count(*) as bigint) as n, cast(sum(pos) as bigint) as places from c group by 1, 2""")
def _(hits):
    place = F.concat("strand", F.lpad(F.substring("chrom", 4, 2), 4, "0"), F.lit("w"), F.lpad(F.col("coord").cast("string"), 10, "0"))
    lines = hits.select(F.concat_ws("\t", "read", F.lit("0"), place, F.lit("x"), F.lit("ACGT"), F.lit("-xY-"), F.lit("0"), F.lit("0")).alias("value"))
    return T.explode_calls(T.parse_seeker(lines)).groupBy("sequence", "call").agg(F.count("*").alias("n"), F.sum("pos").alias("places"))


@query("s25_peaks", "gff", " select sequence, start, stop, score as height from gff")
def _(gff):
    lines = _lines(gff, F.upper("sequence"), "start", "stop", "score", "score", F.lit("0.01"), F.lit("0.05"))
    return T.parse_peaks(lines).select("sequence", "start", "stop", "height")


@query("s26_cross_match", "gff", " select sequence, start, stop, strand, feature from gff")
def _(gff):
    head = [F.col("c").cast("string"), F.lit("1.0"), F.lit("0.0"), F.lit("0.0"), F.col("sequence"), F.col("start").cast("string"), F.col("stop").cast("string"), F.lit("(9)")]
    tail = [F.col("feature"), F.lit("1"), F.lit("2"), F.lit("(3)"), F.lit("x")]
    lines = gff.select(F.when(F.col("strand") == "-", F.concat_ws(" ", *head, F.lit("C"), *tail)).otherwise(F.concat_ws("  ", *head, *tail)).alias("value"))
    return T.parse_cross_match(lines).select("sequence", "start", "stop", "strand", "feature")


@query("s27_agp", "genes", " select sequence as object, start - 1 as start, stop, case when stop % 3 = 0 then 'N' else 'W' end as type, case when stop % 3 = 0 then stop - start + 1 end as length, case when stop % 3 <> 0 then locus end as component from genes")
def _(genes):
    gap = F.col("stop") % 3 == 0
    lines = _lines(genes, "sequence", "start", "stop", F.lit("1"), F.when(gap, "n").otherwise("W"), F.when(gap, F.expr("cast(stop - start + 1 as string)")).otherwise(F.col("locus")), F.lit("1"), F.lit("5"), F.lit("+"))
    return T.parse_agp(lines).select("object", "start", "stop", "type", "length", "component")


@query("s28_xml_segments", "genes", " select sequence, start, stop from genes")
def _(genes):
    seg = F.concat(F.lit("<segments><segment><chrom>"), F.upper("sequence"), F.lit("</chrom><start>"), F.col("start").cast("string"), F.lit("</start><stop>"), F.col("stop").cast("string"), F.lit("</stop><score>1.5</score></segment></segments>"))
    return T.parse_segments(genes.select(seg.alias("value"))).select("sequence", "start", "stop")


@query("s29_read_table", "sites", " select case start % 2 when 0 then 'chrc' else 'chrm' end as sequence, start as pos, strand, c, t from sites where start % 5 <> 0")
def _(sites):
    chrom = F.when(F.col("start") % 5 == 0, "1").when(F.col("start") % 2 == 0, "C").otherwise("M")
    return T.parse_read_table(_lines(sites, chrom, "start", "strand", "c", "t"))


@query("s31_sam_groups", "hits_a", """ select "read", cast(count(*) as int) as n, min(case when strand = '-' then 0 else 1 end) as low from hits_a where mismatches < 2 group by 1""")
def _(hits):
    lit = F.lit
    name = F.when(F.col("strand") == "-", F.concat(lit("RC_"), "chrom")).otherwise(F.col("chrom"))
    lines = hits.select(F.concat_ws("\t", "read", F.when(F.col("mismatches") == 2, "4").otherwise("0"), name, F.col("coord").cast("string"), lit("255"), lit("4M"), lit("*"), lit("0"), lit("0"), lit("ACGT"), lit("IIII")).alias("value"))
    rows = T.grouped_alignments(T.parse_sam(lines))
    return rows.select("read", F.size("alignments").alias("n"), F.array_min(F.transform("alignments", lambda a: F.when(a["strand"] == "-", 0).otherwise(1))).alias("low"))


@query("s32_id_lists", "lists", " select id, list_score from lists")
def _(lists):
    wide = F.concat_ws("\t", *[F.lit(x) for x in "abc"], F.lit("1"), F.lit("2"), F.col("list_score").cast("string"), F.lit("+"), F.lit("."), F.concat(F.lit("ID="), "id"))
    lines = lists.select(F.when(F.col("ordinal") % 2 == 0, wide).otherwise(F.concat_ws("\t", "id", F.col("list_score").cast("string"))).alias("value"))
    return T.parse_list(lines).select("id", "list_score")


_LENGTHS = ", ".join(f"('{g}', '{k}', {n})" for g, own in T.CHROMOSOME_LENGTHS.items() for k, n in own.items())


@query("s33_chromosome_lengths", "gff", f", l as (select sequence as name, n from (values {_LENGTHS}) t(genome, sequence, n) where genome = 'arabidopsis') select sequence, cast(n as bigint) as length, cast(count(*) as bigint) as rows_, cast(count(*) filter (stop > n) as bigint) as beyond, cast(min(n + 1 - stop) as bigint) as flipped from gff join l on name = sequence group by 1, 2")
def _(gff):
    """Rows by chromosome, those that leave it, and the least start on the other strand."""
    lengths = T.chromosome_lengths(gff.sparkSession)
    rows = gff.join(F.broadcast(lengths), "sequence")
    return rows.groupBy("sequence", "length").agg(F.count("*").alias("rows_"), F.count_if(F.col("stop") > F.col("length")).alias("beyond"), F.min(X.flip("stop", "length")).alias("flipped"))


@query("s33_chromosomes_of_genomes", "sites", f", l as (select genome, sequence, n from (values {_LENGTHS}) t(genome, sequence, n) where genome <> 'arabidopsis'), s as (select *, cast(substr(sequence, 4) as bigint) as k from sites) select genome, l.sequence, cast(n as bigint) as length, cast(count(*) as bigint) as sites, cast(sum(c) as bigint) as c from s join l on l.sequence = case genome when 'rice' then 'chr' || lpad(cast(k as varchar), 2, '0') else cast(k as varchar) end where start <= n group by 1, 2, 3")
def _(sites):
    """Sites on the chromosomes of two genomes that name them in ways of their own."""
    lengths = [T.chromosome_lengths(sites.sparkSession, g).select(F.lit(g).alias("genome"), F.col("sequence").alias("name"), "length") for g in ("rice", "puffer")]
    k = F.substring("sequence", 4, 9)
    named = sites.select("start", "c", F.explode(F.array(F.struct(F.lit("rice").alias("genome"), F.concat(F.lit("chr"), F.lpad(k, 2, "0")).alias("name")), F.struct(F.lit("puffer").alias("genome"), k.alias("name")))).alias("x")).select("start", "c", "x.*")
    rows = named.join(F.broadcast(lengths[0].unionByName(lengths[1])), ["genome", "name"]).where("start <= length")
    return rows.groupBy("genome", F.col("name").alias("sequence"), "length").agg(F.count("*").alias("sites"), F.sum("c").alias("c"))


@query("s35_store_view", "gff", " select sequence, cast(count(*) as bigint) as n from gff where strand = '+' group by 1")
def _(gff):
    spark = gff.sparkSession
    gff.createOrReplaceTempView("interval_store")
    return spark.sql("select sequence, count(*) as n from interval_store where strand = '+' group by 1")


@query("k1_gff_lines", "gff", " select sequence || chr(9) || source || chr(9) || feature || chr(9) || start || chr(9) || stop || chr(9) || printf('%g', floor(score)) || chr(9) || strand || chr(9) || '.' || chr(9) || '.' as value from gff")
def _(gff):
    return K.gff_line(gff.withColumn("score", F.floor("score").cast("double")))


@query("k2_fasta_records", "fasta", " select '>' || seq_id as head, cast(ceil(length(seq) / 80.0) as int) as lines from fasta where length(seq) > 0")
def _(fasta):
    parts = F.split("value", "\n")
    return K.fasta_record(fasta.where("length(seq) > 0")).select(parts[0].alias("head"), (F.size(parts) - 1).alias("lines"))


@query("k3_fastq_records", "reads", " select '@' || name || chr(10) || bases || chr(10) || '+' || chr(10) || bases as value from reads")
def _(reads):
    return K.fastq_record(reads.select("name", F.col("bases").alias("seq"), F.col("bases").alias("qual")))


@query("k4_soft_table", "genes", " select row_number() over (order by sequence, start, locus) as id_ref, stop as value from genes")
def _(genes):
    return K.soft_table(genes, ["sequence", "start", "locus"], "stop")


@query("k4_soft_lines", "sites", ", r as (select row_number() over (order by sequence, start, id) as k, * from sites), n as (select count(*) as n from sites) select cast(k as bigint) as line, k || chr(9) || printf('%g', floor(c * 100)) || chr(9) || c || chr(9) || t || chr(9) || sequence || chr(9) || start || chr(9) || strand || chr(9) as value from r union all select n + 1, '!Sample_table_end' from n union all select i - 7, x from (values (0, '#ID_REF = '), (1, '#VALUE = Fractional methylation: c / (c + t)'), (2, '#NoC = Number of sequenced methylated cytosines'), (3, '#NoT = Number of sequenced non-methylated cytosines'), (4, 'Coord = Forward strand position'), (5, 'Strand = Orientation of alignment'), (6, '!Sample_table_begin'), (7, 'ID_REF' || chr(9) || 'VALUE' || chr(9) || 'NoC' || chr(9) || 'NoT' || chr(9) || 'Chr' || chr(9) || 'Coord' || chr(9) || 'Strand')) h(i, x)")
def _(sites):
    return K.soft_lines(sites.withColumn("score", F.floor(F.col("c") * 100).cast("double")), ["sequence", "start", "id"])


@query("k5_attribute_table", "gff", " select sequence, start, id as \"ID\", 'free text' as \"Note\" from gff")
def _(gff):
    return K.attribute_table(T.parse_gff(_gff_lines(gff)), ["ID", "Note"]).select("sequence", "start", "ID", "Note")


@query("k5_attribute_keys", "gff", " select unnest(['ID', 'c', 'Note']) as key")
def _(gff):
    return T.attribute_keys(T.parse_gff(_gff_lines(gff)))


@query("k6_eland_lines", "hits_a", """ select "read" || chr(9) || 'ACGT' || chr(9) || case mismatches when 0 then '1:0:0' when 1 then '0:1:0' else '0:0:1' end || chr(9) || chrom || ':' || coord || case when strand = '-' then 'R' else 'F' end || mismatches as value from hits_a""")
def _(hits):
    return K.eland_line(hits.withColumn("seq", F.lit("ACGT")))


@query("k8_fragments", "hits_a", """ select chrom as sequence, "read" as feature, coord + 1 as start, coord + 4 as stop, cast(mismatches as double) as score, strand from hits_a""")
def _(hits):
    rows = hits.select("read", "strand", F.col("chrom").alias("target"), "coord", F.lit("ACGT").alias("seq"), F.col("mismatches"))
    return K.fragments(rows).select("sequence", "feature", "start", "stop", "score", "strand")


@query("k8_paired_fragments", "hits_a hits_b", """ select a.chrom as sequence, a.coord as start, b.coord + 3 as stop, 'alt=0' as attributes from hits_a a join hits_b b on a."read" = b."read" and a.hit = b.hit""")
def _(a, b):
    rows = lambda h: h.select("read", "hit", F.col("chrom").alias("target"), "coord", F.lit("ACGT").alias("seq"), F.lit(0).alias("alternatives"))
    return K.paired_fragments(rows(a), rows(b)).select("sequence", "start", "stop", "attributes")


@query("k12_header_lines", "genes", " select '# ' || unnest(['made by test', 'columns: 9']) as value union all select sequence || chr(9) || '.' || chr(9) || '.' || chr(9) || start || chr(9) || stop || chr(9) || '.' || chr(9) || strand || chr(9) || '.' || chr(9) || '.' from genes")
def _(genes):
    return K.with_header(K.gff_line(genes), ["made by test", "columns: 9"])


@query("k14_metrics", "hits_a", """, m as (select count(*) as reads, count(distinct "read") as ids, count(*) filter (mismatches = 0) as exact from hits_a) select 'reads' as metric, cast(reads as bigint) as value from m union all select 'ids', ids from m union all select 'exact', exact from m""")
def _(hits):
    m = hits.agg(F.count("*").alias("reads"), F.count_distinct("read").alias("ids"), F.count_if(F.expr("mismatches = 0")).alias("exact"))
    return m.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in ("reads", "ids", "exact")])).alias("x")).select("x.*")


@query("u3_scorer_registry", "gff", " select feature, cast(count(*) as bigint) as n, round(sum(score), 2) as score from gff group by 1")
def _(gff):
    from spanloom.operators.scoring import scored

    return scored(gff, ["feature"], "sum").withColumn("score", F.round("score", 2))


@query("d2_attribute_columns", "gff", " select id, ln from gff where id = 'AT7'")
def _(gff):
    parsed = T.parse_gff(_lines(gff, "sequence", "source", "feature", "start", "stop", "score", "strand", F.lit("."), F.concat(F.lit("ID="), "id", F.lit(";ln="), F.col("ln").cast("string"))))
    return R.equal_to(parsed, ID="AT7").select(X.attribute("attributes", "ID").alias("id"), X.attribute("attributes", "ln").cast("long").alias("ln"))


@query("a9_position_frequencies", "reads", ", p as (select i - 1 as pos, substr(bases, i, 1) as base from reads, unnest(range(1, length(bases) + 1)) t(i)) select cast(pos as int) as pos, " + ", ".join(f"round(count(*) filter (base = '{b}') / count(*), 9) as {b.lower()}" for b in "ACGT") + ", cast(count(*) as bigint) as n from p group by 1")
def _(reads):
    from spanloom.operators.scoring import base_frequencies

    return base_frequencies(reads).select("pos", *[F.round(b, 9).alias(b) for b in "acgt"], "n")


@query("j19_nested_exons", "exons", ", g as (select locus, min(start) as gene_start from exons group by 1), m as (select locus, isoform, string_agg(start || '-' || stop, ' ' order by start, stop) as e from exons group by 1, 2) select locus, gene_start, string_agg(isoform || ':' || e, ';' order by isoform) as model from m join g using (locus) group by 1, 2")
def _(exons):
    from spanloom.operators.genes import nested

    genes = exons.groupBy("locus").agg(F.min("start").alias("gene_start"))
    one = lambda i: F.concat(i["isoform"], F.lit(":"), F.array_join(F.transform(i["exons"], lambda x: F.concat_ws("-", x["start"], x["stop"])), " "))
    return nested(genes, exons).select("locus", "gene_start", F.array_join(F.transform("isoforms", one), ";").alias("model"))


@query("k7_eland_from_bowtie", "hits_a", """ select "read" || chr(9) || 'ACGT' || chr(9) || case mismatches when 0 then '1:0:0' when 1 then '0:1:0' else '0:0:1' end || chr(9) || chrom || ':' || coord || case when strand = '-' then 'R' else 'F' end || mismatches as value from hits_a""")
def _(hits):
    snps = F.concat_ws(",", F.slice(F.array(F.lit("3:A>C"), F.lit("9:G>T")), F.lit(1), F.col("mismatches").cast("int")))
    lines = hits.select(F.concat_ws("\t", "read", "strand", "chrom", F.col("coord").cast("string"), F.lit("ACGT"), F.lit("IIII"), F.lit("0"), snps).alias("value"))
    return K.eland_line(T.parse_bowtie(lines).withColumn("chrom", F.col("target")))


@query("o3_sorted_within", "gff", " select sequence, start, id, ln from gff")
def _(gff):
    return T.by_sequence(gff).select("sequence", "start", "id", "ln")


@query("u2_custom_aggregate", "gff", " select feature, round(exp(avg(ln(score))), 4) as geometric from gff group by 1")
def _(gff):
    """A user's own aggregate as an expression: the geometric mean."""
    return gff.groupBy("feature").agg(F.round(F.exp(F.avg(F.log("score"))), 4).alias("geometric"))
