"""Files written and read again, and functions that a user names or brings."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators import joins as J
from spanloom.operators import relational as R
from spanloom.operators import stats as S
from spanloom.operators import windows as W
from spanloom.operators.scoring import scored
from spanloom.operators.search import search_join
from spanloom.operators.states import CountedQuantile, aggregate
from spanloom.operators.sweep import sweep_join
from spanloom.plans.book import query
from spanloom.plans.q_interval import WIDTH, _peaks
from spanloom.sources import sinks as K
from spanloom.sources import text as T
from spanloom.sources.bam import read_bam, write_bam
from spanloom.sources.formats import read_fasta_pieces, register
from spanloom.sources.parsers import register_parser
from spanloom.sources.store import IntervalStore
from spanloom.storage import shared_dir


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _store(gff, name: str) -> str:
    """The interval table as a file of lines in the shared folder."""
    path = _folder(gff.sparkSession, name)
    K.write_lines(K.gff_line(gff.withColumn("attributes", F.concat(F.lit("ID="), "id"))), path)
    return path


@query("s1_gff_file", "gff", " select sequence, feature, start, stop, strand, id from gff")
def _(gff):
    rows = T.read_gff(gff.sparkSession, _store(gff, "store"))
    return rows.select("sequence", "feature", "start", "stop", "strand", F.try_element_at("attrs", F.lit("ID")).alias("id"))


@query("s3_each_row", "gff", " select sequence, cast(count(*) as bigint) as n, cast(sum(length(id)) as bigint) as letters from gff group by 1")
def _(gff):
    """A function of the user's that sees each row of a scan, a batch at a time."""

    def each(batches):
        for part in batches:
            yield part.groupby("sequence", as_index=False).agg(n=("id", "size"), letters=("id", lambda x: int(x.str.len().sum())))

    rows = gff.select("sequence", "id").mapInPandas(each, "sequence string, n long, letters long")
    return rows.groupBy("sequence").agg(F.sum("n").alias("n"), F.sum("letters").alias("letters"))


@query("s11_fasta_file", "fasta", " select seq_id, seq from fasta where seq_id <> ''")
def _(fasta):
    path = _folder(fasta.sparkSession, "fasta")
    K.write_lines(K.fasta_record(fasta), path)
    return T.read_fasta(fasta.sparkSession, path).select("seq_id", "seq")


@query("s17_fastq_file", "reads", " select name, bases as seq, repeat('I', length(bases)) as qual from reads where length(bases) > 0")
def _(reads):
    path = _folder(reads.sparkSession, "fastq")
    rows = reads.where("length(bases) > 0").select("name", F.col("bases").alias("seq"), F.expr("repeat('I', length(bases))").alias("qual"))
    K.write_lines(K.fastq_record(rows), path)
    return T.read_fastq(reads.sparkSession, path)


@query("s36_find_files", "genes", " select * from (values ('a_chr1_CG.gff'), ('CG.chr1.gff')) t(name)")
def _(genes):
    """Files whose names hold two parts in any order."""
    spark, path = genes.sparkSession, _folder(genes.sparkSession, "named")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name in ("a_chr1_CG.gff", "CG.chr1.gff", "chr1.gff", "CG.gff"):
        at = fs.Path(f"{path}/{name}")
        out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
        out.write(10)
        out.close()
    return T.find_files(spark, path, parts=("chr1", "CG")).select(F.regexp_extract("path", "[^/]*$", 0).alias("name"))


@query("k9_split_files", "gff", " select sequence, cast(count(*) as bigint) as n, cast(sum(start) as bigint) as starts from gff group by 1")
def _(gff):
    path = _folder(gff.sparkSession, "split")
    K.write_split(gff, path, "sequence", files=4)
    return gff.sparkSession.read.parquet(path).groupBy("sequence").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


_LISTS = "select id, 'good' as list from lists where list_score = 1 union all select id, 'toxic' from lists where toxic = 1 union all select id, 'even' from lists where ordinal % 2 = 0"


@query("k10_membership_files", "lists", f", m as ({_LISTS}) select id, string_agg(distinct list, '&' order by list) as combo from m group by 1")
def _(lists):
    part = lambda cond, name: lists.where(cond).select("id", F.lit(name).alias("list"))
    path = _folder(lists.sparkSession, "memberships")
    K.write_memberships(R.combinations(part("list_score = 1", "good").unionByName(part("toxic = 1", "toxic")).unionByName(part("ordinal % 2 = 0", "even"))), path)
    return lists.sparkSession.read.text(path).select(F.col("value").alias("id"), "combo")


@query("k11_slice_files", "sites", ", r as (select start, row_number() over (order by score, id) as k, (select count(*) from sites) as n from sites) select cast((k - 1) // greatest(1, n // 7) as int) as slice, cast(count(*) as bigint) as n, cast(sum(start) as bigint) as starts from r group by 1")
def _(sites):
    path = _folder(sites.sparkSession, "slices")
    K.write_slices(W.partition_slices(sites, "score", 7, "id"), path)
    lines = sites.sparkSession.read.text(path)
    return lines.groupBy("slice").agg(F.count("*").alias("n"), F.sum(F.split("value", "\t")[3].cast("long")).alias("starts"))


@query("k13_dumped_store", "gff", " select feature, cast(count(*) as bigint) as n, cast(sum(stop - start) as bigint) as bases from gff group by 1")
def _(gff):
    rows = T.read_gff(gff.sparkSession, _store(gff, "dump"))
    return rows.groupBy("feature").agg(F.count("*").alias("n"), F.sum(F.expr("stop - start")).alias("bases"))


@query("k15_appended_file", "gff", " select sequence, cast(2 * count(*) as bigint) as n from gff group by 1")
def _(gff):
    path = _store(gff, "append")
    K.write_lines(K.gff_line(gff), path, mode="append")
    return T.read_gff(gff.sparkSession, path).groupBy("sequence").agg(F.count("*").alias("n"))


@query("p19_bowtie_to_gff", "hits_a", """ select chrom as sequence, 'bowtie' as source, "read" as feature, coord + 1 as start, coord + 4 as stop, strand from hits_a""")
def _(hits):
    snps = F.concat_ws(",", F.slice(F.array(F.lit("3:A>C"), F.lit("9:G>T")), F.lit(1), F.col("mismatches").cast("int")))
    lines = hits.select(F.concat_ws("\t", "read", "strand", "chrom", F.col("coord").cast("string"), F.lit("ACGT"), F.lit("IIII"), F.lit("0"), snps).alias("value"))
    return K.fragments(T.parse_bowtie(lines)).select("sequence", "source", "feature", "start", "stop", "strand")


@query("j8_swept_overlaps", "gff genes", ", p as (select a.id, a.ln from gff a join genes b on a.sequence = b.sequence and a.start <= b.stop and a.stop >= b.start) select id, ln, cast(count(*) as bigint) as n from p group by 1, 2")
def _(gff, genes):
    """Windows that each row meets, by a sweep along the starts."""
    return sweep_join(gff, genes).groupBy("id", "ln").agg(F.count("*").alias("n"))


@query("j8_long_intervals", "exons genes", ", w as (select sequence, min(start) as start, max(stop) as stop, cast(substr(locus, 3) as bigint) // 50 as block from genes group by 1, 4), p as (select w.sequence, w.block, e.isoform from w join exons e on e.sequence = w.sequence and e.start <= w.stop and e.stop >= w.start) select sequence, block, cast(count(*) as bigint) as n, cast(count(distinct isoform) as bigint) as isoforms from p group by 1, 2")
def _(exons, genes):
    """The same with long windows that lie over each other, each over many rows."""
    wide = genes.groupBy("sequence", F.expr("cast(substring(locus, 3) as bigint) div 50").alias("block")).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return sweep_join(wide, exons).groupBy("sequence", "block").agg(F.count("*").alias("n"), F.count_distinct("b_isoform").alias("isoforms"))


@query("j1_hot_bins", "gff genes", ", p as (select b.locus, a.c from (select *, case when c % 3 = 0 then 700 else start end as s, case when c % 3 = 0 then 720 else stop end as e from gff) a join genes b on a.sequence = b.sequence and a.s <= b.stop and a.e >= b.start) select locus, cast(count(*) as bigint) as n, cast(sum(c) as bigint) as sum_c from p group by 1")
def _(gff, genes):
    """Overlaps where a third of the rows lies at one place, whose bins are found by a count."""
    hot = F.col("c") % 3 == 0
    rows = gff.withColumn("start", F.when(hot, 700).otherwise(F.col("start"))).withColumn("stop", F.when(hot, 720).otherwise(F.col("stop")))
    return J.overlap_join(rows, genes, WIDTH, salts=None).groupBy(F.col("b_locus").alias("locus")).agg(F.count("*").alias("n"), F.sum("c").alias("sum_c"))


@query("j4_searched_overlaps", "gff genes", ", p as (select b.locus, a.c, a.t from gff a join genes b on a.sequence = b.sequence and a.start <= b.stop and a.stop >= b.start) select locus, cast(count(*) as bigint) as n, cast(sum(c) as bigint) as sum_c, cast(sum(t) as bigint) as sum_t from p group by 1")
def _(gff, genes):
    """Annotated loci as lists that every task searches; the rows stay where they are."""
    return search_join(gff, genes).groupBy(F.col("b_locus").alias("locus")).agg(F.count("*").alias("n"), F.sum("c").alias("sum_c"), F.sum("t").alias("sum_t"))


@query("s17_fastq_source", "reads", " select name, bases as seq, repeat('@', length(bases)) as qual from reads where length(bases) > 0")
def _(reads):
    """FASTQ as a data source of byte ranges, with qualities that look like the first line of a record."""
    path = _folder(reads.sparkSession, "fastq")
    rows = reads.where("length(bases) > 0").select("name", F.col("bases").alias("seq"), F.expr("repeat('@', length(bases))").alias("qual"))
    K.write_lines(K.fastq_record(rows), path)
    register(reads.sparkSession)
    return reads.sparkSession.read.format("fastq").option("split_bytes", 1 << 20).load(path)


@query("s11_fasta_source", "fasta", " select seq_id, cast(length(seq) as bigint) as length, sha256(seq) as digest from fasta where seq_id <> ''")
def _(fasta):
    path = _folder(fasta.sparkSession, "fasta")
    K.write_lines(K.fasta_record(fasta), path)
    register(fasta.sparkSession)
    rows = fasta.sparkSession.read.format("fasta").option("split_bytes", 1 << 20).load(path)
    return rows.select("seq_id", F.length("seq").cast("long").alias("length"), F.sha2("seq", 256).alias("digest"))


@query("s11_fasta_pieces", "fasta", ", p as (select seq_id, seq, unnest(range(1, length(seq) + 1, 100)) as i from fasta) select seq_id, (i - 1) // 100 as bin, cast(len(regexp_extract_all(substr(seq, i, 100), 'C')) as bigint) as c, cast(length(substr(seq, i, 100)) as bigint) as bases from p")
def _(fasta):
    """Bases counted in bins of sequences that are read in pieces, which end anywhere."""
    path = _folder(fasta.sparkSession, "fasta")
    K.write_lines(K.fasta_record(fasta), path)
    register(fasta.sparkSession)
    pieces = read_fasta_pieces(fasta.sparkSession, path, 1000, 1 << 16)
    cut = pieces.select("seq_id", "at", F.explode(F.expr("transform(sequence((at - 1) div 100, (at + length(part) - 2) div 100), k -> struct(k as bin, substring(part, cast(greatest(k * 100 + 2 - at, 1) as int), cast(least(k * 100 + 101, at + length(part)) - greatest(k * 100 + 1, at) as int)) as part))")).alias("x"))
    return cut.groupBy("seq_id", F.col("x.bin").alias("bin")).agg(F.sum(F.regexp_count("x.part", F.lit("C"))).cast("long").alias("c"), F.sum(F.length("x.part")).cast("long").alias("bases"))


@query("s1_gff_source", "gff", " select feature, start, id from gff where sequence = 'chr2' and start >= 300")
def _(gff):
    """Interval rows as a data source that takes filters."""
    spark, path = gff.sparkSession, _store(gff, "source")
    register(spark)
    rows = spark.read.format("gff").schema("sequence string, feature string, start long, attributes string").load(path).where("sequence = 'chr2' and start >= 300")
    return rows.select("feature", "start", X.attribute(F.col("attributes"), "ID").alias("id"))


@query("s31_bam_groups", "hits_a", """ select "read", string_agg(chrom || ':' || coord || ':' || strand, ',' order by chrom, coord, strand) as alignments from hits_a group by 1""")
def _(hits):
    """Alignments written as BAM by tasks, read by splits, and put together by read; the reverse strand as rc_ sequences or by flag."""
    spark, path = hits.sparkSession, _folder(hits.sparkSession, "bam")
    minus, named = F.col("strand") == "-", F.col("coord") % 2 == 0
    rows = hits.select(
        "read", F.when(minus & ~named, 16).otherwise(0).alias("flag"), F.concat(F.when(minus & named, "RC_").otherwise(""), "chrom").alias("sequence"), F.col("coord").alias("pos"),
        F.expr("repeat('ACGT', 9)").alias("seq"), F.lit("36M").alias("cigar"),
    )
    names = sorted(r.chrom for r in hits.select("chrom").distinct().collect())
    write_bam(rows, path, [(p + n, 1 << 29) for n in names for p in ("", "RC_")])
    register(spark)
    found = T.grouped_alignments(read_bam(spark, path, 1 << 18))
    return found.select("read", F.array_join(F.transform("alignments", lambda x: F.concat_ws(":", x["sequence"], x["start"], x["strand"])), ",").alias("alignments"))


@query("s35_committed_loads", "gff", " select load, sequence, cast(count(*) as bigint) as n, cast(sum(start) as bigint) as starts from (select *, case when ln % 3 = 0 then 'a' when ln % 3 = 1 then 'b' end as load from gff) x where load is not null group by 1, 2")
def _(gff):
    """Loads committed to a stored table; a load that is there already is not loaded again, and one that isn't committed is not read."""
    store = IntervalStore(gff.sparkSession, _folder(gff.sparkSession, "store"), 2048)
    for name, k in (("a", 0), ("b", 1), ("a", 2)):
        store.load(gff.where(f"ln % 3 = {k}"), name)
    return store.rows().groupBy("load", "sequence").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


@query("j2_stored_ranges", "gff", " select sequence, feature, start, stop, id, ln from gff where sequence = 'chr2' and ((start <= 900 and stop >= 500) or (start <= 12200 and stop >= 12000))")
def _(gff):
    """Ranges of a stored table, of which only the bins near them are read."""
    store = IntervalStore(gff.sparkSession, _folder(gff.sparkSession, "store"), 2048)
    store.load(gff.where("strand = '+'"), "plus")
    store.load(gff.where("strand = '-'"), "minus")
    return store.overlapping("chr2", [(500, 900), (12000, 12200)]).select("sequence", "feature", "start", "stop", "id", "ln")


@query("u2_user_aggregate", "gff", " select sequence, feature, quantile_disc(c, 0.5) as median from gff group by 1, 2")
def _(gff):
    """An aggregate of the user's with states of its own: here the middle value."""
    return aggregate(gff, ["sequence", "feature"], ["c"], CountedQuantile(0.5), "long", "median")


@query("u1_parser_in_sql", "gff", " select lower(id) as name, start, stop, cast(k as int) as k from gff, (values (0), (1)) t(k) where k < 2 - ln % 2")
def _(gff):
    """A parser of the user's as a table function in SQL: a line gives two rows, one or none."""

    def parser(line):
        name, start, stop, n = line.split("|")
        return [(name.lower(), int(start), int(stop), k) for k in range(2 - int(n) % 2)]

    spark = gff.sparkSession
    register_parser(spark, "interval_line", parser, "name string, start long, stop long, k int")
    lines = gff.select(F.concat_ws("|", "id", "start", "stop", "ln").alias("value"))
    return spark.sql("select t.* from {lines} l, lateral interval_line(l.value) t", lines=lines)


@query("o5_sample_size", "gff", " select cast(100 as bigint) as n, cast(100 as bigint) as different, cast(100 as bigint) as found, cast(count(*) as bigint) as total from gff")
def _(gff):
    """A sample has as many rows as asked for, all different, and all of them rows of the table."""
    sample = R.sample_rows(gff, 100, 3)
    found = sample.join(gff.select("id", "ln").distinct(), ["id", "ln"], "left_semi")
    counts = sample.agg(F.count("*").alias("n"), F.count_distinct("id", "ln").alias("different"))
    return counts.join(found.agg(F.count("*").alias("found"))).join(gff.agg(F.count("*").alias("total")))


@query("u1_row_parser", "gff", " select upper(id) as name, start, stop - start + 1 as bases from gff")
def _(gff):
    """A parser that the user brings: a function of the lines of a scan."""
    lines = gff.select(F.concat_ws("|", "id", "start", "stop").alias("value"))

    def parser(batches):
        for part in batches:
            f = part["value"].str.split("|", expand=True)
            yield f.assign(name=f[0].str.upper(), start=f[1].astype("int64"), bases=f[2].astype("int64") - f[1].astype("int64") + 1)[["name", "start", "bases"]]

    return lines.mapInPandas(parser, "name string, start long, bases long")


@query("u4_scorers_by_name", "gff", " select strand, cast(count(*) as bigint) as n, cast(sum(c) as bigint) as sum_c, cast(sum(t) as bigint) as sum_t, round(sum(c) / sum(c + t), 9) as score from gff group by 1")
def _(gff):
    return scored(gff, ["strand"], "fractional_methylation").withColumn("score", F.round("score", 9))


def _bounds(five: bool, strategy: int) -> str:
    at_start = "(strand <> '-')" if five else "(strand = '-')"
    clip = "lo as flag_start, hi as flag_stop" if strategy == 0 else "case when at_start then greatest(lo, coalesce(prev + 1, lo)) else greatest(lo, start) end as flag_start, case when at_start then least(hi, stop) else least(hi, coalesce(nxt - 1, hi)) end as flag_stop"
    return f"select {int(five)} as five, {strategy} as strategy, locus, {clip} from (select *, {at_start} as at_start, greatest(0, case when {at_start} then start else stop end - 80) as lo, case when {at_start} then start else stop end + 80 as hi from g)"


@query("u5_stop_strategies", "genes", ", g as (select *, lag(stop) over (partition by sequence order by start, stop, locus) as prev, lead(start) over (partition by sequence order by start, stop, locus) as nxt from genes), u as (" + " union all ".join(_bounds(f, s) for f in (True, False) for s in (0, 2)) + ") select cast(five as int) as five, cast(strategy as int) as strategy, locus, flag_start, flag_stop from u where flag_start <= flag_stop")
def _(genes):
    parts = [W.offset_regions(genes, 80, five, s).select(F.lit(int(five)).alias("five"), F.lit(s).alias("strategy"), "locus", "flag_start", "flag_stop") for five in (True, False) for s in (0, 2)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("u6_combined_scores", "sites sites_b", ", p as (select a.id, a.score as x, b.score as y from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start) select id, 'difference' as how, round(x - y, 6) as score from p union all select id, 'product', round(x * y, 9) from p union all select id, 'log2', case when x > 0 and y > 0 then round(log2(x / y), 6) end from p")
def _(a, b):
    pairs = J.keyed_pairs(a.select("sequence", "start", "id", "score"), b.select("sequence", "start", "score"), ["sequence", "start"])
    ways = F.array(*[F.struct(F.lit(h).alias("how"), F.round(X.combine_scores("score", "b_score", h), 9 if h == "product" else 6).alias("value")) for h in ("difference", "product", "log2")])
    return pairs.select("id", F.explode(ways).alias("w")).select("id", "w.how", F.col("w.value").alias("score"))


_REGION = {"centre": ("greatest(0, (start + stop) // 2 - 40)", "(start + stop) // 2 + 40"), "span": ("start", "stop"), "span_flank": ("greatest(0, start - 40)", "stop + 40")}


@query("u7_region_bounds", "gff genes", ", peaks as (select sequence, id || ':' || ln as peak, start, stop from gff where t = 1), u as (" + " union all ".join(f"select '{m}' as mode, sequence, peak, {lo} as lo, {hi} as hi from peaks" for m, (lo, hi) in _REGION.items()) + ") select mode, peak, cast(count(*) as int) as n from u join genes g on u.sequence = g.sequence and u.lo <= g.stop and u.hi >= g.start group by 1, 2")
def _(gff, genes):
    parts = [J.assign_loci(_peaks(gff), genes, 40, m, WIDTH).select(F.lit(m).alias("mode"), "peak", F.size("targets").alias("n")) for m in _REGION]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("u8_named_statistics", "sites sites_b", ", p as (select a.id, cast(a.c as double) as n11, cast(a.t as double) as n12, cast(b.c as double) as n21, cast(b.t as double) as n22 from sites a join sites_b b on a.sequence = b.sequence and a.start = b.start) select id, round(2 * n11 / nullif(2 * n11 + n12 + n21, 0), 6) as dice, round(n11 / nullif(n11 + n12 + n21, 0), 6) as jaccard, round(n11 * n22 / nullif(n12 * n21, 0), 6) as odds from p")
def _(a, b):
    """Statistics looked up by name, and one that the user brings."""
    own = {"odds": F.try_divide(F.col("n11") * F.col("n22"), F.col("n12") * F.col("n21"))}
    pairs = a.select("sequence", "start", "id", F.col("c").alias("n11"), F.col("t").alias("n12")).join(b.select("sequence", "start", F.col("c").alias("n21"), F.col("t").alias("n22")), ["sequence", "start"])
    cast = pairs.withColumns({k: F.col(k).cast("double") for k in ("n11", "n12", "n21", "n22")})
    return cast.select("id", *[F.round(own.get(k) if k in own else S.measure(k), 6).alias(k) for k in ("dice", "jaccard", "odds")])


@query("u9_conversions", "reads", " select '>m:1:2:3:' || substr(name, 2) || chr(10) || bases as value from reads where length(bases) > 0")
def _(reads):
    """One text format to another by way of rows: SCARF lines to FASTA records."""
    lines = reads.where("length(bases) > 0").select(F.concat(F.lit("m:1:2:3:"), F.substring("name", 2, 20), F.lit(":"), "bases", F.lit(":"), F.expr("repeat('h', length(bases))")).alias("value"))
    return K.fasta_record(T.parse_scarf(lines).withColumnRenamed("name", "seq_id"))


@query("u11_row_callback", "gff", " select id, ln, score * 2 + c as value from gff")
def _(gff):
    """A function of the user's called with the rows of a selection."""

    def callback(batches):
        for part in batches:
            yield part.assign(value=part["score"] * 2 + part["c"])[["id", "ln", "value"]]

    return gff.sparkSession.sql("select id, ln, score, c from {gff}", gff=gff).mapInPandas(callback, "id string, ln long, value double")
