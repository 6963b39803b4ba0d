"""Sequences: composition, motifs, differences, patches and assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import exprs as X
from spanloom.operators.ordering import running_total


def counts(fasta: DataFrame) -> DataFrame:
    """(seq_id, length, bp, nonbp) of each sequence."""
    bp = F.length(F.regexp_replace("seq", "[^acgtACGT]", ""))
    return fasta.select("seq_id", F.length("seq").alias("length"), bp.alias("bp"), (F.length("seq") - bp).alias("nonbp"))


def padded(fasta: DataFrame) -> DataFrame:
    """Sequences with NN on both ends, forward and reversed."""
    return fasta.select("seq_id", F.concat(F.lit("NN"), "seq", F.lit("NN")).alias("forward"), F.concat(F.lit("NN"), X.reverse_complement("seq"), F.lit("NN")).alias("reverse"))


def bisulfite_genome(fasta: DataFrame) -> DataFrame:
    """C-to-T converted sequences, and those of the reverse complements as RC_."""
    return fasta.select("seq_id", X.c_to_t("seq").alias("seq")).unionByName(fasta.select(F.concat(F.lit("RC_"), "seq_id").alias("seq_id"), X.c_to_t(X.reverse_complement("seq")).alias("seq")))


def both_strands(fasta: DataFrame) -> DataFrame:
    return fasta.unionByName(fasta.select(F.concat(F.lit("RC_"), "seq_id").alias("seq_id"), X.reverse_complement("seq").alias("seq")))


#: Bytes that a sequence is first cut into.
PIECE = 1 << 20


def _cut(of: str, step: str, take: str, length: str, cast: str, base: str) -> str:
    """SQL of an array of (at, part): `take` bytes from every `step`-th of the first `length` bytes on. The bytes are bound
    to a variable once: a column would be copied for each part."""
    return (
        f"flatten(transform(array({of}), b -> transform(sequence(0, least(length(b), {length}) - 1, {step}), i -> "
        f"struct(cast({base} + i as int) as at, cast(substring(b, i + 1, {take}) as {cast}) as part))))"
    )


def chunks(fasta: DataFrame, size: int, flank: int = 0) -> DataFrame:
    """Sequences in pieces of `size` bases, each with up to `flank` further ones: (seq_id, at, part).

    Sequences are ASCII and taken as bytes, of which any place is reached at once; they are cut into large pieces, then into
    small ones, so that the work is in proportion to a sequence's length and no array has more parts than a large piece."""
    large = max(1, PIECE // size) * size
    whole = fasta.where("octet_length(seq) > 0").select("seq_id", F.explode(F.expr(_cut("cast(seq as binary)", str(large), str(large + flank), "2147483647", "binary", "1"))).alias("x"))
    cut = whole.select("seq_id", F.explode(F.expr(_cut("x.part", str(size), str(size + flank), str(large), "string", "x.at"))).alias("x"))
    return cut.select("seq_id", "x.at", "x.part")


def kmers(fasta: DataFrame, k: int, size: int = 1 << 16) -> DataFrame:
    """(kmer, n) over all sequences, overlapping; long sequences are cut into pieces that share k - 1 bases.

    Sequences are ASCII: k-mers are taken from bytes, where any place is reached at once."""
    parts = chunks(fasta, size, k - 1).where(F.length("part") >= k).select(F.col("part").cast("binary").alias("part"))
    words = parts.select("part", F.explode(F.expr(f"sequence(1, length(part) - {k} + 1)")).alias("i")).select(F.substring("part", F.col("i"), F.lit(k)).alias("kmer"))
    return words.groupBy("kmer").agg(F.count("*").alias("n")).select(F.col("kmer").cast("string").alias("kmer"), "n")


def expected_kmers(fasta: DataFrame, k: int) -> DataFrame:
    """k-mers with observed and expected counts if bases were independent, and their ratio."""
    base = kmers(fasta, 1).withColumnRenamed("kmer", "base").withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).select("base", "share")
    seen = kmers(fasta, k)
    total = seen.agg(F.sum("n").alias("total"))
    cut = seen.select("kmer", "n", F.explode(F.split("kmer", "")).alias("base")).where("base <> ''").join(F.broadcast(base), "base")
    out = cut.groupBy("kmer", "n").agg(F.exp(F.sum(F.log("share"))).alias("p")).join(F.broadcast(total))
    return out.select("kmer", "n", (F.col("p") * F.col("total")).alias("expected"), (F.col("n") / (F.col("p") * F.col("total"))).alias("ratio"))


def kmer_difference(all_: DataFrame, part: DataFrame) -> DataFrame:
    """k-mer counts of what is left of `all_` without `part`."""
    return all_.join(part.select("kmer", F.col("n").alias("m")), "kmer", "left").select("kmer", (F.col("n") - F.coalesce("m", F.lit(0))).alias("n"))


def motif_hits(fasta: DataFrame, motif: str) -> DataFrame:
    return fasta.select("seq_id", F.regexp_count("seq", F.lit(motif)).alias("hits"))


def composition(fasta: DataFrame, width: int) -> DataFrame:
    """Counts of a, c, g and t in fixed windows of each sequence."""
    parts = chunks(fasta, width)
    base = lambda b: F.regexp_count("part", F.lit(f"[{b}{b.upper()}]"))
    return parts.select("seq_id", F.col("at").alias("start"), (F.col("at") + F.length("part") - 1).alias("stop"), *[base(b).alias(b) for b in "acgt"])


def differences(a: DataFrame, b: DataFrame, size: int = 4096, equal_lengths: bool = False) -> DataFrame:
    """(seq_id, pos, a, b) where two genomes' bases differ; compared piece by piece, up to the shorter end. With
    equal_lengths a sequence whose other one has another length is an error when the result is made.

    Of a piece that differs, runs of 64 bases are compared first, and single bases only in runs that differ."""
    x, y = chunks(a, size), chunks(b, size).withColumnRenamed("part", "other")
    rows = x.join(y, ["seq_id", "at"]).where("part <> other")
    if equal_lengths:
        rows = rows.join(F.broadcast(_checked_lengths(a, b))).where("__same >= 0").drop("__same")
    n = "least(length(z.p), length(z.o))"
    runs = (
        f"flatten(transform(array(struct(cast(part as binary) as p, cast(other as binary) as o)), z -> filter(transform(sequence(0, {n} - 1, 64), i -> "
        f"struct(at + i as at, substring(z.p, i + 1, least(64, {n} - i)) as p, substring(z.o, i + 1, least(64, {n} - i)) as o)), x -> x.p <> x.o)))"
    )
    places = "transform(filter(sequence(1, length(r.p)), i -> substring(r.p, i, 1) <> substring(r.o, i, 1)), i -> struct(r.at + i - 1 as pos, cast(substring(r.p, i, 1) as string) as a, cast(substring(r.o, i, 1) as string) as b))"
    found = rows.select("seq_id", F.explode(F.expr(runs)).alias("r")).select("seq_id", F.explode(F.expr(places)).alias("x"))
    return found.select("seq_id", "x.pos", "x.a", "x.b")


def _checked_lengths(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row, made of lengths only; an error if b lacks a sequence of a or has it in another length."""
    x, y = (g.select("seq_id", F.octet_length("seq").alias(n)) for g, n in ((a, "__a"), (b, "__b")))
    wrong = F.concat(F.col("seq_id").cast("string"), F.lit(": lengths "), F.coalesce(F.col("__a").cast("string"), F.lit("none")), F.lit(" and "), F.coalesce(F.col("__b").cast("string"), F.lit("none")), F.lit(" do not match"))
    return x.join(y, "seq_id", "left").agg(F.count(F.when(~F.col("__a").eqNullSafe(F.col("__b")), F.raise_error(wrong).cast("int"))).alias("__same"))


def marked_differences(a: DataFrame, b: DataFrame, size: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(marked, report) of two genomes (rank, header, seq) compared by rank.

    marked is (rank, side, header, at, part): both sequences in pieces, in lower case where they are alike and in upper case
    where they differ; bases behind the other one's end differ. report is (rank, a, b, mismatches, warning) for each
    rank that both have: the warning tells sequences of different lengths."""
    x, y = (chunks(g.select(F.col("rank").alias("seq_id"), "seq"), size) for g in (a, b))
    both = x.withColumnRenamed("part", "p").join(y.withColumnRenamed("part", "o"), ["seq_id", "at"], "full")
    pair = "transform(array(struct(cast(coalesce(p, '') as binary) as p, cast(coalesce(o, '') as binary) as o)), z -> {})[0]"
    own = "array_join(transform(sequence(1, length(z.{0})), i -> case when substring(z.p, i, 1) = substring(z.o, i, 1) then lower(cast(substring(z.{0}, i, 1) as string)) else upper(cast(substring(z.{0}, i, 1) as string)) end), '')"
    text = lambda c: F.expr(f"case when {c} is null then null when p = o then lower({c}) else {pair.format(own.format(c))} end")
    count = F.expr(f"case when p = o then 0 else {pair.format('size(filter(sequence(1, greatest(length(z.p), length(z.o))), i -> substring(z.p, i, 1) <> substring(z.o, i, 1)))')} end")
    sides = F.array(*[F.struct(F.lit(name).alias("side"), text(c).alias("part")) for name, c in (("a", "p"), ("b", "o"))])
    names = a.select("rank", F.lit("a").alias("side"), "header").unionByName(b.select("rank", F.lit("b").alias("side"), "header"))
    out = both.select(F.col("seq_id").alias("rank"), "at", F.explode(sides).alias("x")).select("rank", "x.side", "at", "x.part").where("part is not null")
    marked = out.join(names, ["rank", "side"]).select("rank", "side", "header", "at", "part")
    size_of = lambda g, n: g.select("rank", F.col("header").alias(n), F.octet_length("seq").alias("__" + n))
    lengths = size_of(a, "a").join(size_of(b, "b"), "rank")
    warning = F.when(F.col("__a") != F.col("__b"), F.format_string("strings have different sizes: %d, %d", "__a", "__b"))
    report = lengths.join(both.groupBy(F.col("seq_id").alias("rank")).agg(F.sum(count).alias("mismatches")), "rank", "left")
    return marked, report.select("rank", "a", "b", F.coalesce("mismatches", F.lit(0).cast("long")).alias("mismatches"), warning.alias("warning"))


def patch(fasta: DataFrame, snps: DataFrame, size: int = 4096) -> DataFrame:
    """Sequences with single bases replaced: snps are (seq_id, pos, base), the last by base wins at one place.

    Pieces get the replacements of their own stretch, and are put together again in order."""
    parts = chunks(fasta, size)
    own = snps.select("seq_id", (F.floor((F.col("pos") - 1) / size) * size + 1).cast("int").alias("at"), ((F.col("pos") - 1) % size).cast("int").alias("k"), "base")
    own = own.groupBy("seq_id", "at", "k").agg(F.max("base").alias("base")).groupBy("seq_id", "at").agg(F.array_sort(F.collect_list(F.struct("k", "base"))).alias("new"))

    # the bases between two replacements are taken as they are: as many steps as a piece has replacements
    cuts = "transform(new, (x, i) -> concat(substring(part, case when i = 0 then 1 else new[i - 1].k + 2 end, x.k - (case when i = 0 then 0 else new[i - 1].k + 1 end)), x.base))"
    put = F.expr(f"case when new is null or size(new) = 0 then part else concat(array_join({cuts}, ''), substring(part, element_at(new, -1).k + 2)) end")
    done = parts.join(own, ["seq_id", "at"], "left").withColumn("new", F.expr("filter(new, x -> x.k < length(part))")).select("seq_id", "at", put.alias("part"))
    return done.groupBy("seq_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]), "").alias("seq"))


def extract(intervals: DataFrame, fasta: DataFrame, distance: int | None = None, anchor: str = "centre", longer_than: int | None = None, shorter_than: int | None = None, size: int = 1 << 16) -> DataFrame:
    """The bases of each interval, on its strand; null where it leaves its sequence.

    distance takes that many bases around the interval's centre, or around its 5' end (anchor "tss"), instead; where
    that begins before the sequence, from its start on. longer_than and shorter_than drop intervals by stop - start.
    Sequences are cut into pieces, and an interval meets only the pieces that it covers. Repeated intervals are
    extracted once and repeated in the result; those of an unknown sequence are left out."""
    rows = intervals
    if longer_than is not None:
        rows = rows.where(F.col("stop") - F.col("start") > longer_than)
    if shorter_than is not None:
        rows = rows.where(F.col("stop") - F.col("start") < shorter_than)
    rows = rows.groupBy(*intervals.columns).agg(F.count("*").cast("int").alias("__copies"))
    if distance is not None:
        at = F.expr("start + (stop - start) div 2") if anchor == "centre" else F.when(F.col("strand") == "-", F.col("stop")).otherwise(F.col("start"))
        rows = rows.withColumn("__at", at).withColumn("start", F.greatest(F.lit(1).cast("long"), F.col("__at") - distance // 2)).withColumn("stop", F.col("__at") - distance // 2 + distance - 1).drop("__at")
    rows = rows.join(fasta.select(F.col("seq_id").alias("sequence"), F.length("seq").alias("__n")), "sequence").withColumn("__fits", F.expr("start >= 1 and start <= stop and stop <= __n"))
    pieces = F.expr(f"case when __fits then transform(sequence((start - 1) div {size}, (stop - 1) div {size}), k -> k * {size} + 1) end")
    cut = rows.withColumn("__piece", F.explode_outer(pieces))
    parts = chunks(fasta, size).select(F.col("seq_id").alias("sequence"), F.col("at").cast("long").alias("__piece"), "part")
    own = F.expr("substring(part, int(greatest(start - __piece, 0) + 1), int(stop - greatest(start, __piece) + 1))")
    met = cut.join(parts, ["sequence", "__piece"], "left").groupBy(*intervals.columns, "__copies", "__fits").agg(F.array_sort(F.collect_list(F.struct("__piece", own.alias("bases")))).alias("__p"))
    text = F.when(F.col("__fits"), F.array_join(F.transform("__p", lambda x: x["bases"]), ""))
    return met.select(*intervals.columns, F.when(F.col("strand") == "-", X.reverse_complement(text)).otherwise(text).alias("bases"), F.explode(F.expr("array_repeat(0, __copies)")).alias("__k")).drop("__k")


def assemble(parts: DataFrame) -> DataFrame:
    """Objects from ordered parts (object, part_no, type, length, seq): gaps (N or U) become runs of N."""
    piece = F.when(F.upper("type").isin("N", "U"), F.repeat(F.lit("N"), F.col("length").cast("int"))).otherwise(F.col("seq"))
    return parts.select("object", "part_no", piece.alias("piece")).groupBy("object").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part_no", "piece"))), lambda x: x["piece"]), "").alias("seq"))


def concat_runs(records: DataFrame) -> DataFrame:
    """Consecutive records of one header as one: records are (ordinal, header, seq), ordinals without gaps."""
    before = records.select((F.col("ordinal") + 1).alias("ordinal"), F.col("header").alias("__before"))
    marked = records.join(before, "ordinal", "left").withColumn("__new", F.when(F.col("__before") == F.col("header"), 0).otherwise(1))
    # only numbers and headers are put in order, as a range of the order has so many rows, however long their sequences are
    runs = running_total(marked.select("ordinal", "header", "__new"), ["ordinal"], "__new", "run").select("ordinal", "run")
    return records.join(runs, "ordinal").groupBy("run", "header").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "seq"))), lambda x: x["seq"]), "").alias("seq"))


def check_bases(rows: DataFrame, fasta: DataFrame, size: int = 1 << 16) -> DataFrame:
    """Rows whose reference base is neither C nor G; each meets only the piece of the sequence that it lies in."""
    parts = chunks(fasta, size).select(F.col("seq_id").alias("sequence"), F.col("at").cast("long").alias("__piece"), "part")
    both = rows.withColumn("__piece", F.expr(f"(start - 1) div {size} * {size} + 1")).join(parts, ["sequence", "__piece"])
    return both.withColumn("base", F.substring("part", (F.col("start") - F.col("__piece") + 1).cast("int"), F.lit(1))).where("base <> ''").where(~F.upper("base").isin("C", "G")).drop("part", "__piece")


def trim_adapter(reads: DataFrame, adapter: str, head: int = 7, least: int = 39) -> DataFrame:
    """FASTQ reads cut before the adapter's first bases, with a status: kept, short, or no_adapter."""
    at = F.instr("seq", adapter[:head])
    status = F.when(at == 0, "no_adapter").when(at - 1 < least, "short").otherwise("kept")
    return reads.select("name", F.substring("seq", F.lit(1), F.greatest(F.lit(0), at - 1)).alias("seq"), F.substring("qual", F.lit(1), F.greatest(F.lit(0), at - 1)).alias("qual"), status.alias("status"))
