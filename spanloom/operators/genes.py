"""Gene models: spans, exons and introns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exon_counts(exons: DataFrame) -> DataFrame:
    """Span and number of rows of each locus."""
    return exons.groupBy("sequence", "locus").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n"))


def gene_spans(exons: DataFrame, most_isoforms: int = 1) -> DataFrame:
    """Genes from exons (sequence, locus, isoform, start, stop, strand) of genes with few isoforms."""
    out = exons.groupBy("sequence", "locus").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("strand").alias("strand"), F.count_distinct("isoform").alias("isoforms"))
    return out.where(F.col("isoforms") <= most_isoforms)


def introns(exons: DataFrame, genes: DataFrame) -> DataFrame:
    """Gaps between consecutive exons of an isoform, the first one from its gene's start."""
    w = Window.partitionBy("locus", "isoform").orderBy("start", "stop")
    rows = exons.join(genes.select("locus", F.col("start").alias("gene_start")), "locus").withColumn("__before", F.coalesce(F.lag("stop").over(w) + 1, "gene_start"))
    return rows.where("__before < start").select("sequence", "locus", "isoform", F.col("__before").alias("start"), (F.col("start") - 1).alias("stop"), "strand")


def pick_exons(exons: DataFrame, which: str, first_isoform: bool = False) -> DataFrame:
    """The first, last or middle exons of each locus in the order of transcription; a locus of one exon has only a first.

    first_isoform keeps, of the exons of each locus, those of the isoform that its first exon belongs to."""
    order = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    ties = ["stop", "isoform"] if "isoform" in exons.columns else ["stop"]
    own = Window.partitionBy("locus")
    w = own.orderBy(order, *ties)
    if first_isoform:
        exons = exons.withColumn("__isoform", F.first("isoform").over(w)).where("isoform = __isoform").drop("__isoform")
    rows = exons.withColumn("rank", F.row_number().over(w)).withColumn("n", F.count("*").over(own))
    return rows.where({"first": "rank = 1", "last": "rank = n and n > 1", "middle": "rank > 1 and rank < n"}[which])


def mixed_strands(exons: DataFrame) -> DataFrame:
    """Loci whose exons lie on both strands."""
    return exons.groupBy("locus").agg(F.count_distinct("strand").alias("strands")).where("strands > 1")


def collapse_exons(exons: DataFrame, genes: DataFrame) -> DataFrame:
    """Exons with the bounds of their genes."""
    return exons.join(genes.select("locus", F.col("start").alias("gene_start"), F.col("stop").alias("gene_stop")), "locus")


def nested(genes: DataFrame, exons: DataFrame) -> DataFrame:
    """Each gene with its isoforms' exons: (locus, isoforms: array of (isoform, exons: array of (start, stop)))."""
    own = exons.groupBy("locus", "isoform").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("exons"))
    models = own.groupBy("locus").agg(F.array_sort(F.collect_list(F.struct("isoform", "exons"))).alias("isoforms"))
    return genes.join(models, "locus")
