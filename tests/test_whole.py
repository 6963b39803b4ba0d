"""Queries that cover whole texts."""

from pyspark.sql import functions as F

from spanloom.plans import registry
from spanloom.plans.tables import table


def test_simulated_reads_cover_whole_sequences(spark, sf):
    reads = registry.queries()["f28_simulated_reads"](spark, sf)
    size = lambda c: [F.length(c).alias("n"), F.length(F.regexp_replace(c, "[CT]", "")).alias("other")]
    totals = lambda df, c: {r[0]: (r[1], r[2]) for r in df.select("seq_id", *size(c)).groupBy("seq_id").agg(F.sum("n"), F.sum("other")).collect()}
    assert totals(reads, "bases") == totals(table(spark, sf, "fasta"), "seq")
    assert reads.select(F.max(F.length("bases"))).first()[0] == 50
