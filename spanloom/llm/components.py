"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.shared import drop_table, write_table


#: Links up to which smallest neighbours are broadcast: at most twice as many rows of two longs.
BROADCAST_LINKS = 250_000


def connected_components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link to another; component is the smallest node reached.

    Each round turns every node's links to point at the smallest neighbour (large star: from
    larger neighbours, small star: from smaller ones) and is written to the shared folder. The
    number of rounds grows with the logarithm of the number of links. Nulls and loops are left out.

    The nodes' smallest neighbours are broadcast while a count shows at most BROADCAST_LINKS links, so a node of very
    many links stays where its links are; more are joined by a shuffle.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    edges = write_table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before, n = None, edges.count()
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = F.broadcast if n <= BROADCAST_LINKS else lambda df: df
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(near(low), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near(low), "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        new = write_table(small.select("x.*").where("u != v").distinct(), "links")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_table(edges)
        edges, n = new, now[0]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
