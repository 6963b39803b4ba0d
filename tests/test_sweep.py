import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators import joins, sweep


def made(spark, seed, n, long_share=0.1, name="id"):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = rng.randrange(1, 3000)
        size = rng.randrange(1, 2500) if rng.random() < long_share else rng.randrange(0, 20)
        rows.append((rng.choice(["chr1", "chr1", "chr2", "x:1"]), start, start + size, i))
    rows += [("chr1", 5, 4, -1), ("chr1", None, 9, -2), (None, 1, 9, -3), ("only" + name, 1, 9, -4), ("chr1", 1, 5000, -5), ("chr1", 700, 700, -6), ("chr1", 700, 700, -7)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, f"sequence string, start long, stop long, {name} long").repartition(5), rows


@pytest.mark.parametrize("rows, batch", [(10_000, 10_000), (60, 10_000), (60, 13), (25, 1)])
def test_sweep_equals_all_pairs(spark, rows, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        (a, x), (b, y) = made(spark, 1, 240), made(spark, 2, 150, name="other")
        want = sorted((p[3], q[3]) for p in x for q in y if None not in (p[0], p[1], q[0], q[1]) and p[0] == q[0] and p[1] <= p[2] and q[1] <= q[2] and p[1] <= q[2] and p[2] >= q[1])
        got = sweep.sweep_join(a, b, rows)
        assert got.columns == ["sequence", "start", "stop", "id", "b_sequence", "b_start", "b_stop", "b_other"]
        assert sorted((r.id, r.b_other) for r in got.collect()) == want
        assert sorted((r.id, r.b_other) for r in joins.overlap_join(a, b, 64).collect()) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nothing_is_repeated_by_bins(spark):
    """Long intervals lie in the plan once, and once more for each range that they reach."""
    a = spark.range(2000).select(F.lit("c").alias("sequence"), (F.col("id") * 10 + 1).alias("start"), (F.col("id") * 10 + 5).alias("stop"))
    b = spark.createDataFrame([("c", 1, 20000), ("c", 50, 15000)], "sequence string, start long, stop long")
    got = sweep.sweep_join(a, b, 500)
    assert got.count() == 2000 + sum(1 for i in range(2000) if 10 * i + 5 >= 50 and 10 * i + 1 <= 15000)
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty_sides(spark):
    (a, _), (b, _) = made(spark, 1, 10), made(spark, 2, 10, name="other")
    assert sweep.sweep_join(a.limit(0), b).count() == 0 and sweep.sweep_join(a, b.limit(0)).count() == 0


def test_hot_bins_are_found(spark):
    """A bin that holds a third of the rows is dealt over tasks; every pair is still there once."""
    a = spark.range(60000).select(F.lit("c").alias("sequence"), F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") * 50).alias("start"), F.lit(0).alias("d"), "id").withColumn("stop", F.col("start") + 3)
    b = spark.createDataFrame([("c", 90, 110, "hot"), ("c", 1000, 9000, "wide"), ("c", 95, 99, "left")], "sequence string, start long, stop long, locus string")
    found = joins.overlap_join(a, b, 64, salts=None)
    plain = joins.overlap_join(a, b, 64)
    key = lambda df: sorted(map(tuple, df.select("id", "b_locus").collect()))
    old = joins.HOT_ROWS
    joins.HOT_ROWS = 2000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        dealt = joins.overlap_join(a, b, 64, salts=None)
        assert key(dealt) == key(found) == key(plain)
        x = a.withColumn("__key", F.lit(1)).where("start = 100")
        y = b.where("locus = 'hot'").withColumn("__key", F.lit(1)).select("__key", "locus")
        per = joins.dealt_join(x, y, ["__key"]).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per) == 20001 and max(r["count"] for r in per) < 3 * 20001 / 8
    finally:
        joins.HOT_ROWS = old
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
