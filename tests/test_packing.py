"""Greedy packing against the fold over a sequence's rows."""

import random

from spanloom.operators import packing


def fold(lengths, least):
    group, at, out = 0, 0, []
    for n in lengths:
        if at >= least:
            group, at = group + 1, 0
        out.append((group, at, at + n))
        at += n
    return out


def test_packing_equals_the_fold_and_no_task_holds_a_sequence(spark):
    rng = random.Random(5)
    rows = {s: [rng.choice([0, 1, 3, 40, 900]) for _ in range(n)] for s, n in (("hot", 400), ("b", 37), ("one", 1))} | {"long": [5000, 0, 0, 1, 9999], "zero": [0, 0, 0]}
    df = spark.createDataFrame([(s, i, n) for s, ns in rows.items() for i, n in enumerate(ns)], "sequence string, i int, length int").repartition(5)
    for least in (1, 100):
        out = packing.pack_in_order(df, "sequence", ["i"], "length", least)
        got = {(r.sequence, r.i): (r.pack, r.pack_offset, r.pack_end) for r in out.collect()}
        assert got == {(s, i): x for s, ns in rows.items() for i, x in enumerate(fold(ns, least))}
        assert out.columns == ["sequence", "i", "length", "pack", "pack_offset", "pack_end"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan
