"""Liability hits of the fused scan against those of the positional view."""

import random

from proteoframe.operators import liability, scan


def test_fused_hits_equal_positional_hits(spark, seqs):
    rnd = random.Random(7)
    texts = ["", "A", "C", "M", "RR", "KKKKK", "RRRKKK", "KRRKRRRRK", "ILMFV", "ILMFVWILMFVW", "NGNSDGDGC", "C" * 45]
    texts += ["".join(rnd.choices("CMRKNGDEILMFVWA", k=rnd.randrange(1, 90))) for _ in range(300)]
    texts += ["".join(rnd.choices(letters, k=3000)) for letters in ("RK", "ILMA", "CMDEK")]
    df = seqs(*texts).unionByName(spark.createDataFrame([(0, None)], "pid long, sequence string"))
    got, want = liability.liability_hits(df), scan.liability_hits(df)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_position_becomes_a_row(spark):
    from proteoframe.plans import model_queries
    plan = model_queries.liability_table(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "explode(sequence" not in plan and "sequence(1" not in plan
