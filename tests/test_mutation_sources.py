"""Mutations are held once, with the set of their sources."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from proteoframe.operators import evidence, report
from proteoframe.plans import run_queries

STEPS = ["consensus_design", "pssm_analysis", "other_step"]
SF = "/root/testdata/sf0.001"


def _rows():
    rnd = random.Random(3)
    return [(rnd.randrange(4), rnd.randrange(1, 9), rnd.choice("CMK"), rnd.choice("LQS"), rnd.choice([*STEPS, None]))
            for _ in range(600)]


def test_sources_and_totals(spark):
    rows = _rows()
    muts = spark.createDataFrame(rows, "pid long, position long, wt string, mut string, source_step string")
    sources = defaultdict(set)
    for *mutation, step in rows:
        sources[tuple(mutation)].add(step)
    got = evidence.mutation_sources(muts, STEPS)
    assert {(r.pid, r.position, r.wt, r.mut): r.n_sources for r in got.collect()} == {m: len(s) for m, s in sources.items()}
    want = {p: (sum(m[0] == p for m in sources), len({m[1] for m in sources if m[0] == p}),
                sum(m[0] == p and len(s) > 1 for m, s in sources.items())) for p in range(4)}
    for proposals in (None, muts):
        totals = evidence.evidence_totals(got, proposals).collect()
        assert {r.pid: (r.n_mutations, r.n_positions, r.n_multi) for r in totals} == want

    category = evidence.mutation_category(F.col("wt"), F.col("mut"), F.array("source_step"))
    unique = report.unique_step_mutations(muts, category, STEPS)
    plain = muts.distinct().groupBy("source_step", category.alias("category")).agg(F.count("*").alias("n"))
    assert Counter(map(tuple, unique.collect())) == Counter(map(tuple, plain.collect()))


def _plan(query, spark):
    return query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_a_mutation_is_held_once(spark):
    """Variants, then mutations by source, used to be held in one task next to each other."""
    plan = _plan(run_queries.unique_step_mutations, spark)
    assert plan.count("Aggregate [") == 2
    assert "source_step" not in plan.split("Aggregate [")[-1].split("]")[0]


def test_totals_hold_mutations_beside_proteins_only(spark):
    keys = [x.split("Aggregate [")[1].split("]")[0] for x in _plan(run_queries.evidence_totals, spark).splitlines() if "Aggregate [" in x]
    assert sorted(len(k.split(", ")) for k in keys) == [1, 1, 1, 2, 4]
