"""Branches and edge cases that the registered queries do not reach."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from harness import difference
from proteoframe.functions import text as S
from proteoframe.operators import biophys, evidence, library, modelscores, msa, mutate, ranking, scan, scoring, structure

SCORES = "candidate_id string, score_key string, value double"


def test_histogram_of_a_constant_score(spark):
    scores = spark.createDataFrame([(str(i), "k", 2.5) for i in range(7)] + [("x", "other", 1.0)], SCORES)
    got = scoring.score_histogram(scores, "k", bins=4).orderBy("bin").collect()
    assert [r.n for r in got] == [7, 0, 0, 0] and all(r.bin_start == 2.5 for r in got)


def test_histogram_counts(spark):
    scores = spark.createDataFrame([(str(i), "k", float(v)) for i, v in enumerate([0, 1, 2, 3, 10])], SCORES)
    assert [r.n for r in scoring.score_histogram(scores, "k", bins=2).orderBy("bin").collect()] == [4, 1]


def test_duplicate_score_keys_keep_the_largest(spark):
    scores = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 3.0), ("a", "y", 2.0), ("a", "x", None), ("b", "y", 5.0)], SCORES)
    got = {r.candidate_id: r.scores for r in scoring.score_map(scores).collect()}
    assert got == {"a": {"x": 3.0, "y": 2.0}, "b": {"y": 5.0}}


def test_duplicate_logprobs_keep_the_largest(spark):
    lps = spark.createDataFrame([(1, 1, "A", -2.0), (1, 1, "C", -1.0), (1, 1, "C", -0.5), (1, 1, "D", -3.0)],
                                "pid long, position int, aa string, lp double")
    res = spark.createDataFrame([(1, 1, "A")], "pid long, position int, aa string")
    assert [(r.mut, r.gain) for r in modelscores.marginal_gains(lps, res).collect()] == [("C", 1.5)]


def test_composite_statistics_are_those_of_the_candidates(spark):
    scores = spark.createDataFrame([("a", "e1_fitness", 0.0), ("b", "e1_fitness", 2.0), ("far", "e1_fitness", 1000.0)], SCORES)
    some = spark.createDataFrame([("a",), ("b",), ("none",)], "candidate_id string")
    got = {r.candidate_id: r.composite_score for r in scoring.composite_score(some, scores).collect()}
    assert got == {"a": -1.0, "b": 1.0, "none": 0.0}
    got = {r.candidate_id: r.composite_score for r in scoring.composite_score(some, scores, missing=None).collect()}
    assert got["none"] is None


def test_composite_in_the_row_equals_the_long_form(spark):
    rows = [("a", {"e1_fitness": 1.0, "ddg": 2.0}), ("b", {"e1_fitness": 3.0}), ("c", {"ddg": -1.0, "other": 9.0}), ("d", {})]
    wide = spark.createDataFrame(rows, "candidate_id string, scores map<string,double>")
    long = wide.select("candidate_id", F.explode("scores").alias("score_key", "value"))
    want = {r.candidate_id: r.composite_score for r in scoring.composite_score(wide.select("candidate_id"), long).collect()}
    got = {r.candidate_id: r.composite_score for r in scoring.composite_in_row(wide).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in got)


def test_instability_is_rounded_before_its_label(spark, seqs, monkeypatch):
    monkeypatch.setattr(biophys.B, "instability_index", lambda s: F.lit(39.997))
    row = biophys.sequence_metrics(seqs("MKV")).first()
    assert row.instability_index == 40.0 and row.instability_label == "Unstable"


def test_aggregation_score_has_three_decimals(seqs):
    row = biophys.aggregation_propensity(seqs("IIIIIIIII" + "K" * 20)).first()
    assert row.agg_score == round(row.agg_score, 3) > 0


def test_equal_best_scores_keep_the_order_of_first_appearance(spark):
    rows = [(1, 5, "A", "C", "s", 0.5, 1), (1, 6, "A", "D", "s", 2.0, 2), (1, 5, "A", "C", "s", 2.0, 3)]
    df = spark.createDataFrame(rows, "pid long, position int, wt string, mut string, source_step string, best double, seq_no long")
    assert [(r.position, r.rank) for r in library.top_single_mutations(df).orderBy("rank").collect()] == [(5, 1), (6, 2)]


def test_whole_sequences_are_scored(spark):
    res = spark.createDataFrame([(1, i, "A") for i in range(1, 2001)], "pid long, position int, aa string")
    lps = res.withColumn("model", F.lit(1)).withColumn("lp", F.when(F.col("position") <= 1022, 0.0).otherwise(-1.0))
    assert modelscores.ensemble_pll(lps, res).first().pll == pytest.approx(-978 / 2000)
    assert modelscores.ensemble_pll(lps, res, max_len=1022).first().pll == 0.0


def test_all_homologs_stay(spark):
    rows = [("p", i, "query" if i == 0 else str(i), "A" * (i + 1)) for i in range(700)]
    hits = spark.createDataFrame(rows, "pid string, idx long, name string, sequence string")
    kept = msa.dedupe_homologs(hits)
    assert kept.count() == 699 and msa.dedupe_homologs(hits, max_hits=500).count() == 500
    assert msa.homolog_stats(kept).first().mean_length == pytest.approx(sum(range(2, 701)) / 699)


def test_copies_are_searched_once_and_all_come_back(spark, seqs):
    rng = "ACDEFGHIKLMNPQRSTVWY" * 3
    q = seqs(rng[:30], rng[:30])
    found = msa.kmer_homologs(q, seqs(rng[:30], rng[5:40], rng[:30]), k=8)
    assert {(r.query, r.target) for r in found.collect()} == {(a, b) for a in (1, 2) for b in (1, 2, 3)}


def test_ascending_rank(spark):
    df = spark.createDataFrame([(1, i, None if i == 7 else float(i * 37 % 11)) for i in range(30)], "k int, tie int, v double")
    got = ranking.full_rank(df, ["k"], "v", "tie", descending=False).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 31))
    assert [r.tie for r in got] == [t for _, t in sorted((i * 37 % 11, i) for i in range(30) if i != 7)] + [7]


def test_score_keys_of_a_prefix(spark):
    cands = spark.createDataFrame([("a", "MKVL"), ("b", "MKVX"), ("c", "AAAA")], "candidate_id string, sequence string")
    model = spark.createDataFrame([("MKV", 1.5)], "sequence string, value double")
    assert {r.candidate_id for r in scoring.map_scores(cands, model, key_len=3).collect()} == {"a", "b"}


def test_recovery_rule(spark):
    cands = spark.createDataFrame([("a", "r"), ("b", "r")], "candidate_id string, parent_id string")
    scores = spark.createDataFrame([("a", "mpnn_recovery", 0.2), ("b", "mpnn_recovery", 0.9)], SCORES)
    muts = spark.createDataFrame([("a", [(1, "A", "G")])], "candidate_id string, mutations array<struct<position:bigint,wt:string,mut:string>>")
    got = {r.candidate_id: r.reasons for r in scoring.quality_filter(cands, scores, muts, min_recovery=0.5).collect()}
    assert got == {"a": ["low_recovery"], "b": []}


def test_explicit_target_positions(spark, seqs):
    prot = spark.createDataFrame([(1, 3)], "pid long, position int")
    assert [r.position for r in scan.target_positions(seqs("MKVLA"), prot, [2, 3, 4]).orderBy("position").collect()] == [2, 4]


def test_fixed_positions_of_other_modes(spark, seqs):
    prot = spark.createDataFrame([(1, 3), (1, 3)], "pid long, position int")
    flagged = spark.createDataFrame([(1, 1)], "pid long, position int")
    for mode in ("all", "surface"):
        assert [r.position for r in scan.fixed_positions(seqs("MKVLA"), flagged, prot, mode).collect()] == [3]


@pytest.mark.parametrize("kept", [[], [1], [5, 2], [0, -3, 9, 3], [1, 2, 3, 4, 5]])
def test_kept_positions(spark, kept):
    df = spark.createDataFrame([("CACCC", kept)], "s string, k array<bigint>")
    got = df.select(S.with_kept(F.col("s"), F.col("k"), at=lambda c: c, between=lambda s: F.translate(s, "C", "S"))).first()[0]
    assert got == "".join(c if i + 1 in kept else c.replace("C", "S") for i, c in enumerate("CACCC"))


def test_unbounded_selection(spark):
    rows = [(1, i, s) for i, s in enumerate(["AAAA", "AAAC", "CCCC", "CCDD", "DDDD", "CCC"])]
    ranked = spark.createDataFrame(rows, "pid long, rank long, sequence string")
    assert sorted(r["rank"] for r in library.diversify(ranked, min_distance=2, cap=None, batch=2).collect()) == [0, 2, 3, 4]


def test_all_combinations(spark):
    rows = [(1, r, r, "A", "C", 1.0) for r in range(1, 16)]
    top = spark.createDataFrame(rows, "pid long, rank int, position int, wt string, mut string, best double")
    assert library.combine_variants(top, cap=None).count() == 15 * 14 // 2 + 15 * 14 * 13 // 6
    assert library.combine_variants(top).count() == 200


def test_sphere_points_are_limited(spark):
    with pytest.raises(ValueError):
        structure.atom_sasa(spark.createDataFrame([], "structure_id long, element string"), n_points=121)


def test_liabilities_are_ranked(spark, seqs):
    s = seqs("MNGCKKRRMAAAC")
    rows = evidence.liabilities(scan.liability_hits(s)).orderBy("rank").collect()
    risks = [round(r.risk, 9) for r in rows]
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and risks == sorted(risks, reverse=True)


def test_a_hot_protein_is_split(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        cands = spark.range(1, 60).select(F.col("id").alias("pid"), F.lit("MKVLACDEFG" * 5).alias("sequence")).repartition(8)
        muts = spark.range(60_000).select(
            F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id") % 59 + 1).alias("pid"), (F.col("id") % 5 * 10 + 1).cast("int").alias("position"),
            F.lit("M").alias("wt"), F.md5(F.col("id").cast("string")).alias("mut")).repartition(8)
        df = mutate.apply_mutation(cands, muts)
        assert len(df.collect()) == 60_000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_homologs_of_a_hot_source(spark, tmp_path):
    """Queries on one source of more than 500 texts, held against plain Python; no task gets the whole source."""
    import __spark_entry__ as entry
    alphabet = "ACDEFGHIKLMNPQRSTVWY"
    texts = ["".join(alphabet[(i % 2900) // 20 ** k % 20] for k in range(3)) * (i % 7 + 1) for i in range(3000)]
    spark.createDataFrame([(3 * i, t, "hot" if i % 10 else "small") for i, t in enumerate(texts)],
                          "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    want, seen = [], {}
    for source in ("hot", "small"):
        mine = [(3 * i, t) for i, t in enumerate(texts) if (i % 10 > 0) == (source == "hot")]
        for idx, t in mine:
            if idx >= 10 or idx != mine[0][0]:
                if t not in seen.setdefault(source, []):
                    seen[source].append(t)
                    want.append((source, len(seen[source]), idx))
    def run(name):
        return entry.queries()[name](spark, str(tmp_path))
    df = run("homologs_deduplicated")
    assert sorted((r.pid, r["rank"], r.idx) for r in df.collect()) == sorted(want) and len(seen["hot"]) > 500
    assert "row_number()" not in df._jdf.queryExecution().optimizedPlan().toString()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("homologs_deduplicated", "homolog_stats", "homologs_attached"):
        assert difference(run(name).toPandas(), con.execute(entry.oracle_sql()[name]).df()) is None
    lengths = {s: (len(t), sum(map(len, t)) / len(t)) for s, t in seen.items()}
    stats = {r.pid: (r.num_homologs, r.mean_length) for r in run("homolog_stats").collect()}
    assert {s: (n, pytest.approx(m, abs=1e-6)) for s, (n, m) in lengths.items()} == stats
    assert {(r.pid, r.num_homologs) for r in run("homologs_attached").collect()} == {(s, n) for s, (n, _) in lengths.items()}
    assert {r.pid: r.residues for r in run("context_homologs").collect()} == {s: sum(map(len, t[:8])) for s, t in seen.items()}


def test_ranks_of_a_hot_key_come_from_several_tasks(spark):
    """One key holds nine tenths of the rows, null is a key of its own, columns may have any name."""
    rows = [("a" if i % 10 else None if i % 20 else "b", i * i - 300, i, "x") for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v long, id long, _task string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.full_rank(df.drop("_task"), ["k"], "v", "id", descending=False)
        got = ranked.collect()
        tasks = ranking.dealt_by_range(df.filter("k = 'a'").drop("_task"), [F.asc("v"), F.asc("id")]).select("_task").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    want = {}
    for k in ("a", "b", None):
        own = sorted((v, i) for key, v, i, _ in rows if key == k)
        want |= {i: n for n, (_, i) in enumerate(own, 1)}
    assert {r.id: r["rank"] for r in got} == want
    assert tasks > 2
    assert ranking.full_rank(df.drop("_task").filter("v is null"), ["k"], "v", "id").count() == 0


def test_correlation_of_unknown_keys(spark):
    rng = random.Random(6)
    rows = [(str(i), k, rng.gauss(0, 1)) for i in range(40) for k in ("a", "b", "c") if rng.random() < 0.8]
    rows += [(str(i), "flat", 3.0) for i in range(40)] + [("x", "alone", 1.0), ("0", "two", 1.0), ("1", "two", 2.0), ("2", "a", None)]
    rows += [("0", "a", 9.5)]  # the largest value of a key counts
    df = spark.createDataFrame(rows, SCORES)
    got = {(r.key_x, r.key_y): r.r for r in scoring.score_correlation(df).collect()}
    best = {}
    for c, k, v in rows:
        if v is not None:
            best[c, k] = max(v, best.get((c, k), v))
    names = sorted({k for _, k in best})
    assert set(got) == {(x, y) for x in names for y in names}
    for x in names:
        for y in names:
            pairs = [(best[c, x], best[c, y]) for c in {c for c, _ in best} if (c, x) in best and (c, y) in best]
            if x == y:
                want = 1.0
            elif len(pairs) < 3 or "flat" in (x, y):
                want = 0.0
            else:
                want = np.corrcoef(*zip(*pairs))[0, 1]
            assert got[x, y] == pytest.approx(want, abs=1e-9)
    some = {(r.key_x, r.key_y): r.r for r in scoring.score_correlation(df, ["a", "b", "none"]).collect()}
    assert some[("a", "b")] == got[("a", "b")] and some[("none", "a")] == 0.0 and len(some) == 9
