"""Report tables on a run with multi-mutants, unscored variants and the later tiers."""

import pytest
from pyspark.sql import functions as F

from proteoframe.operators import report as R
from proteoframe.operators import scan

SCHEMA = ("pid long, candidate_id string, source_step string, seq_no long, "
          "mutations array<struct<position:int,wt:string,mut:string,source_step:string>>, "
          "scores map<string,double>, composite_score double")


def m(position, wt, mut, step):
    return (position, wt, mut, step)


ROWS = [
    (1, "single", "cysteine_scan", 1, [m(3, "C", "S", "cysteine_scan")], {"cys_risk": 0.7}, 0.5),
    (1, "double", "combine_variants", 2, [m(3, "C", "S", "cysteine_scan"), m(9, "M", "L", "motif_scan")], {"combo_sum": 2.0, "combo_mean": 1.0}, 0.9),
    (1, "triple", "combine_variants", 3, [m(3, "C", "S", "x"), m(9, "M", "L", "combine_variants"), m(12, "N", "Q", "y")], {"combo_sum": 3.0}, None),
    (1, "scored", "e1_score", 4, [m(20, "A", "V", "other")], {"e1_fitness": 1.5, "esm1v_delta": 0.25}, 0.1),
    (1, "unscored", "e1_score", 5, [m(21, "A", "G", "other")], {}, None),
    (1, "scaffold", "motif_scaffold", 6, [], {"e1_fitness": -1.0}, -0.2),
    (2, "other", "surface_patch", 7, [m(4, "L", "K", "surface_patch")], {"surface_sap": 0.3}, 0.0),
]


@pytest.fixture(scope="module")
def run(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_candidate_table(run):
    got = R.candidate_table(run.filter("pid = 1"), ("e1_fitness", "combo_sum")).orderBy("rank").collect()
    assert [r.candidate_id for r in got] == ["double", "single", "scored", "scaffold", "triple", "unscored"]
    assert [r.n_mutations for r in got] == [2, 1, 1, 0, 3, 1]
    assert got[0].labels == "C3S, M9L" and got[0].combo_sum == 2.0 and got[2].e1_fitness == 1.5 and got[5].combo_sum is None


def test_candidate_table_without_composite_goes_by_the_first_key(run):
    got = R.candidate_table(run.drop("composite_score").filter("pid = 1"), ("e1_fitness",)).orderBy("rank").collect()
    assert [r.candidate_id for r in got][:2] == ["scored", "scaffold"]
    assert R.candidate_table(run.drop("composite_score")).count() == 7


def test_step_variants_fall_back_to_the_largest_score(run):
    got = {r.candidate_id: (r.sort_score, r["rank"], [tuple(s) for s in r.shown]) for r in R.step_variants(run).collect()}
    assert got["triple"][:2] == (3.0, 1) and got["double"][:2] == (0.9, 2)
    assert got["triple"][2] == []  # combo_sum and combo_mean are no report columns
    assert got["scored"][2] == [("e1_fitness", 1.5), ("esm1v_delta", 0.25)]
    assert got["unscored"][:2] == (0.0, 2) and got["unscored"][2] == [("e1_fitness", None), ("esm1v_delta", None)]


def test_library_shows_popular_keys(run):
    got = {r.candidate_id: [tuple(s) for s in r.shown] for r in R.variant_library(run).collect()}
    assert got["other"] == [("surface_sap", 0.3)]
    assert got["single"] == [("e1_fitness", None), ("combo_mean", None), ("cys_risk", 0.7), ("esm1v_delta", None)]


def test_tiers(run):
    top = {(r.tier, r["rank"]): (r.candidate_id, r.positions) for r in R.tier_top(run.filter("pid = 1")).collect()}
    # The double carries no mutation of its own tier; scoring tiers ask for none.
    assert top == {(1, 1): ("single", "3"), (4, 1): ("triple", "3,9,12"), (5, 1): ("scored", "20"), (5, 2): ("unscored", "21"),
                   (6, 1): ("scaffold", "")}
    best = {(r.tier, r.position): r.label for r in R.tier_highlights(run.filter("pid = 1")).collect()}
    assert best[(4, 12)] == "N12Q" and best[(5, 20)] == "A20V"


def test_matrix_takes_scored_single_mutants(run):
    got = {r.position: r.best for r in R.mutation_matrix(run).collect()}
    assert got == {3: 0.5, 20: 0.1, 4: 0.0}


@pytest.mark.parametrize("value,want", [(None, []), ("", []), ("10, 25,30", [10, 25, 30]), ([25, "10"], [10, 25]), ({7}, [7])])
def test_protected_positions_as_text_or_list(seqs, value, want):
    got = scan.protected_set(seqs("MKV").select("pid"), value)
    assert sorted(r.position for r in got.collect()) == want
    hits = seqs("C" * 30).select("pid", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("position"))
    assert scan.exclude_protected(hits, got).count() == 30 - len(want)
