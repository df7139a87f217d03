"""Hand-computed edges."""

import pytest
from pyspark.sql import functions as F

from proteoframe.functions import text as S
from proteoframe.operators import biophys, evidence, library, msa, mutate, scan, scoring, structure
from proteoframe.operators.windows import position_windows, runs


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_windows_pad_and_skip_empty(seqs):
    got = rows(position_windows(seqs("ABC", "", "D"), 1, 1), "pid", "position", "window")
    assert got == [(1, 1, "-AB"), (1, 2, "ABC"), (1, 3, "BC-"), (3, 1, "-D-")]


def test_runs(seqs):
    assert rows(runs(seqs("AAABBCCC"), 3), "start", "length", "residues") == [(1, 3, "AAA"), (6, 3, "CCC")]
    assert rows(runs(seqs("GILMG", "ILM"), 3, "ILMFVW"), "pid", "start", "length") == [(1, 2, 3), (2, 1, 3)]


def test_cysteine_risk(seqs):
    got = rows(scan.cysteine_hits(seqs("MACVCKGGG", "GGG", "C")), "pid", "position", F.round("risk", 6), "context")
    # near an end, another C within 20, one charge only; a single residue has no neighbours
    assert got == [(1, 3, 0.85, "MA[C]VCKGG"), (1, 5, 0.85, "MACV[C]KGGG"), (3, 1, 0.7, "[C]")]


def test_remove_all_needs_two(seqs):
    got = rows(scan.remove_all_cysteines(seqs("MACVCKGGG", "MCG")), "pid", "n_mutations", "sequence")
    assert got == [(1, 2, "MASVSKGGG")]


def test_protected_cysteine(spark, seqs):
    prot = spark.createDataFrame([(1, 3)], "pid long, position long")
    assert rows(scan.cysteine_scan(seqs("MACVCKGGG"), protected=prot), "position") == [(5,)]
    assert rows(scan.cysteine_warnings(seqs("MACVC", "GG"), prot), "pid", "kind", "n") == [
        (1, "protected_cysteine", 1), (2, "no_cysteine", 0)]


def test_dibasic_does_not_overlap(seqs):
    got = rows(scan.motif_hits(seqs("RRR", "KKKK", "KRK")), "pid", "pattern", "position", "fix_position", "fix_wt")
    assert got == [(1, "RR", 1, 2, "R"), (2, "KK", 1, 2, "K"), (2, "KK", 3, 4, "K"),
                   (3, "KR", 1, 2, "R"), (3, "RK", 2, 3, "K")]


def test_motifs(seqs):
    got = rows(scan.motif_hits(seqs("GGGGNGGGGG", "AMA", "GGILVFWGG")), "pid", "category", "position", "fix_wt", "fix_mut", F.round("risk", 6))
    assert got == [(1, "deamidation", 5, "N", "Q", 1.0), (2, "oxidation", 2, "M", "L", 0.3),
                   (3, "aggregation", 3, "V", "K", 0.3)]


def test_complexity(seqs):
    got = rows(scan.complexity_flags(seqs("GGAAAAAAGGG", "GGPPPPGGG", "PPAPPAP", "ACDEFGHIKLMNPQRSTVWY")),
               "pid", "category", "position", "length", F.round("risk", 6))
    assert got == [(1, "homopolymer", 3, 6, 0.4), (2, "proline_run", 3, 4, 0.6), (2, "proline_stall", 3, 4, 0.4),
                   (3, "proline_stall", 1, 4, 0.4)]


def test_window_of_exactly_twenty(seqs):
    flags = scan.complexity_flags(seqs("AG" * 10, "AG" * 9 + "A"))
    assert rows(flags, "pid", "category", "position", "length") == [(1, "low_complexity", 1, 20)]


def test_charge_clusters_are_not_merged(seqs):
    flags = scan.complexity_flags(seqs("DEKRHDEAGGA")).filter("category = 'charge_cluster'")
    assert rows(flags, "position", F.round("risk", 6)) == [(1, 0.3)]


def test_merge_keeps_first_residues(spark):
    flags = spark.createDataFrame(
        [(1, "c", 1, 20, "a", 0.3), (1, "c", 31, 20, "b", 0.4), (1, "c", 62, 20, "d", 0.1)],
        "pid long, category string, position int, length int, residues string, risk double")
    assert rows(scan.merge_intervals(flags), "position", "length", "residues", "risk") == [
        (1, 50, "a", 0.4), (62, 20, "d", 0.1)]


def test_contigs(spark, seqs):
    sites = spark.createDataFrame([(1, 3), (1, 4), (1, 5), (1, 9)], "pid long, position long")
    got = rows(scan.motif_contigs(sites, seqs("A" * 10, "A")), "pid", "contig")
    assert got == [(1, "[5-25/A3-5/5-25/A9-9/5-25]"), (2, "[80-120]")]


def test_mutations(spark, seqs):
    muts = spark.createDataFrame(
        [(1, 2, "A", "G"), (1, 2, "C", "G"), (1, 9, "A", "G"), (1, 0, "A", "G")], "pid long, position long, wt string, mut string")
    assert rows(mutate.apply_mutation(seqs("MAC"), muts), "name", "sequence") == [("1_A2G", "MGC")]
    assert rows(mutate.rejected_mutations(seqs("MAC"), muts), "position", "reason") == [
        (0, "out_of_range"), (2, "wild_type_mismatch"), (9, "out_of_range")]


def test_two_mutations_at_one_position_reject_the_set(spark, seqs):
    sets = spark.createDataFrame(
        [(1, 1, [(1, "M", "A"), (3, "C", "S")]), (1, 2, [(1, "M", "A"), (1, "M", "G")])],
        "pid long, set_id long, mutations array<struct<position:long,wt:string,mut:string>>")
    assert rows(mutate.apply_mutations(seqs("MAC"), sets), "set_id", "name", "sequence") == [(1, "1_M1A+C3S", "AAS")]


def test_hamming_uses_the_common_length(spark):
    df = spark.createDataFrame([("ABCD", "ABXDE"), ("", "A"), ("AA", "BB")], "a string, b string")
    assert [r[0] for r in df.select(S.hamming(F.col("a"), F.col("b"))).collect()] == [1, 0, 2]


def test_metrics(seqs):
    r = biophys.sequence_metrics(seqs("G", "WMGG")).orderBy("pid").collect()
    assert r[0]["mw"] == pytest.approx(75.03) and r[0]["instability_index"] == 0.0
    # WM 24.68, MG 1.0, GG -7.49
    assert r[1]["instability_index"] == round(10 / 4 * (24.68 + 1.0 - 7.49), 2)
    assert r[1]["rare_codons"] == 2


def test_consensus_tie_and_depth(spark):
    m = spark.createDataFrame(
        [(1, 0, "AC-X"), (1, 1, "GCAX"), (1, 2, "GC-X"), (1, 3, "A--X"), (2, 0, "A"), (2, 1, "G")],
        "pid long, rec_idx long, aligned string")
    cmap = msa.column_map(msa.wt_record(m))
    assert rows(cmap, "pid", "col", "wt", "position") == [(1, 1, "A", 1), (1, 2, "C", 2), (1, 4, "X", 3), (2, 1, "A", 1)]
    counts = msa.column_counts(m, cmap)
    # A and G tie at 2: A was seen first; X counts for the consensus; depth 2 is skipped
    assert rows(msa.consensus(counts), "pid", "position", "consensus", "conservation") == [
        (1, 1, "A", 0.5), (1, 2, "C", 1.0), (1, 3, "X", 1.0)]
    p = {(r.position, r.aa): r for r in msa.pssm(counts, cmap).filter("pid = 1").collect()}
    assert p[(3, "A")].log_odds == pytest.approx(0.0)  # X is no alphabet letter: no evidence
    assert p[(3, "A")].wt_log_odds == 0.0


def test_wild_type_is_not_record_zero(spark):
    m = spark.createDataFrame([(1, 0, "A-G"), (1, 1, "AC-"), (1, 2, "-AC")], "pid long, rec_idx long, aligned string")
    wt = spark.createDataFrame([(1, "AC")], "pid long, sequence string")
    assert rows(msa.wt_record(m, wt), "rec_idx") == [(1,)]
    assert rows(msa.msa_warnings(m), "pid") == []


def test_composite_fallbacks(spark):
    cands = spark.createDataFrame([("a",), ("b",), ("c",)], "candidate_id string")
    scores = spark.createDataFrame(
        [("a", "ddg", 1.0), ("b", "ddg", 3.0), ("a", "mpnn_score", 7.0), ("a", "e1_fitness", 2.0), ("b", "e1_fitness", 2.0),
         ("c", "unweighted", 5.0)], "candidate_id string, score_key string, value double")
    got = {r[0]: r[1] for r in scoring.composite_score(cands, scores).collect()}
    # a: ddg z = -1 -> +1; mpnn has one value -> raw 7; constant e1 -> 0
    assert got["a"] == pytest.approx((0.05 * 1 + 0.1 * 7 + 0.25 * 0) / 0.4)
    assert got["b"] == pytest.approx((0.05 * -1) / 0.3) and got["c"] == 0.0


def test_filter_zero_validation_confidence_falls_through(spark):
    df = spark.createDataFrame(
        [({"val_plddt": 0.0, "plddt": 80.0}, [(1, "A", "C"), (2, "A", "P")]), ({"val_plddt": 50.0, "plddt": 80.0}, [])],
        "s map<string,double>, m array<struct<position:long,wt:string,mut:string>>")
    got = [r[0] for r in df.select(scoring.filter_reasons(F.col("s"), F.col("m"), F.lit("HH"), require_scores=("ddg",))).collect()]
    assert got == [["introduces_cys_1", "pro_in_helix_2", "missing_ddg"], ["low_plddt", "missing_ddg"]]


def test_best_score_priority(spark):
    df = spark.createDataFrame([({"ddg": -2.0, "cys_risk": 9.0},), ({"other": 1.5, "more": 2.5},), ({},)], "s map<string,double>")
    assert [r[0] for r in df.select(library.best_score(F.col("s"))).collect()] == [2.0, 2.5, 0.0]
    assert [r[0] for r in df.select(library.best_score(F.col("s"), "cys_risk")).collect()][0] == 9.0


def test_categories(spark):
    df = spark.createDataFrame([("C", "M", []), ("M", "L", []), ("K", "Q", []), ("A", "V", ["pssm_analysis", "consensus_design"]),
                                ("A", "V", [])], "wt string, mut string, s array<string>")
    assert [r[0] for r in df.select(evidence.mutation_category(F.col("wt"), F.col("mut"), F.col("s"))).collect()] == [
        "Cysteine removal", "Oxidation fix", "Proteolysis fix", "Consensus reversion", "Other"]


def test_disulfide_band_edges_and_double_cys(spark):
    pts = spark.createDataFrame(
        [(1, 1, "C", (0.0, 0.0, 0.0)), (1, 5, "C", (3.5, 0.0, 0.0)), (1, 9, "A", (0.0, 4.5, 0.0)), (1, 4, "A", (0.0, 0.0, 3.8))],
        "structure_id long, position long, aa string, cb struct<x:double,y:double,z:double>")
    pairs = structure.disulfide_pairs(pts)
    assert rows(pairs, "i", "j") == [(1, 5), (1, 9)]  # 1-4 is too close in the chain
    assert rows(structure.disulfide_variants(pairs), "i", "j") == [(1, 9)]


def test_validation_defaults(spark):
    df = spark.createDataFrame([(None, None), (69.0, 1.0), (80.0, 2.0)], "plddt double, rmsd double")
    got = [tuple(r) for r in structure.validate_designs(df).select("validation_passed", "val_plddt", "val_rmsd").collect()]
    assert got == [(True, 0.0, 99.0), (False, 69.0, 1.0), (True, 80.0, 2.0)]


def test_steps(spark):
    from proteoframe.operators.steps import check_schema, get_step, step

    @step("double_it", 1)
    def double_it(df):
        return df.withColumn("x", F.col("x") * 2)

    df = spark.createDataFrame([(1,)], "x long")
    assert df.transform(get_step("double_it").run).first()["x"] == 2
    with pytest.raises(KeyError, match="double_it"):
        get_step("nothing")
    assert check_schema(df, "x long") is df
    with pytest.raises(ValueError, match="y"):
        check_schema(df, "x long, y string")
