"""Readers on hand-written files."""

import json

import pytest

from proteoframe.sources import fasta, results, structures


def write(path, text):
    path.write_text(text)
    return str(path)


def test_fasta(spark, tmp_path):
    p = write(tmp_path / "a.fasta", ">wt some words\nMAC\nVC\n\n>v1\nMA\n")
    got = [tuple(r) for r in fasta.read_fasta(spark, p).orderBy("rec_idx").select("rec_idx", "name", "sequence").collect()]
    assert got == [(0, "wt", "MACVC"), (1, "v1", "MA")]
    big = sorted(tuple(r) for r in fasta.read_large_fasta(spark, p).select("name", "sequence").collect())
    assert big == [("v1", "MA"), ("wt", "MACVC")]
    cand = fasta.load_candidates(spark, p).collect()
    assert {c["step_name"] for c in cand} == {"input"} and len({c["candidate_id"] for c in cand}) == 2
    assert fasta.empty_files(spark, write(tmp_path / "e.fa", "\n")).count() == 1


def test_a3m_and_hits(spark, tmp_path):
    p = write(tmp_path / "x.a3m", "#1\n>q note\nMA-aC\n>empty\n---\n>h\nM-\nkkV\n")
    assert [tuple(r) for r in fasta.read_a3m(spark, p).orderBy("rec_idx").select("name", "sequence").collect()] == [
        ("q", "MAC"), ("h", "MV")]
    t = write(tmp_path / "h.tsv", "t1\tMAC\nbroken\nt2\tMV\textra\n")
    assert sorted(tuple(r) for r in fasta.read_hits(spark, t).collect()) == [("t1", "MAC"), ("t2", "MV")]


def test_msa_gate(spark, tmp_path):
    write(tmp_path / "good.fasta", ">a\nMA-\n>b\nMAC\n")
    write(tmp_path / "ragged.fasta", ">a\nMA\n>b\nMAC\n")
    msa, warnings = fasta.read_msa(spark, str(tmp_path / "*.fasta"))
    assert msa.count() == 2 and warnings.count() == 1


def test_designs(spark, tmp_path):
    p = write(tmp_path / "d.fa", ">native, score=2.0, seq_recovery=1.0\nMAC\n>T=0.1, sample=1, score=1.5, seq_recovery=0.4\nMAV\n"
                                 ">T=0.1, sample=2, score=0.0\nMAA\n")
    assert [tuple(r) for r in fasta.read_designs(spark, p).select("sequence", "score", "recovery").collect()] == [("MAV", 1.5, 0.4)]
    assert fasta.read_designs(spark, p, drop_native=False).count() == 2


def test_results_folder(spark, tmp_path):
    def step(name, ids, **extra):
        return json.dumps({"step_name": name, "warnings": ["w"], "candidates": [
            {"sequence": "MA", "name": i, "candidate_id": i, "parent_id": None, "scores": {"n": 1, "x": 0.5},
             "mutations": [{"position": 1, "wt": "M", "mut": "A", "source_step": name, "score": None, "metadata": {"k": 1}}],
             **extra} for i in ids]})
    write(tmp_path / "a.json", step("scan", ["old"]))
    write(tmp_path / "b.json", step("scan", ["new"]))
    write(tmp_path / "c.json", "{ not json")
    write(tmp_path / "d.json", step("rank", ["r1", "r2"]))
    got = results.read_results_dir(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.select("step_name", "candidate_id").collect()) == [
        ("rank", "r1"), ("rank", "r2"), ("scan", "new")]
    assert got.filter("candidate_id = 'new'").first()["scores"] == {"n": 1.0, "x": 0.5}
    assert results.read_step_warnings(spark, str(tmp_path / "a.json")).count() == 1


def test_model_scores(spark, tmp_path):
    p = write(tmp_path / "s.json", json.dumps({"predictions": [{"position": 3, "wt": "A", "mut": "V", "ddg": -1.5}]}))
    assert tuple(results.read_model_scores(spark, p, "predictions").select("position", "ddg").first()) == (3, -1.5)


PDB = """MODEL        1
ATOM      1  CA  MET A  10      11.104   6.134  -6.504  1.00 90.50           C
ATOM      2  CB  MET A  10      12.000   6.000  -6.000  1.00 90.50           C
HETATM    3  CA  MSE A  11      13.000   6.000  -6.000  1.00 80.00           C
ATOM      4  CA  GLY A  12      14.000   6.000  -6.000  1.00 70.00           C
ATOM      5  CA  GLY B   1      15.000   6.000  -6.000  1.00 70.00           C
ENDMDL
MODEL        2
ATOM      1  CA  MET A  10      99.000   6.134  -6.504  1.00 90.50           C
ENDMDL
"""


def test_pdb(spark, tmp_path):
    atoms = structures.read_pdb_atoms(spark, write(tmp_path / "a.pdb", PDB))
    got = [tuple(r) for r in atoms.orderBy("position", "atom").select("position", "het", "aa", "atom", "x", "bfactor").collect()]
    assert got == [(1, False, "M", "CA", 11.104, 90.5), (1, False, "M", "CB", 12.0, 90.5),
                   (2, True, "X", "CA", 13.0, 80.0), (3, False, "G", "CA", 14.0, 70.0)]


def test_a_report_is_visible_whole_or_not_at_all(spark, tmp_path):
    folder = str(tmp_path)
    first = results.write_report({"a": spark.range(3), "b": spark.range(2).withColumnRenamed("id", "n")}, folder)
    broken = {"a": spark.range(9), "c": spark.range(4).selectExpr("raise_error('lost')")}
    with pytest.raises(Exception, match="lost"):
        results.write_report(broken, folder)
    read = results.read_report(spark, folder)
    assert {k: v.count() for k, v in read.items()} == {"a": 3, "b": 2}
    results.write_report({"a": spark.range(5)}, folder)
    assert {k: v.count() for k, v in results.read_report(spark, folder).items()} == {"a": 5}
    assert {k: v.count() for k, v in results.read_report(spark, folder, first).items()} == {"a": 3, "b": 2}


def test_many_alignments_in_one_file(spark, tmp_path):
    rows = [(p, i, ("AC-" if p % 3 else "ACD") + "K" * (i if p % 4 == 0 else 2)) for p in range(40) for i in range(p % 5 + 1)]
    fasta.write_msa(spark.createDataFrame(rows, "pid long, rec_idx long, aligned string").repartition(7), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").glob("part-*"))) < 10
    msa, warnings = fasta.read_msa(spark, str(tmp_path / "m"))
    want = {}
    for p, _, a in rows:
        want.setdefault(p, []).append(a)
    got = {}
    for r in msa.orderBy("pid", "rec_idx").collect():
        got.setdefault(r.pid, []).append(r.aligned)
    assert sorted(got.values()) == sorted(v for v in want.values() if len({len(a) for a in v}) == 1)
    assert warnings.count() == sum(len({len(a) for a in v}) > 1 for v in want.values())


def test_alignment_of_a_file_keeps_its_path(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">x\nAC\n>y\nA-\n//\n>z\nACD\n")
    msa, _ = fasta.read_msa(spark, str(tmp_path / "a.fasta"))
    got = [(r.pid.rsplit("/", 1)[1], r.rec_idx, r.aligned) for r in msa.orderBy("rec_idx").collect()]
    assert got == [("a.fasta", 0, "AC"), ("a.fasta", 1, "A-"), ("a.fasta#1", 2, "ACD")]
