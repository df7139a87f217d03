"""Readers that cut files into blocks, against reading whole files."""

import random
import re

import pytest
from pyspark.sql import functions as F

from proteoframe.sources import blocks, fasta, structures


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def fasta_text(rng, n, newline="\n"):
    out = []
    for i in range(n):
        out.append(f">{rng.choice(['', '>', ' '])}r{i} note > {i}")
        out += ["".join(rng.choices("ACDEFGHIKLMNPQRSTVWY-", k=rng.choice([0, 1, 30, 60]))) for _ in range(rng.randint(0, 4))]
    return newline.join(out) + newline * rng.randint(0, 2)


def whole(text):
    """Records of a whole text, by the old rule: split at line starts."""
    parts = re.split(r"(?m)^>", text.replace("\r\n", "\n"))[1:]
    return [((re.match(r"\s*(\S+)", p.split("\n")[0]) or [None, ""])[1], re.sub(r"\s", "", "".join(p.split("\n")[1:])))
            for p in parts]


@pytest.mark.parametrize("lead", ["", "#1\t2\n", "\n\n"])
def test_records_and_numbers_equal_whole_files(spark, tmp_path, small_blocks, lead):
    rng = random.Random(len(lead))
    want = {}
    for i, size in enumerate([200, 3, 1, 80]):
        text = lead + fasta_text(rng, size, "\r\n" if i == 3 else "\n")
        (tmp_path / f"f{i}.fa").write_bytes(text.encode())
        want |= {(f"f{i}.fa", k): r for k, r in enumerate(whole(text))}
    df = fasta.read_fasta(spark, str(tmp_path / "*.fa"))
    assert df.rdd.getNumPartitions() > 4
    got = {(r.path.rsplit("/", 1)[1], r.rec_idx): (r.name, r.sequence) for r in df.collect()}
    assert got == want


def test_files_without_records(spark, tmp_path, small_blocks):
    for name, text in (("a.fa", ""), ("b.fa", "no mark\nat > all\n"), ("c.fa", ">x\nAC"), ("d.fa", "junk\n>y\nAC\n")):
        (tmp_path / name).write_text(text)
    path = str(tmp_path / "*.fa")
    assert {(r.path[-4:], r.rec_idx, r.name) for r in fasta.read_fasta(spark, path).collect()} == {("c.fa", 0, "x"), ("d.fa", 0, "y")}
    assert {r.path[-4:] for r in fasta.empty_files(spark, path).collect()} == {"a.fa", "b.fa"}


def test_alignment_rows_keep_their_numbers_over_blocks(spark, tmp_path, small_blocks):
    (tmp_path / "m.fasta").write_text("".join(f">s{i}\n{'A' * 30}-\n" for i in range(300)))
    msa, warnings = fasta.read_msa(spark, str(tmp_path / "m.fasta"))
    assert [(r.rec_idx, r.rec_name) for r in msa.orderBy("rec_idx").collect()] == [(i, f"s{i}") for i in range(300)]
    assert warnings.count() == 0


def test_running_counts_over_blocks_and_files(spark, tmp_path, small_blocks):
    rng = random.Random(9)
    want = []
    for i in range(5):
        lines = [rng.choice(["a", "b", "mark", "MARK"]) + "x" * rng.randint(0, 30) for _ in range(rng.choice([1, 50, 400]))]
        (tmp_path / f"{i}.txt").write_text("\n".join(lines) + "\n")
        n = m = 0
        for k, line in enumerate(lines):
            n, m = n + line.startswith("mark"), m + line.startswith("MARK")
            want.append((f"{i}.txt", k, line, n, m))
    rows = blocks.running_counts(blocks.pieces(spark, str(tmp_path / "*.txt")), {
        "low": F.col("value").startswith("mark"), "high": F.col("value").startswith("MARK")})
    assert sorted((r.path.rsplit("/", 1)[1], r.line_no, r.value, r.low, r.high) for r in rows.collect()) == sorted(want)


def pdb(code, models, residues, head=True, end=True):
    out = [f"HEADER    LYASE                                   01-JAN-20   {code}"] if head else []
    for m in range(max(1, models)):
        out += [f"MODEL     {m + 1:4d}"] if models else []
        for i in range(residues):
            out.append(f"ATOM  {i + 1:5d}  CA  GLY A{i + 5:4d}    {m + i:8.3f}{1.0:8.3f}{2.0:8.3f}  1.00 50.00           C")
        out += ["ATOM      9  CA  GLY A   1      ********   1.000   2.000  1.00 50.00           C"] if models == 2 else []
        out += ["ENDMDL"] if models else []
    return "\n".join(out + ["END"] * end) + "\n"


@pytest.mark.parametrize("head,end", [(True, True), (True, False), (False, True)])
def test_many_structures_share_a_file(spark, tmp_path, small_blocks, head, end):
    shapes = [(f"{i:04d}", i % 3, 1 + i % 5) for i in range(60)]
    (tmp_path / "all.pdb").write_text("".join(pdb(*s, head=head, end=end) for s in shapes))
    atoms = structures.read_pdb_atoms(spark, str(tmp_path / "all.pdb")).collect()
    got = {}
    for a in atoms:
        number = int(a.structure_id.partition("#")[2] or 0)
        got.setdefault((number, a.label, a.model), []).append((a.position, a.x))
    assert {k: sorted(v) for k, v in got.items()} == {
        (n, code if head else None, min(models, 1)): [(i + 1, float(i)) for i in range(size)]
        for n, (code, models, size) in enumerate(shapes)}
    assert structures.pdb_warnings(spark, str(tmp_path / "all.pdb")).count() == 2 * sum(m == 2 for _, m, _ in shapes)


def test_cif_blocks_with_their_own_headers(spark, tmp_path, small_blocks):
    one = "data_{0}\nloop_\n_atom_site.group_PDB\n_atom_site.label_atom_id\n_atom_site.label_comp_id\n_atom_site.label_asym_id\n_atom_site.label_seq_id\n_atom_site.Cartn_x\n_atom_site.Cartn_y\n_atom_site.Cartn_z\nATOM \"C A\" GLY A 7 {1}.5 1 2\nATOM 'O5'' ALA A 8 1 1 2\nATOM CA GLY A 9 1\nHETATM CA GLY A 10 x 1 2\n#\n"
    two = "data_{0}\nloop_\n_atom_site.Cartn_z\n_atom_site.Cartn_y\n_atom_site.Cartn_x\n_atom_site.label_seq_id\n_atom_site.auth_asym_id\n_atom_site.label_comp_id\n_atom_site.label_atom_id\n_atom_site.group_PDB\n"
    # An atom row begins with its group: the second header puts it last, so its rows are none.
    (tmp_path / "all.cif").write_text("".join((one if i % 2 == 0 else two).format(f"n{i}", i) for i in range(40)))
    atoms = structures.read_cif_atoms(spark, str(tmp_path / "all.cif")).collect()
    assert sorted((a.label, a.position, a.atom, a.aa, a.x) for a in atoms) == sorted(
        row for i in range(0, 40, 2) for row in ((f"n{i}", 1, "C A", "G", i + 0.5), (f"n{i}", 2, "O5'", "A", 1.0)))
    warned = structures.cif_warnings(spark, str(tmp_path / "all.cif")).collect()
    assert sorted({(w.reason, w.line.split()[0]) for w in warned}) == [
        (structures.UNPLACED, "HETATM"), ("values do not fit the column names", "ATOM")] and len(warned) == 40
