"""Atom tables from PDB and mmCIF text files.

A file may hold one structure or many, one after another. Files are cut into blocks of lines;
which structure and model a line belongs to is the number of marks before it in its
file (:mod:`proteoframe.sources.blocks`), so no task reads a whole file. Lines that are
meant as atoms but cannot be read go to a warning table and the rest is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proteoframe.functions import text as S
from proteoframe.sources import blocks

# ---- fixed values: three-letter residue names ----
RESIDUE_NAMES = {
    "ALA": "A", "CYS": "C", "ASP": "D", "GLU": "E", "PHE": "F", "GLY": "G", "HIS": "H",
    "ILE": "I", "LYS": "K", "LEU": "L", "MET": "M", "ASN": "N", "PRO": "P", "GLN": "Q",
    "ARG": "R", "SER": "S", "THR": "T", "VAL": "V", "TRP": "W", "TYR": "Y",
}
# ---- end of fixed values ----

UNPLACED = "coordinates are not numbers"
#: A value of an mmCIF row: quoted (the closing quote stands before a blank) or bare.
VALUE = r"""'(?:[^']|'(?=\S))*'(?=\s|$)|"(?:[^"]|"(?=\S))*"(?=\s|$)|\S+"""


def _in_structures(lines: DataFrame, before: Column) -> DataFrame:
    """Name the structure of each line: the first of a file has the file's name, others a number behind it."""
    number = F.greatest(before, F.lit(0))
    return lines.withColumn("structure_id", F.when(number == 0, F.col("path")).otherwise(
        F.concat("path", F.lit("#"), number.cast("string"))))


def _first_chain(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """First model, first chain; the position is the residue's place in the chain.

    Hetero residues take a place as well. ``rows`` carry ``line_no, model, chain,
    residue_key``; a structure is one chain of atoms, so its window is bounded.
    """
    lead = rows.groupBy("structure_id").agg(F.min_by(F.struct("model", "chain"), "line_no").alias("_lead"))
    chain = rows.join(lead, "structure_id").filter(
        (F.col("model") == F.col("_lead.model")) & (F.col("chain") == F.col("_lead.chain"))).drop("_lead")
    starts = chain.groupBy("structure_id", "residue_key").agg(F.min("line_no").alias("_start"))
    order = Window.partitionBy("structure_id").orderBy("_start")
    places = starts.withColumn("position", F.row_number().over(order)).drop("_start")
    return chain.join(places, ["structure_id", "residue_key"]).join(labels, "structure_id", "left").select(
        "structure_id", "label", F.greatest(F.col("model") - F.coalesce("models_before", F.lit(0)), F.lit(0)).alias("model"),
        "chain", "position", "het", "resname", S.lookup(F.col("resname"), RESIDUE_NAMES, "X").alias("aa"),
        "atom", "element", "x", "y", "z", "bfactor")


def _warnings(bad: DataFrame, reason: Column) -> DataFrame:
    return bad.select("structure_id", "line_no", reason.alias("reason"), F.col("value").alias("line"))


def _pdb_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that matter, with their structure and the models of the file so far."""
    record = F.trim(F.substring("value", 1, 6))
    lines = blocks.running_counts(blocks.pieces(spark, path), {
        "ends": record == "END", "heads": record == "HEADER", "models": record == "MODEL"})
    # A structure ends at END or where the next header stands, whichever a file uses.
    lines = lines.withColumn("record", record).filter(F.col("record").isin("ATOM", "HETATM", "HEADER", "MODEL"))
    return _in_structures(lines, F.greatest("ends", F.col("heads") - 1))


def _pdb_atoms(lines: DataFrame) -> DataFrame:
    """Atoms by their fixed columns; a coordinate that is no number is null."""
    def cut(start: int, end: int) -> Column:
        return F.trim(F.col("value").substr(start, end - start + 1))

    return lines.filter(F.col("record").isin("ATOM", "HETATM")).select(
        "structure_id", "line_no", "value", F.col("models").alias("model"), cut(22, 22).alias("chain"),
        F.concat_ws("|", cut(1, 6), cut(23, 27)).alias("residue_key"),
        (F.col("record") == "HETATM").alias("het"), cut(18, 20).alias("resname"), cut(13, 16).alias("atom"),
        F.coalesce(F.nullif(cut(77, 78), F.lit("")), F.regexp_extract(cut(13, 16), "([A-Z])", 1)).alias("element"),
        *[cut(a, b).try_cast("double").alias(n) for n, a, b in
          (("x", 31, 38), ("y", 39, 46), ("z", 47, 54), ("bfactor", 61, 66))])


def _placed() -> Column:
    return F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()


def read_pdb_atoms(spark: SparkSession, path: str) -> DataFrame:
    """Atoms of PDB files. ``label`` is the code of the HEADER line; atoms without a place are left out."""
    lines = _pdb_lines(spark, path)
    labels = lines.groupBy("structure_id").agg(
        F.max(F.when(F.col("record") == "HEADER", F.trim(F.expr("substr(value, 63)")))).alias("label"),
        F.min(F.col("models") - (F.col("record") == "MODEL").cast("int")).alias("models_before"))
    return _first_chain(_pdb_atoms(lines).filter(_placed()), labels)


def pdb_warnings(spark: SparkSession, path: str) -> DataFrame:
    """``structure_id, line_no, reason, line`` of the atom lines that were left out."""
    return _warnings(_pdb_atoms(_pdb_lines(spark, path)).filter(~_placed()), F.lit(UNPLACED))


def _cif_lines(spark: SparkSession, path: str) -> DataFrame:
    """Block names, atom columns and atom rows, with their structure."""
    line = F.trim("value")
    lines = blocks.running_counts(blocks.pieces(spark, path), {"data": line.startswith("data_")}).withColumn("value", line)
    wanted = line.startswith("data_") | line.startswith("_atom_site.") | line.rlike(r"^(ATOM|HETATM)\s")
    return _in_structures(lines.filter(wanted), F.col("data") - 1)


def _cif_rows(lines: DataFrame) -> DataFrame:
    """Atom rows with the column order of their own loop header."""
    heads = lines.filter(F.col("value").startswith("_atom_site.")).groupBy("structure_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("line_no", "value"))),
                    lambda s: F.substring_index(s["value"], ".", -1)).alias("names"))
    rows = lines.filter(F.col("value").rlike(r"^(ATOM|HETATM)\s")).join(heads, "structure_id", "left").withColumn(
        "values", F.regexp_extract_all("value", F.lit(VALUE), F.lit(0)))

    def field(name: str) -> Column:
        return F.get("values", F.array_position("names", name).cast("int") - 1)

    return rows.select(
        "structure_id", "line_no", "value", (F.size("names") == F.size("values")).alias("complete"),
        F.coalesce(field("pdbx_PDB_model_num").try_cast("int"), F.lit(1)).alias("model"),
        F.coalesce(field("auth_asym_id"), field("label_asym_id")).alias("chain"),
        F.concat_ws("|", field("group_PDB"), F.coalesce(field("auth_seq_id"), field("label_seq_id")),
                    field("pdbx_PDB_ins_code")).alias("residue_key"),
        (field("group_PDB") == "HETATM").alias("het"), field("label_comp_id").alias("resname"),
        F.regexp_replace(field("label_atom_id"), r"^(['\"])(.*)\1$", "$2").alias("atom"), field("type_symbol").alias("element"),
        *[field(c).try_cast("double").alias(n) for n, c in
          (("x", "Cartn_x"), ("y", "Cartn_y"), ("z", "Cartn_z"), ("bfactor", "B_iso_or_equiv"))])


def _usable() -> Column:
    return F.coalesce("complete", F.lit(False)) & _placed()


def read_cif_atoms(spark: SparkSession, path: str) -> DataFrame:
    """Atoms of mmCIF files. ``label`` is the name of the data block; rows that do not fit their header are left out."""
    lines = _cif_lines(spark, path)
    labels = lines.groupBy("structure_id").agg(
        F.max(F.when(F.col("value").startswith("data_"), F.expr("substr(value, 6)"))).alias("label"),
        F.lit(0).alias("models_before"))
    return _first_chain(_cif_rows(lines).filter(_usable()), labels)


def cif_warnings(spark: SparkSession, path: str) -> DataFrame:
    """``structure_id, line_no, reason, line`` of the atom rows that were left out."""
    bad = _cif_rows(_cif_lines(spark, path)).filter(~_usable())
    return _warnings(bad, F.when(F.coalesce("complete", F.lit(False)), F.lit(UNPLACED)).otherwise(
        F.lit("values do not fit the column names")))
