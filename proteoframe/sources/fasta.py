"""FASTA-like sources and sinks: sequences, alignments, designs, search hits."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proteoframe.operators import msa as M
from proteoframe.sources import blocks

SUFFIXES = (".fasta", ".fa", ".faa", ".fas")


def _split_record(record: Column) -> tuple[Column, Column]:
    """Header and raw body of a record without its leading ``>``."""
    header = F.regexp_extract(record, r"^([^\r\n]*)", 1)
    body = F.regexp_replace(record, r"^[^\r\n]*", "")
    return header, body


def _records(spark: SparkSession, path: str, **marks: Column) -> DataFrame:
    """One row per record: ``path, rec_idx, header, body`` and how many of the ``marks`` stand up to it in its file.

    Files are split between records, however large they are. ``rec_idx`` counts from 0 in
    each file; what stands before the first ``>`` is no record.
    """
    pieces = blocks.pieces(spark, path, "\n>")
    headed = F.col("value").startswith(">")
    if marks:
        numbered = blocks.running_counts(pieces, marks, _headed=headed)
    else:
        before = blocks.sums_before(pieces, {}, _headed=headed)
        numbered = pieces.join(before, ["path", "block"]).withColumn("line_no", blocks.place())
    place = F.col("line_no")
    # The first piece of a file keeps its mark, and without one it is no record.
    rec_idx = F.when(F.col("_headed"), place).otherwise(place - 1).cast("int")
    record = F.when(place == 0, F.substring("value", 2, 2 ** 31 - 1)).otherwise(F.col("value"))
    rows = numbered.select("path", rec_idx.alias("rec_idx"), record.alias("record"), *marks).filter("rec_idx >= 0")
    header, body = _split_record(F.col("record"))
    return rows.select("path", "rec_idx", header.alias("header"), body.alias("body"), *marks)


def _residues(body: Column) -> Column:
    return F.regexp_replace(body, r"\s+", "")


def _first_word(header: Column) -> Column:
    return F.regexp_extract(header, r"^\s*(\S+)", 1)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Files of any size: ``path, rec_idx, name, sequence``; record 0 is the wild type."""
    return _records(spark, path).select(
        "path", "rec_idx", _first_word(F.col("header")).alias("name"), _residues(F.col("body")).alias("sequence"))


def read_fasta_headers(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_fasta` with the whole ``header``, which names the mutations of a candidate."""
    return _records(spark, path).select(
        "path", "rec_idx", "header", _first_word(F.col("header")).alias("name"), _residues(F.col("body")).alias("sequence"))


def read_large_fasta(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_fasta` without numbers, so without the scan that counts: ``path, name, sequence``."""
    rows = blocks.pieces(spark, path, "\n>").select("path", F.regexp_replace("value", "^>", "").alias("record"))
    header, body = _split_record(F.col("record"))
    return rows.filter(F.length(F.trim("record")) > 0).select(
        "path", _first_word(header).alias("name"), _residues(body).alias("sequence"))


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Files without any record: an error for a caller that needs a wild type."""
    lines = spark.read.text(path)
    # Scans skip files of no bytes; the listing that the scan is planned with has them.
    files = spark.createDataFrame([(f,) for f in lines.inputFiles()], "path string")
    held = lines.filter(F.col("value").startswith(">")).select(F.input_file_name().alias("path"))
    return files.join(held.distinct(), "path", "left_anti")


def fasta_to_candidates(df: DataFrame) -> DataFrame:
    """Records as root candidates of the step ``input``."""
    return df.select(
        F.lit("input").alias("step_name"), F.col("path").alias("source_file"),
        F.sha2(F.concat_ws("|", "path", "name", "sequence"), 256).substr(1, 12).alias("candidate_id"),
        F.lit(None).cast("string").alias("parent_id"), "name", "sequence")


def fasta_lines(df: DataFrame) -> DataFrame:
    """Text of each record; mutated candidates name their mutations."""
    header = F.coalesce(F.nullif("name", F.lit("")), F.col("candidate_id"))
    labels = F.when(F.size("labels") > 0, F.concat(F.lit(" mutations="), F.array_join("labels", ","))).otherwise("")
    return df.select(F.concat(F.lit(">"), header, labels, F.lit("\n"), F.col("sequence")).alias("value"))


def write_fasta(df: DataFrame, path: str, records_per_file: int = 10000) -> None:
    """``df(name, candidate_id, labels, sequence)`` as part files of bounded size."""
    fasta_lines(df).write.mode("overwrite").option("maxRecordsPerFile", records_per_file).text(path)


def read_a3m(spark: SparkSession, path: str) -> DataFrame:
    """Alignment rows without insertions and gaps; comment lines and empty rows go."""
    rows = _records(spark, path).withColumn("body", F.regexp_replace("body", r"(?m)^\s*#.*$", ""))
    return rows.select(
        "path", "rec_idx", _first_word(F.col("header")).alias("name"),
        M.a3m_residues(F.col("body")).alias("sequence")).filter(F.length("sequence") > 0)


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Search hits ``target, tseq`` from tab-separated lines with two or more fields."""
    parts = F.split("value", "\t")
    return spark.read.text(path).filter(F.size(parts) >= 2).select(
        parts[0].alias("target"), F.trim(parts[1]).alias("tseq"))


#: A line of its own that parts the alignments of one file.
PARTING = r"(?:^|\n)//\s*$"


def read_msa(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Aligned records of the valid alignments, and a warning for each ragged one.

    A file holds one alignment, whose ``pid`` is its path, or many of them parted by lines
    ``//``: the n-th such line of a file begins the alignment ``path#n``.
    """
    parted = F.col("value").rlike(PARTING)
    rows = _records(spark, path, partings=parted)
    # The line stands at the end of the record before it, which is not of the new alignment.
    n = F.col("partings") - F.col("body").rlike(PARTING).cast("int")
    msa = rows.select(
        F.when(n > 0, F.concat_ws("#", "path", n)).otherwise(F.col("path")).alias("pid"),
        F.col("rec_idx").cast("bigint").alias("rec_idx"), _first_word(F.col("header")).alias("rec_name"),
        _residues(F.regexp_replace("body", PARTING, "")).alias("aligned"))
    return M.valid_msa(msa), M.msa_warnings(msa)


def write_msa(df: DataFrame, path: str) -> None:
    """Alignments ``df(pid, rec_idx, aligned)`` as part files of many alignments each, records in order."""
    place = F.row_number().over(Window.partitionBy("pid").orderBy("rec_idx"))
    parting = F.when(place == 1, "//\n").otherwise("")
    df.select(F.concat(parting, F.lit(">r"), F.col("rec_idx").cast("string"), F.lit("\n"), "aligned").alias("value")).write.text(path)


def read_designs(spark: SparkSession, path: str, drop_native: bool = True) -> DataFrame:
    """Designed sequences with ``score`` and ``recovery`` from the header list.

    The first record of a file is the native sequence. A record without a score
    counts as 0.0; as the last record of its file it is left out.
    """
    def value(key: str) -> Column:
        return F.coalesce(
            F.regexp_extract("header", rf"(?:^|,)\s*{key}=\s*([-+0-9.eE]+)", 1).try_cast("double"), F.lit(0.0))

    rows = _records(spark, path).select(
        "path", "rec_idx", "header", value("score").alias("score"), value("seq_recovery").alias("recovery"),
        _residues(F.col("body")).alias("sequence"))
    last = rows.groupBy("path").agg(F.max("rec_idx").alias("_last"))
    kept = rows.join(last, "path").filter((F.col("rec_idx") < F.col("_last")) | (F.col("score") != 0.0)).drop("_last")
    return kept.filter("rec_idx > 0") if drop_native else kept


def load_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates by suffix: ``.json`` step results, FASTA otherwise."""
    from proteoframe.sources import results

    suffix = os.path.splitext(path)[1]
    if suffix == ".json":
        return results.read_step_results(spark, path)
    if suffix in SUFFIXES:
        return fasta_to_candidates(read_fasta(spark, path))
    start = spark.read.text(path).filter(F.trim("value") != "").first()
    if start is not None and start["value"].lstrip().startswith("{"):
        return results.read_step_results(spark, path)
    return fasta_to_candidates(read_fasta(spark, path))
