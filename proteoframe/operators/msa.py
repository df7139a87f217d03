"""Alignment operators: validity, column statistics, consensus, log-odds, homologs.

Cells are aggregated to ``(pid, column, residue)`` on the map side before any
exchange, so a family that holds most of the records costs no more than a small
one; nothing keeps the records of a family together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proteoframe.functions import constants as K
from proteoframe.operators.ranking import full_rank, top_per_key
from proteoframe.operators.windows import position_windows, residues


def _widths(msa: DataFrame) -> DataFrame:
    n = F.length("aligned")
    return msa.groupBy("pid").agg(F.min(n).alias("shortest"), F.max(n).alias("longest"))


def valid_msa(msa: DataFrame) -> DataFrame:
    """Records of the alignments whose records all have one length."""
    good = _widths(msa).filter("shortest = longest").select("pid")
    return msa.join(good, "pid", "left_semi")


def msa_warnings(msa: DataFrame) -> DataFrame:
    return _widths(msa).filter("shortest <> longest").select(
        "pid", F.lit("sequences must all be the same length").alias("message")
    )


def wt_record(msa: DataFrame, wild_types: DataFrame | None = None) -> DataFrame:
    """Aligned wild type per protein: the first record equal to it, else the first."""
    record = F.struct("rec_idx", "aligned")
    if wild_types is None:
        return msa.groupBy("pid").agg(F.min_by(record, "rec_idx").alias("r")).select("pid", "r.*")
    # Met by the residues, not by protein alone, which would deal all records of a protein to one task.
    wanted = wild_types.select("pid", F.col("sequence").alias("_wt")).distinct()
    same = msa.withColumn("_wt", F.replace("aligned", F.lit(K.GAP), F.lit(""))).join(wanted, ["pid", "_wt"])
    hit = same.groupBy("pid").agg(F.min_by(record, "rec_idx").alias("hit"))
    first = msa.groupBy("pid").agg(F.min_by(record, "rec_idx").alias("first"))
    return first.join(hit, "pid", "left").select("pid", F.coalesce("hit", "first").alias("r")).select("pid", "r.*")


def column_map(wt: DataFrame) -> DataFrame:
    """Alignment column -> wild-type position; gap columns are dropped."""
    by = Window.partitionBy("pid").orderBy("col")
    cells = residues(wt, "aligned").select("pid", F.col("position").alias("col"), F.col("aa").alias("wt"))
    return cells.filter(F.col("wt") != K.GAP).withColumn("position", F.row_number().over(by))


def column_counts(msa: DataFrame, cmap: DataFrame) -> DataFrame:
    """Residue counts per wild-type position with the first record that shows each."""
    cells = residues(msa, "aligned", ("pid", "rec_idx")).filter(F.col("aa") != K.GAP)
    counts = cells.groupBy("pid", F.col("position").alias("col"), "aa").agg(
        F.count("*").alias("n"), F.min("rec_idx").alias("first_idx")
    )
    return counts.join(cmap, ["pid", "col"]).select("pid", "position", "wt", "aa", "n", "first_idx")


def consensus(counts: DataFrame, min_depth: int = 3) -> DataFrame:
    """Most common symbol per position; on a tie the one seen first."""
    best = F.struct(F.col("n"), (-F.col("first_idx")).alias("early"), F.col("aa"))
    return (
        counts.groupBy("pid", "position", "wt")
        .agg(F.max(best).alias("b"), F.sum("n").alias("depth"),
             F.sum(F.when(F.col("aa") == F.col("wt"), F.col("n")).otherwise(0)).alias("n_wt"))
        .filter(F.col("depth") >= min_depth)
        .select("pid", "position", "wt", F.col("b.aa").alias("consensus"),
                (F.col("b.n") / F.col("depth")).alias("conservation"),
                (F.col("n_wt") / F.col("depth")).alias("wt_frequency"), "depth")
    )


def consensus_mutations(calls: DataFrame, min_conservation: float = 0.5, top: int = 20) -> DataFrame:
    by = Window.partitionBy("pid").orderBy(F.desc("conservation"), "position")
    return (
        calls.filter((F.col("consensus") != F.col("wt")) & (F.col("conservation") >= min_conservation))
        .withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
        .select("pid", "position", "wt", F.col("consensus").alias("mut"),
                F.col("conservation").alias("score"), "wt_frequency", "depth", "rank")
    )


def consensus_combo(muts: DataFrame, top: int = 5) -> DataFrame:
    """The best ``top`` consensus mutations of a protein as one variant."""
    return (
        muts.filter(F.col("rank") <= top).groupBy("pid")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "position", "wt", "mut"))).alias("mutations"),
             F.sum("score").alias("score"))
        .filter(F.size("mutations") > 1)
        .select("pid", F.concat(F.col("pid").cast("string"), F.lit("_consensus_top"),
                                F.size("mutations").cast("string")).alias("name"),
                "mutations", "score")
    )


def _log_odds(n: Column, depth: Column, pseudocount: float) -> Column:
    size = len(K.ALPHABET)
    return F.log2((n + pseudocount) / (depth + size * pseudocount) * size)


def pssm(counts: DataFrame, cmap: DataFrame, pseudocount: float = 0.5) -> DataFrame:
    """Log-odds of all twenty residues per position against a flat background.

    The counts of one position form a map of at most twenty entries, so the
    alphabet is exploded next to it instead of joined.
    """
    known = counts.filter(F.col("aa").isin(*K.ALPHABET)).groupBy("pid", "position").agg(
        F.map_from_entries(F.collect_list(F.struct("aa", "n"))).alias("n_of"),
        F.sum("n").alias("depth"),
    )
    rows = cmap.select("pid", "position", "wt").join(known, ["pid", "position"], "left")
    n = F.coalesce(F.try_element_at("n_of", F.col("aa")), F.lit(0))
    n_wt = F.coalesce(F.try_element_at("n_of", F.col("wt")), F.lit(0))
    depth = F.coalesce("depth", F.lit(0))
    wt_score = F.when(F.col("wt").isin(*K.ALPHABET), _log_odds(n_wt, depth, pseudocount)).otherwise(0.0)
    return rows.select(
        "pid", "position", "wt", "n_of", "depth",
        F.explode(F.array(*[F.lit(a) for a in K.ALPHABET])).alias("aa"),
    ).select("pid", "position", "wt", "aa",
             _log_odds(n, depth, pseudocount).alias("log_odds"), wt_score.alias("wt_log_odds"))


def pssm_mutations(matrix: DataFrame, min_delta: float = 2.0, top: int = 30) -> DataFrame:
    by = Window.partitionBy("pid").orderBy(F.desc(F.round("score", 9)), "position", "mut")
    return (
        matrix.filter("aa <> wt")
        .select("pid", "position", "wt", F.col("aa").alias("mut"),
                (F.col("log_odds") - F.col("wt_log_odds")).alias("score"),
                "wt_log_odds", "log_odds")
        .filter(F.round("score", 9) >= min_delta)
        .withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    )


# ------------------------------------------------------------------ homologs

def a3m_residues(text: Column) -> Column:
    """Upper-case residues of an alignment row, insertions and gaps removed."""
    return F.regexp_replace(text, "[^A-Z]+", "")


def dedupe_homologs(hits: DataFrame, max_hits: int | None = None, ranked: bool = True) -> DataFrame:
    """First hit per distinct sequence, the leading query dropped, in hit order.

    Only digests travel to find the first hit of a sequence; ``max_hits`` keeps
    the first of them if given. Without it a protein's hits are ranked by many tasks; ``ranked`` False leaves ``rank`` out.
    """
    lead = hits.groupBy("pid").agg(F.min("idx").alias("_lead"))
    # Met by hit, not by protein alone, which would deal all hits of a protein to one task.
    lead = lead.select(F.col("pid").alias("_pid"), "_lead")
    is_lead = ((F.col("pid") == F.col("_pid")) & (F.col("idx") == F.col("_lead"))
               & F.coalesce(F.col("name").isin("query", "101"), F.lit(True)))
    body = hits.filter(F.col("pid").isNotNull() & (F.length("sequence") > 0)).join(lead, is_lead, "left_anti")
    first = body.groupBy("pid", F.md5("sequence").alias("_d")).agg(F.min("idx").alias("idx"))
    kept = first.select("pid", "idx")
    if max_hits is not None:
        kept = top_per_key(kept, ["pid"], ["idx"], max_hits)
    elif ranked:
        kept = full_rank(kept, ["pid"], "idx", "idx", descending=False).withColumn("rank", F.col("rank").cast("int"))
    return body.join(kept, ["pid", "idx"]).select("pid", *(["rank"] if ranked else []), "idx", "name", "sequence")


def homolog_stats(kept: DataFrame, sample: int | None = None) -> DataFrame:
    """Number of homologs and mean length of all, or of the first ``sample`` of them."""
    length = F.length("sequence")
    return kept.groupBy("pid").agg(
        F.count("*").alias("num_homologs"),
        F.avg(length if sample is None else F.when(F.col("rank") <= sample, length)).alias("mean_length"),
    )


def context_homologs(kept: DataFrame, k: int = 8) -> DataFrame:
    """The first ``k`` homologs as an ordered array."""
    return (
        kept.filter(F.col("rank") <= k).groupBy("pid")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "name", "sequence"))).alias("context"))
    )


def attach_homologs(cands: DataFrame, stats: DataFrame) -> DataFrame:
    """Alignment information on every candidate of a protein, roots and variants."""
    return cands.join(stats, "pid", "left")


def kmer_homologs(queries: DataFrame, database: DataFrame, k: int = 8, min_shared: int = 4,
                  min_identity: float = 0.5, max_hits: int | None = None) -> DataFrame:
    """Homologs by shared k-mers and ungapped identity on the best diagonal.

    Every distinct sequence is searched once and the result mapped back to its
    copies. Repeated k-mers inside one sequence are kept, so no candidate is lost.
    The join output is counted per (query, target, diagonal) on the map side; which
    side is broadcast, or how a frequent k-mer is split, is left to adaptive
    execution, which knows the real sizes.
    """
    def distinct(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Distinct sequences under their digest, and the ids behind each."""
        keyed = df.select("pid", F.md5("sequence").alias("_d"), "sequence")
        return (keyed.groupBy(F.col("_d").alias("pid")).agg(F.first("sequence").alias("sequence")),
                keyed.select("_d", "pid"))

    (queries, query_ids), (database, target_ids) = distinct(queries), distinct(database)

    def kmers(df: DataFrame, name: str) -> DataFrame:
        return position_windows(df, 0, k - 1).filter(
            F.col("position") + (k - 1) <= F.col("seq_len")
        ).select(F.col("pid").alias(name), F.col("position").alias(f"{name}_pos"),
                 F.col("window").alias("kmer"))

    pairs = kmers(database, "target").join(kmers(queries, "query"), "kmer")
    per_diag = pairs.groupBy(
        "query", "target", (F.col("target_pos") - F.col("query_pos")).alias("diagonal")
    ).agg(F.count("*").alias("shared"))
    best = per_diag.groupBy("query", "target").agg(
        F.max(F.struct("shared", (-F.col("diagonal")).alias("neg"))).alias("b")
    ).select("query", "target", F.col("b.shared").alias("shared"), (-F.col("b.neg")).alias("diagonal"))
    rows = (
        best.filter(F.col("shared") >= min_shared)
        .join(queries.select(F.col("pid").alias("query"), F.col("sequence").alias("_q")), "query")
        .join(database.select(F.col("pid").alias("target"), F.col("sequence").alias("_t")), "target")
    )
    q_from = F.greatest(F.lit(1), 1 - F.col("diagonal"))
    t_from = F.greatest(F.lit(1), 1 + F.col("diagonal"))
    overlap = F.least(F.length("_q") - q_from, F.length("_t") - t_from) + 1
    rows = rows.select(
        "query", "target", "shared", "diagonal", overlap.alias("overlap"),
        F.split(F.col("_q").substr(q_from, overlap), "").alias("a"),
        F.split(F.col("_t").substr(t_from, overlap), "").alias("b"),
    )
    same = F.size(F.filter(F.zip_with("a", "b", lambda x, y: x == y), lambda e: e))
    rows = rows.select("query", "target", "shared", "diagonal", "overlap",
                       (same / F.col("overlap")).alias("identity"))
    found = rows.filter(F.col("identity") >= min_identity)
    for side, ids in (("query", query_ids), ("target", target_ids)):
        found = found.withColumnRenamed(side, "_d").join(ids, "_d").drop("_d").withColumnRenamed("pid", side)
    by = Window.partitionBy("query").orderBy(F.desc("identity"), F.desc("shared"), "target")
    ranked = found.select("query", "target", "shared", "diagonal", "overlap", "identity", F.row_number().over(by).alias("rank"))
    return ranked if max_hits is None else ranked.filter(F.col("rank") <= max_hits)
