"""Registered queries: alignments built from whole texts, homolog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from proteoframe.functions import text as S
from proteoframe.operators import msa as M
from proteoframe.plans import projections as P
from proteoframe.plans.catalog import Catalog
from proteoframe.plans.sqlbase import (
    CONSENSUS, CONSMUT, HOMOLOGS, LINES, MSA, PSSM, PSSMMUT, SEQS, r6, with_)

CATALOG = Catalog()
query = CATALOG.query


def _counts(spark, d):
    msa = P.msa(spark, d)
    cmap = M.column_map(M.wt_record(msa))
    return M.column_counts(msa, cmap), cmap


@query(with_(LINES, body="""
, al AS (SELECT doc_id AS pid, rec_idx, line FROM lines)
SELECT pid, rec_idx, line AS aligned FROM al a
WHERE (SELECT count(DISTINCT length(line)) FROM al b WHERE b.pid = a.pid) = 1
"""))
def valid_alignments(spark, d):
    return M.valid_msa(P.document_alignments(spark, d))


@query(with_(LINES, body="""
SELECT doc_id AS pid, 'sequences must all be the same length' AS message
FROM lines GROUP BY doc_id HAVING count(DISTINCT length(line)) > 1
"""))
def alignment_warnings(spark, d):
    return M.msa_warnings(P.document_alignments(spark, d))


@query(with_(LINES, MSA, body="""
, last AS (SELECT pid, max_by(aligned, rec_idx) AS a FROM msa GROUP BY pid),
want AS (SELECT pid, CASE WHEN pid IN ('en', 'fr') THEN replace(a, '-', '') ELSE 'ABSENT' END AS sequence FROM last)
SELECT m.pid, coalesce(min(rec_idx) FILTER (replace(aligned, '-', '') = sequence), min(rec_idx)) AS rec_idx,
       coalesce(min_by(aligned, rec_idx) FILTER (replace(aligned, '-', '') = sequence), min_by(aligned, rec_idx)) AS aligned
FROM msa m JOIN want w ON w.pid = m.pid GROUP BY m.pid
"""))
def wild_type_records(spark, d):
    return M.wt_record(P.msa(spark, d), P.wild_types(spark, d))


@query(with_(LINES, MSA, body="SELECT pid, col, wt, position FROM cmap"))
def column_map(spark, d):
    return M.column_map(M.wt_record(P.msa(spark, d)))


@query(with_(LINES, MSA, body="SELECT pid, position, wt, aa, n, first_idx FROM counts"))
def column_counts(spark, d):
    return _counts(spark, d)[0]


@query(with_(LINES, MSA, CONSENSUS, body=f"""
SELECT pid, position, wt, consensus, {r6('conservation')} AS conservation,
       {r6('wt_frequency')} AS wt_frequency, depth FROM calls
"""))
def consensus_calls(spark, d):
    return M.consensus(_counts(spark, d)[0])


@query(with_(LINES, MSA, CONSENSUS, CONSMUT.format(cut=0.1), body=f"""
SELECT pid, position, wt, consensus AS mut, {r6('conservation')} AS score,
       {r6('wt_frequency')} AS wt_frequency, depth, rank FROM cmut
"""))
def consensus_mutations(spark, d):
    return M.consensus_mutations(M.consensus(_counts(spark, d)[0]), min_conservation=0.1)


@query(with_(LINES, MSA, CONSENSUS, CONSMUT.format(cut=0.1), body=f"""
SELECT pid, pid || '_consensus_top' || count(*) AS name,
       string_agg(wt || position || consensus, '+' ORDER BY rank) AS labels, {r6('sum(conservation)')} AS score
FROM cmut WHERE rank <= 5 GROUP BY pid HAVING count(*) > 1
"""))
def consensus_combo(spark, d):
    muts = M.consensus_mutations(M.consensus(_counts(spark, d)[0]), min_conservation=0.1)
    return M.consensus_combo(muts).select(
        "pid", "name", F.array_join(S.labels(F.col("mutations")), "+").alias("labels"), "score")


@query(with_(LINES, MSA, PSSM, body=f"SELECT pid, position, wt, aa, {r6('log_odds')} AS log_odds FROM pssm"))
def pssm(spark, d):
    return M.pssm(*_counts(spark, d)).select("pid", "position", "wt", "aa", "log_odds")


@query(with_(LINES, MSA, PSSM, PSSMMUT.format(cut=2.0), body=f"""
SELECT pid, position, wt, mut, {r6('score')} AS score, {r6('wt_log_odds')} AS wt_log_odds,
       {r6('log_odds')} AS log_odds, rank FROM pmut
"""))
def pssm_mutations(spark, d):
    return M.pssm_mutations(M.pssm(*_counts(spark, d)))


@query("""
SELECT doc_id AS pid, md5(replace(regexp_replace(text, '[^A-Z-]', '', 'g'), '-', '')) AS digest,
       length(replace(regexp_replace(text, '[^A-Z-]', '', 'g'), '-', '')) AS n
FROM documents
""")
def a3m_residues(spark, d):
    src = P.table(spark, d, "documents")
    return src.select(F.col("doc_id").alias("pid"), M.a3m_residues(F.col("text")).alias("s")).select(
        "pid", F.md5("s").alias("digest"), F.length("s").alias("n"))


@query(with_(HOMOLOGS, body="SELECT pid, rank, idx, name, md5(sequence) AS digest FROM kept"))
def homologs_deduplicated(spark, d):
    return M.dedupe_homologs(P.source_hits(spark, d)).select(
        "pid", "rank", "idx", "name", F.md5("sequence").alias("digest"))


@query(with_(HOMOLOGS, body=f"""
SELECT pid, count(*) AS num_homologs, {r6('avg(length(sequence))')} AS mean_length
FROM kept GROUP BY pid
"""))
def homolog_stats(spark, d):
    return M.homolog_stats(M.dedupe_homologs(P.source_hits(spark, d), ranked=False))


@query(with_(HOMOLOGS, body=f"""
, st AS (SELECT pid, count(*) AS num_homologs, avg(length(sequence)) AS mean_length
         FROM kept GROUP BY pid)
SELECT d.doc_id AS candidate_id, d.source AS pid, num_homologs, {r6('mean_length')} AS mean_length
FROM documents d LEFT JOIN st ON st.pid = d.source
"""))
def homologs_attached(spark, d):
    cands = P.table(spark, d, "documents").select(
        F.col("doc_id").alias("candidate_id"), F.col("source").alias("pid"))
    return M.attach_homologs(cands, M.homolog_stats(M.dedupe_homologs(P.source_hits(spark, d), ranked=False)))


@query(with_(HOMOLOGS, body="""
SELECT pid, string_agg(name, ',' ORDER BY rank) AS names, CAST(sum(length(sequence)) AS BIGINT) AS residues
FROM kept WHERE rank <= 8 GROUP BY pid
"""))
def context_homologs(spark, d):
    # The context is the first eight, which every task can prune to.
    return M.context_homologs(M.dedupe_homologs(P.source_hits(spark, d), max_hits=8)).select(
        "pid", F.array_join(F.transform("context", lambda h: h["name"]), ",").alias("names"),
        F.aggregate("context", F.lit(0), lambda a, h: a + F.length(h["sequence"])).alias("residues"))


@query(with_(SEQS, body=f"""
, qs AS (SELECT item_id AS pid,
           translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BJOUXZ', '') AS sequence FROM benchmark),
qk AS (SELECT pid AS q, i AS qp, substr(sequence, i, 20) AS kmer
       FROM (SELECT *, unnest(range(1, length(sequence) - 18)) AS i FROM qs)),
tk AS (SELECT pid AS t, i AS tp, substr(sequence, i, 20) AS kmer
       FROM (SELECT *, unnest(range(1, length(sequence) - 18)) AS i FROM seqs)),
dg AS (SELECT q, t, tp - qp AS diagonal, count(*) AS shared FROM qk JOIN tk USING (kmer) GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q, t ORDER BY shared DESC, diagonal) AS rn FROM dg)
         WHERE rn = 1 AND shared >= 4),
span AS (
  SELECT q, t, shared, diagonal, greatest(1, 1 - diagonal) AS qf, greatest(1, 1 + diagonal) AS tf,
         a.sequence AS qs, b.sequence AS ts
  FROM best JOIN qs a ON a.pid = q JOIN seqs b ON b.pid = t),
ov AS (SELECT *, least(length(qs) - qf, length(ts) - tf) + 1 AS overlap FROM span),
ident AS (
  SELECT q, t, shared, diagonal, overlap,
         len(list_filter(range(0, overlap), lambda i: substr(qs, qf + i, 1) = substr(ts, tf + i, 1)))
           / overlap AS identity
  FROM ov)
SELECT q AS query, t AS target, shared, diagonal, overlap, {r6('identity')} AS identity,
       row_number() OVER (PARTITION BY q ORDER BY identity DESC, shared DESC, t) AS rank
FROM ident WHERE identity >= 0.3
"""))
def kmer_homologs(spark, d):
    queries = P.sequences(spark, d, "benchmark", "item_id")
    return M.kmer_homologs(queries, P.sequences(spark, d), k=20, min_identity=0.3)
