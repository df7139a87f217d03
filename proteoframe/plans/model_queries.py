"""Registered queries: model-score analytics, diversity, position sets, liabilities."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from proteoframe.functions import text as S
from proteoframe.operators import biophys, complexity, liability
from proteoframe.operators import evidence as E
from proteoframe.operators import library as L
from proteoframe.operators import modelscores as MS
from proteoframe.operators import msa as M
from proteoframe.operators import mutate
from proteoframe.operators import report as R
from proteoframe.operators import scan
from proteoframe.operators import scoring as C
from proteoframe.operators import structure as G
from proteoframe.operators.windows import residues
from proteoframe.plans import projections as P
from proteoframe.plans.catalog import Catalog
from proteoframe.plans.biophys_queries import BISECT, PROPS, SCALE, charge_sql
from proteoframe.plans.sequence_queries import CYS, FLAGS, MOTIF
from proteoframe.plans.structure_queries import patch_members
from proteoframe.session import shared
from proteoframe.plans.sqlbase import (
    ATOMS, BMUT, BSEQ, DOCMUT, LINES, LOGPROBS, MSA, PATCH, PROT, PSSM, PSSMMUT, RES, SASA, SEQS, SURFACE,
    TCAND, VSEQ, exact, r6, with_)

CATALOG = Catalog()
query = CATALOG.query


def _bench(spark, d):
    res = residues(P.benchmark_sequences(spark, d))
    return res, P.logprobs(res)


@query(with_(BSEQ, RES, LOGPROBS, body=f"""
, m AS (SELECT l.pid, model, avg(lp) AS pll FROM lps l JOIN res r
          ON r.pid = l.pid AND r.position = l.position AND r.aa = l.aa GROUP BY l.pid, model)
SELECT pid, {r6('avg(pll)')} AS pll, count(*) AS n_models FROM m GROUP BY pid
"""))
def ensemble_pll(spark, d):
    res, lps = _bench(spark, d)
    return MS.ensemble_pll(lps, res)


@query(with_(BSEQ, RES, LOGPROBS, body=f"""
SELECT l.pid, {r6('avg(lp)')} AS mean_loglik, count(*) AS n FROM lps l JOIN res r
  ON r.pid = l.pid AND r.position = l.position AND r.aa = l.aa WHERE model = 1 GROUP BY l.pid
"""))
def mean_loglik(spark, d):
    res, lps = _bench(spark, d)
    return MS.mean_loglik(lps.filter("model = 1"), res)


GAINS = f"""
gn AS (
  SELECT a.pid, a.position, r.aa AS wt, a.aa AS mut, {exact('a.lp - w.lp', 4)} AS gain
  FROM res r JOIN lps a ON a.pid = r.pid AND a.position = r.position AND a.model = 1
  JOIN lps w ON w.pid = r.pid AND w.position = r.position AND w.aa = r.aa AND w.model = 1
  WHERE a.aa <> r.aa AND {exact('a.lp - w.lp', 4)} > 0)"""


def _gains(spark, d):
    res, lps = _bench(spark, d)
    return MS.marginal_gains(lps.filter("model = 1"), res)


@query(with_(BSEQ, RES, LOGPROBS, GAINS, body=f"""
SELECT pid, position, wt, count(*) AS n, {r6('sum(gain)')} AS gain_sum, string_agg(mut, '' ORDER BY mut) AS gaining FROM gn GROUP BY ALL
"""))
def marginal_gains(spark, d):
    """All gains, told per position: how many, their sum, and which letters gain."""
    return _gains(spark, d).groupBy("pid", "position", "wt").agg(
        F.count("*").alias("n"), F.sum("gain").alias("gain_sum"),
        F.array_join(F.sort_array(F.collect_list("mut")), "").alias("gaining"))


@query(with_(BSEQ, RES, LOGPROBS, GAINS, body=f"""
, b AS (SELECT * FROM gn QUALIFY row_number() OVER (PARTITION BY pid, position ORDER BY gain DESC, mut) = 1),
fit AS (SELECT l.pid, avg(lp) AS f FROM lps l JOIN res r
        ON r.pid = l.pid AND r.position = l.position AND r.aa = l.aa WHERE model = 1 GROUP BY l.pid)
SELECT b.pid, position, wt, mut, {r6('gain')} AS gain, {r6('f + gain')} AS e1_fitness,
       row_number() OVER (PARTITION BY b.pid ORDER BY gain DESC, position) AS rank
FROM b JOIN fit ON fit.pid = b.pid QUALIFY rank <= 5
"""))
def saturation_scan(spark, d):
    res, lps = _bench(spark, d)
    fit = MS.mean_loglik(lps.filter("model = 1"), res).select("pid", F.col("mean_loglik").alias("parent_fitness"))
    best = L.saturation_best(MS.marginal_gains(lps.filter("model = 1"), res))
    return MS.saturation_fitness(best, fit).drop("parent_fitness")


@query(with_(BSEQ, RES, LOGPROBS, BMUT, body=f"""
SELECT b.pid, set_id, {r6('sum(m.lp - w.lp)')} AS fitness, count(*) AS n_mutations
FROM bmut b JOIN lps m ON m.pid = b.pid AND m.position = b.position AND m.aa = b.mut AND m.model = 1
JOIN lps w ON w.pid = b.pid AND w.position = b.position AND w.aa = b.wt AND w.model = 1
GROUP BY b.pid, set_id
"""))
def wildtype_marginal(spark, d):
    _, lps = _bench(spark, d)
    return MS.wildtype_marginal(P.benchmark_mutations(spark, d), lps.filter("model = 1"))


@query(with_(TCAND, body=f"""
SELECT candidate_id, {r6("(length(sequence) - length(replace(sequence, 'E', ''))) / greatest(1, length(sequence))")} AS value
FROM tc
"""))
def mapped_model_scores(spark, d):
    """A scorer sees each distinct sequence once; copies get the same score."""
    def share_of_e(frames):
        for f in frames:
            n = f["sequence"].str.len().clip(lower=1)
            yield pd.DataFrame({"sequence": f["sequence"], "value": f["sequence"].str.count("E") / n})

    cands = P.text_candidates(spark, d)
    return C.score_with(cands, share_of_e, "sequence string, value double")


@query(with_(TCAND, body="SELECT md5(sequence) AS digest, count(*) AS copies FROM tc GROUP BY ALL"))
def distinct_sequences(spark, d):
    cands = P.text_candidates(spark, d)
    once = C.distinct_sequences(cands).select(F.md5("sequence").alias("digest"))
    return once.join(cands.groupBy(F.md5("sequence").alias("digest")).agg(F.count("*").alias("copies")), "digest")


@query(with_(BSEQ, BMUT, body="""
, ds AS (
  SELECT b.pid, set_id, string_agg(wt || position || mut, '+' ORDER BY position) AS labels, count(*) AS n_mutations
  FROM bmut b GROUP BY b.pid, set_id HAVING count(*) = count(DISTINCT position))
SELECT pid AS parent_id, set_id AS design_no, labels, n_mutations, n_mutations / 10.0::DOUBLE AS mpnn_score,
       round(1 - n_mutations / length(sequence)::DOUBLE, 6) AS mpnn_recovery
FROM ds JOIN seqs USING (pid)
"""))
def designs_to_candidates(spark, d):
    seqs = P.benchmark_sequences(spark, d)
    sets = P.benchmark_mutations(spark, d).groupBy("pid", "set_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "wt", "mut"))).alias("mutations"))
    n = F.size("mutations")
    designs = mutate.valid_sets(seqs, sets).select(
        "pid", F.col("set_id").alias("design_no"), S.apply_all(F.col("sequence"), F.col("mutations")).alias("sequence"),
        (n / 10.0).alias("score"), (1 - n / F.length("sequence")).alias("recovery"))
    out = MS.designs_to_candidates(designs, seqs)
    return out.select("parent_id", "design_no", F.array_join(S.labels(F.col("mutations")), "+").alias("labels"),
                      F.size("mutations").alias("n_mutations"), "mpnn_score", "mpnn_recovery")


@query(with_(VSEQ, body="""
, o AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY rank) AS k FROM vs),
g AS (
  SELECT pid, 1::BIGINT AS k, [sequence] AS kept, [rank] AS ids FROM o WHERE k = 1
  UNION ALL
  SELECT o.pid, o.k,
    CASE WHEN len(kept) < 25 AND len(list_filter(kept, lambda s: len(list_filter(range(1, 65), lambda i:
      substr(s, i, 1) <> substr(o.sequence, i, 1))) < 50)) = 0 THEN list_append(kept, o.sequence) ELSE kept END,
    CASE WHEN len(kept) < 25 AND len(list_filter(kept, lambda s: len(list_filter(range(1, 65), lambda i:
      substr(s, i, 1) <> substr(o.sequence, i, 1))) < 50)) = 0 THEN list_append(ids, o.rank) ELSE ids END
  FROM g JOIN o ON o.pid = g.pid AND o.k = g.k + 1)
SELECT pid, unnest(ids) AS rank FROM g WHERE k = (SELECT max(k) FROM o WHERE o.pid = g.pid)
""").replace("WITH", "WITH RECURSIVE", 1))
def diversified(spark, d):
    return L.diversify(P.vector_sequences(spark, d), min_distance=50, cap=25).select("pid", "rank")


@shared
def _hits(spark, d):
    return liability.liability_hits(P.sequences(spark, d))


@query(with_(SEQS, RES, CYS, MOTIF, PROT, body=f"""
, fx AS (
  SELECT h.pid, fix_position AS position, fix_wt || fix_position || fix_mut AS label,
         row_number() OVER (PARTITION BY h.pid, fix_position ORDER BY CASE category WHEN 'deamidation' THEN 1
           WHEN 'oxidation' THEN 2 WHEN 'proteolysis' THEN 3 ELSE 4 END DESC) AS rn
  FROM hits h LEFT JOIN prot p ON p.pid = h.pid AND p.position = h.fix_position
  WHERE p.pid IS NULL AND fix_wt <> fix_mut QUALIFY rn = 1),
li AS (
  SELECT c.pid, c.position, 'C' AS residue, 'Unpaired Cys' AS category, risk, 'C' || c.position || 'S' AS fix
  FROM cyshit c LEFT JOIN prot p ON p.pid = c.pid AND p.position = c.position WHERE p.pid IS NULL
  UNION ALL
  SELECT h.pid, h.position, substr(residues, 1, 1), upper(substr(category, 1, 1)) || substr(category, 2), risk,
         coalesce(a.label, b.label)
  FROM hits h LEFT JOIN fx a ON a.pid = h.pid AND a.position = h.position
  LEFT JOIN fx b ON b.pid = h.pid AND b.position = h.position + 1),
rl AS (
  SELECT *, CASE WHEN risk >= 0.65 THEN 'bad' WHEN risk >= 0.4 THEN 'warn' ELSE 'good' END AS band,
         row_number() OVER (PARTITION BY pid ORDER BY round(risk, 9) DESC, position, category, residue) AS rank
  FROM li)
SELECT pid, category, band, count(*) AS n, {r6('sum(risk)')} AS risk_sum, count(fix) AS n_fixes,
       sum(position * rank)::BIGINT AS place_sum,
       md5(string_agg(residue || position || coalesce('>' || fix, ''), ',' ORDER BY rank)) AS rows_digest
FROM rl GROUP BY ALL
"""))
def liability_table(spark, d):
    """The whole table, told per protein, category and band: counts, sums, and a digest of its rows."""
    rows = E.liabilities(_hits(spark, d), P.protected_positions(spark, d))
    line = F.concat(F.col("residue"), F.col("position").cast("string"), F.coalesce(F.concat(F.lit(">"), "fix"), F.lit("")))
    return rows.groupBy("pid", "category", "band").agg(
        F.count("*").alias("n"), F.sum("risk").alias("risk_sum"), F.count("fix").alias("n_fixes"),
        F.sum(F.col("position") * F.col("rank")).alias("place_sum"),
        F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))),
                                       lambda r: r["line"]), ",")).alias("rows_digest"))


@query(with_(SEQS, RES, CYS, MOTIF, FLAGS, PROT, body="""
SELECT 'cysteine_scan' AS source_step, 'cysteine' AS category,
       CASE WHEN round(risk, 9) >= 0.7 THEN 'bad' WHEN round(risk, 9) >= 0.5 THEN 'warn' ELSE 'good' END AS band, count(*) AS n
FROM cyshit c LEFT JOIN prot p ON p.pid = c.pid AND p.position = c.position WHERE p.pid IS NULL GROUP BY ALL
UNION ALL
SELECT 'motif_scan', category,
       CASE WHEN round(risk, 9) >= 0.7 THEN 'bad' WHEN round(risk, 9) >= 0.4 THEN 'warn' ELSE 'good' END, count(*) FROM hits GROUP BY ALL
UNION ALL
SELECT 'sequence_complexity', category,
       CASE WHEN round(risk, 9) >= 0.7 THEN 'bad' WHEN round(risk, 9) >= 0.3 THEN 'warn' ELSE 'good' END, count(*) FROM flags GROUP BY ALL
"""))
def step_breakdown(spark, d):
    seqs, prot = P.sequences(spark, d), P.protected_positions(spark, d)
    shield = prot.select("pid", "position", F.lit("cysteine").alias("category"))
    hits = _hits(spark, d).join(shield, ["pid", "position", "category"], "left_anti")
    return R.step_breakdown(hits, complexity.complexity_flags(seqs))


FLAGGED = """
fl AS (
  SELECT DISTINCT n.pid, n.position FROM (
    SELECT pid, position FROM hits UNION ALL SELECT pid, position FROM flags UNION ALL SELECT pid, position FROM docmut) n
  JOIN seqs s ON s.pid = n.pid LEFT JOIN prot p ON p.pid = n.pid AND p.position = n.position
  WHERE n.position BETWEEN 1 AND length(sequence) AND p.pid IS NULL)"""


def _flagged(spark, d, seqs, prot):
    return scan.flagged_positions(
        scan.motif_hits(seqs), complexity.complexity_flags(seqs), P.document_mutations(spark, d), seqs, prot)


@query(with_(SEQS, RES, MOTIF, FLAGS, PROT, DOCMUT, FLAGGED, body="SELECT pid, position FROM fl"))
def flagged_positions(spark, d):
    return _flagged(spark, d, P.sequences(spark, d), P.protected_positions(spark, d))


@query(with_(SEQS, RES, MOTIF, FLAGS, PROT, DOCMUT, FLAGGED, body="""
SELECT s.pid, count(k.position) AS n_fixed, CAST(coalesce(sum(k.position), 0) AS BIGINT) AS position_sum
FROM seqs s LEFT JOIN (
  (SELECT pid, position FROM res EXCEPT SELECT pid, position FROM fl) UNION SELECT pid, position FROM prot) k
  ON k.pid = s.pid GROUP BY s.pid
"""))
def fixed_positions(spark, d):
    seqs, prot = P.sequences(spark, d), P.protected_positions(spark, d)
    fixed = scan.fixed_positions(seqs, _flagged(spark, d, seqs, prot), prot)
    per = fixed.groupBy("pid").agg(F.count("*").alias("n"), F.sum("position").alias("s"))
    return seqs.select("pid").join(per, "pid", "left").select(
        "pid", F.coalesce("n", F.lit(0)).alias("n_fixed"), F.coalesce("s", F.lit(0)).alias("position_sum"))


@query(with_(LINES, MSA, PSSM, PSSMMUT.format(cut=2.0), body=f"""
SELECT pid, rank, position, wt, mut, {r6('score')} AS score,
       CASE WHEN score >= 5 THEN 'very strong' WHEN score >= 3 THEN 'strong' WHEN score >= 2 THEN 'moderate' ELSE 'weak' END AS strength,
       coalesce((SELECT string_agg(o.mut, ',' ORDER BY o.mut) FROM pmut o
         WHERE o.pid = m.pid AND o.position = m.position AND o.mut <> m.mut), '') AS alternatives,
       wt = 'C' AS removes_cys, mut = 'C' AS introduces_cys
FROM pmut m
"""))
def pssm_table(spark, d):
    msa = P.msa(spark, d)
    cmap = M.column_map(M.wt_record(msa))
    return R.pssm_table(M.pssm_mutations(M.pssm(M.column_counts(msa, cmap), cmap)))


CHAINS = """
seqs AS (SELECT structure_id AS pid, string_agg(aa, '' ORDER BY position) AS sequence FROM vecs GROUP BY structure_id)"""


@query(with_(ATOMS, SASA, SURFACE, PATCH, CHAINS, RES, SCALE, PROPS, body=BISECT + f"""
, hw AS (
  SELECT r.pid, r.position, n,
         sum(kd) OVER (PARTITION BY r.pid ORDER BY r.position ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) > 112 AS hot
  FROM res r JOIN scale USING (aa)),
hv AS (SELECT *, lag(hot) OVER (PARTITION BY pid ORDER BY position) AS before FROM hw WHERE position + 6 <= n),
ag AS (SELECT pid, count(*) FILTER (hot) / count(*) AS share, count(*) FILTER (hot AND NOT coalesce(before, false)) AS patches
       FROM hv GROUP BY pid),
cf AS (SELECT structure_id AS pid, avg(bfactor) FILTER (atom = 'CA') AS ca_mean, min(bfactor) FILTER (atom = 'CA') AS ca_low
       FROM atoms GROUP BY structure_id),
np AS (SELECT structure_id AS pid, count(DISTINCT patch) AS n_patches FROM mem GROUP BY structure_id)
SELECT cnt.pid, n AS length, {r6('mw')} AS mw, {r6(exact('(lo + hi) / 2', 2))} AS pi, {r6('gravy')} AS gravy,
       {r6(exact(charge_sql('7.4', 'cnt.'), 1))} AS charge_7_4, {r6(exact('ii', 2))} AS instability_index,
       {r6(exact('ai', 1))} AS aliphatic_index, cnt.c AS cys_count, rare AS rare_codons, pro AS proline_count,
       CASE WHEN {exact('ii', 2)} < 40 THEN 'Stable' ELSE 'Unstable' END AS instability_label,
       {r6(exact('coalesce(share, 0)', 3))} AS agg_score, coalesce(patches, 0) AS agg_patches,
       {r6(exact('cf.ca_mean', 1))} AS plddt_mean, {r6(exact('cf.ca_low', 1))} AS plddt_min, coalesce(np.n_patches, 0) AS n_surface_patches
FROM cnt JOIN inst ON inst.pid = cnt.pid JOIN bis ON bis.pid = cnt.pid AND bis.step = 100
LEFT JOIN ag ON ag.pid = cnt.pid LEFT JOIN cf ON cf.pid = cnt.pid LEFT JOIN np ON np.pid = cnt.pid
""").replace("WITH RECURSIVE", "WITH").replace("WITH", "WITH RECURSIVE", 1))
def protein_metrics(spark, d):
    """Whole metrics row of each chain with its confidence and surface patches."""
    atoms = P.atoms(spark, d)
    chain = atoms.select(F.col("structure_id").alias("pid"), "position", "aa").distinct()
    seqs = chain.groupBy("pid").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("position", "aa"))), lambda r: r["aa"]), "").alias("sequence"))
    conf = G.plddt(atoms).select(F.col("structure_id").alias("pid"), "plddt_mean", "plddt_min")
    return biophys.protein_metrics(seqs, conf, patch_members(spark, d))
