"""Registered queries over the run tables: scores, library, evidence, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from proteoframe.functions import constants as K
from proteoframe.functions import text as S
from proteoframe.operators import evidence as E
from proteoframe.operators import library as L
from proteoframe.operators import mutate
from proteoframe.operators import report as R
from proteoframe.operators import scoring as C
from proteoframe.operators import steps
from proteoframe.operators.ranking import dealt_by_range, dealt_rank, full_rank, top_per_key
from proteoframe.plans import projections as P
from proteoframe.plans.catalog import Catalog
from proteoframe.plans.sqlbase import COMPOSITE, OCANDS, OMUTS, OSCORES, RSCORES, RUN, r6, with_
from proteoframe.session import planned, shared, sharing, stored

CATALOG = Catalog()
query = CATALOG.query

STEPS = [name for name, _ in P.RUN_STEPS.values()]
RCOMP = COMPOSITE.format(src="rs")
OCOMP = COMPOSITE.format(src="os")
VARS = """
v AS (
  SELECT rv.*, coalesce(composite, 0.0) AS composite_score,
         step_no * 1000000 + position * 100 + ascii(mut) AS seq_no
  FROM rv LEFT JOIN comp USING (candidate_id)),
best AS (SELECT candidate_id, max(value) AS top_value FROM rs GROUP BY candidate_id)"""
TIER = "CASE WHEN step_no <= 2 THEN 1 WHEN step_no <= 4 THEN 2 ELSE 3 END"


def _entries():
    """Scores of a run variant as key and column; ``own_key`` names the score of its step."""
    return [(F.lit(k), F.col(k)) for k in ("e1_fitness", "esm1v_delta")] + [(F.col("own_key"), F.col("score"))]


def _scored(spark, d):
    """Run variants with their composite score, all in plain columns."""
    key = S.lookup(F.col("step_no"), {k: s[1] for k, s in P.RUN_STEPS.items()})
    # Read for the statistics and for the rows.
    v = P.run_variants(spark, d) if sharing() else stored(P.run_variants(spark, d))
    return C.composite_in_row(v.withColumn("own_key", key), entries=_entries()).withColumn(
        "seq_no", F.col("step_no") * 1000000 + F.col("position") * 100 + F.ascii("mut"))


@planned
def _dealt(spark, d):
    """Scored variants by protein and falling score: the variants of a protein lie together for whatever reads them."""
    return dealt_by_range(_scored(spark, d), [
        F.asc_nulls_first("pid"), F.desc_nulls_last("composite_score"), F.asc_nulls_first("seq_no")])


@planned
def _ranked(spark, d):
    """Scored variants with their rank inside the protein."""
    return dealt_rank(_dealt(spark, d), ["pid"])


def _with_arrays(v, *more):
    """Scored variants with mutation array and score map."""
    return v.select(
        "pid", "candidate_id", "source_step", "step_no", "position", "wt", "mut", "score", "seq_no",
        F.array(F.struct("position", "wt", "mut", "source_step")).alias("mutations"),
        S.map_of_present(_entries()).alias("scores"), "composite_score", *more)


def variants(spark, d):
    """Run variants with mutation array, score map and composite score."""
    return _with_arrays(_dealt(spark, d) if sharing() else _scored(spark, d))


def _first(ranked):
    return _with_arrays(ranked.filter(F.col("rank") <= R.LIBRARY_TOP))


@shared
def _first_ranked(spark, d):
    return _first(_ranked(spark, d))


def _leading(spark, d):
    """Variants that hold the first ``R.LIBRARY_TOP`` of each protein; no others if these are at hand."""
    return _first_ranked(spark, d) if sharing() else variants(spark, d)


def singles(spark, d):
    return variants(spark, d).select(
        "pid", "position", "wt", "mut", "source_step", "seq_no",
        L.best_score(F.col("scores")).alias("best"))


# ------------------------------------------------------------------- scoring

@query(with_(OSCORES, body=f"""
SELECT score_key, {r6('avg(value)')} AS mean, {r6('stddev_pop(value)')} AS std, count(*) AS n
FROM os GROUP BY score_key HAVING count(*) > 1
"""))
def score_stats(spark, d):
    return C.score_stats(P.order_scores(spark, d))


@query(with_(OCANDS, OSCORES, OCOMP, body=f"""
SELECT pid, oc.candidate_id, parent_id, {r6('coalesce(composite, 0)')} AS composite_score
FROM oc LEFT JOIN comp USING (candidate_id)
"""))
def composite_score(spark, d):
    return C.composite_score(P.order_candidates(spark, d), P.order_scores(spark, d))


@query(with_(OCANDS, OSCORES, body=f"""
, c AS (
  SELECT candidate_id, sum(w * sgn * value) / sum(w) AS composite FROM (
    SELECT candidate_id, value, CASE WHEN score_key IN ('ddg', 'surface_sap') THEN -1 ELSE 1 END AS sgn,
           CASE score_key WHEN 'e1_fitness' THEN 0.25 WHEN 'esm1v_delta' THEN 0.2 WHEN 'mpnn_score' THEN 0.5
                WHEN 'ddg' THEN 0.05 WHEN 'surface_sap' THEN 0.025 WHEN 'plddt' THEN 0.01 END::DOUBLE AS w
    FROM os WHERE score_key <> 'val_plddt') GROUP BY candidate_id)
SELECT pid, oc.candidate_id, parent_id, {r6('coalesce(composite, 0)')} AS composite_score
FROM oc LEFT JOIN c USING (candidate_id)
"""))
def composite_score_raw(spark, d):
    return C.composite_score(
        P.order_candidates(spark, d), P.order_scores(spark, d),
        weights={"mpnn_score": 0.5, "plddt": 0.01}, normalize=False)


@query(with_(OCANDS, OSCORES, OCOMP, body=f"""
SELECT pid, oc.candidate_id, {r6('composite')} AS composite_score,
       row_number() OVER (PARTITION BY pid % 3 ORDER BY composite DESC NULLS LAST, oc.candidate_id) AS rank
FROM oc LEFT JOIN comp USING (candidate_id)
"""))
def ranked_candidates(spark, d):
    """Three huge groups: the ranking must not put a group into one task."""
    cands = P.order_candidates(spark, d)
    rows = C.composite_score(cands.select("pid", "candidate_id"), P.order_scores(spark, d), missing=None)
    ranked = full_rank(rows.withColumn("third", F.col("pid") % 3), ["third"], "composite_score", "candidate_id")
    return ranked.select("pid", "candidate_id", "composite_score", "rank")


@query(with_(OSCORES, body=f"""
SELECT score_key, candidate_id, {r6('value')} AS value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY score_key ORDER BY value, candidate_id) AS rank FROM os) WHERE rank <= 10
"""))
def top_candidates(spark, d):
    return top_per_key(P.order_scores(spark, d), ["score_key"], ["value", "candidate_id"], 10)


@query(with_(OCANDS, OSCORES, OCOMP, OMUTS, body=f"""
, top AS (SELECT candidate_id, composite, row_number() OVER (ORDER BY composite DESC, candidate_id) AS rank
          FROM comp QUALIFY rank <= 20),
lab AS (SELECT candidate_id, string_agg(wt || position || mut, ', ' ORDER BY position, wt, mut) AS labels
        FROM om GROUP BY candidate_id)
SELECT t.candidate_id, rank, {r6('composite')} AS composite_score, labels
FROM top t LEFT JOIN lab USING (candidate_id)
"""))
def rank_table(spark, d):
    """Best twenty of everything: a bounded sort, then labels for twenty rows."""
    scores = P.order_scores(spark, d)
    ids = scores.filter(F.col("score_key").isin(*K.DEFAULT_WEIGHTS)).select("candidate_id").distinct()
    top = C.composite_score(ids, scores).orderBy(F.desc("composite_score"), "candidate_id").limit(20)
    place = F.struct((-F.col("composite_score")).alias("s"), "candidate_id")
    ranked = top.agg(F.sort_array(F.collect_list(place)).alias("l")).select(F.posexplode("l").alias("i", "e"))
    return ranked.select(
        F.col("e.candidate_id").alias("candidate_id"), (F.col("i") + 1).alias("rank"),
        (-F.col("e.s")).alias("composite_score"),
    ).join(P.order_mutations(spark, d), "candidate_id", "left").select(
        "candidate_id", "rank", "composite_score", F.array_join(S.labels(F.col("mutations")), ", ").alias("labels"))


REASONS = """
sm AS (SELECT candidate_id, max(value) FILTER (score_key = 'val_plddt') AS vp, max(value) FILTER (score_key = 'plddt') AS p,
         max(value) FILTER (score_key = 'ddg') AS ddg, max(value) FILTER (score_key = 'e1_fitness') AS e1,
         max(value) FILTER (score_key = 'esm1v_delta') AS ev,
         count(*) FILTER (score_key = 'mpnn_score') AS has_mpnn FROM os GROUP BY candidate_id),
mm AS (SELECT candidate_id, count(*) AS n, min(position) FILTER (mut = 'C') AS cys,
         string_agg('pro_in_helix_' || position, ';' ORDER BY position, wt, mut)
           FILTER (mut = 'P' AND position % 10 BETWEEN 1 AND 4) AS pro
       FROM om GROUP BY candidate_id),
rsn AS (
  SELECT oc.pid, oc.candidate_id, oc.parent_id,
    CASE WHEN parent_id IS NULL THEN '' ELSE concat_ws(';',
      CASE WHEN n > 5 THEN 'too_many_mutations' END,
      CASE WHEN coalesce(CASE WHEN vp <> 0 THEN vp END, p) < 30 THEN 'low_plddt' END,
      CASE WHEN ddg > 5.0 THEN 'high_ddg' END,
      CASE WHEN e1 < -5 THEN 'low_e1_fitness' END, CASE WHEN ev < -5 THEN 'negative_esm1v_delta' END,
      CASE WHEN cys IS NOT NULL THEN 'introduces_cys_' || cys END, pro,
      CASE WHEN coalesce(has_mpnn, 0) = 0 THEN 'missing_mpnn_score' END) END AS reasons
  FROM oc LEFT JOIN sm USING (candidate_id) LEFT JOIN mm USING (candidate_id))"""


@query(with_(OCANDS, OSCORES, OMUTS, REASONS, body="""
SELECT pid, candidate_id, reasons, reasons = '' AS passed FROM rsn
"""))
def quality_filter(spark, d):
    cands = P.order_candidates(spark, d).withColumn(
        "secondary_structure", F.lit("HHHHCCCEEC" * 30))
    out = C.quality_filter(
        cands, P.order_scores(spark, d), P.order_mutations(spark, d), max_mutations=5, min_plddt=30.0,
        min_e1_fitness=-5.0, min_esm1v_delta=-5.0, require_scores=("mpnn_score",))
    return out.select("pid", "candidate_id", F.array_join("reasons", ";").alias("reasons"), "passed")


@query(with_(OCANDS, OSCORES, body="""
SELECT pid, candidate_id, CASE WHEN parent_id IS NOT NULL AND value / 100.0 < 0.45 THEN 'low_recovery' ELSE '' END AS reasons,
       NOT (parent_id IS NOT NULL AND coalesce(value / 100.0 < 0.45, false)) AS passed
FROM oc LEFT JOIN (SELECT candidate_id, value FROM os WHERE score_key = 'val_plddt') USING (candidate_id)
"""))
def recovery_filter(spark, d):
    """The quality filter on designs that recover too little of the native sequence."""
    recovered = P.order_scores(spark, d).filter("score_key = 'val_plddt'").select(
        "candidate_id", F.lit("mpnn_recovery").alias("score_key"), (F.col("value") / 100.0).alias("value"))
    out = C.quality_filter(P.order_candidates(spark, d), recovered, P.order_mutations(spark, d), max_mutations=1000,
                           min_recovery=0.45, forbid_new_cysteines=False, forbid_prolines_in_helix=False)
    return out.select("pid", "candidate_id", F.array_join("reasons", ";").alias("reasons"), "passed")


@query(with_(OCANDS, body="""
SELECT CASE WHEN parent_id IS NULL THEN 'parent' ELSE 'variant' END AS kind, count(*) AS n,
       CAST(sum(candidate_id) AS BIGINT) AS id_sum FROM oc GROUP BY ALL
"""))
def parent_variant_split(spark, d):
    c = P.order_candidates(spark, d)
    out = mutate.parents(c).withColumn("kind", F.lit("parent")).unionByName(
        mutate.variants(c).withColumn("kind", F.lit("variant")))
    return out.groupBy("kind").agg(F.count("*").alias("n"), F.sum("candidate_id").alias("id_sum"))


@query(with_(OCANDS, body="""
SELECT candidate_id, parent_id FROM oc WHERE parent_id IN (SELECT candidate_id FROM oc WHERE parent_id IS NULL)
"""))
def direct_children(spark, d):
    return mutate.direct_children(P.order_candidates(spark, d)).select("candidate_id", "parent_id")


@query(with_(OCANDS, body="""
SELECT pid, candidate_id, parent_id FROM oc WHERE parent_id IS NULL
UNION ALL SELECT o_custkey, -o_orderkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'
"""))
def roots_with_proposals(spark, d):
    """Old variants leave, roots and the new proposals stay."""
    proposed = P.table(spark, d, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("pid"), (-F.col("o_orderkey")).alias("candidate_id"),
        F.col("o_orderkey").alias("parent_id"))
    return mutate.with_parents(P.order_candidates(spark, d), proposed)


@query(with_(OCANDS, body="""
SELECT pid, 'disulfide_design' AS source_step, candidate_id || ': no structure' AS message
FROM oc JOIN orders ON o_orderkey = candidate_id WHERE parent_id IS NULL AND o_orderstatus <> 'F'
"""))
def missing_structures(spark, d):
    status = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("candidate_id"), "o_orderstatus")
    cands = P.order_candidates(spark, d).join(status, "candidate_id").withColumn(
        "structure_path", F.when(F.col("o_orderstatus") == "F", "model"))
    return steps.missing_structures(cands, "disulfide_design")


@query(with_(OCANDS, body="""
, s AS (SELECT oc.*, CASE WHEN parent_id IS NULL OR o_orderstatus = 'F' THEN 'model_' || candidate_id END AS path
        FROM oc JOIN orders ON o_orderkey = candidate_id)
SELECT a.candidate_id, coalesce(a.path, b.path) AS structure_path
FROM s a LEFT JOIN s b ON b.candidate_id = a.parent_id
"""))
def inherited_structures(spark, d):
    status = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("candidate_id"), "o_orderstatus")
    own = F.when(F.col("parent_id").isNull() | (F.col("o_orderstatus") == "F"),
                 F.concat(F.lit("model_"), F.col("candidate_id").cast("string")))
    cands = P.order_candidates(spark, d).join(status, "candidate_id").withColumn("structure_path", own)
    return mutate.inherit_structure(cands).select("candidate_id", "structure_path")


@query(with_(OCANDS, OSCORES, body=f"""
SELECT v.candidate_id, v.parent_id, {r6('a.value - b.value')} AS delta
FROM oc v JOIN os a ON a.candidate_id = v.candidate_id AND a.score_key = 'esm1v_delta'
JOIN oc p ON p.candidate_id = v.parent_id AND p.parent_id IS NULL
JOIN os b ON b.candidate_id = p.candidate_id AND b.score_key = 'esm1v_delta'
"""))
def delta_vs_parent(spark, d):
    vals = P.order_scores(spark, d).filter("score_key = 'esm1v_delta'").select("candidate_id", "value")
    return C.delta_vs_parent(vals, P.order_candidates(spark, d))


@query(with_(RUN, body=f"""
SELECT rv.pid, CAST(rv.pid AS VARCHAR) AS parent_id, position, wt, mut, {r6('score')} AS ddg
FROM rv JOIN supplier ON s_suppkey = rv.pid WHERE step_no = 7 AND score < -1.0
"""))
def ddg_variants(spark, d):
    ddg = P.run_variants(spark, d).filter("step_no = 7").select(
        "pid", "position", "wt", "mut", F.col("score").alias("ddg"))
    return C.ddg_variants(P.run_roots(spark, d), ddg)


@query(with_(OSCORES, body=f"""
SELECT a.candidate_id, {r6('a.value')} AS x, {r6('b.value')} AS y
FROM os a JOIN os b USING (candidate_id) WHERE a.score_key = 'e1_fitness' AND b.score_key = 'ddg'
"""))
def score_pairs(spark, d):
    return C.score_pairs(P.order_scores(spark, d), "e1_fitness", "ddg")


@query(with_(OSCORES, body="""
, keys AS (SELECT DISTINCT score_key FROM os),
pr AS (SELECT a.score_key AS key_x, b.score_key AS key_y, corr(a.value, b.value) AS r, count(*) AS n
       FROM os a JOIN os b USING (candidate_id) GROUP BY ALL)
SELECT x.score_key AS key_x, y.score_key AS key_y,
       round(CASE WHEN x.score_key = y.score_key THEN 1.0 WHEN n >= 3 AND NOT isnan(r) THEN r ELSE 0 END::DOUBLE, 6) + 0.0 AS r
FROM keys x CROSS JOIN keys y LEFT JOIN pr ON pr.key_x = x.score_key AND pr.key_y = y.score_key
"""))
def score_correlation(spark, d):
    return C.score_correlation(P.order_scores(spark, d))


@query(with_(OSCORES, body=f"""
, e AS (SELECT value FROM os WHERE score_key = 'e1_fitness'),
l AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM e),
c AS (SELECT least(CAST(floor((value - lo) / w) AS BIGINT), 29) AS bin, count(*) AS n FROM e, l GROUP BY 1)
SELECT b.bin, {r6('lo + b.bin * w')} AS bin_start, coalesce(n, 0) AS n
FROM (SELECT unnest(range(30)) AS bin) b CROSS JOIN l LEFT JOIN c ON c.bin = b.bin
"""))
def score_histogram(spark, d):
    return C.score_histogram(P.order_scores(spark, d), "e1_fitness")


# ------------------------------------------------------------------- library

@query(with_(RUN, RSCORES, body=f"""
SELECT pid, candidate_id, {r6('''CASE own_key WHEN 'ddg' THEN -score WHEN 'surface_sap' THEN -score ELSE score END''')} AS best
FROM rv
"""))
def best_score(spark, d):
    return variants(spark, d).select("pid", "candidate_id", L.best_score(F.col("scores")).alias("best"))


@query(with_(RUN, RSCORES, body=f"""
SELECT pid, candidate_id, {r6('''coalesce(e1_fitness, CASE WHEN step_no IN (6, 7) THEN -score ELSE score END)''')} AS best
FROM rv
"""))
def best_score_preferred(spark, d):
    return variants(spark, d).select(
        "pid", "candidate_id", L.best_score(F.col("scores"), "e1_fitness").alias("best"))


TOPSINGLE = """
lb AS (
  SELECT pid, position, wt, mut, best, seq_no FROM (
    SELECT pid, position, wt, mut, max(best) AS best, min(seq_no) AS seq_no FROM (
      SELECT *, CASE WHEN step_no IN (6, 7) THEN -score ELSE score END AS best,
             step_no * 1000000 + position * 100 + ascii(mut) AS seq_no
      FROM rv WHERE source_step <> 'motif_scan') GROUP BY ALL) WHERE best >= 0),
ts AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY best DESC, seq_no) AS rank FROM lb QUALIFY rank <= 15)"""


@query(with_(RUN, TOPSINGLE, body=f"SELECT pid, position, wt, mut, {r6('best')} AS best, rank FROM ts"))
def top_single_mutations(spark, d):
    return L.top_single_mutations(singles(spark, d), exclude_steps=("motif_scan",)).drop("seq_no")


COMBOS = """
c2 AS (SELECT a.pid, 2 AS n_mutations, a.rank AS i, b.rank AS j, 0 AS k, a.best + b.best AS s,
         a.wt || a.position || a.mut || '+' || b.wt || b.position || b.mut AS components
       FROM ts a JOIN ts b ON b.pid = a.pid AND b.rank > a.rank AND b.position <> a.position),
c3 AS (SELECT a.pid, 3 AS n_mutations, i, j, b.rank AS k, s + b.best AS s,
         components || '+' || b.wt || b.position || b.mut AS components
       FROM c2 a JOIN ts b ON b.pid = a.pid AND b.rank > a.j
       JOIN ts x ON x.pid = a.pid AND x.rank = a.i AND x.position <> b.position
       JOIN ts y ON y.pid = a.pid AND y.rank = a.j AND y.position <> b.position),
combos AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY n_mutations, i, j, k) AS combo_no
           FROM (SELECT * FROM c2 UNION ALL SELECT * FROM c3) QUALIFY combo_no <= 200)"""


def _combos(spark, d):
    return L.combine_variants(L.top_single_mutations(singles(spark, d), exclude_steps=("motif_scan",)))


@query(with_(RUN, TOPSINGLE, COMBOS, body=f"""
SELECT pid, combo_no, CAST(n_mutations AS BIGINT) AS n_mutations, components, {r6('s')} AS combo_sum,
       {r6('s / n_mutations')} AS combo_mean FROM combos
"""))
def combine_variants(spark, d):
    return _combos(spark, d).withColumn("components", F.array_join("components", "+"))


@query(with_(RUN, TOPSINGLE, COMBOS, body=f"""
SELECT c.pid, CAST(c.n_mutations AS BIGINT) AS n_mutations, combo_no, components, {r6('s')} AS combo_sum, n_of_order, rank
FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY s DESC, combo_no) AS rank FROM combos QUALIFY rank <= 5) c
JOIN (SELECT pid, n_mutations, count(*) AS n_of_order FROM combos GROUP BY ALL) o
  ON o.pid = c.pid AND o.n_mutations = c.n_mutations
"""))
def combo_summary(spark, d):
    return R.combo_summary(_combos(spark, d)).select(
        "pid", "n_mutations", "combo_no", F.array_join("components", "+").alias("components"),
        "combo_sum", "n_of_order", "rank")


@query(with_(RUN, body=f"""
SELECT pid || ':' || wt || position || mut AS candidate_id, min(step_no) AS step_no,
       {r6('min_by(score, step_no)')} AS score
FROM rv GROUP BY pid, wt, position, mut
"""))
def gathered_variants(spark, d):
    v = P.run_variants(spark, d).select(
        F.concat_ws(":", F.col("pid").cast("string"), S.mutation_label(F.col("wt"), F.col("position"), F.col("mut")))
        .alias("candidate_id"), "step_no", "score")
    return L.gather_variants(*[v.filter(F.col("step_no") == k) for k in P.RUN_STEPS])


@query(with_(RUN, body=f"""
, g AS (SELECT pid, position, wt, mut, score AS gain FROM rv WHERE step_no = 4),
b AS (SELECT *, row_number() OVER (PARTITION BY pid, position ORDER BY gain DESC, mut) AS rn FROM g WHERE gain > 0)
SELECT pid, position, wt, mut, {r6('gain')} AS gain,
       row_number() OVER (PARTITION BY pid ORDER BY gain DESC, position) AS rank
FROM b WHERE rn = 1 QUALIFY rank <= 5
"""))
def saturation_best(spark, d):
    return L.saturation_best(_gains(spark, d))


@query(with_(RUN, body=f"""
, g AS (SELECT pid, position, wt, mut, score AS gain FROM rv WHERE step_no = 4 AND score > 0),
b AS (SELECT pid, position, row_number() OVER (PARTITION BY pid ORDER BY max(gain) DESC, position) AS rank
      FROM g GROUP BY pid, position QUALIFY rank <= 5)
SELECT g.pid, g.position, wt, mut, {r6('gain')} AS gain, rank FROM g JOIN b ON b.pid = g.pid AND b.position = g.position
"""))
def saturation_all(spark, d):
    return L.saturation_all(_gains(spark, d))


def _gains(spark, d):
    return P.run_variants(spark, d).filter("step_no = 4").select(
        "pid", "position", "wt", "mut", F.col("score").alias("gain"))


# ------------------------------------------------------------------ evidence

EVID = """
ev AS (
  SELECT pid, position, wt, mut, count(*) AS n_sources, max(score) AS max_score,
         string_agg(source_step, ',' ORDER BY step_no) AS sources, first(score ORDER BY step_no) AS first_score,
         CASE WHEN wt = 'C' THEN 'Cysteine removal' WHEN wt = 'M' AND mut = 'L' THEN 'Oxidation fix'
           WHEN wt = 'N' AND mut = 'Q' THEN 'Deamidation fix' WHEN wt = 'D' AND mut = 'E' THEN 'Isomerization fix'
           WHEN wt IN ('K', 'R') AND mut = 'Q' THEN 'Proteolysis fix'
           WHEN bool_or(step_no = 3) THEN 'Consensus reversion' WHEN bool_or(step_no = 4) THEN 'PSSM-guided'
           ELSE 'Other' END AS category,
         CASE WHEN count(*) >= 3 THEN 'Strongly recommended'
              WHEN count(*) = 2 AND max(score) >= 3 THEN 'Recommended' ELSE 'Likely beneficial' END AS recommendation
  FROM rv GROUP BY pid, position, wt, mut)"""


@shared
def _evidence(spark, d):
    return E.consolidate_evidence(P.run_variants(spark, d), STEPS)


def _names():
    return F.array_join(F.transform("sources", lambda s: s["source_step"]), ",").alias("sources")


@query(with_(RUN, EVID, body=f"""
SELECT pid, position, wt, mut, n_sources, {r6('max_score')} AS max_score, sources, category, recommendation FROM ev
"""))
def consolidated_evidence(spark, d):
    return _evidence(spark, d).select(
        "pid", "position", "wt", "mut", "n_sources", "max_score", _names(), "category", "recommendation")


@query(with_(RUN, EVID, body="""
SELECT pid, count(*) AS n_mutations, count(DISTINCT position) AS n_positions, count(*) FILTER (n_sources >= 2) AS n_multi
FROM ev GROUP BY pid
"""))
def evidence_totals(spark, d):
    lines = P.run_lines(spark, d)
    return E.evidence_totals(E.mutation_sources(lines, STEPS), lines)


@query(with_(RUN, EVID, body=f"""
SELECT pid, position, wt, mut, n_sources, {r6('max_score')} AS max_score, sources, category, recommendation,
       row_number() OVER (PARTITION BY pid ORDER BY n_sources DESC, max_score DESC, position, mut) AS rank
FROM ev WHERE n_sources >= 2
"""))
def multi_evidence(spark, d):
    return E.multi_evidence(_evidence(spark, d)).select(
        "pid", "position", "wt", "mut", "n_sources", "max_score", _names(), "category", "recommendation", "rank")


@query(with_(RUN, EVID, body=f"""
SELECT pid, category, position, wt, mut, sources, {r6('first_score')} AS score,
       row_number() OVER (PARTITION BY pid, category ORDER BY max_score DESC, position, mut) AS rank
FROM ev WHERE n_sources = 1 QUALIFY rank <= 15
"""))
def single_evidence(spark, d):
    return E.single_evidence(_evidence(spark, d)).select(
        "pid", "category", "position", "wt", "mut", _names(),
        F.get("sources", F.lit(0))["score"].alias("score"), "rank")


# ------------------------------------------------------------------- reports

@query(with_(RUN, RSCORES, body=f"""
SELECT step_no, score_key, {r6('min(value)')} AS min, {r6('max(value)')} AS max, {r6('avg(value)')} AS mean, count(*) AS n
FROM rs GROUP BY step_no, score_key
"""))
def step_summary(spark, d):
    return R.step_summary(P.run_scores(spark, d))


def _warnings(spark, d):
    """Per protein and step: a warning when the step proposes nothing positive."""
    return P.run_variants(spark, d).groupBy("pid", "source_step").agg(F.max("score").alias("best")).filter(
        "best < 6").select("pid", "source_step", F.concat(
            F.lit("protein "), F.col("pid").cast("string"), F.lit(": no strong proposal")).alias("message"))


WARN = """
wn AS (SELECT pid, source_step, 'protein ' || pid || ': no strong proposal' AS message
       FROM rv GROUP BY pid, source_step HAVING max(score) < 6)"""


@query(with_(RUN, WARN, body="SELECT pid, source_step, message FROM wn"))
def warnings_table(spark, d):
    return _warnings(spark, d)


@query(with_(RUN, WARN, body="""
SELECT source_step, count(*) + (SELECT count(*) FROM supplier) AS n_candidates, count(*) AS n_variants,
       (SELECT count(*) FROM wn WHERE wn.source_step = rv.source_step) AS n_warnings
FROM rv GROUP BY source_step
"""))
def step_table(spark, d):
    return R.step_table(P.run_variants(spark, d), P.run_roots(spark, d), _warnings(spark, d))


@query(with_(RUN, RSCORES, body="""
SELECT 'steps' AS metric, count(DISTINCT source_step) AS value FROM rv
UNION ALL SELECT 'parents', count(*) FROM supplier
UNION ALL SELECT 'variants', count(*) FROM rv
UNION ALL SELECT 'positions', count(DISTINCT (pid, position)) FROM rv
UNION ALL SELECT 'score_types', count(DISTINCT score_key) FROM rs
"""))
def run_totals(spark, d):
    return R.run_totals(variants(spark, d), P.run_roots(spark, d), P.run_scores(spark, d))


@query(with_(RUN, body="""
, l AS (SELECT pid, position, label, count(*) AS c FROM rv GROUP BY ALL)
SELECT pid, position, CAST(sum(c) AS BIGINT) AS total,
       string_agg(label || ' (' || c || 'x)', ', ' ORDER BY c DESC, label) AS labels,
       row_number() OVER (PARTITION BY pid ORDER BY sum(c) DESC, position) AS rank
FROM l GROUP BY pid, position QUALIFY rank <= 30
"""))
def mutated_positions(spark, d):
    return R.position_frequency(variants(spark, d))


@query(with_(RUN, RSCORES, RCOMP, VARS, body="""
, b AS (SELECT pid, candidate_id, row_number() OVER (PARTITION BY pid ORDER BY composite_score DESC, seq_no) AS r
        FROM v QUALIFY r <= 200)
SELECT b.pid, score_key, count(*) AS n, row_number() OVER (PARTITION BY b.pid ORDER BY count(*) DESC, score_key) AS rank
FROM b JOIN rs USING (candidate_id) GROUP BY b.pid, score_key QUALIFY rank <= 6
"""))
def popular_score_keys(spark, d):
    return R.popular_score_keys(variants(spark, d))


@query(with_(RUN, body=f"""
SELECT pid, count(*) AS total, count(e1_fitness) AS scored, {r6('min(e1_fitness)')} AS lowest,
       {r6('max(e1_fitness)')} AS highest, count(*) FILTER (e1_fitness > 0) AS beneficial
FROM rv GROUP BY pid
"""))
def fitness_summary(spark, d):
    return R.fitness_summary(variants(spark, d))


@query(with_(RUN, RSCORES, body=f"""
SELECT pid, step_no, score_key, count(*) AS n, {r6('min(value)')} AS lowest, {r6('max(value)')} AS highest,
       count(*) FILTER (value < 0) AS negative
FROM rs GROUP BY pid, step_no, score_key
"""))
def score_ranges(spark, d):
    return R.score_ranges(P.run_scores(spark, d))


@query(with_(RUN, RSCORES, RCOMP, VARS, body=f"""
, c AS (SELECT pid, position, mut, max_by(composite_score, seq_no) AS s FROM v GROUP BY ALL)
SELECT pid, position, {r6('max(s)')} AS best,
       {', '.join(f"round(max(s) FILTER (mut = '{a}'), 6) + 0.0 AS aa_{a}" for a in 'ACDEFGHIKLMNPQRSTVWY')},
       row_number() OVER (PARTITION BY pid ORDER BY max(s) DESC, position) AS rank
FROM c GROUP BY pid, position QUALIFY rank <= 50
"""))
def mutation_matrix(spark, d):
    return R.mutation_matrix(variants(spark, d))


@query(with_(RUN, body="""
SELECT source_step, CASE WHEN wt = 'C' THEN 'Cysteine removal' WHEN wt = 'M' AND mut = 'L' THEN 'Oxidation fix'
           WHEN wt = 'N' AND mut = 'Q' THEN 'Deamidation fix' WHEN wt = 'D' AND mut = 'E' THEN 'Isomerization fix'
           WHEN wt IN ('K', 'R') AND mut = 'Q' THEN 'Proteolysis fix' WHEN step_no = 3 THEN 'Consensus reversion'
           WHEN step_no = 4 THEN 'PSSM-guided' ELSE 'Other' END AS category,
       count(DISTINCT (pid, position, wt, mut)) AS n
FROM rv GROUP BY 1, 2
"""))
def unique_step_mutations(spark, d):
    category = E.mutation_category(F.col("wt"), F.col("mut"), F.array("source_step"))
    return R.unique_step_mutations(P.run_lines(spark, d), category, STEPS)


@query(with_(RUN, RSCORES, RCOMP, VARS, body="""
, f AS (SELECT pid, position, min(r) AS r FROM (
  SELECT *, row_number() OVER (PARTITION BY pid ORDER BY composite_score DESC, seq_no) AS r FROM v) GROUP BY pid, position)
SELECT pid, position, row_number() OVER (PARTITION BY pid ORDER BY r) AS rank FROM f QUALIFY rank <= 5
"""))
def top_positions(spark, d):
    return R.top_positions(variants(spark, d))


@query(with_(RUN, RSCORES, RCOMP, VARS, body=f"""
, b AS (SELECT pid, source_step, candidate_id, row_number() OVER (PARTITION BY pid, source_step ORDER BY composite_score DESC, seq_no) AS r
        FROM v QUALIFY r <= 50),
pk AS (SELECT b.pid, b.source_step, score_key FROM b JOIN rs USING (candidate_id) GROUP BY b.pid, b.source_step, score_key
       QUALIFY row_number() OVER (PARTITION BY b.pid, b.source_step ORDER BY count(*) DESC, score_key) <= 5),
sh AS (SELECT v.candidate_id, count(*) AS n, sum(value) AS s FROM v JOIN rs ON rs.candidate_id = v.candidate_id
       JOIN pk ON pk.pid = v.pid AND pk.source_step = v.source_step AND pk.score_key = rs.score_key GROUP BY v.candidate_id)
SELECT pid, source_step, v.candidate_id, {r6('composite_score')} AS sort_score,
       row_number() OVER (PARTITION BY pid, source_step ORDER BY composite_score DESC, seq_no) AS rank,
       coalesce(sh.n, 0) AS n_shown, {r6("coalesce(sh.s, 0)")} AS shown_sum
FROM v LEFT JOIN sh ON sh.candidate_id = v.candidate_id QUALIFY rank <= 100
"""))
def step_variant_table(spark, d):
    return R.step_variants(variants(spark, d)).select(
        "pid", "source_step", "candidate_id", "sort_score", "rank", *_shown())


@query(with_(RUN, RSCORES, RCOMP, VARS, body=f"""
, t AS (SELECT *, {TIER} AS tier FROM v),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY pid, tier, position ORDER BY composite_score DESC, seq_no) = 1)
SELECT pid, CAST(tier AS BIGINT) AS tier, position, label, {r6('composite_score')} AS score,
       row_number() OVER (PARTITION BY pid, tier ORDER BY composite_score DESC, seq_no) AS rank
FROM b QUALIFY rank <= 20
"""))
def tier_highlight_table(spark, d):
    return R.tier_highlights(variants(spark, d))


@query(with_(RUN, RSCORES, RCOMP, VARS, body=f"""
, t AS (SELECT *, {TIER} AS tier FROM v),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY pid, tier, position ORDER BY composite_score DESC, seq_no) = 1),
k AS (SELECT *, row_number() OVER (PARTITION BY pid, tier ORDER BY composite_score DESC, seq_no) AS rank FROM b QUALIFY rank <= 5)
SELECT k.pid, CAST(k.tier AS BIGINT) AS tier, rank, CAST(position AS VARCHAR) AS positions, candidate_id,
       {r6('composite_score')} AS score, n_variants
FROM k JOIN (SELECT pid, tier, count(*) AS n_variants FROM t GROUP BY ALL) c ON c.pid = k.pid AND c.tier = k.tier
"""))
def tier_analysis(spark, d):
    v = variants(spark, d)
    return R.tier_top(v).join(R.tier_counts(v), ["pid", "tier"])


@query(with_(RUN, WARN, body="""
SELECT pid, source_step, message, row_number() OVER (PARTITION BY pid, source_step ORDER BY message) AS rank
FROM wn QUALIFY rank <= 2
"""))
def tier_warnings(spark, d):
    return R.top_warnings(_warnings(spark, d))


@query(with_(RUN, RSCORES, RCOMP, VARS, body=f"""
SELECT pid, row_number() OVER (PARTITION BY pid ORDER BY composite_score DESC, seq_no) AS rank, candidate_id,
       label AS labels, CAST(1 AS BIGINT) AS n_mutations, {r6('composite_score')} AS composite_score,
       {r6('e1_fitness')} AS e1_fitness, {r6('esm1v_delta')} AS esm1v_delta, {r6("CASE WHEN own_key = 'ddg' THEN score END")} AS ddg
FROM v QUALIFY rank <= 100
"""))
def candidate_table(spark, d):
    return R.candidate_table(_leading(spark, d), ("e1_fitness", "esm1v_delta", "ddg"))


@query(with_(RUN, RSCORES, RCOMP, VARS, body=f"""
SELECT pid, row_number() OVER (PARTITION BY pid ORDER BY composite_score DESC, seq_no) AS rank, candidate_id,
       source_step, {r6('composite_score')} AS composite_score, {r6('e1_fitness')} AS e1_fitness,
       {r6('esm1v_delta')} AS esm1v_delta, CAST(NULL AS DOUBLE) AS esmif1_delta,
       {r6("CASE WHEN own_key = 'ddg' THEN score END")} AS ddg
FROM v QUALIFY rank <= 20
"""))
def top_recommendations(spark, d):
    return R.top_recommendations(_leading(spark, d))


@query(with_(RUN, RSCORES, RCOMP, VARS, body=f"""
, b AS (SELECT pid, candidate_id, row_number() OVER (PARTITION BY pid ORDER BY composite_score DESC, seq_no) AS r
        FROM v QUALIFY r <= 200),
pk AS (SELECT b.pid, score_key FROM b JOIN rs USING (candidate_id) GROUP BY b.pid, score_key
       QUALIFY row_number() OVER (PARTITION BY b.pid ORDER BY count(*) DESC, score_key) <= 6),
sh AS (SELECT rs.candidate_id, count(*) AS n, sum(value) AS s FROM rs JOIN pk ON pk.pid = rs.pid AND pk.score_key = rs.score_key
       GROUP BY rs.candidate_id)
SELECT pid, row_number() OVER (PARTITION BY pid ORDER BY composite_score DESC, seq_no) AS rank, v.candidate_id,
       label AS labels, source_step, {r6('composite_score')} AS composite_score, {r6('e1_fitness')} AS e1_fitness,
       coalesce(sh.n, 0) AS n_shown, {r6("coalesce(sh.s, 0)")} AS shown_sum
FROM v LEFT JOIN sh ON sh.candidate_id = v.candidate_id
"""))
def variant_library(spark, d):
    ranked = _ranked(spark, d)
    first = _first_ranked(spark, d) if sharing() else _first(ranked)
    return R.library_rows(_with_arrays(ranked, "rank"), first).select(
        "pid", "rank", "candidate_id", F.array_join(S.labels(F.col("mutations")), ", ").alias("labels"),
        "source_step", "composite_score", F.try_element_at("scores", F.lit("e1_fitness")).alias("e1_fitness"), *_shown())


def _shown():
    """Number and sum of the shown values."""
    values = F.filter(F.transform("shown", lambda s: s["value"]), lambda x: x.isNotNull())
    return (F.size(values).alias("n_shown"), F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("shown_sum"))


@query(with_(RUN, RSCORES, RCOMP, VARS, body=f"""
, p AS (SELECT pid, candidate_id, composite_score FROM v
        QUALIFY row_number() OVER (PARTITION BY pid ORDER BY composite_score DESC, seq_no) = 1)
SELECT v.pid, count(*) AS total_candidates, {r6('min(e1_fitness)')} AS e1_min, {r6('max(e1_fitness)')} AS e1_max,
       count(*) FILTER (e1_fitness > 0) AS beneficial, count(DISTINCT source_step) AS n_stages,
       any_value(p.candidate_id) AS top_pick, {r6('any_value(p.composite_score)')} AS top_score
FROM v JOIN p ON p.pid = v.pid GROUP BY v.pid
"""))
def executive_summary(spark, d):
    return R.executive_summary(variants(spark, d))
