"""Registered queries over the vectors seen as atoms."""

from __future__ import annotations

from pyspark.sql import functions as F

from proteoframe.functions import text as S
from proteoframe.operators import structure as G
from proteoframe.plans import projections as P
from proteoframe.plans.catalog import Catalog
from proteoframe.plans.sqlbase import (
    ATOMS, BURIAL, DISULFIDE, OCANDS, PATCH, RMSD, SASA, SURFACE, exact, r6, with_)

CATALOG = Catalog()
query = CATALOG.query


@query(with_(ATOMS, body=f"""
SELECT structure_id, position, aa, {', '.join(r6('pts.' + c) + ' AS "' + c + '"' for c in ('bx', 'by', 'bz', 'ax', 'ay', 'az'))} FROM pts
"""))
def residue_points(spark, d):
    p = G.residue_points(P.atoms(spark, d))
    return p.select("structure_id", "position", "aa",
                    *[F.col(s)[c].alias(s[1] + c) for s in ("cb", "ca") for c in "xyz"]).toDF(
        "structure_id", "position", "aa", "bx", "by", "bz", "ax", "ay", "az")


@query(with_(ATOMS, body="""
SELECT structure_id, count(DISTINCT position) AS n_residues FROM atoms WHERE NOT het GROUP BY structure_id
"""))
def chain_length(spark, d):
    return G.chain_length(P.atoms(spark, d))


@query(with_(ATOMS, body=f"""
SELECT structure_id, {r6('avg(bfactor)')} AS plddt_all, {r6("avg(bfactor) FILTER (atom = 'CA')")} AS plddt_ca,
       {r6(exact("avg(bfactor) FILTER (atom = 'CA')", 1))} AS plddt_mean,
       {r6(exact("min(bfactor) FILTER (atom = 'CA')", 1))} AS plddt_min
FROM atoms GROUP BY structure_id
"""))
def plddt_summary(spark, d):
    return G.plddt(P.atoms(spark, d))


def _pairs(spark, d):
    return G.disulfide_pairs(G.residue_points(P.atoms(spark, d), P.protected_residues(spark, d)))


@query(with_(ATOMS, DISULFIDE, body=f"""
SELECT structure_id, i, j, wt_i, wt_j, {r6('distance')} AS distance, {r6('energy')} AS energy, rank FROM ss
"""))
def disulfide_pairs(spark, d):
    return _pairs(spark, d)


@query(with_(ATOMS, DISULFIDE, body=f"""
SELECT structure_id, i, j, concat_ws('+', CASE WHEN wt_i <> 'C' THEN wt_i || i || 'C' END,
       CASE WHEN wt_j <> 'C' THEN wt_j || j || 'C' END) AS labels, {r6('distance')} AS distance,
       {r6('energy')} AS energy, rank
FROM ss WHERE wt_i <> 'C' OR wt_j <> 'C'
"""))
def disulfide_variants(spark, d):
    return G.disulfide_variants(_pairs(spark, d)).select(
        "structure_id", "i", "j", F.array_join(S.labels(F.col("mutations")), "+").alias("labels"),
        "distance", "energy", "rank")


@query(with_(ATOMS, BURIAL, body="SELECT structure_id, position, aa, contacts FROM bur"))
def burial_contacts(spark, d):
    return G.burial(P.atoms(spark, d), protected=P.protected_residues(spark, d))


@query(with_(ATOMS, BURIAL, body=f"""
, sub(aa, choice, mut) AS (VALUES ('G',0,'A'), ('A',0,'V'), ('A',1,'L'), ('V',0,'I'), ('V',1,'L'), ('S',0,'T'),
  ('S',1,'V'), ('T',0,'V'), ('T',1,'I'))
SELECT structure_id, position, b.aa AS wt, mut, {r6('contacts / 30.0')} AS score,
       row_number() OVER (PARTITION BY structure_id ORDER BY contacts DESC, position, choice) AS rank
FROM bur b JOIN sub s ON s.aa = b.aa WHERE contacts > 15 QUALIFY rank <= 10
"""))
def cavity_variants(spark, d):
    return G.cavity_variants(G.burial(P.atoms(spark, d), protected=P.protected_residues(spark, d)))


@query(with_(ATOMS, SASA, body=f"SELECT structure_id, position, atom, {r6('sasa')} AS sasa FROM asa"))
def atom_sasa(spark, d):
    return G.atom_sasa(P.atoms(spark, d)).select("structure_id", "position", "atom", "sasa")


def _surface(spark, d):
    return G.surface_hydrophobics(
        G.residue_sasa(G.atom_sasa(P.atoms(spark, d))), protected=P.protected_residues(spark, d))


@query(with_(ATOMS, SASA, SURFACE, body=f"""
SELECT structure_id, position, aa, {r6('exposure')} AS exposure, {r6('score')} AS score FROM surf
"""))
def surface_hydrophobics(spark, d):
    return _surface(spark, d)


def patch_members(spark, d):
    return G.patches(_surface(spark, d), G.residue_points(P.atoms(spark, d)))


@query(with_(ATOMS, SASA, SURFACE, PATCH, body=f"""
SELECT structure_id, position, aa, {r6('exposure')} AS exposure, {r6('score')} AS score, patch, patch_size FROM mem
""").replace("WITH", "WITH RECURSIVE", 1))
def surface_patches(spark, d):
    return patch_members(spark, d)


@query(with_(ATOMS, SASA, SURFACE, PATCH, body=f"""
, sub(aa, choice, mut) AS (VALUES ('I',0,'T'), ('I',1,'K'), ('L',0,'K'), ('L',1,'Q'), ('M',0,'K'), ('M',1,'Q'),
  ('F',0,'Y'), ('F',1,'R'), ('V',0,'T'), ('V',1,'D'), ('W',0,'R'), ('W',1,'Y'))
SELECT structure_id, position, m.aa AS wt, mut, {r6('score')} AS score, patch_size,
       row_number() OVER (PARTITION BY structure_id
         ORDER BY patch_size DESC, round(score, 9) DESC, position, choice) AS rank
FROM mem m JOIN sub s ON s.aa = m.aa QUALIFY rank <= 10
""").replace("WITH", "WITH RECURSIVE", 1))
def surface_variants(spark, d):
    return G.surface_variants(patch_members(spark, d))


def _rmsd(spark, d):
    return G.ca_rmsd(G.residue_points(P.atoms(spark, d)), P.structure_pairs(spark, d))


@query(with_(ATOMS, RMSD, body=f"SELECT sa AS structure_a, sb AS structure_b, n_atoms, {r6('rmsd')} AS rmsd FROM rm"))
def superposition_rmsd(spark, d):
    return _rmsd(spark, d)


@query(with_(ATOMS, RMSD, body=f"""
, pl AS (SELECT structure_id, avg(bfactor) FILTER (atom = 'CA') AS plddt FROM atoms GROUP BY structure_id)
SELECT p.structure_id, NOT (coalesce(plddt < 70, false) OR coalesce(rmsd > 6, false)) AS validation_passed,
       {r6('coalesce(plddt, 0)')} AS val_plddt, {r6('coalesce(rmsd, 99)')} AS val_rmsd
FROM pl p LEFT JOIN rm ON rm.sb = p.structure_id
"""))
def validated_designs(spark, d):
    conf = G.plddt(P.atoms(spark, d)).select("structure_id", F.col("plddt_ca").alias("plddt"))
    rmsd = _rmsd(spark, d).select(F.col("structure_b").alias("structure_id"), "rmsd")
    return G.validate_designs(conf.join(rmsd, "structure_id", "left"), max_rmsd=6.0).select(
        "structure_id", "validation_passed", "val_plddt", "val_rmsd")


@query(with_(OCANDS, body="""
, c AS (SELECT oc.*, o_orderstatus = 'P' AND o_custkey % 2 = 0 AS flag,
               CASE WHEN o_orderstatus <> 'O' THEN 'model_' || candidate_id END AS path
        FROM oc JOIN orders ON o_orderkey = candidate_id),
a AS (SELECT *, bool_or(flag) OVER (PARTITION BY pid) AS anyflag FROM c)
SELECT pid, candidate_id FROM a WHERE CASE WHEN anyflag THEN flag ELSE parent_id IS NOT NULL AND path IS NOT NULL END
"""))
def design_targets(spark, d):
    status = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("candidate_id"), "o_orderstatus")
    cands = P.order_candidates(spark, d).join(status, "candidate_id").select(
        "pid", "candidate_id", "parent_id",
        ((F.col("o_orderstatus") == "P") & (F.col("pid") % 2 == 0)).alias("needs_sequence_design"),
        F.when(F.col("o_orderstatus") != "O", F.concat(F.lit("model_"), F.col("candidate_id").cast("string")))
        .alias("structure_path"))
    return G.design_targets(cands).select("pid", "candidate_id")
