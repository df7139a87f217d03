"""Structure geometry: distance joins, burial, exposure, patches, superposition."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proteoframe.functions import constants as K
from proteoframe.functions import text as S
from proteoframe.functions.numeric import round_exact
from proteoframe.operators.ranking import top_per_key
from proteoframe.session import use_checkpoint_dir

XYZ = ("x", "y", "z")


def grid_pairs(a: DataFrame, b: DataFrame, radius: float) -> DataFrame:
    """Pairs of ``a`` and ``b`` rows of one structure at most ``radius`` apart.

    Space is cut into cubes of the radius; a row of ``a`` is repeated for its 27
    neighbouring cubes, which makes the distance join an equi-join on
    (structure, cube). The cube is part of the key, so a structure that holds
    most of the rows spreads over many tasks; no width is forced on the exchange,
    so adaptive execution may split a crowded cube. Columns get suffixes _a and _b.
    """
    def cube(axis: str) -> Column:
        return F.floor(F.col(axis) / radius)

    shifts = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    left = a.select(*[F.col(c).alias(c if c == "structure_id" else f"{c}_a") for c in a.columns],
                    *[cube(c).alias(f"_{c}") for c in XYZ])
    for c in XYZ:
        left = left.withColumn("_s", F.explode(shifts)).withColumn(f"_{c}", F.col(f"_{c}") + F.col("_s")).drop("_s")
    right = b.select(*[F.col(c).alias(c if c == "structure_id" else f"{c}_b") for c in b.columns],
                     *[cube(c).alias(f"_{c}") for c in XYZ])
    joined = left.join(right, ["structure_id", "_x", "_y", "_z"]).drop("_x", "_y", "_z")
    d2 = sum(((F.col(f"{c}_a") - F.col(f"{c}_b")) ** 2 for c in XYZ[1:]),
             (F.col("x_a") - F.col("x_b")) ** 2)
    return joined.withColumn("d2", d2).filter(F.col("d2") <= radius * radius)


def self_pairs(rows: DataFrame, radius: float, order: tuple[str, ...]) -> DataFrame:
    """Unordered pairs of rows of one structure at most ``radius`` apart, each once.

    As :func:`grid_pairs`, but by symmetry a row is repeated for half the shell only: its own
    cube, where the side that is smaller by ``order`` comes first (equal ones do not
    meet), and the 13 cubes that follow it.
    """
    def cube(axis: str) -> Column:
        return F.floor(F.col(axis) / radius)

    steps = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) >= (0, 0, 0)]
    shell = F.array(*[F.struct(*[(cube(c) + s).alias(c) for c, s in zip(XYZ, step)], F.lit(step == (0, 0, 0)).alias("own"))
                      for step in steps])
    left = rows.select(*[F.col(c).alias(c if c == "structure_id" else f"{c}_a") for c in rows.columns], F.explode(shell).alias("_c"))
    left = left.select("*", *[F.col(f"_c.{c}").alias(f"_{c}") for c in XYZ], F.col("_c.own").alias("_own")).drop("_c")
    right = rows.select(*[F.col(c).alias(c if c == "structure_id" else f"{c}_b") for c in rows.columns],
                        *[cube(c).alias(f"_{c}") for c in XYZ])
    first = F.struct(*[F.col(f"{c}_a") for c in order]) < F.struct(*[F.col(f"{c}_b") for c in order])
    d2 = sum(((F.col(f"{c}_a") - F.col(f"{c}_b")) ** 2 for c in XYZ[1:]), (F.col("x_a") - F.col("x_b")) ** 2)
    joined = left.join(right, ["structure_id", "_x", "_y", "_z"]).filter(~F.col("_own") | first)
    return joined.drop("_x", "_y", "_z", "_own").withColumn("d2", d2).filter(F.col("d2") <= radius * radius)


def _first_atom(name: str) -> Column:
    at = F.col("atom") == name
    return F.max(F.when(at, F.struct(*XYZ)))


def residue_points(atoms: DataFrame, protected: DataFrame | None = None) -> DataFrame:
    """One row per standard residue: CB point (CA without one) and CA point."""
    rows = atoms.filter(~F.col("het") & F.col("atom").isin("CA", "CB"))
    if protected is not None:
        rows = rows.join(protected.select("structure_id", "position"), ["structure_id", "position"], "left_anti")
    per = rows.groupBy("structure_id", "position", "aa").agg(
        _first_atom("CB").alias("cb"), _first_atom("CA").alias("ca"))
    return per.select("structure_id", "position", "aa", F.coalesce("cb", "ca").alias("cb"), "ca")


def chain_length(atoms: DataFrame) -> DataFrame:
    per = atoms.filter(~F.col("het")).groupBy("structure_id", "position").agg(F.lit(1).alias("one"))
    return per.groupBy("structure_id").agg(F.count("*").alias("n_residues"))


def plddt(atoms: DataFrame) -> DataFrame:
    """Confidence from B-factors: all atoms, CA mean, CA mean and minimum at one decimal."""
    ca = F.when(F.col("atom") == "CA", F.col("bfactor"))
    return atoms.groupBy("structure_id").agg(
        F.avg("bfactor").alias("plddt_all"), F.avg(ca).alias("plddt_ca"), F.min(ca).alias("low")
    ).select("structure_id", "plddt_all", "plddt_ca",
             round_exact("plddt_ca", 1).alias("plddt_mean"), round_exact("low", 1).alias("plddt_min"))


# ------------------------------------------------------------------ disulfides

def disulfide_pairs(points: DataFrame, low: float = 3.5, high: float = 4.5,
                    separation: int = 4, top: int = 10) -> DataFrame:
    """Residue pairs in the CB distance band, closest to 3.8 first."""
    p = points.filter("cb is not null").select("structure_id", "position", "aa", "cb.x", "cb.y", "cb.z")
    dist = F.sqrt("d2")
    pairs = grid_pairs(p, p, high).filter(
        (F.col("position_b") - F.col("position_a") >= separation) & (F.col("d2") >= low * low)
    ).select("structure_id", F.col("position_a").alias("i"), F.col("position_b").alias("j"),
             F.col("aa_a").alias("wt_i"), F.col("aa_b").alias("wt_j"), dist.alias("distance"),
             (-2.0 + 5.0 * F.abs(dist - 3.8)).alias("energy"))
    return top_per_key(pairs, ["structure_id"], [F.abs(F.col("distance") - 3.8), "i", "j"], top)


def disulfide_variants(pairs: DataFrame) -> DataFrame:
    """Partners that are not yet C become C; a pair of two C is no variant."""
    def to_c(pos: str, wt: str) -> Column:
        return F.when(F.col(wt) != "C", F.struct(
            F.col(pos).alias("position"), F.col(wt).alias("wt"), F.lit("C").alias("mut")))

    muts = F.array_compact(F.array(to_c("i", "wt_i"), to_c("j", "wt_j")))
    return pairs.select("structure_id", "i", "j", muts.alias("mutations"), "distance", "energy", "rank").filter(
        F.size("mutations") > 0)


# ------------------------------------------------------------- burial, cavities

def burial(atoms: DataFrame, radius: float = 10.0, protected: DataFrame | None = None) -> DataFrame:
    """Other residues with a heavy atom near the CA of each small residue."""
    heavy = atoms.filter("element <> 'H'").select("structure_id", "position", *XYZ)
    centres = atoms.filter(
        ~F.col("het") & (F.col("atom") == "CA") & F.col("aa").isin(*K.CAVITY_SUBSTITUTIONS)
    ).select("structure_id", "position", "aa", *XYZ)
    if protected is not None:
        centres = centres.join(protected.select("structure_id", "position"), ["structure_id", "position"], "left_anti")
    near = grid_pairs(centres, heavy, radius).groupBy(
        "structure_id", "position_a", "aa_a", "position_b").agg(F.lit(1).alias("one"))
    return near.groupBy("structure_id", F.col("position_a").alias("position"), F.col("aa_a").alias("aa")).agg(
        (F.count("*") - 1).alias("contacts"))


def _substitutions(df: DataFrame, table: dict[str, str]) -> DataFrame:
    options = S.lookup(F.col("aa"), table)
    return df.withColumn("_options", options).filter("_options is not null").select(
        *df.columns, F.posexplode(F.split("_options", "")).alias("choice", "mut"))


def cavity_variants(contacts: DataFrame, min_contacts: int = 15, top: int = 10) -> DataFrame:
    buried = contacts.filter(F.col("contacts") > min_contacts).withColumn("score", F.col("contacts") / 30.0)
    rows = _substitutions(buried, K.CAVITY_SUBSTITUTIONS)
    return top_per_key(rows, ["structure_id"], [F.desc("score"), "position", "choice"], top).select(
        "structure_id", "rank", "position", F.col("aa").alias("wt"), "mut", "score")


# ------------------------------------------------------------ exposure, patches

def sphere_points(n: int) -> list[tuple[float, float, float]]:
    """Evenly spread unit vectors on a golden spiral."""
    out = []
    for i in range(n):
        z = 1 - (2 * i + 1) / n
        r, a = math.sqrt(1 - z * z), i * math.pi * (3 - math.sqrt(5))
        out.append((r * math.cos(a), r * math.sin(a), z))
    return out


def _hidden_points(n_points: int):
    """Column function: the test points behind a plane across (dx, dy, dz), as the bits of ``m1`` and ``m2``."""
    points = np.array(sphere_points(n_points))
    bits = np.array([1 << (i % 60) for i in range(n_points)], dtype=np.int64)

    @F.pandas_udf("m1 bigint, m2 bigint")
    def hidden(dx: pd.Series, dy: pd.Series, dz: pd.Series, plane: pd.Series) -> pd.DataFrame:
        side = sum(np.multiply.outer(d.to_numpy(), points[:, i]) for i, d in enumerate((dx, dy, dz)))
        marks = np.where(side > plane.to_numpy()[:, None], bits, 0)
        return pd.DataFrame({"m1": marks[:, :60].sum(axis=1), "m2": marks[:, 60:].sum(axis=1)})

    return hidden


def atom_sasa(atoms: DataFrame, n_points: int = 100, probe: float = 1.4) -> DataFrame:
    """Accessible surface of each heavy atom by test points on its sphere.

    A neighbour hides the points on its side of a plane. Its hidden points are
    the bits of two integers, and the hidden points of an atom are the bitwise
    OR over its neighbours: a partial aggregate instead of a points x atoms
    join. ``n_points`` is at most 120 (two words of sixty bits).
    """
    if not 1 <= n_points <= 120:
        raise ValueError("n_points must lie between 1 and 120")
    radius = S.lookup(F.col("element"), K.ATOM_RADII, K.DEFAULT_RADIUS) + F.lit(probe)
    own = atoms.filter("element <> 'H'").select(
        "structure_id", "position", "aa", "het", "atom", radius.alias("r"), *XYZ)
    reach = 2 * (max(K.ATOM_RADII.values()) + probe)
    slim = own.select("structure_id", "position", "atom", "r", *XYZ)
    near = self_pairs(slim, reach, ("position", "atom")).filter(
        ((F.col("position_a") != F.col("position_b")) | (F.col("atom_a") != F.col("atom_b")))
        & (F.col("d2") < (F.col("r_a") + F.col("r_b")) ** 2))

    def seen_from(a: str, b: str) -> Column:
        plane = (F.col(f"r_{a}") ** 2 + F.col("d2") - F.col(f"r_{b}") ** 2) / (2 * F.col(f"r_{a}"))
        return F.struct(F.col(f"position_{a}").alias("position"), F.col(f"atom_{a}").alias("atom"),
                        *[(F.col(f"{c}_{b}") - F.col(f"{c}_{a}")).alias(f"d{c}") for c in XYZ], plane.alias("plane"))

    sides = near.select("structure_id", F.explode(F.array(seen_from("a", "b"), seen_from("b", "a"))).alias("n"))
    masks = sides.select("structure_id", "n.position", "n.atom",
                         _hidden_points(n_points)("n.dx", "n.dy", "n.dz", "n.plane").alias("m")).select(
        "structure_id", "position", "atom", "m.m1", "m.m2")
    covered = masks.groupBy("structure_id", "position", "atom").agg(
        F.bit_or("m1").alias("m1"), F.bit_or("m2").alias("m2"))
    free = n_points - F.coalesce(F.bit_count("m1"), F.lit(0)) - F.coalesce(F.bit_count("m2"), F.lit(0))
    return own.join(covered, ["structure_id", "position", "atom"], "left").select(
        "structure_id", "position", "aa", "het", "atom",
        (free * (4 * math.pi / n_points) * F.col("r") ** 2).alias("sasa"))


def residue_sasa(atom_areas: DataFrame) -> DataFrame:
    return atom_areas.groupBy("structure_id", "position", "aa", "het").agg(F.sum("sasa").alias("sasa"))


def surface_hydrophobics(residue_areas: DataFrame, min_exposure: float = 0.25,
                         protected: DataFrame | None = None) -> DataFrame:
    """Exposed hydrophobic residues with exposure x hydropathy."""
    rows = residue_areas.filter(~F.col("het") & F.col("aa").isin(*K.HYDROPHOBIC))
    if protected is not None:
        rows = rows.join(protected.select("structure_id", "position"), ["structure_id", "position"], "left_anti")
    rel = F.col("sasa") / S.lookup(F.col("aa"), K.MAX_SURFACE)
    return rows.withColumn("exposure", rel).filter(F.round("exposure", 9) >= min_exposure).select(
        "structure_id", "position", "aa", "exposure",
        (F.col("exposure") * S.lookup(F.col("aa"), K.HYDROPATHY)).alias("score"))


def patch_edges(surface: DataFrame, points: DataFrame, distance: float = 8.0, gap: int = 5) -> DataFrame:
    """Neighbouring surface residues: CA distance, or chain distance without a CA."""
    placed = surface.select("structure_id", "position").join(
        points.select("structure_id", "position", "ca"), ["structure_id", "position"], "left")
    with_ca = placed.filter("ca is not null").select("structure_id", "position", "ca.x", "ca.y", "ca.z")
    spatial = grid_pairs(with_ca, with_ca, distance).filter("position_a < position_b").select(
        "structure_id", F.col("position_a").alias("u"), F.col("position_b").alias("v"))
    size = gap + 1
    every = placed.select("structure_id", F.col("position").alias("u"), F.col("ca").isNull().alias("bare_u"),
                          F.explode(F.array(*[F.floor(F.col("position") / size) + s for s in (-1, 0, 1)])).alias("_b"))
    other = placed.select("structure_id", F.col("position").alias("v"), F.col("ca").isNull().alias("bare_v"),
                          F.floor(F.col("position") / size).alias("_b"))
    chain = every.join(other, ["structure_id", "_b"]).filter(
        (F.col("u") < F.col("v")) & (F.col("v") - F.col("u") <= gap) & (F.col("bare_u") | F.col("bare_v"))
    ).select("structure_id", "u", "v")
    return spatial.unionByName(chain)


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components: each vertex gets the smallest position it reaches.

    A round takes the smallest label around each vertex and then the label of
    that label, so chains shrink by more than half; every round is checkpointed
    and the loop ends when no label moved.
    """
    use_checkpoint_dir(vertices.sparkSession)
    both = edges.select("structure_id", "u", "v").unionByName(
        edges.select("structure_id", F.col("v").alias("u"), F.col("u").alias("v"))).distinct().checkpoint()
    labels = vertices.select("structure_id", "position", F.col("position").alias("label")).checkpoint()
    while True:
        around = (
            both.join(labels.select("structure_id", F.col("position").alias("v"), F.col("label").alias("l")),
                      ["structure_id", "v"])
            .groupBy("structure_id", F.col("u").alias("position")).agg(F.min("l").alias("near")))
        step = labels.join(around, ["structure_id", "position"], "left").select(
            "structure_id", "position", "label", F.least("label", F.coalesce("near", "label")).alias("to"))
        jump = step.select("structure_id", F.col("position").alias("to"), F.col("to").alias("root"))
        moved = step.join(jump, ["structure_id", "to"]).select(
            "structure_id", "position", F.col("label").alias("old"), F.col("root").alias("label")).checkpoint()
        labels = moved.select("structure_id", "position", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def patches(surface: DataFrame, points: DataFrame, distance: float = 8.0, min_size: int = 3) -> DataFrame:
    """Clusters of at least ``min_size`` exposed hydrophobic residues."""
    use_checkpoint_dir(surface.sparkSession)
    surface = surface.checkpoint()  # used by vertices, edges and members
    labels = components(surface, patch_edges(surface, points, distance))
    sizes = labels.groupBy("structure_id", "label").agg(F.count("*").alias("patch_size"))
    return (
        surface.join(labels, ["structure_id", "position"])
        .join(sizes.filter(F.col("patch_size") >= min_size), ["structure_id", "label"])
        .withColumnRenamed("label", "patch"))


def surface_variants(members: DataFrame, top: int = 10) -> DataFrame:
    rows = _substitutions(members, K.SURFACE_SUBSTITUTIONS)
    order = [F.desc("patch_size"), F.desc(F.round("score", 9)), "position", "choice"]
    return top_per_key(rows, ["structure_id"], order, top).select(
        "structure_id", "rank", "position", F.col("aa").alias("wt"), "mut", "score", "patch_size")


# --------------------------------------------------------------- superposition

def _with_singular_sum(df: DataFrame) -> DataFrame:
    """Add ``ssum``: the singular values of the 3x3 matrix in columns hxx..hzz,
    summed with the smallest one signed by the determinant.

    Eigenvalues of H'H in closed form. Each stage names its results, so that
    no expression is repeated inside another.
    """
    def h(i: str, j: str) -> Column:
        return F.col(f"h{i}{j}")

    def gram(i: str, j: str) -> Column:
        return h("x", i) * h("x", j) + h("y", i) * h("y", j) + h("z", i) * h("z", j)

    def det3(rows: list[list[Column]]) -> Column:
        (a, b, c), (d, e, f), (g, k, m) = rows
        return a * (e * m - f * k) - b * (d * m - f * g) + c * (d * k - e * g)

    upper = [(i, j) for n, i in enumerate(XYZ) for j in XYZ[n:]]
    det = det3([[h(i, j) for j in XYZ] for i in XYZ])
    df = df.select("*", det.alias("_det"), *[gram(i, j).alias(f"_g{i}{j}") for i, j in upper])
    df = df.withColumn("_q", (F.col("_gxx") + F.col("_gyy") + F.col("_gzz")) / 3)
    df = df.select("*", *[(F.col(f"_g{c}{c}") - F.col("_q")).alias(f"_d{c}") for c in XYZ])
    spread2 = F.col("_dx") ** 2 + F.col("_dy") ** 2 + F.col("_dz") ** 2
    off2 = F.col("_gxy") ** 2 + F.col("_gxz") ** 2 + F.col("_gyz") ** 2
    shifted = det3([[F.col("_dx"), F.col("_gxy"), F.col("_gxz")],
                    [F.col("_gxy"), F.col("_dy"), F.col("_gyz")],
                    [F.col("_gxz"), F.col("_gyz"), F.col("_dz")]])
    df = df.select("*", F.sqrt((spread2 + 2 * off2) / 6).alias("_p"), shifted.alias("_b"))
    cosine = F.when(F.col("_p") > 0, F.greatest(F.lit(-1.0), F.least(
        F.lit(1.0), F.col("_b") / (2 * F.col("_p") ** 3)))).otherwise(1.0)
    df = df.withColumn("_phi", F.acos(cosine) / 3)
    df = df.select(
        "*", (F.col("_q") + 2 * F.col("_p") * F.cos("_phi")).alias("_e1"),
        (F.col("_q") + 2 * F.col("_p") * F.cos(F.col("_phi") + 2 * math.pi / 3)).alias("_e3"))
    roots = [F.sqrt(F.greatest(x, F.lit(0.0))) for x in
             (F.col("_e1"), 3 * F.col("_q") - F.col("_e1") - F.col("_e3"), F.col("_e3"))]
    return df.withColumn("ssum", roots[0] + roots[1] + F.signum("_det") * roots[2])


def ca_rmsd(points: DataFrame, pairs: DataFrame, min_atoms: int = 10) -> DataFrame:
    """CA RMSD of ``pairs(structure_a, structure_b)`` after optimal superposition.

    CA atoms pair by their ordinal. Everything needed is a handful of sums, so a
    pair is one partial aggregate; the 3x3 problem is solved in closed form.
    """
    by = Window.partitionBy("structure_id").orderBy("position")
    ca = points.filter("ca is not null").select(
        "structure_id", "ca", F.row_number().over(by).alias("k"))

    def side(s: str) -> DataFrame:
        return pairs.join(ca.withColumnRenamed("structure_id", f"structure_{s}"), f"structure_{s}").select(
            "structure_a", "structure_b", "k", *[F.col("ca")[c].alias(f"{c}{s}") for c in XYZ])

    both = side("a").join(side("b"), ["structure_a", "structure_b", "k"])
    sums = [F.count("*").cast("double").alias("n")]
    for s in "ab":
        sums += [F.sum(f"{c}{s}").alias(f"s{c}{s}") for c in XYZ]
        sums.append(F.sum(sum((F.col(f"{c}{s}") ** 2 for c in XYZ[1:]), F.col(f"x{s}") ** 2)).alias(f"q{s}"))
    sums += [F.sum(F.col(f"{i}a") * F.col(f"{j}b")).alias(f"{i}{j}") for i in XYZ for j in XYZ]
    agg = both.groupBy("structure_a", "structure_b").agg(*sums)
    n = F.col("n")
    centred = agg.select(
        "structure_a", "structure_b", "n",
        *[(F.col(f"q{s}") - sum((F.col(f"s{c}{s}") ** 2 for c in XYZ[1:]), F.col(f"sx{s}") ** 2) / n).alias(f"e{s}")
          for s in "ab"],
        *[(F.col(f"{i}{j}") - F.col(f"s{i}a") * F.col(f"s{j}b") / n).alias(f"h{i}{j}") for i in XYZ for j in XYZ])
    rest = F.col("ea") + F.col("eb") - 2 * F.col("ssum")
    return _with_singular_sum(centred).select(
        "structure_a", "structure_b", n.cast("bigint").alias("n_atoms"),
        F.when(n >= min_atoms, F.sqrt(F.greatest(rest / n, F.lit(0.0)))).alias("rmsd"))


def validate_designs(metrics: DataFrame, min_plddt: float = 70.0, max_rmsd: float = 2.0) -> DataFrame:
    """Verdict per design; a missing metric passes and scores 0.0 or 99.0."""
    fails = F.coalesce(F.col("plddt") < min_plddt, F.lit(False)) | F.coalesce(F.col("rmsd") > max_rmsd, F.lit(False))
    return metrics.withColumn("validation_passed", ~fails).withColumn(
        "val_plddt", F.coalesce("plddt", F.lit(0.0))).withColumn("val_rmsd", F.coalesce("rmsd", F.lit(99.0)))


def design_targets(cands: DataFrame) -> DataFrame:
    """Flagged candidates of a protein; without any, its variants with a structure."""
    flagged = cands.groupBy("pid").agg(F.max("needs_sequence_design").alias("_any"))
    return cands.join(flagged, "pid").filter(
        F.when(F.col("_any"), F.col("needs_sequence_design"))
        .otherwise(F.col("parent_id").isNotNull() & F.col("structure_path").isNotNull())).drop("_any")
