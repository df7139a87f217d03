"""Report tables: the data behind run summaries, without any rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proteoframe.functions import constants as K
from proteoframe.functions import text as S
from proteoframe.operators.evidence import mutation_sources
from proteoframe.operators.ranking import full_rank, top_per_key

# Variants carry: pid, candidate_id, name, source_step, step_no, seq_no,
# mutations (array of position/wt/mut/source_step), scores (map), composite_score.


def sort_score(composite: Column, scores: Column) -> Column:
    """Composite score, else the largest score, else zero."""
    return F.coalesce(composite, F.array_max(F.map_values(scores)), F.lit(0.0))


def positions_key(muts: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(muts, lambda m: m["position"])), ",")


def step_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("step_no", "score_key").agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").alias("mean"), F.count("*").alias("n"))


def step_table(variants: DataFrame, roots: DataFrame, warnings: DataFrame) -> DataFrame:
    """Candidates, variants and warnings per step; every step also holds the roots."""
    n_roots = roots.agg(F.count("*").alias("n")).scalar()
    per = variants.groupBy("source_step").agg(F.count("*").alias("n_variants"))
    warned = warnings.groupBy("source_step").agg(F.count("*").alias("n_warnings"))
    return per.join(warned, "source_step", "left").select(
        "source_step", (F.col("n_variants") + n_roots).alias("n_candidates"), "n_variants",
        F.coalesce("n_warnings", F.lit(0)).alias("n_warnings"))


def run_totals(variants: DataFrame, roots: DataFrame, scores: DataFrame) -> DataFrame:
    """Steps, roots, variants, mutated positions and score types as metric rows.

    Each distinct count is a grouping of its own keys, so it is combined on the
    map side instead of expanding every row once per count.
    """
    per_step = variants.groupBy("source_step").agg(F.count("*").alias("n"))
    positions = variants.select("pid", F.explode("mutations").alias("m")).groupBy("pid", "m.position").agg(
        F.lit(1).alias("n"))
    parts = [
        per_step.agg(F.count("*").alias("value")).withColumn("metric", F.lit("steps")),
        roots.agg(F.count("*").alias("value")).withColumn("metric", F.lit("parents")),
        per_step.agg(F.sum("n").alias("value")).withColumn("metric", F.lit("variants")),
        positions.agg(F.count("*").alias("value")).withColumn("metric", F.lit("positions")),
        scores.groupBy("score_key").agg(F.lit(1).alias("n")).agg(F.count("*").alias("value"))
        .withColumn("metric", F.lit("score_types")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("metric", "value")


def position_frequency(variants: DataFrame, n: int = 30) -> DataFrame:
    """Most mutated positions per protein with the count of each label."""
    rows = variants.select("pid", F.explode("mutations").alias("m")).select("pid", "m.position", "m.wt", "m.mut")
    per_label = rows.groupBy("pid", "position", S.mutation_label(F.col("wt"), F.col("position"), F.col("mut")).alias("label")).agg(
        F.count("*").alias("c"))
    per_pos = per_label.groupBy("pid", "position").agg(
        F.sum("c").alias("total"),
        F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("neg"), "label"))).alias("l"))
    return top_per_key(per_pos, ["pid"], [F.desc("total"), "position"], n).select(
        "pid", "rank", "position", "total",
        F.array_join(F.transform("l", lambda x: F.concat(
            x["label"], F.lit(" ("), (-x["neg"]).cast("string"), F.lit("x)"))), ", ").alias("labels"))


#: Variants of a protein that decide which score keys are popular.
LIBRARY_TOP = 200


def popular_score_keys(variants: DataFrame, top: int = LIBRARY_TOP, n_keys: int = 6,
                       skip: tuple[str, ...] = K.LIBRARY_SKIP_KEYS, by: tuple[str, ...] = ("pid",)) -> DataFrame:
    """Most frequent score keys among the best ``top`` variants of each protein (or other group)."""
    best = top_per_key(variants, [*by], [F.desc_nulls_last("composite_score"), "seq_no"], top)
    return _frequent_keys(best, n_keys, skip, by)


def _frequent_keys(best: DataFrame, n_keys: int = 6, skip: tuple[str, ...] = K.LIBRARY_SKIP_KEYS,
                   by: tuple[str, ...] = ("pid",)) -> DataFrame:
    keys = best.select(*by, F.explode(F.map_keys("scores")).alias("score_key"))
    per = keys.filter(~F.col("score_key").isin(*skip)).groupBy(*by, "score_key").agg(F.count("*").alias("n"))
    return top_per_key(per, [*by], [F.desc("n"), "score_key"], n_keys)


def with_shown_scores(variants: DataFrame, popular: DataFrame, by: tuple[str, ...] = ("pid",)) -> DataFrame:
    """Adds ``shown``: the popular keys of the variant's group in order, each with the variant's value or null.

    ``popular`` has a handful of rows per group.
    """
    keys = popular.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("rank", "score_key"))).alias("_keys"))
    shown = F.transform(F.coalesce("_keys", F.expr("cast(array() as array<struct<rank:int,score_key:string>>)")), lambda k: F.struct(
        k["score_key"].alias("score_key"), F.try_element_at("scores", k["score_key"]).alias("value")))
    return variants.join(keys, [*by], "left").withColumn("shown", shown).drop("_keys")


def fitness_summary(variants: DataFrame, key: str = "e1_fitness") -> DataFrame:
    v = F.try_element_at("scores", F.lit(key))
    return variants.groupBy("pid").agg(
        F.count("*").alias("total"), F.count(v).alias("scored"), F.min(v).alias("lowest"),
        F.max(v).alias("highest"), F.count_if(v > 0).alias("beneficial"))


def score_ranges(scores: DataFrame) -> DataFrame:
    """Range of each score per protein and step, with the count below zero."""
    return scores.groupBy("pid", "step_no", "score_key").agg(
        F.count("*").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest"),
        F.count_if(F.col("value") < 0).alias("negative"))


def combo_summary(combos: DataFrame, n: int = 5) -> DataFrame:
    """Number of combinations per order and the best ``n`` of a protein."""
    per = combos.groupBy("pid", "n_mutations").agg(F.count("*").alias("n_of_order"))
    best = top_per_key(combos, ["pid"], [F.desc("combo_sum"), "combo_no"], n)
    return best.join(per, ["pid", "n_mutations"])


def mutation_matrix(variants: DataFrame, n: int = 50) -> DataFrame:
    """Position x residue score matrix of single mutants, best positions first."""
    m = F.get("mutations", F.lit(0))
    single = variants.filter((F.size("mutations") == 1) & F.col("composite_score").isNotNull()).select(
        "pid", m["position"].alias("position"), m["mut"].alias("mut"), "composite_score", "seq_no")
    cells = single.groupBy("pid", "position", "mut").agg(F.max_by("composite_score", "seq_no").alias("s"))
    # A position has one cell per residue: they travel as one short list, columns are cut from the rows kept.
    cell = F.when(F.col("mut").isNotNull(), F.struct("mut", "s"))
    rows = cells.groupBy("pid", "position").agg(F.max("s").alias("best"), F.collect_list(cell).alias("_cells"))
    top = top_per_key(rows, ["pid"], [F.desc("best"), "position"], n).withColumn("_s", F.map_from_entries("_cells"))
    return top.select("pid", "position", "best", *[F.try_element_at("_s", F.lit(a)).alias(f"aa_{a}") for a in K.ALPHABET], "rank")


def unique_step_mutations(muts: DataFrame, category: Column, steps: list[str]) -> DataFrame:
    """Distinct mutations per step and category; a source that is not among ``steps`` is null.

    ``category`` may look at ``pid, position, wt, mut, source_step``.
    """
    def named(name: Column, i: int) -> Column:
        return F.when(F.getbit("sources", F.lit(i)) == 1, F.struct(name.alias("source_step")))

    names = [F.lit(s) for s in steps] + [F.lit(None).cast("string")]
    each = F.explode(F.array_compact(F.array(*[named(name, i) for i, name in enumerate(names)])))
    rows = mutation_sources(muts, steps).select("pid", "position", "wt", "mut", each.alias("s")).select("*", "s.source_step")
    return rows.groupBy("source_step", category.alias("category")).agg(F.count("*").alias("n"))


def top_positions(variants: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` distinct positions in rank order of the variants."""
    rows = variants.select("pid", "composite_score", "seq_no", F.explode("mutations").alias("m"))
    best = rows.groupBy("pid", "m.position").agg(
        F.max(F.struct("composite_score", (-F.col("seq_no")).alias("neg"))).alias("b"))
    return top_per_key(best, ["pid"], [F.desc("b"), "position"], n).select("pid", "rank", "position")


def step_variants(variants: DataFrame, n: int = 100) -> DataFrame:
    """Best variants of every step with their values under the step's five popular keys."""
    by = ("pid", "source_step")
    rows = variants.withColumn("sort_score", sort_score(F.col("composite_score"), F.col("scores")))
    best = top_per_key(rows, [*by], [F.desc("sort_score"), "seq_no"], n)
    ordered = rows.withColumn("composite_score", F.col("sort_score"))
    return with_shown_scores(best, popular_score_keys(ordered, 50, 5, K.STEP_SKIP_KEYS, by), by)


def _tier(step: Column) -> Column:
    return S.lookup(step, K.STEP_TIERS, 0)


def tier_highlights(variants: DataFrame, n: int = 20) -> DataFrame:
    """Best mutation per tier and position."""
    rows = variants.withColumn("sort_score", sort_score(F.col("composite_score"), F.col("scores"))).select(
        "pid", _tier(F.col("source_step")).alias("tier"), "sort_score", "seq_no", F.explode("mutations").alias("m"))
    best = rows.filter("tier > 0").groupBy("pid", "tier", F.col("m.position").alias("position")).agg(
        F.max(F.struct("sort_score", (-F.col("seq_no")).alias("neg"),
                       S.mutation_label(F.col("m.wt"), F.col("m.position"), F.col("m.mut")).alias("label"))).alias("b"))
    return top_per_key(best, ["pid", "tier"], [F.desc("b"), "position"], n).select(
        "pid", "tier", "rank", "position", "b.label", F.col("b.sort_score").alias("score"))


def tier_top(variants: DataFrame, n: int = 5) -> DataFrame:
    """Best variants per tier, one per set of mutated positions.

    Outside the scoring tiers a variant must carry a mutation of the tier.
    """
    rows = variants.withColumn("tier", _tier(F.col("source_step"))).withColumn(
        "sort_score", sort_score(F.col("composite_score"), F.col("scores")))
    own = F.exists("mutations", lambda m: _tier(m["source_step"]) == F.col("tier"))
    rows = rows.filter((F.col("tier") > 0) & (F.col("tier").isin(*K.SCORING_TIERS) | own))
    best = rows.groupBy("pid", "tier", positions_key(F.col("mutations")).alias("positions")).agg(
        F.max(F.struct("sort_score", (-F.col("seq_no")).alias("neg"), "candidate_id")).alias("b"))
    return top_per_key(best, ["pid", "tier"], [F.desc("b"), "positions"], n).select(
        "pid", "tier", "rank", "positions", "b.candidate_id", F.col("b.sort_score").alias("score"))


def tier_counts(variants: DataFrame) -> DataFrame:
    return variants.groupBy("pid", _tier(F.col("source_step")).alias("tier")).agg(F.count("*").alias("n_variants"))


def candidate_table(variants: DataFrame, score_keys: tuple[str, ...] = (), n: int = 100) -> DataFrame:
    """Best candidates with labels and a column for each of ``score_keys``.

    They go by composite score; a table without that column goes by the first key.
    """
    value = {k: F.try_element_at("scores", F.lit(k)) for k in score_keys}
    composite = "composite_score" in variants.columns
    order = F.col("composite_score") if composite else value[score_keys[0]] if score_keys else F.lit(None).cast("double")
    rows = variants.withColumn("_order", order)
    return top_per_key(rows, ["pid"], [F.desc_nulls_last("_order"), "seq_no"], n).select(
        "pid", "rank", "candidate_id", F.array_join(S.labels(F.col("mutations")), ", ").alias("labels"),
        S.num_mutations(F.col("mutations")).alias("n_mutations"), *(["composite_score"] if composite else []),
        *[v.alias(k) for k, v in value.items()])


def top_recommendations(variants: DataFrame, n: int = 20) -> DataFrame:
    keys = ("e1_fitness", "esm1v_delta", "esmif1_delta", "ddg")
    return top_per_key(variants, ["pid"], [F.desc_nulls_last("composite_score"), "seq_no"], n).select(
        "pid", "rank", "candidate_id", "source_step", "composite_score",
        *[F.try_element_at("scores", F.lit(k)).alias(k) for k in keys])


def variant_library(variants: DataFrame) -> DataFrame:
    """Every variant with its rank inside the protein and its values under the popular keys."""
    ranked = full_rank(variants, ["pid"], "composite_score", "seq_no")
    return library_rows(ranked, ranked.filter(F.col("rank") <= LIBRARY_TOP))


def library_rows(ranked: DataFrame, first: DataFrame) -> DataFrame:
    """Ranked variants with their values under the keys that are popular in ``first``, those of rank up to ``LIBRARY_TOP``."""
    return with_shown_scores(ranked, _frequent_keys(first))


def executive_summary(variants: DataFrame) -> DataFrame:
    """Totals, fitness range and the best variant of each protein."""
    e1 = F.try_element_at("scores", F.lit("e1_fitness"))
    pick = F.struct("composite_score", (-F.col("seq_no")).alias("neg"), "candidate_id")
    return variants.groupBy("pid").agg(
        F.count("*").alias("total_candidates"), F.min(e1).alias("e1_min"), F.max(e1).alias("e1_max"),
        F.count_if(e1 > 0).alias("beneficial"), F.max(pick).alias("p"),
        F.size(F.collect_set("source_step")).alias("n_stages"),
    ).select("pid", "total_candidates", "e1_min", "e1_max", "beneficial", "n_stages",
             F.col("p.candidate_id").alias("top_pick"), F.col("p.composite_score").alias("top_score"))


def pssm_table(muts: DataFrame) -> DataFrame:
    """Strength, alternatives at the position and cysteine notes of PSSM hits.

    The input holds at most thirty mutations per protein.
    """
    alt = muts.groupBy("pid", "position").agg(F.sort_array(F.collect_list("mut")).alias("_all"))
    return muts.join(alt, ["pid", "position"]).select(
        "pid", "rank", "position", "wt", "mut", "score",
        S.band(F.col("score"), [(5.0, "very strong"), (3.0, "strong"), (2.0, "moderate")], "weak").alias("strength"),
        F.array_join(F.array_remove("_all", F.col("mut")), ",").alias("alternatives"),
        (F.col("wt") == "C").alias("removes_cys"), (F.col("mut") == "C").alias("introduces_cys"))


def step_breakdown(hits: DataFrame, flags: DataFrame) -> DataFrame:
    """Counts per step, category and risk band; ``hits`` hold cysteines and motifs."""
    is_cys, risk = F.col("category") == "cysteine", F.round("risk", 9)
    out = hits.select(
        F.when(is_cys, "cysteine_scan").otherwise("motif_scan").alias("source_step"), "category",
        F.when(is_cys, S.band(risk, [(0.7, "bad"), (0.5, "warn")], "good"))
        .otherwise(S.band(risk, [(0.7, "bad"), (0.4, "warn")], "good")).alias("band")
    ).unionByName(flags.select(
        F.lit("sequence_complexity").alias("source_step"), "category",
        S.band(risk, [(0.7, "bad"), (0.3, "warn")], "good").alias("band")))
    return out.groupBy("source_step", "category", "band").agg(F.count("*").alias("n"))


def top_warnings(warnings: DataFrame, n: int = 2) -> DataFrame:
    """First warnings of each protein and step."""
    return top_per_key(warnings, ["pid", "source_step"], ["message"], n)
