"""Score tables: statistics, composite score, filter rules, score map-back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proteoframe.functions import constants as K
from proteoframe.functions import text as S


def score_stats(scores: DataFrame) -> DataFrame:
    """Mean and population deviation per key; keys with one value are absent."""
    return scores.groupBy("score_key").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("*").alias("n")
    ).filter("n > 1")


def composite_score(cands: DataFrame, scores: DataFrame, weights: dict[str, float] | None = None,
                    normalize: bool = True, missing: float | None = 0.0) -> DataFrame:
    """Weighted mean of the z-scores a candidate has.

    A key with one value keeps its raw value, a constant key counts as zero,
    lower-is-better keys change sign, a candidate without any key gets
    ``missing``. Statistics are those of the given candidates; they hold one row
    per weighted key, so their broadcast is bounded by the number of weights.
    """
    w = {**K.DEFAULT_WEIGHTS, **(weights or {})}
    used = scores.filter(F.col("score_key").isin(*w)).join(
        cands.select("candidate_id").distinct(), "candidate_id", "left_semi")
    z = F.col("value")
    if normalize:
        used = used.join(F.broadcast(score_stats(used)), "score_key", "left")
        z = (
            F.when(F.col("std").isNull(), F.col("value"))
            .when(F.col("std") > 1e-8, (F.col("value") - F.col("mean")) / F.col("std"))
            .otherwise(0.0)
        )
    signed = F.when(F.col("score_key").isin(*K.LOWER_IS_BETTER), -z).otherwise(z)
    weight = S.lookup(F.col("score_key"), w)
    per = used.groupBy("candidate_id").agg(
        F.sum(weight * signed).alias("num"), F.sum(weight).alias("den")
    )
    value = F.when(F.col("den") > 0, F.col("num") / F.col("den")).otherwise(F.lit(missing).cast("double"))
    return cands.join(per, "candidate_id", "left").withColumn("composite_score", value).drop("num", "den")


def score_map(scores: DataFrame) -> DataFrame:
    """Scores of a candidate folded into one map; of several values of a key the largest counts."""
    entries = F.sort_array(F.collect_list(F.struct("score_key", "value")))
    return scores.filter("score_key is not null").groupBy("candidate_id").agg(entries.alias("_e")).select(
        "candidate_id", F.map_from_entries(S.last_of_each(F.col("_e"), "score_key")).alias("scores"))


def _weighted_z(value: Column, key: str, weight: float, stats: dict) -> Column:
    s = stats.get(key)
    z = value if s is None else (value - s["mean"]) / s["std"] if s["std"] > 1e-8 else F.lit(0.0)
    return weight * (-z if key in K.LOWER_IS_BETTER else z)


def composite_in_row(cands: DataFrame, weights: dict[str, float] | None = None,
                     entries: list[tuple[Column, Column]] | None = None) -> DataFrame:
    """``composite_score`` of candidates that carry their scores as a map, or as ``entries`` (key, value) in columns.

    The statistics are at most one row per weight and become constants of the expression; nothing
    is joined by candidate. ``entries`` of a candidate have different keys; they are weighed as they
    are, while a map that is made in the same projection would be made again for every weight.
    ``cands`` is read twice: pass a stored table if it is dear.
    """
    w = {**K.DEFAULT_WEIGHTS, **(weights or {})}
    if entries is None:
        long = cands.select(F.explode("scores").alias("score_key", "value"))
        entries = [(F.lit(k), F.try_element_at("scores", F.lit(k))) for k in w]
    else:
        long = cands.select(F.inline(F.array(*[F.struct(k.alias("score_key"), v.alias("value")) for k, v in entries])))
    long = long.filter(F.col("score_key").isin(*w) & F.col("value").isNotNull())
    stats = {r["score_key"]: r for r in score_stats(long).collect()}
    num = den = F.lit(0.0)
    for key, value in entries:
        here = value.isNotNull()
        term = weight = None
        for k, x in w.items():
            z = _weighted_z(value, k, x, stats)
            term = F.when(here & (key == k), z) if term is None else term.when(here & (key == k), z)
            weight = F.when(here & (key == k), x) if weight is None else weight.when(here & (key == k), x)
        num, den = num + term.otherwise(0.0), den + weight.otherwise(0.0)
    return cands.withColumn("composite_score", F.when(den > 0, num / den).otherwise(0.0))


def filter_reasons(scores: Column, muts: Column, structure: Column | None = None, *,
                   max_mutations: int = 15, min_plddt: float = 60.0, max_ddg: float = 5.0,
                   min_e1_fitness: float | None = None, min_esm1v_delta: float | None = None,
                   min_recovery: float = 0.0, forbid_new_cysteines: bool = True,
                   forbid_prolines_in_helix: bool = True,
                   require_scores: tuple[str, ...] = ()) -> Column:
    """Array of the rules a candidate breaks, in rule order."""
    def score(key: str) -> Column:
        return F.try_element_at(scores, F.lit(key))

    muts = F.coalesce(muts, F.expr("cast(array() as array<struct<position:bigint,wt:string,mut:string>>)"))
    has_map = F.when(scores.isNull(), F.array().cast("array<string>")).otherwise(F.map_keys(scores))
    confidence = F.coalesce(F.nullif(score("val_plddt"), F.lit(0.0)), score("plddt"))
    rules = [
        F.when(F.size(muts) > max_mutations, "too_many_mutations"),
        F.when(confidence < min_plddt, "low_plddt"),
        F.when(score("ddg") > max_ddg, "high_ddg"),
    ]
    if min_e1_fitness is not None:
        rules.append(F.when(score("e1_fitness") < min_e1_fitness, "low_e1_fitness"))
    if min_esm1v_delta is not None:
        rules.append(F.when(score("esm1v_delta") < min_esm1v_delta, "negative_esm1v_delta"))
    rules.append(F.when(score("mpnn_recovery") < min_recovery, "low_recovery"))
    if forbid_new_cysteines:
        new = F.filter(muts, lambda m: m["mut"] == "C")
        rules.append(F.when(
            F.size(new) > 0,
            F.concat(F.lit("introduces_cys_"), F.get(new, F.lit(0))["position"].cast("string"))))
    reasons = F.array_compact(F.array(*rules))
    if forbid_prolines_in_helix and structure is not None:
        helix = F.filter(muts, lambda m: (m["mut"] == "P") & (S.residue_at(structure, m["position"]) == "H"))
        reasons = F.concat(reasons, F.transform(
            helix, lambda m: F.concat(F.lit("pro_in_helix_"), m["position"].cast("string"))))
    if require_scores:
        missing = F.array_except(F.array(*[F.lit(k) for k in require_scores]), has_map)
        reasons = F.concat(reasons, F.transform(missing, lambda k: F.concat(F.lit("missing_"), k)))
    return reasons


def quality_filter(cands: DataFrame, scores: DataFrame, muts: DataFrame, **rules) -> DataFrame:
    """Candidates with ``reasons`` and ``passed``; roots always pass."""
    joined = cands.join(score_map(scores), "candidate_id", "left").join(muts, "candidate_id", "left")
    structure = F.col("secondary_structure") if "secondary_structure" in cands.columns else None
    reasons = filter_reasons(F.col("scores"), F.col("mutations"), structure, **rules)
    broken = F.when(F.col("parent_id").isNull(), F.array().cast("array<string>")).otherwise(reasons)
    return joined.withColumn("reasons", broken).withColumn("passed", F.size("reasons") == 0)


def score_pairs(scores: DataFrame, x: str, y: str) -> DataFrame:
    """Candidates that have both scores, by one aggregation instead of a join."""
    return (
        scores.filter(F.col("score_key").isin(x, y)).groupBy("candidate_id")
        .agg(F.max(F.when(F.col("score_key") == x, F.col("value"))).alias("x"),
             F.max(F.when(F.col("score_key") == y, F.col("value"))).alias("y"))
        .filter("x is not null and y is not null")
    )


def score_correlation(scores: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation of all score keys, or of the named ones.

    The keys need not be known: a candidate's scores are folded into one short list,
    which gives one row for each pair of its keys, and the co-moments of a pair are
    summed in every task before they meet. Pairs of fewer than three candidates or without
    spread are 0, the diagonal is 1. Keys that share no candidate are pairs as well.
    """
    rows = scores.filter(F.col("value").isNotNull() & F.col("score_key").isNotNull())
    if keys is not None:
        rows = rows.filter(F.col("score_key").isin(*keys))
    own = rows.groupBy("candidate_id", "score_key").agg(F.max("value").alias("value"))
    held = own.groupBy("candidate_id").agg(F.sort_array(F.collect_list(F.struct("score_key", "value"))).alias("s"))
    later = F.transform("s", lambda x, i: F.transform(
        F.slice("s", i + 2, F.size("s")), lambda y: F.struct(
            x["score_key"].alias("key_x"), y["score_key"].alias("key_y"), x["value"].alias("x"), y["value"].alias("y"))))
    sums = held.select(F.inline(F.flatten(later))).groupBy("key_x", "key_y").agg(
        # F.corr divides by zero where a key has one value.
        F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("r"), F.count("*").alias("n"))
    r = F.when((F.col("n") < 3) | F.col("r").isNull() | F.isnan("r"), 0.0).otherwise(F.col("r"))
    found = sums.select("key_x", "key_y", r.alias("r"))
    both = found.unionByName(found.select(F.col("key_y").alias("key_x"), F.col("key_x").alias("key_y"), "r"))
    names = F.collect_set("score_key") if keys is None else F.array(*[F.lit(k) for k in sorted(set(keys))])
    matrix = rows.agg(names.alias("k")) if keys is None else scores.sparkSession.range(1).select(names.alias("k"))
    cells = matrix.select("k", F.explode("k").alias("key_x")).select("key_x", F.explode("k").alias("key_y"))
    return cells.join(both, ["key_x", "key_y"], "left").select(
        "key_x", "key_y", F.when(F.col("key_x") == F.col("key_y"), 1.0).otherwise(F.coalesce("r", F.lit(0.0))).alias("r"))


def score_histogram(scores: DataFrame, key: str, bins: int = 30) -> DataFrame:
    """Counts of equal-width bins between the smallest and the largest value.

    A constant score has bins of no width; all its values lie in the first.
    """
    vals = scores.filter(F.col("score_key") == key).select("value")
    limits = vals.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.floor((F.col("value") - F.col("lo")) / F.nullif(width, F.lit(0.0))).cast("int")
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1))
    counted = (
        vals.withColumn("_l", limits.select(F.struct("lo", "hi")).scalar())
        .select("value", "_l.lo", "_l.hi")
        .groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n"))
    )
    edges = limits.select("lo", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return edges.join(counted, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


# ------------------------------------------------------------ external scores

def distinct_sequences(cands: DataFrame, key_len: int | None = None) -> DataFrame:
    """Each different sequence once: what an external scorer has to see."""
    seq = F.col("sequence") if key_len is None else F.col("sequence").substr(1, key_len)
    return cands.select(seq.alias("sequence")).distinct()


def map_scores(cands: DataFrame, model_scores: DataFrame, key_len: int | None = None) -> DataFrame:
    """Scores of distinct sequences back on every candidate with that sequence."""
    seq = F.col("sequence") if key_len is None else F.col("sequence").substr(1, key_len)
    keyed = cands.select("candidate_id", F.md5(seq).alias("_k"))
    by_key = model_scores.select(F.md5("sequence").alias("_k"), "value")
    return keyed.join(by_key, "_k").select("candidate_id", "value")


def delta_vs_parent(values: DataFrame, cands: DataFrame) -> DataFrame:
    """Variant value minus the value of its root."""
    roots = cands.filter(F.col("parent_id").isNull()).join(values, "candidate_id").select(
        F.col("candidate_id").alias("parent_id"), F.col("value").alias("parent_value")
    )
    return (
        cands.filter(F.col("parent_id").isNotNull()).join(values, "candidate_id")
        .join(roots, "parent_id")
        .select("candidate_id", "parent_id", (F.col("value") - F.col("parent_value")).alias("delta"))
    )


def score_with(cands: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Run a user's scorer on Arrow batches of the distinct sequences.

    ``fn`` maps an iterator of frames with a ``sequence`` column to frames with
    ``sequence`` and ``value``; the result is mapped back to all candidates.
    """
    scored = distinct_sequences(cands).mapInPandas(fn, schema)
    return map_scores(cands, scored)


def ddg_variants(cands: DataFrame, ddg: DataFrame, threshold: float = -1.0) -> DataFrame:
    """Stabilising substitutions of root candidates by predicted energy."""
    roots = cands.filter(F.col("parent_id").isNull()).select("pid", "candidate_id")
    return ddg.filter(F.col("ddg") < threshold).join(roots, "pid").select(
        "pid", F.col("candidate_id").alias("parent_id"), "position", "wt", "mut", "ddg"
    )
