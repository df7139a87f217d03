"""The driver tables seen as protein tables.

Every projection covers its whole table and whole texts. The SQL twins used by
the checks stand in ``sqlbase.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proteoframe.functions import constants as K
from proteoframe.functions import text as S
from proteoframe.session import shared, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letters(text: Column, drop: str = "") -> Column:
    """ASCII letters of a text in upper case, without the dropped ones.

    One pass of one pattern; everything beyond ASCII goes before upper-casing.
    """
    keep = "".join(c for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c not in drop)
    return F.upper(F.regexp_replace(text, f"[^{keep}{keep.lower()}]+", ""))


def sequences(spark: SparkSession, sf_dir: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """Whole texts as residue strings: ``pid, sequence``."""
    # The filter looks at the raw text: on the result it would be pushed below
    # the projection and clean every text twice.
    src = spread(table(spark, sf_dir, name).select(key, "text"), key)
    return src.filter(F.col("text").rlike(f"(?i)[{K.ALPHABET}]")).select(
        F.col(key).alias("pid"),
        letters(F.col("text"), drop="BJOUXZ").alias("sequence"),
    )


def protected_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shielded positions per labelled document."""
    lab = table(spark, sf_dir, "labels")
    return lab.select(
        F.col("doc_id").alias("pid"),
        F.explode(F.array(
            F.col("doc_id") % 50 + 1,
            F.col("doc_id") % 50 + 2 + F.col("quality").cast("bigint") * 3,
        )).alias("position"),
    ).distinct()


def letter(index: Column) -> Column:
    return F.lit(K.ALPHABET).substr((index % 20 + 1).cast("int"), F.lit(1))


def document_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as mutation requests on documents.

    Positions run a little past the end and some wild types are wrong, so both
    kinds of rejection occur: ``pid, set_id, position, wt, mut``.
    """
    seqs = sequences(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("pid"), F.col("l_orderkey").alias("set_id"),
        "l_linenumber", "l_suppkey", "l_tax",
    )
    n = F.length("sequence")
    pos = (F.col("set_id") * 31 + F.col("l_linenumber") * 7) % (n + 2) + 1
    return li.join(seqs, "pid").select(
        "pid", "set_id", pos.alias("position"),
        F.when((F.col("l_tax") > 0.005) & (pos <= n), S.residue_at(F.col("sequence"), pos))
        .otherwise("W").alias("wt"),
        letter(F.col("l_suppkey")).alias("mut"),
    ).distinct()


def mutation_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of one order on one document as a mutation array."""
    return document_mutations(spark, sf_dir).groupBy("pid", "set_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "wt", "mut"))).alias("mutations")
    )


def design_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn as the design that follows from the turn before."""
    turns = sequences_of_turns(spark, sf_dir)
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"),
                          F.col("sequence").alias("parent_sequence"))
    return turns.join(before, ["conv_id", "turn"]).select(
        F.concat_ws(":", "conv_id", "turn").alias("pid"), "parent_sequence", "sequence"
    )


def sequences_of_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return src.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        letters(F.col("text"), drop="BJOUZ").alias("sequence"),
    ).filter(F.length("sequence") > 0)


def wrapped_lines(spark: SparkSession, sf_dir: str, width: int = 60) -> DataFrame:
    """Whole texts wrapped like aligned records: ``doc_id, lang, rec_idx, line``.

    Letters outside the alphabet (but X) become gaps; the last line is short.
    """
    src = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    text = F.regexp_replace(letters(F.col("text")), "[BJOUZ]", K.GAP)
    rows = src.select("doc_id", "lang", text.cast("binary").alias("t")).filter(F.length("t") > 0)
    return rows.select(
        "doc_id", "lang", "t",
        F.explode(F.sequence(F.lit(0), F.length("t") - 1, F.lit(width))).alias("off"),
    ).select(
        "doc_id", "lang",
        (F.col("doc_id") * 1000000 + F.floor(F.col("off") / width)).alias("rec_idx"),
        F.col("t").substr(F.col("off") + 1, F.lit(width)).cast("string").alias("line"),
    )


def msa(spark: SparkSession, sf_dir: str, width: int = 60) -> DataFrame:
    """One alignment per language, every text contributes all its lines."""
    return wrapped_lines(spark, sf_dir, width).select(
        F.col("lang").alias("pid"), "rec_idx", F.rpad("line", width, K.GAP).alias("aligned")
    )


def document_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alignment per text from its unpadded lines; most are ragged."""
    return wrapped_lines(spark, sf_dir).select(
        F.col("doc_id").alias("pid"), "rec_idx", F.col("line").alias("aligned")
    )


def wild_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ungapped last record for half of the alignments, an absent one otherwise."""
    last = msa(spark, sf_dir).groupBy("pid").agg(F.max_by("aligned", "rec_idx").alias("a"))
    return last.select(
        "pid",
        F.when(F.col("pid").isin("en", "fr"), F.replace("a", F.lit(K.GAP), F.lit("")))
        .otherwise("ABSENT").alias("sequence"),
    )


def source_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one source as its search hits, the first one being the query."""
    src = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")
    return src.select(
        F.col("source").alias("pid"), F.col("doc_id").alias("idx"),
        F.when(F.col("doc_id") < 10, "query").otherwise(F.col("doc_id").cast("string")).alias("name"),
        letters(F.col("text"), drop="BJOUXZ").alias("sequence"),
    )


RUN_STEPS = {
    1: ("cysteine_scan", "cys_risk"),
    2: ("motif_scan", "motif_risk_fixed"),
    3: ("consensus_design", "consensus_conservation"),
    4: ("pssm_analysis", "pssm_log_odds"),
    5: ("cavity_fill", "cavity_burial"),
    6: ("surface_patch", "surface_sap"),
    7: ("stability_ddg", "ddg"),
}


def run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as proposals of a mutation by one of seven steps; one variant may have several."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("pid"), "l_linenumber",
        (F.col("l_partkey") % 50 + 1).alias("position"),
        letter(F.col("l_quantity").cast("bigint")).alias("mut"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("disc"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tax"),
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_linestatus") == "F").alias("final"),
        _run_step().alias("source_step"),
    )
    return li.withColumn("wt", letter(F.col("pid") * 7 + F.col("position") * 3)).filter("wt <> mut")


def _run_step() -> Column:
    return S.lookup(F.col("l_linenumber"), {k: v[0] for k, v in RUN_STEPS.items()})


@shared
def run_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single mutants proposed for each supplier's protein by seven steps.

    Line items with one supplier, position, residue and line number are one
    variant; sums are kept in integer cents so that every order gives one value.
    """
    g = run_lines(spark, sf_dir).groupBy(
        "pid", "l_linenumber", "position", "wt", "mut"
    ).agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"), F.sum("disc").alias("disc"),
        F.sum("tax").alias("tax"), F.max("returned").alias("returned"), F.max("final").alias("final"),
    )
    label = S.mutation_label(F.col("wt"), F.col("position"), F.col("mut"))
    n = F.col("n").cast("double")
    return g.select(
        "pid",
        F.concat_ws(":", F.col("pid").cast("string"), F.col("l_linenumber").cast("string"), label)
        .alias("candidate_id"),
        F.col("l_linenumber").cast("bigint").alias("step_no"),
        _run_step().alias("source_step"),
        "position", "wt", "mut",
        (F.col("cents") / n / F.lit(791900.0) - F.lit(6.3)).alias("score"),
        F.when(F.col("returned"), F.col("disc") / n / F.lit(7.0) - F.lit(0.7)).alias("e1_fitness"),
        F.when(F.col("final"), F.col("tax") / n / F.lit(3.0) - F.lit(1.3)).alias("esm1v_delta"),
    )


def run_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long score table of the run: ``pid, candidate_id, step_no, score_key, value``."""
    v = run_variants(spark, sf_dir)
    key = S.lookup(F.col("step_no"), {k: s[1] for k, s in RUN_STEPS.items()})
    entries = F.array(
        F.struct(key.alias("score_key"), F.col("score").alias("value")),
        F.struct(F.lit("e1_fitness").alias("score_key"), F.col("e1_fitness").alias("value")),
        F.struct(F.lit("esm1v_delta").alias("score_key"), F.col("esm1v_delta").alias("value")),
    )
    return v.select("pid", "candidate_id", "step_no", F.explode(entries).alias("e")).select(
        "pid", "candidate_id", "step_no", "e.score_key", "e.value"
    ).filter("value is not null")


def run_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("pid"), F.col("s_suppkey").cast("string").alias("candidate_id"),
        F.lit(None).cast("string").alias("parent_id"), F.col("s_name").alias("name"),
    )


ORDER_KEYS = {1: "e1_fitness", 2: "esm1v_delta", 3: "ddg", 4: "surface_sap", 5: "mpnn_score"}


def order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of each order seen as a candidate: ``candidate_id, score_key, value``.

    Line numbers 1-5 give model scores, 6 a structure confidence, 7 a validation
    confidence that is 0.0 for single items.
    """
    li = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("candidate_id"), "l_linenumber"
    ).agg(
        F.count("*").alias("n"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
    )
    n = F.col("n").cast("double")
    confidence = F.when(F.col("l_linenumber") == 6, F.col("qty") / n * 2.0).otherwise(
        F.col("qty") / n * 2.0 - 2.0
    )
    key = S.lookup(F.col("l_linenumber"), {**ORDER_KEYS, 6: "plddt", 7: "val_plddt"})
    return li.select(
        "candidate_id", key.alias("score_key"),
        F.when(F.col("l_linenumber") >= 6, confidence)
        .otherwise(F.col("cents") / n / F.lit(791900.0) - F.lit(6.3)).alias("value"),
    )


def order_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as candidates; the first order of a customer is the root."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    first = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("root"))
    return o.join(first, "o_custkey").select(
        F.col("o_custkey").alias("pid"), F.col("o_orderkey").alias("candidate_id"),
        F.when(F.col("o_orderkey") != F.col("root"), F.col("root")).alias("parent_id"),
    )


def order_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mutation array of each order: ``candidate_id, mutations``."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("candidate_id"),
        (F.col("l_partkey") % 300 + 1).alias("position"),
        letter(F.col("l_suppkey")).alias("wt"),
        letter(F.col("l_quantity").cast("bigint")).alias("mut"),
    ).filter("wt <> mut")
    return li.groupBy("candidate_id").agg(
        F.sort_array(F.collect_set(F.struct("position", "wt", "mut"))).alias("mutations")
    )


def atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as residues: fifty make a chain, triples of components are atoms.

    Glycine has no CB, one residue in 23 lacks its CA, one in 17 is a hetero
    residue, so every branch of the geometry operators is taken.
    """
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    e = e.withColumn("aa", letter(F.col("vec_id") * 7 + F.floor(F.col("vec_id") / 20)))

    def atom(name: str, first: int, present: Column | None = None) -> Column:
        s = F.struct(
            F.lit(name).alias("atom"), F.lit(name[0]).alias("element"),
            *[(F.get("embedding", F.lit(first + i)).cast("double") * 40).alias(c) for i, c in enumerate("xyz")])
        return s if present is None else F.when(present, s)

    parts = F.array_compact(F.array(
        atom("N", 6), atom("CA", 0, F.col("vec_id") % 23 != 5), atom("C", 9), atom("CB", 3, F.col("aa") != "G")))
    return e.select(
        F.floor(F.col("vec_id") / 50).alias("structure_id"), (F.col("vec_id") % 50 + 1).alias("position"),
        "aa", (F.col("vec_id") % 17 == 3).alias("het"),
        (F.abs(F.get("embedding", F.lit(12)).cast("double")) * 100 + 60).alias("bfactor"),
        F.explode(parts).alias("a"),
    ).select("structure_id", "position", "aa", "het", "bfactor", "a.*")


def protected_residues(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").filter("label = 3")
    return e.select(F.floor(F.col("vec_id") / 50).alias("structure_id"),
                    (F.col("vec_id") % 50 + 1).alias("position"))


def structure_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chain next to the one before it."""
    ids = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 50).alias("structure_b")).distinct()
    return ids.filter("structure_b > 0").select((F.col("structure_b") - 1).alias("structure_a"), "structure_b")


def benchmark_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences(spark, sf_dir, "benchmark", "item_id")


def logprobs(res: DataFrame, models: int = 2) -> DataFrame:
    """A log-probability for every residue, letter and model of ``res``."""
    alphabet = F.array(*[F.lit(a) for a in K.ALPHABET])
    rows = res.select("pid", "position", F.explode(F.sequence(F.lit(1), F.lit(models))).alias("model"))
    rows = rows.select("pid", "position", "model", F.explode(alphabet).alias("aa"))
    lp = -F.log(1.0 + (F.col("position") * 31 + F.ascii("aa") * 17 + F.col("pid") * F.col("model")) % 97)
    return rows.withColumn("lp", lp)


def benchmark_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as mutation sets on the benchmark texts."""
    seqs = benchmark_sequences(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("pid"), F.col("l_orderkey").alias("set_id"), "l_partkey", "l_quantity")
    pos = F.col("l_partkey") % F.length("sequence") + 1
    return li.join(seqs, "pid").select(
        "pid", "set_id", pos.alias("position"), S.residue_at(F.col("sequence"), pos).alias("wt"),
        letter(F.col("l_quantity").cast("bigint")).alias("mut"),
    ).filter("wt <> mut").distinct()


def text_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as candidates; the first one of a source is the root."""
    src = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")
    rows = src.select("source", "doc_id", letters(F.col("text"), drop="BJOUXZ").alias("sequence"))
    first = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("root"))
    return rows.join(first, "source").select(
        F.col("source").alias("pid"), F.col("doc_id").alias("candidate_id"),
        F.when(F.col("doc_id") != F.col("root"), F.col("root")).alias("parent_id"), "sequence")


def vector_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as a string of 64 letters, ranked by id: ``pid, rank, sequence``."""
    code = F.transform("embedding", lambda e: F.lit(K.ALPHABET).substr(
        F.greatest(F.lit(1), F.least(F.lit(20), F.floor((e.cast("double") + 0.5) * 20).cast("int") + 1)), F.lit(1)))
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("bigint").alias("pid"), F.col("vec_id").alias("rank"),
        F.array_join(code, "").alias("sequence"))
