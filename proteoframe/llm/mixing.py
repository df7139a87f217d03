"""Mixing sources to target weights by capped water-filling.

Sources are ranked by code point, null last, and take the weights in turn. The
target of a source is ``level * weight``, clamped at ``max_epochs`` times its
size; the level is raised until the targets sum to all words, which is where
repeated clamping and proportional redistribution ends. A document is taken
``floor(target / source size)`` whole times. The fraction that remains is one
more pass over a seeded order of the source's documents, up to the word count
that is missing; the document at that border is taken in part. So the words
taken equal the rounded target, and equal rows get equal shares.

Null and empty texts have size 0 and are taken for 0 words; a null source is a
source of its own; rows with one key (repeated ids) at the border share the
rest in proportion to their sizes. An empty table gives an empty result. Extra
columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proteoframe.llm.base import piece_digits, running_sum, seeded_key, store, word_count


def targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``sizes``: one row per source with ``source`` and ``source_size``. Adds ``target`` and ``whole``.

    Its windows see one row per source, never documents.
    """
    everything = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    fill = Window.orderBy("_cost", "_rank")
    total = Window.partitionBy()
    cap = F.col("source_size") * F.lit(max_epochs)
    ranked = (sizes.withColumn("_rank", F.row_number().over(everything))
              .withColumn("_weight", F.element_at(cycle, F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1))
              .withColumn("_cost", cap / F.col("_weight")))
    # Sources in the order in which a rising level fills them: with the first j at their
    # caps, the others share the rest. That level rises up to the feasible one, then falls.
    rest = F.sum("source_size").over(total) - F.coalesce(
        F.sum(cap).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    filled = (ranked.withColumn("_level", rest / F.sum("_weight").over(
        fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("_level", F.max("_level").over(total)))
    target = F.least(cap.cast("double"), F.col("_level") * F.col("_weight"))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    return filled.select("source", "source_size", target.alias("target"), whole.cast("long").alias("whole"))


def plan(sized: DataFrame, seed: int, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """One row per source: targets and where its fractional pass ends.

    ``sized`` has ``_source`` (a non-null name), ``source``, ``_key``, ``_size``. The pass takes rows with
    a key below ``_border`` whole, those with that key for ``_rest`` of ``_tied`` words.
    """
    sums = sized.groupBy("_source").agg(
        F.first("source", ignorenulls=True).alias("source"), F.sum("_size").alias("source_size"),
        F.count(F.lit(1)).alias("_rows"))
    sums = store(sums)
    rows = sums.agg(F.sum("_rows")).first()[0] or 0
    want = targets(sums.select("source", "source_size"), weights, max_epochs)
    want = want.withColumn("_source", named(F.col("source"))).withColumn(
        "_pass", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
    keyed = (sized.filter("_size > 0").groupBy("_source", "_key").agg(F.sum("_size").alias("_tied"))
             .withColumn("_piece", F.substring("_key", 1, piece_digits(rows))))
    run = running_sum(keyed, ["_source"], "_piece", ["_key"], "_tied", "_before")
    border = (run.join(want.select("_source", "_pass"), "_source")
              .filter((F.col("_before") < F.col("_pass")) & (F.col("_pass") <= F.col("_before") + F.col("_tied")))
              .select("_source", F.col("_key").alias("_border"), "_tied",
                      (F.col("_pass") - F.col("_before")).alias("_rest")))
    return want.join(border, "_source", "left")


def named(source: Column) -> Column:
    """A non-null name that keeps a null source apart from every text."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source))


def _fraction() -> Column:
    """Words that the fractional pass takes of a row."""
    return (F.when(F.col("_border").isNull() | (F.col("_key") > F.col("_border")), F.lit(0))
            .when(F.col("_key") < F.col("_border"), F.col("_size"))
            .otherwise(F.expr("(_size * _rest) div _tied")).cast("long"))


def mixed(docs: DataFrame, seed: int = 42, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3,
          doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Decisions per row: all columns but the text, ``size``, ``source_size``, ``target``, ``taken``."""
    kept = [c for c in docs.columns if c not in {text, "size", "source_size", "target", "taken"}]
    rows = store(docs.select(
        F.struct(*kept).alias("_row"), F.col(source).alias("source"), named(F.col(source)).alias("_source"),
        seeded_key(seed, doc_id).alias("_key"), word_count(F.col(text)).alias("_size")))
    want = store(plan(rows, seed, weights, max_epochs).drop("source"))
    return rows.join(want, "_source").select(
        "_row.*", F.col("_size").alias("size"), "source_size", "target",
        (F.col("whole") * F.col("_size") + _fraction()).alias("taken"))


def mix(docs: DataFrame, seed: int = 42, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself, with the columns of ``docs``: whole rows repeated, plus the fractional pass.

    Texts stay whole: the row at the border is taken once more if at least half of
    it belongs to the pass and left out otherwise, so a source comes as near to its target
    as whole rows can. Rows of one id are told apart by their text; rows equal in
    both share the border. Texts are not shuffled: rows meet only the
    one-row-per-source plan.
    """
    key = F.concat(seeded_key(seed, doc_id), F.hex(F.xxhash64(text)))
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(source).alias("source"), named(F.col(source)).alias("_source"),
        key.alias("_key"), word_count(F.col(text)).alias("_size"))
    sized = store(rows.drop("_row"))
    want = store(plan(sized, seed, weights, max_epochs).drop("source"))
    share = rows.join(want, "_source").withColumn("_part", _fraction())
    once_more = (F.col("_part") > 0) & (2 * F.col("_part") >= F.col("_size"))
    copies = (F.col("whole") + once_more.cast("long")) * (F.col("_size") > 0).cast("long")
    each = share.withColumn("_copies", copies.cast("int")).filter("_copies > 0")
    return each.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).select("_row.*")
