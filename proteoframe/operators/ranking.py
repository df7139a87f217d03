"""Exact ranks that do not need a whole key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proteoframe.session import stored


def dealt_by_range(df: DataFrame, by: list[Column]) -> DataFrame:
    """``df`` in the order ``by`` over tasks and inside them, stored, with ``_task`` and the running number ``_at``."""
    return stored(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({
        "_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))


def full_rank(df: DataFrame, keys: list[str], value: str, tie: str, descending: bool = True) -> DataFrame:
    """Add ``rank``: 1, 2, ... per key by ``value`` (nulls last), then by ``tie``; a null key is a key.

    One window over a key would sort the whole key in one task, and a single
    key may hold a third of all rows. Instead all rows are dealt by ranges of (key,
    value, tie), whose bounds Spark samples, and sorted in their task. A task then holds a
    stretch of a key's order: its rows are numbered along the task, and what the
    earlier tasks hold of the key, one count for each task, is added. Which bounds were drawn
    decides the balance, never the result; the dealt rows are stored, so they are
    drawn once.
    """
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    by = [*(F.asc_nulls_first(k) for k in keys), order, F.asc_nulls_first(tie)]
    return dealt_rank(dealt_by_range(df, by), keys)


def dealt_rank(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """``rank`` of rows that ``dealt_by_range`` has dealt by the keys and the order inside them."""
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # A row per task and key; its size is known once it is stored.
    ahead = stored(dealt.groupBy(*keys, "_task").agg(F.min("_at").alias("_start"), F.count("*").alias("_n")).select(
        *(F.col(k).alias(f"_{i}") for i, k in enumerate(keys)), F.col("_task").alias("_of"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_start") + 1).alias("_ahead")))
    same = F.col("_task") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
    columns = [c for c in dealt.columns if c not in ("_task", "_at")]
    return dealt.join(ahead, same).withColumn("rank", F.col("_at") + F.col("_ahead")).select(*columns, "rank")


def top_per_key(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """Best ``n`` rows per key with their ``rank``.

    Every task prunes to ``n`` rows per key before the exchange.
    """
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= n)
