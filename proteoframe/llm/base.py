"""What several operators share: word splitting, stored tables, running sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one piece of a running sum holds on average.
PIECE_ROWS = 2_000
#: Rows of ids and hashes that may be sent to every task.
BROADCAST_ROWS = 1_000_000
#: Texts handed to Python at a time: bounds a worker's memory when texts are long.
TEXTS_PER_BATCH = 500


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one the cluster names; a local session without it gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def store(df: DataFrame, **options: object) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, lost executors cost nothing."""
    folder = shared_folder(df.sparkSession)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small(df: DataFrame) -> DataFrame:
    """``df``, stored, to be broadcast if it has at most BROADCAST_ROWS rows (of a few short columns); else joined as Spark sees fit."""
    df = store(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))


def word_count(text: Column | str) -> Column:
    """Number of words; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_key(seed: int, *cols: str) -> Column:
    """Hex key that orders rows at random but alike in every run; null counts as the word null."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def piece_digits(rows: int) -> int:
    """Leading hex digits of a seeded key that cut ``rows`` rows into pieces of about PIECE_ROWS."""
    digits = 0
    while 16 ** digits * PIECE_ROWS < rows:
        digits += 1
    return digits


def running_sum(df: DataFrame, groups: list[str], piece: str, order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, as column ``out``.

    ``piece`` never falls along ``order`` and splits a group, so that a hot
    group is sorted by many tasks: pieces are summed first, the sums of earlier
    pieces are added to the running sum inside a piece. ``groups`` hold no null.
    """
    keys = [*groups, piece]
    before = Window.partitionBy(*groups).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(*keys).agg(F.sum(value).alias("_t"))
              .select(*keys, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(starts, keys)
            .withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_start"))
