"""Text files read in parallel with places and running counts over whole files.

Spark cuts a text file into byte ranges (blocks) and finds the first separator
in each. What a reader of the whole file would know at a place - how many records or
marks came before - is the sum over the earlier blocks of the file plus the count
inside the block. The block sums are one small row per block, written to the shared
folder so that their size is known where they are joined; the texts are never
shuffled, sorted or held as one value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proteoframe.session import stored


def pieces(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """``path, block, at, value``: pieces between separators (lines, if none is given).

    ``at`` rises along a block by one from piece to piece. It is a running number of the
    scan's task, so nothing may be filtered before it is used.
    """
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path).select(
        F.input_file_name().alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def sums_before(rows: DataFrame, sums: dict[str, Column], **firsts: Column) -> DataFrame:
    """One row per block: ``path, block`` and what the earlier blocks of its file hold.

    ``sums`` are summed over the earlier blocks (columns ``_<name>``); ``firsts`` are taken
    from the first piece of the file. ``_n`` is the number of pieces in earlier
    blocks, ``_first`` the ``at`` of the block's first piece.
    """
    heads = {k: F.min_by(c, "at").alias(k) for k, c in firsts.items()}
    blocks = rows.groupBy("path", "block").agg(
        F.min("at").alias("_first"), F.count("*").alias("_n"), *[F.sum(c.cast("long")).alias(f"_{k}") for k, c in sums.items()],
        *heads.values())
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    names = ["_n", *(f"_{k}" for k in sums)]
    return stored(blocks.select(
        "path", "block", "_first", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in names],
        *[F.first(k).over(order).alias(k) for k in heads]))


def place() -> Column:
    """Place of a piece in its file, from 0, of rows that were joined with :func:`sums_before`."""
    return F.col("_n") + F.col("at") - F.col("_first")


def running_counts(rows: DataFrame, marks: dict[str, Column], **firsts: Column) -> DataFrame:
    """Add ``line_no`` and, for each mark, the number of marked rows of the file so far, the row itself included.

    ``firsts`` are taken from the first piece of the file, as in :func:`sums_before`.

    Counting goes along the scan in whole Arrow batches and starts anew in every block; the
    sums of the earlier blocks are added by a join. ``rows`` come straight from
    :func:`pieces`.
    """
    names = list(marks)
    own = rows.withColumns({f"_is_{k}": c for k, c in marks.items()})
    before = sums_before(own, {k: F.col(f"_is_{k}") for k in names}, **firsts)
    keyed = own.withColumn("_key", F.xxhash64("path", "block"))
    schema = T.StructType(keyed.schema.fields + [T.StructField(k, T.LongType()) for k in names])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, dict.fromkeys(names, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("_key").to_numpy()
            starts = np.flatnonzero(key[1:] != key[:-1]) + 1
            part = np.zeros(len(key), dtype=np.int64)
            part[starts] = 1
            part = np.cumsum(part)
            columns = list(batch.columns)
            for k in names:
                so_far = np.cumsum(batch.column(f"_is_{k}").to_numpy(zero_copy_only=False).astype(np.int64))
                if key[0] == last:
                    so_far += carried[k]
                inside = so_far - np.concatenate([[0], so_far[starts - 1]])[part]
                carried[k] = int(inside[-1])
                columns.append(pa.array(inside))
            last = key[-1]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    counted = keyed.mapInArrow(count, schema).join(before, ["path", "block"])
    return counted.select("path", place().alias("line_no"), "value", *firsts, *[(F.col(k) + F.col(f"_{k}")).alias(k) for k in names])
