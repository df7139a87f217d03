"""Sequence scans on a stream of FASTA folders.

The scans are projections of one row, so the batch operators run unchanged on
a streaming frame: no state, no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_sequences(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Records of arriving text files ``pid<TAB>sequence``."""
    parts = F.split("value", "\t")
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
        .select(parts[0].cast("bigint").alias("pid"), parts[1].alias("sequence")))


def write_hits(hits: DataFrame, out: str, checkpoint: str):
    """Append the hits of every batch as Parquet; stops when the input is read."""
    return (
        hits.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start())
