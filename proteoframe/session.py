"""Session helpers: checkpoint folder, spreading of scans on request, output tidying."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point the session at the shared checkpoint folder the cluster names.

    Only a local session without the setting (a test) gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    sc.setCheckpointDir(folder)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table next to the checkpoints: computed once, of known size, safe when executors are lost."""
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


_SHARED: ContextVar[dict | None] = ContextVar("shared", default=None)


@contextmanager
def shared_steps() -> Iterator[None]:
    """Inside, a step marked :func:`shared` is stored by its first reader and read by the others."""
    token = _SHARED.set({})
    try:
        yield
    finally:
        _SHARED.reset(token)


def sharing() -> bool:
    """Whether several queries of one result are being made together."""
    return _SHARED.get() is not None


def _once(step: Callable[[SparkSession, str], DataFrame], keep: Callable[[DataFrame], DataFrame]):
    @wraps(step)
    def once(spark: SparkSession, d: str) -> DataFrame:
        steps = _SHARED.get()
        if steps is None:
            return step(spark, d)
        key = (step.__module__, step.__qualname__, d)
        if key not in steps:
            steps[key] = keep(step(spark, d))
        return steps[key]

    return once


def shared(step: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A step ``(spark, folder) -> DataFrame`` that several queries of one result have in common."""
    return _once(step, stored)


def planned(step: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """As :func:`shared`, but readers share the plan, not a table: for columns that are cheap to make
    from a stored table once what they depend on (statistics, ranges) has been found."""
    return _once(step, lambda df: df)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a scan over as many partitions as the session asks for.

    Only a session that sets ``proteoframe.scan.partitions`` gets an exchange: a
    small test file is one row group and would be one task. Without the setting
    the scan stays as the files are.
    """
    n = df.sparkSession.conf.get("proteoframe.scan.partitions", None)
    return df if n is None else df.repartition(int(n), *keys)


def r6(col: Column | str) -> Column:
    """Round a double for output; adding 0.0 turns -0.0 into 0.0."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("double"), 6) + F.lit(0.0)


def tidy(df: DataFrame) -> DataFrame:
    """Integers to BIGINT, floats rounded to six decimals."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = r6(c)
        out.append(c.alias(f.name))
    return df.select(*out)
