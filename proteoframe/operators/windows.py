"""Positional views of residue strings that need no shuffle.

A sequence stays inside its own row until it is exploded into positions, and
every position sees its neighbourhood as a short string. Filters and scores
then run in generated code over the scan, before any exchange.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proteoframe.functions import constants as K


def position_windows(df: DataFrame, before: int, after: int, text: str = "sequence",
                     keys: tuple[str, ...] = ("pid",), also: dict[str, Column] | None = None,
                     where: Callable[[Callable[..., Column]], Column] | None = None) -> DataFrame:
    """One row per residue: ``keys, position, seq_len, window``.

    ``window`` holds the residues ``position-before .. position+after``; places
    outside the sequence are ``-``. ``also`` names further strings of the same
    length (recoded copies) to cut in parallel. Strings are cut as bytes: a byte
    slice costs its width, a character slice the distance from the start.

    ``where`` filters positions before any window is built: it gets a function
    ``at(offset, n, name)`` for the ``n`` letters from ``position + offset`` on.
    A filter on the window itself would be pushed below the projection and cut
    the window once for every mention.
    """
    width = before + 1 + after

    def pad(c: Column) -> Column:
        return F.concat(F.lit(K.GAP * before), c, F.lit(K.GAP * after)).cast("binary")

    texts = {"window": F.col(text), **(also or {})}
    # An empty string gives no rows through a null array: a filter would be
    # pushed below whatever made the string and make it twice.
    src = df.select(
        *keys, F.length(text).alias("seq_len"), *[pad(c).alias(n) for n, c in texts.items()]
    )
    rows = src.select(
        *keys, "seq_len", *texts,
        F.explode(F.when(F.col("seq_len") > 0, F.sequence(F.lit(1), F.col("seq_len")))).alias("position"),
    )
    if where is not None:
        def at(offset: int = 0, n: int = 1, name: str = "window") -> Column:
            return F.col(name).substr(F.col("position") + (before + offset), F.lit(n)).cast("string")

        rows = rows.filter(where(at))
    return rows.select(
        *keys, "position", "seq_len",
        *[F.col(n).substr(F.col("position"), F.lit(width)).cast("string").alias(n) for n in texts],
    )


def residues(df: DataFrame, text: str = "sequence", keys: tuple[str, ...] = ("pid",)) -> DataFrame:
    """One row per residue: ``keys, position, aa``."""
    return position_windows(df, 0, 0, text, keys).select(
        *keys, "position", F.col("window").alias("aa")
    )


def runs(df: DataFrame, min_len: int, letters: str | None = None, text: str = "sequence",
         keys: tuple[str, ...] = ("pid",)) -> DataFrame:
    """Maximal runs as ``keys, start, length, residues``.

    ``letters`` gives runs of a residue class, ``None`` runs of one repeated
    residue. Starts and ends are found by looking one residue left and right,
    so both arrays have equal size and zip to the runs in linear time.
    """
    seq = F.col(text)
    if letters is None:
        probe = "(.)\\1{%d}" % (min_len - 1)

        def boundary(ch: Column, i: Column, step: int) -> Column:
            return F.get(ch, i) != F.get(ch, i + step)
    else:
        probe = "[%s]{%d}" % (letters, min_len)

        def boundary(ch: Column, i: Column, step: int) -> Column:
            return F.get(ch, i).isin(*letters) & ~F.get(ch, i + step).isin(*letters)

    padded = F.concat(F.lit(" "), seq, F.lit(" "))
    chars = df.select(
        *keys, seq.alias("_s"), F.length(seq).alias("_n"),
        F.when(seq.rlike(probe), F.split(padded, "")).alias("_ch"),
    )

    def places(step: int) -> Column:
        return F.when(F.col("_ch").isNotNull(), F.filter(
            F.sequence(F.lit(1), F.col("_n")), lambda i: boundary(F.col("_ch"), i, step)))

    ends = chars.select(*keys, "_s", places(-1).alias("first"), places(1).alias("last"))
    pairs = ends.select(
        *keys, "_s",
        F.explode(F.filter(F.arrays_zip("first", "last"),
                           lambda r: r["last"] - r["first"] + 1 >= min_len)).alias("_r"),
    )
    return pairs.select(
        *keys,
        F.col("_r.first").alias("start"),
        (F.col("_r.last") - F.col("_r.first") + 1).alias("length"),
        F.col("_s").substr(F.col("_r.first"), F.col("_r.last") - F.col("_r.first") + 1).alias("residues"),
    )
