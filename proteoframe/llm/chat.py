"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are
context, only that reply is trainable. If the last turn is not the assistant's,
one more example without a target holds the whole conversation, so that nothing
is lost. A turn is written ``<|role|>`` newline text ``<|end|>`` newline. Control
strings of this and other templates that occur inside a text or role are
broken up by an escape, which ``unescape`` takes back.

Turns are ordered by number, then role, then text; null texts and roles count
as empty; repeated turns are turns of their own; rows with a null conversation
id form one conversation. An empty table gives an empty result. Extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"
#: Openings of control strings: <| </ <s << and [INST] [/INST].
_OPEN = r"(<)(?=[|/s<])|(\[)(?=/?INST\])"


def escape(text: Column) -> Column:
    """Break up control strings: ``~`` becomes ``~0``, and ``~1`` goes behind every opening."""
    return F.regexp_replace(F.replace(text, F.lit("~"), F.lit("~0")), _OPEN, "$1$2~1")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("")), F.lit("~0"), F.lit("~"))


def examples(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """One row per example: ``example`` (from 1), ``text``, and code points ``loss_start`` to ``loss_end``
    (0-based, end excluded; both null without a target); ``last`` marks the one that holds all turns.

    The conversation is formatted once; examples are cut from it row by row, so
    no task holds more than one prefix beside it.
    """
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("_turn"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    piece = F.transform("_turns", lambda t: F.struct(
        t["role"].alias("role"),
        F.concat(F.lit("<|"), F.replace(escape(t["role"]), F.lit("|>"), F.lit("|~1>")), F.lit("|>\n")).alias("head"),
        escape(t["text"]).alias("body")))
    written = convs.select("conv_id", piece.alias("_pieces"))
    widths = F.transform("_pieces", lambda p: F.length(p["head"]) + F.length(p["body"]) + F.lit(len(END)))
    # Where every turn ends: one fold, not one sum per turn.
    ends = F.aggregate(widths, F.array(F.lit(0)), lambda a, w: F.concat(a, F.array(F.element_at(a, -1) + w)))
    spans = F.transform("_pieces", lambda p, i: F.struct(
        (p["role"] == "assistant").alias("target"), (i + 1 == F.size("_pieces")).alias("last"),
        (F.get("_ends", i) + F.length(p["head"])).alias("start"), F.get("_ends", i + 1).alias("end")))
    whole = F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    cut = (written.withColumn("_ends", ends)
           .select("conv_id", whole.alias("_whole"), F.filter(spans, lambda s: s["target"] | s["last"]).alias("_spans"))
           .select("conv_id", "_whole", F.posexplode("_spans").alias("_no", "_span")))
    target = F.col("_span.target")
    return cut.select(
        "conv_id", (F.col("_no") + 1).alias("example"), F.expr("substring(_whole, 1, _span.end)").alias("text"),
        F.when(target, F.col("_span.start")).alias("loss_start"),
        F.when(target, F.col("_span.end") - len(END)).alias("loss_end"), F.col("_span.last").alias("last"))


def loss_text(df: DataFrame) -> Column:
    """The trainable text of an example as it was before escaping; null without a target."""
    return unescape(F.expr("substring(text, loss_start + 1, loss_end - loss_start)"))


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> read back from a formatted text."""
    parts = F.slice(F.split(text, r"<\|end\|>\n"), F.lit(1), F.size(F.split(text, r"<\|end\|>\n")) - 1)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(3)), "|>\n", 1)).alias("role"),
        unescape(F.substr(p, F.locate("|>\n", p, 3) + 3)).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, all read back from its examples."""
    slim = formatted.select(
        "conv_id", F.struct("example", loss_text(formatted).alias("loss")).alias("_loss"),
        F.when(F.col("last"), read_turns(F.col("text"))).alias("_turns"),
        F.length("text").alias("_chars"))
    one = slim.groupBy("conv_id").agg(
        F.max("_turns").alias("_turns"), F.sort_array(F.collect_list("_loss")).alias("_losses"),
        F.sum("_chars").alias("formatted_chars"))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform("_losses", lambda x: F.coalesce(x["loss"], F.lit(""))), "")
    return one.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))
