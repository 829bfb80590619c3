"""Chat formatting: one training example per assistant reply, with all turns before it.

Template, fixed: <|turn|>ROLE<|text|>TEXT<|end|> and a line feed for each turn. Control
strings inside roles and texts are broken up by a backslash after their first character,
and backslashes are doubled, so no text can forge a turn and unescaping gives it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: What chat models read as control strings. Every one starts with a character
#: that differs from a backslash and holds none.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescaped(text: Column) -> Column:
    """A pair of backslashes is one; a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def examples(turns: DataFrame) -> DataFrame:
    """Prefix-target expansion of (conv_id, turn, role, text) rows.

    Returns conv_id, example (from 1), examples (of the conversation), n_turns (in this
    example), formatted, loss_start and loss_end (code points of formatted; only
    the last reply is trainable, its marks are not). Turns that follow the last reply come
    in one more example with an empty loss, so no turn is lost; so does a conversation
    without any reply. Turns are ordered by turn, role, text, nulls first, and repeated
    rows are turns of their own; null roles and texts are empty; a null conv_id is a
    conversation like any other. Other columns are not read. An example holds its whole
    context, so one conversation must fit into a row.
    """
    role, text = escaped(F.coalesce("role", F.lit(""))), escaped(F.coalesce("text", F.lit("")))
    rows = turns.select(
        F.col("conv_id"),
        F.struct(
            F.col("turn"), F.col("role"), F.col("text"),
            F.concat(F.lit(TURN), role, F.lit(TEXT), text, F.lit(END)).alias("piece"),
            F.length(text).alias("chars"),
        ).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    replies = F.expr(
        f"filter(sequence(1, size(t)), i -> coalesce(t[i - 1].role, '') = '{TRAINED}')")
    ends = whole.withColumn("ends", replies).withColumn(
        "ends", F.expr("if(size(ends) = 0 or element_at(ends, -1) < size(t), "
                       "concat(ends, array(size(t))), ends)"))
    each = ends.select(
        "conv_id", F.size("ends").alias("examples"), F.posexplode("ends").alias("at", "n_turns"),
        F.col("t.piece").alias("pieces"), F.element_at("t", F.col("n_turns")).alias("last"))
    built = each.select(
        "conv_id", (F.col("at") + 1).alias("example"), "examples", "n_turns",
        F.array_join(F.slice("pieces", 1, F.col("n_turns")), "").alias("formatted"),
        "last.chars", (F.coalesce("last.role", F.lit("")) == TRAINED).alias("trained"))
    stop = F.length("formatted") - len(END)
    return built.select(
        "conv_id", "example", "examples", "n_turns", "formatted",
        F.when(F.col("trained"), stop - F.col("chars")).otherwise(stop).alias("loss_start"),
        stop.alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted text."""
    pieces = F.filter(
        F.split(formatted, r"<\|end\|>\n"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescaped(F.substring_index(F.substring(p, len(TURN) + 1, 2**31 - 1), TEXT, 1)).alias("role"),
        unescaped(F.substring_index(p, TEXT, -1)).alias("text")))


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The trainable text, read back."""
    return unescaped(F.substring(formatted, start + 1, end - start))


def digests(found: DataFrame) -> DataFrame:
    """One row per conversation of what its examples hold, read back from them."""
    turns = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    each = found.select(
        "conv_id",
        F.struct("example", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss")).alias("loss"),
        F.length("formatted").alias("chars"),
        F.when(F.col("example") == F.col("examples"), F.struct(
            F.col("n_turns").cast("long").alias("n"),
            F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("sha"))).alias("whole"))
    joined = each.groupBy("conv_id").agg(
        F.max("whole").alias("whole"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x.loss), "").alias("loss"))
    return joined.select(
        "conv_id", F.col("whole.n").alias("n_turns"), F.col("whole.sha").alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
