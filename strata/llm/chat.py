"""Relational chat formatting with Spark expressions only.

Turn structs are collected and sorted per conversation, adjacent turns of one
role are merged into one block with array functions, and the pieces are
concatenated. Template, per block::

    <|im_start|>ROLE\\nTEXT(<|im_sep|>TEXT)*<|im_end|>\\n

``<|im_sep|>`` stands between the turns merged into one block, so turns can
be read back. Inside texts and roles every ``<|`` is written ``<||`` (undone
by the inverse replacement), so no text can hold a marker; in roles ``\\`` and
line feeds are escaped too, so the first line feed ends the role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, text_or_empty

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escaped(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("<||"))


def unescaped(c: Column) -> Column:
    return F.replace(c, F.lit("<||"), F.lit("<|"))


def escaped_role(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return escaped(F.replace(c, F.lit("\n"), F.lit("\\n")))


def unescaped_role(c: Column) -> Column:
    # Backslash pairs are parked on a marker that escaped roles cannot hold.
    c = F.replace(c, F.lit("\\\\"), F.lit(SEP))
    return unescaped(F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit(SEP), F.lit("\\")))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text",
                         loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``segments``.

    ``segments`` is an array of ``(text, loss)`` in order, whose texts
    concatenate to ``formatted``; ``loss`` marks exactly the (escaped) texts
    of ``loss_role``, without markers.

    Turns are ordered by turn, then role, then text (ties; repeated rows stay
    repeated turns), a null turn first. Null texts and null roles count as
    empty; rows with a null id form one conversation with a null id; an empty
    table gives an empty result; other input columns are ignored.

    A conversation is one output row, so one conversation must fit in a row.
    """
    turn = F.struct(col(turn_col).alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
                    text_or_empty(text_col).alias("text"))
    convs = turns.groupBy(col(conv_col)).agg(F.array_sort(F.collect_list(turn)).alias("_t"))
    n = F.size("_t")
    at = F.sequence(F.lit(0), n - 1)
    t = F.col("_t")

    def role_of(i):
        return F.get(t, i)["role"]

    def pieces(i):
        # Adjacent turns of one role share a block: header only at its first
        # turn, footer only at its last, a separator in between.
        first = (i == 0) | (role_of(i) != role_of(i - 1))
        last = (i == n - 1) | (role_of(i) != role_of(i + 1))
        head = F.when(first, F.concat(F.lit(START), escaped_role(role_of(i)), F.lit("\n"))).otherwise(F.lit(SEP))
        foot = F.when(last, F.lit(END + "\n")).otherwise(F.lit(""))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(F.get(t, i)["text"]).alias("text"), (role_of(i) == loss_role).alias("loss")),
            F.struct(foot.alias("text"), F.lit(False).alias("loss")))

    segments = F.filter(F.flatten(F.transform(at, pieces)), lambda s: s["text"] != "")
    return (convs.select(col(conv_col), segments.alias("segments"))
            .withColumn("formatted", F.array_join(F.col("segments")["text"], "")))


def parse_turns(formatted: Column) -> Column:
    """Turns ``(role, text)`` read back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, _literal(END + "\n"), -1), lambda b: b != "")

    def turns_of(b):
        body = F.replace(b, F.lit(START), F.lit(""))
        role = F.substring_index(body, "\n", 1)
        texts = F.substr(body, F.length(role) + 2)
        return F.transform(F.split(texts, _literal(SEP), -1),
                           lambda x: F.struct(unescaped_role(role).alias("role"), unescaped(x).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def _literal(marker: str) -> str:
    return "\\Q" + marker + "\\E"
