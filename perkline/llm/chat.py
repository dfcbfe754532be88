"""Chat formatting with Spark expressions only.

Turns become structs, are sorted inside their conversation, neighbours of one role are merged
into one block, and the blocks are joined into a text. The template is

    <|im_start|>role NEWLINE text <|im_sep|> text <|im_end|> NEWLINE

where ``<|im_sep|>`` parts the turns that were merged. Inside texts and roles ``<|`` cannot occur:
one backslash is put between ``<`` and ``|``, one more where backslashes already stand between
them, so it can be taken out again and every text comes back as it was.

Defined cases: a null text or role is empty; turns with equal numbers go by role, then text;
turns without a number come first; a repeated row is a further turn; rows without a conversation id
form one conversation without id; no rows give no conversations. Columns other than the four
named ones are ignored, whatever their names.

A conversation is one text, so its turns meet in one row; all work on them is linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def format_chats(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` and ``formatted``.

    ``segments`` are the parts of ``formatted`` in order, as (text, loss): the parts with
    ``loss`` are the (escaped) texts of ``learned_role`` and nothing else.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    turns = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.regexp_replace(escaped(role), "\n", NEWLINE).alias("role"),
            escaped(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
            (role == learned_role).alias("loss"),
        ).alias("said"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))

    def lead_in(turn: Column, i: Column) -> Column:
        before = F.get(F.col("said"), i - 1)["role"]
        opening = F.concat(F.lit(START), turn["role"], F.lit("\n"))
        return (
            F.when(before == turn["role"], F.lit(SEPARATOR))
            .when(i == 0, opening)
            .otherwise(F.concat(F.lit(END), opening))
        )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    pieces = F.flatten(
        F.transform(
            "said",
            lambda t, i: F.array(segment(lead_in(t, i), F.lit(False)), segment(t["text"], t["loss"])),
        )
    )
    tail = F.array(segment(F.lit(END), F.lit(False)))
    return grouped.select("conv_id", F.concat(pieces, tail).alias("segments")).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    blocks = F.split(formatted, r"<\|im_end\|>\n")
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.char_length(role) + 2, F.char_length(block))
        role = F.substring(role, F.lit(len(START) + 1), F.char_length(role))
        role = unescaped(F.replace(role, F.lit(NEWLINE), F.lit("\n")))
        return F.transform(
            F.split(body, r"<\|im_sep\|>"),
            lambda text: F.struct(role.alias("role"), unescaped(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescaped(s["text"])), "")
