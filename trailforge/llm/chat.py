"""Chat formatting with array expressions only.

A conversation's turns are collected as structs and sorted; neighbours of the same role
become one block, whose texts are escaped and joined by array aggregation; the blocks are
concatenated. The template is

    <|turn|>role<|say|>text<|end|>                 one block
    <|turn|>role<|say|>text<|next|>text<|end|>     neighbours of one role

`&` is written `&amp;` and `<|` is written `&lt;|` inside roles and texts, so no text holds
a control string and `parse` gives back every turn as it was. The loss mask is kept with
the pieces: of each conversation's `pieces` (text, loss), whose texts in order are the
formatted string, those with `loss` are the assistant's texts.

Defined cases: a null text or role is empty; a null conv_id is a conversation of its own;
turns are ordered by turn (null first), role, text, so ties are stable and repeated rows
stay as turns of their own; other columns are ignored; no rows give no conversations. A
conversation is one output value, so its turns meet in one task whatever the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAY, NEXT, END = "<|turn|>", "<|say|>", "<|next|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _block(turns: Column, begin: Column, end: Column) -> Column:
    """The pieces of one block: what opens it, then each text with what parts it from the next, then what closes it."""
    role = F.get(turns, begin)["role"]
    loss = role == LOSS_ROLE
    texts = F.transform(F.slice(turns, begin + 1, end - begin), lambda t: escape(t["text"]))
    opened = F.array(F.struct(F.concat(F.lit(TURN), escape(role), F.lit(SAY)).alias("text"), F.lit(False).alias("loss")))
    said = F.flatten(
        F.transform(
            texts,
            lambda t, i: F.array(
                F.struct(F.when(i > 0, F.lit(NEXT)).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")),
                F.struct(t.alias("text"), loss.alias("loss")),
            ),
        )
    )
    closed = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    return F.concat(opened, said, closed)


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, formatted, pieces for each conversation."""
    said = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    sorted_turns = df.select(F.col(conv), said.alias("said")).groupBy(conv).agg(F.array_sort(F.collect_list("said")).alias("turns"))
    places = F.sequence(F.lit(0), F.size("turns") - 1)
    starts = F.filter(places, lambda i: (i == 0) | (F.get(F.col("turns"), i)["role"] != F.get(F.col("turns"), i - 1)["role"]))
    blocks = F.transform(
        F.col("starts"), lambda begin, k: _block(F.col("turns"), begin, F.coalesce(F.get(F.col("starts"), k + 1), F.size("turns")))
    )
    return (
        sorted_turns.withColumn("starts", starts)
        .select(conv, F.flatten(blocks).alias("pieces"))
        .select(conv, F.array_join(F.col("pieces")["text"], "").alias("formatted"), "pieces")
    )


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns that a formatted string holds."""
    blocks = F.filter(F.split(formatted, r"\<\|turn\|\>"), lambda b: b != "")
    turns = F.transform(
        blocks,
        lambda b: F.transform(
            F.split(F.substring_index(F.substring_index(b, END, 1), SAY, -1), r"\<\|next\|\>"),
            lambda t: F.struct(unescape(F.substring_index(b, SAY, 1)).alias("role"), unescape(t).alias("text")),
        ),
    )
    return F.flatten(turns)


def loss_text(turns: Column) -> Column:
    """The text under the loss mask: what the turns that `parse` found say in the role that is learned."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == LOSS_ROLE), lambda t: t["text"]), "")


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What `format_conversations` wrote, read back from `formatted` alone: counts and digests of turns and of the text under the loss mask."""
    back = formatted.withColumn("turns", parse(F.col("formatted"))).withColumn("learned", loss_text(F.col("turns")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
