r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are
context and only that reply is trainable. Turns after the last reply make one
more example without a loss, so the examples of a conversation always hold all
of it and can be read back.

Template of a turn: ``<|turn|>role<|text|>text<|end|>``. A reserved string inside
a role or text is broken by a backslash after its first character; one that
already has n backslashes there gets n + 1. Other texts stay as they are, and
taking one backslash away restores the original exactly.

Turns are gathered per conversation, which has to fit into a row as its last
example does; examples are made one at a time from the gathered turns, never as
an array of all prefixes.

Defined results: null role and text are empty; rows are ordered by turn (null
first), then role, then text, repeated rows included; rows with a null id form
one conversation; a conversation without a reply has one example without a loss;
an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that must not appear inside a text: the template's own and those of common chat templates.
RESERVED = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
TARGET_ROLE = "assistant"

_OPEN = r"([<\[])"
_REST = "(?=" + "|".join(re.escape(r[1:]) for r in RESERVED) + ")"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + r"(\\*)" + _REST, r"$1$2\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + r"(\\*)\\" + _REST, "$1$2")


def format_examples(conversations: DataFrame, target_role: str = TARGET_ROLE, id_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, example, n_context, text, loss_start, loss_len`` (code points; the loss
    covers ``loss_len`` characters after ``loss_start``; 0 for the example without a loss)."""
    empty = F.lit("")
    turns = conversations.select(F.col(id_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"), F.coalesce(F.col(text_col), empty).alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: F.struct(
        (t["role"] == target_role).alias("target"), F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT)).alias("head"),
        escaped(t["text"]).alias("body"))).alias("turns"))
    at = F.filter(F.transform("turns", lambda t, i: F.when(t["target"] | (i == F.size("turns") - 1), i)), lambda i: i.isNotNull())
    each = whole.select("conv_id", "turns", F.posexplode(at).alias("example", "n_context"))
    last = F.get("turns", F.col("n_context"))
    context = F.array_join(F.transform(F.slice("turns", 1, F.col("n_context")), lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    each = each.select("conv_id", "example", "n_context", context.alias("context"), last.alias("last"))
    return each.select(
        "conv_id", "example", "n_context", F.concat("context", "last.head", "last.body", F.lit(END)).alias("text"),
        (F.length("context") + F.length("last.head")).alias("loss_start"),
        F.when(F.col("last.target"), F.length("last.body")).otherwise(0).alias("loss_len"), F.col("last.target").alias("trainable"))


def parsed_turns(text: Column) -> Column:
    """The turns ``(role, text)`` that a formatted example holds."""
    parts = F.split(text, re.escape(END))
    body = lambda p: F.split(F.substring(p, len(TURN) + 1, F.length(p)), re.escape(TEXT))
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.struct(
        unescaped(F.get(body(p), 0)).alias("role"), unescaped(F.get(body(p), 1)).alias("text")))


def read_back(examples: DataFrame) -> DataFrame:
    """``conv_id, turns, losses, formatted_chars`` from formatted examples: the turns of the
    longest one, and the text under each example's loss mask in order."""
    loss = unescaped(F.substring("text", F.col("loss_start") + 1, F.col("loss_len")))
    df = examples.select("conv_id", "example", "text", F.when(F.col("trainable"), F.struct("example", loss.alias("loss"))).alias("loss"))
    df = df.groupBy("conv_id").agg(F.max_by("text", "example").alias("longest"), F.array_sort(F.collect_list("loss")).alias("losses"),
                                   F.sum(F.length("text")).cast("long").alias("formatted_chars"))
    return df.select("conv_id", parsed_turns(F.col("longest")).alias("turns"), F.transform("losses", lambda x: x["loss"]).alias("losses"), "formatted_chars")
