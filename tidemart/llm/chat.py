"""Chat formatting by prefix-target expansion (native: built-in functions only).

Every assistant turn becomes an example of its own: all preceding turns are context, only that reply is trainable.

Template: ``<|role|>ROLE<|text|>TEXT<|end|>`` per turn. In roles and texts ``&``, ``<`` and ``[`` are written as
``&amp;``, ``&lt;`` and ``&#91;``, so no text can hold a control string of this template, nor one of the usual kind
(``</s>``, ``[INST]``, ``<|...|>``); replacing them back restores the text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["escape", "unescape", "expand_prefixes", "read_back"]

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def expand_prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text", trainable: str = "assistant") -> DataFrame:
    """Examples ``conv_id, target, text, loss_start, loss_chars``.

    ``target`` is the place (from 0) of the trainable turn; ``text`` holds the conversation up to it. The loss mask
    is the ``loss_chars`` characters (code points) from ``loss_start``. Turns after the last trainable one are the
    context of no reply; so that the output holds every turn, they come in a last example without loss
    (``loss_chars`` 0) that has the whole conversation.

    Turns are ordered by turn, then role, then text, nulls first. Null roles and texts are empty, rows of a null
    ``conv_id`` are one conversation, repeated rows are turns of their own. Empty table: empty result; extra columns
    are ignored. A conversation is one row while it is formatted, since each example holds it up to its reply; rows
    of a conversation are combined before the shuffle.
    """
    convs = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text")))).alias("turns"))
    convs = convs.select("conv_id", F.transform("turns", lambda t: F.struct(
        (t["role"] == trainable).alias("train"), escape(t["text"]).alias("text"),
        F.concat(F.lit(ROLE), escape(t["role"]), F.lit(TEXT), escape(t["text"]), F.lit(END)).alias("formatted")
    )).alias("turns"))
    last = F.size("turns") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: F.col("turns")[i]["train"] | (i == last))
    e = convs.select("conv_id", "turns", F.explode(targets).alias("target"))
    reply = F.col("turns")[F.col("target")]
    chars = F.when(reply["train"], F.length(reply["text"])).otherwise(F.lit(0)).cast("bigint")
    e = e.select("conv_id", F.col("target").cast("bigint").alias("target"), chars.alias("loss_chars"),
                 F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("target") + 1), lambda t: t["formatted"]),
                              "").alias("text"))
    return e.select("conv_id", "target", "text",
                    (F.length("text") - len(END) - F.col("loss_chars")).cast("bigint").alias("loss_start"), "loss_chars")


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples hold, per conversation: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_examples``. Turns are parsed from the longest example, losses cut out by their masks."""
    masked = unescape(F.substring(F.col("text"), F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))
    e = examples.select("conv_id", "target", "text", masked.alias("loss"))
    c = e.groupBy("conv_id").agg(
        F.max_by("text", "target").alias("text"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("target", "loss"))), lambda x: x["loss"]),
                     "").alias("loss"),
        F.sum(F.length("text").cast("bigint")).alias("formatted_chars"), F.count(F.lit(1)).alias("n_examples"))
    marked = F.split(F.col("text"), F.lit(r"<\|end\|>"))
    parsed = F.transform(F.slice(marked, F.lit(1), F.size(marked) - 1), lambda s: F.split(
        F.substring(s, F.lit(len(ROLE) + 1), F.length(s)), r"<\|text\|>"))
    c = c.select("conv_id", "loss", "formatted_chars", "n_examples", parsed.alias("turns"))
    body = F.array_join(F.transform("turns", lambda p: F.concat(
        unescape(p[0]), F.lit("\n"), unescape(p[1]), F.lit("\n"))), "")
    return c.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(body, 256).alias("turns_sha256"),
                    F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.col("formatted_chars").cast("bigint").alias("formatted_chars"), "n_examples")
