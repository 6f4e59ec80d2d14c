r"""Chat formatting: conversations to training texts with a loss mask.

Turn structs of a conversation are collected and sorted, adjacent turns of
one role are merged under one header, and everything is concatenated by Spark
expressions only. A block is::

    <|im_start|>ROLE<|im_sep|>TEXT<|im_next|>TEXT<|im_end|>\n

``<|im_next|>`` parts the merged turns, so the turns can be read back. A
control string inside a role or text gets one backslash after its first
character; one that has backslashes there already gets one more, which makes
the escape reversible. Other text is left as it is.

The loss mask is the ``loss`` flag of ``segments``: their texts concatenated
are ``formatted``, and only assistant texts are flagged.

Defined cases: a null text or role is empty; turns sort by (turn, role, text)
with nulls first, so ties and repeated rows keep a fixed order; rows with a
null conversation id form one conversation; an empty table gives no rows;
extra columns are ignored. A conversation is one output row, so it has to fit
a row; conversations are not split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of the template and of other common templates (fixed values).
START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>\n"
AFTER_ANGLE = r"(?:\|\w*\|>|/?s>|</?SYS>>)"
AFTER_BRACKET = r"/?INST\]"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    heads = rf"(<(?=\\*{AFTER_ANGLE})|\[(?=\\*{AFTER_BRACKET}))"
    return F.regexp_replace(text, heads, r"$1\\")


def unescape(text: Column) -> Column:
    heads = rf"(<(?=\\+{AFTER_ANGLE})|\[(?=\\+{AFTER_BRACKET}))\\"
    return F.regexp_replace(text, heads, "$1")


def _literal(marker: str) -> str:
    return rf"\Q{marker}\E"


def format_conversations(df: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its id, ``segments`` (text, loss) and
    ``formatted``."""
    blank = F.lit("")
    turns = df.select(
        F.col(conversation).alias(conversation), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"))
    grouped = (turns.withColumns({"shown_role": escape(F.col("role")), "shown": escape(F.col("text"))})
                    .groupBy(conversation)
                    .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "shown_role", "shown")))
                          .alias("turns")))

    def lead(x: Column, i: Column) -> Column:
        """What stands before a turn's text: a header at a change of role, else the separator."""
        header = F.concat(F.lit(START), x["shown_role"], F.lit(SEP))
        before = F.get(F.col("turns"), i - 1)["role"]
        return (F.when(i == 0, header).when(before == x["role"], F.lit(NEXT))
                 .otherwise(F.concat(F.lit(END), header)))

    def pieces(x: Column, i: Column) -> Column:
        return F.array(
            F.struct(lead(x, i).alias("text"), F.lit(False).alias("loss")),
            F.struct(x["shown"].alias("text"), (x["role"] == ASSISTANT).alias("loss")))

    closing = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    return (grouped.select(conversation,
                           F.concat(F.flatten(F.transform("turns", pieces)), closing).alias("segments"))
                   .withColumn("formatted", F.array_join(F.col("segments.text"), "")))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, from its string alone."""
    parted = F.split(formatted, _literal(START), -1)
    blocks = F.slice(parted, 2, F.size(parted))

    def block_turns(block: Column) -> Column:
        parts = F.split(block, _literal(SEP), 2)
        inner = F.regexp_replace(F.get(parts, 1), rf"{_literal(END)}\z", "")
        return F.transform(F.split(inner, _literal(NEXT), -1),
                           lambda t: F.struct(unescape(F.get(parts, 0)).alias("role"),
                                              unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, block_turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    masked = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return F.array_join(masked, "")
