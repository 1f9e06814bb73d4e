"""Chat formatting: one training text per conversation, by array expressions only.

Template::

    <s>[INST] user [/INST]assistant</s><<SYS>>role
    text<</SYS>>

A block holds adjacent turns of one role, joined by ``<sep>``. Assistant blocks carry the loss.
Control strings inside texts get a backslash behind their first character (one more if there are
some already), which reading takes away again. A line break in a role is written ``%0A``, and ``%`` in a
role ``%25``, as the role ends with its line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END, SEP = "<s>", "</s>", "<sep>"
USER, USER_END = "[INST] ", " [/INST]"
OTHER, OTHER_END = "<<SYS>>", "<</SYS>>"
#: First character, backslashes, rest of a control string.
_CONTROL = r"(/?s>|sep>|/?INST\]|</?SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){_CONTROL}", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){_CONTROL}", r"$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    lines = F.replace(unescape(role), F.lit("%0A"), F.lit("\n"))
    return F.replace(lines, F.lit("%25"), F.lit("%"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted`` from rows ``conv_id, turn, role, text``.

    A conversation's turns are collected, sorted by turn, role and text, and adjacent turns of one
    role become one block. Null text and null role count as empty, null turns come first, rows
    without ``conv_id`` are one conversation, repeated rows are turns like others, an empty table
    gives no rows, other columns play no part. A conversation is one text, so it is gathered in
    one task.
    """
    role = F.coalesce(F.col("role"), F.lit("")).alias("role")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    sorted_turns = F.sort_array(F.collect_list(F.struct("turn", role, text)))
    conversations = turns.groupBy("conv_id").agg(sorted_turns.alias("turns"))
    turns_ = F.col("turns")

    def opens(i):
        return (i == 1) | (F.element_at(turns_, i).role != F.get(turns_, i - 2).role)

    starts = F.filter(F.sequence(F.lit(1), F.size(turns_)), opens)
    conversations = conversations.withColumn("starts", starts)
    starts_ = F.col("starts")

    def block(start, k):
        stop = F.coalesce(F.get(starts_, k + 1), F.size(turns_) + 1)
        merged = F.transform(F.slice(turns_, start, stop - start), lambda t: escape(t.text))
        body = F.array_join(merged, SEP)
        role = F.element_at(turns_, start).role
        return (
            F.when(role == "user", F.concat(F.lit(USER), body, F.lit(USER_END)))
            .when(role == "assistant", F.concat(body, F.lit(END)))
            .otherwise(F.concat(F.lit(OTHER), escape_role(role), F.lit("\n"), body, F.lit(OTHER_END)))
        )

    blocks = F.array_join(F.transform(starts_, block), "")
    return conversations.select("conv_id", F.concat(F.lit(BEGIN), blocks).alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """Array of ``role, text`` read back from a formatted conversation."""
    pattern = r"(?s)\[INST\] .*? \[/INST\]|<<SYS>>.*?<</SYS>>|.*?</s>"
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted))
    blocks = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))

    def turns(role, inside):
        return F.transform(
            F.split(inside, SEP, -1),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    def inside(block, before, after):
        count = F.length(block) - len(before) - len(after)
        return F.substring(block, F.lit(len(before) + 1), count)

    def read(block):
        other = inside(block, OTHER, OTHER_END)
        line = F.instr(other, "\n")
        return (
            F.when(
                block.startswith(USER) & block.endswith(USER_END),
                turns(F.lit("user"), inside(block, USER, USER_END)),
            )
            .when(
                block.startswith(OTHER) & block.endswith(OTHER_END),
                turns(
                    unescape_role(F.substring(other, F.lit(1), line - 1)),
                    F.substring(other, line + 1, F.length(other)),
                ),
            )
            .otherwise(turns(F.lit("assistant"), inside(block, "", END)))
        )

    return F.flatten(F.transform(blocks, read))


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: the assistant's texts in order, nothing between."""
    assistant = F.filter(turns, lambda t: t.role == "assistant")
    return F.array_join(F.transform(assistant, lambda t: t.text), "")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests read back from ``formatted``."""
    read = formatted.withColumn("turns", read_turns(F.col("formatted")))
    read = read.withColumn("loss", loss_text(F.col("turns")))
    whole = F.transform(
        "turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(whole, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
