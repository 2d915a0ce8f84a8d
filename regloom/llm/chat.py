"""Relational chat formatting in Spark expressions only: rows to one string for each conversation, and back.

A run of adjacent turns of one role becomes one block:

    <s>role[INST]text[/INST]text ...</s>

Escaping doubles backslashes and puts one into each control string, so no control string is left within a text or a role
and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, NEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = (OPEN, CLOSE, HEAD, NEXT)


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in _CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    out = text
    for mark in reversed(_CONTROL):
        out = F.replace(out, F.lit(mark[0] + "\\" + mark[1:]), F.lit(mark))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows to (conv_id, formatted), one row for each conversation.

    Turns stand in the order of turn, then role, then text. Null texts and roles are empty; null turns come first; null
    conv_ids form one conversation; repeated rows are turns of their own; other columns are not read. A conversation is
    one output string, so its turns meet in one task; different conversations never do.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    g = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).groupBy("conv_id").agg(turns.alias("t"))
    role = lambda i: F.get(F.col("t"), i)["role"]  # noqa: E731  null outside the array

    def piece(x: Column, i: Column) -> Column:
        starts = ~role(i - 1).eqNullSafe(x["role"])
        ends = ~role(i + 1).eqNullSafe(x["role"])
        head = F.when(starts, F.concat(F.lit(OPEN), escape(x["role"]), F.lit(HEAD))).otherwise(F.lit(NEXT))
        return F.concat(head, escape(x["text"]), F.when(ends, F.lit(CLOSE)).otherwise(F.lit("")))

    return g.select("conv_id", F.array_join(F.transform("t", piece), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns in a formatted string."""
    blocks = F.filter(F.split(formatted, "</s>", -1), lambda b: b != "")

    def turns(b: Column) -> Column:
        at = F.instr(b, HEAD)
        role = unescape(b.substr(F.lit(len(OPEN) + 1), at - len(OPEN) - 1))
        texts = F.split(b.substr(at + len(HEAD), F.length(b)), r"\[/INST\]", -1)
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted strings hold, read back from them.

    The loss mask covers the texts of assistant turns, without control strings and escapes.
    """
    loss = F.array_join(F.transform(F.filter("t", lambda x: x["role"] == "assistant"), lambda x: x["text"]), "")
    whole = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("t")).select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
