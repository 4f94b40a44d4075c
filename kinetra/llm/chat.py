"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, and written with
a template in which every control string starts with ``<|``::

    <|turn|>ROLE<|body|>TEXT<|next|>TEXT<|end|>

Adjacent turns of one role form one block; ``<|next|>`` keeps their borders,
so the rows can be read back.  Inside roles and texts ``<|`` is escaped by one
more backslash after ``<`` (``<|`` -> ``<\\|``, ``<\\|`` -> ``<\\\\|``), which is
reversible and leaves no control string.

Defined cases: null role or text counts as empty; rows with equal turn numbers
are ordered by role, then text; repeated rows stay; a null conv_id is a
conversation of its own; no rows give no conversations; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, NEXT, END = "<|turn|>", "<|body|>", "<|next|>", "<|end|>"
LOSS_ROLES = ("assistant",)


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def format_conversations(rows: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and
    length, in code points, of each text under the loss mask).

    A conversation is one output string, so its turns meet in one row; that is
    the size the format itself asks for.
    """
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn").alias("turn"), text("role").alias("role"),
        text("text").alias("text")))).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before = F.get(F.col("turns"), i - 1)["role"]
        after = F.get(F.col("turns"), i + 1)["role"]
        opened = F.when((i > 0) & (before == t["role"]), F.lit(NEXT)).otherwise(
            F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY)))
        closed = F.when(after == t["role"], F.lit("")).otherwise(F.lit(END))
        return F.struct(opened.alias("opened"), escape(t["text"]).alias("body"),
                        closed.alias("closed"), t["role"].isin(*loss_roles).alias("loss"))

    pieces = turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    joined = F.array_join(F.transform("pieces", lambda p: F.concat(
        p["opened"], p["body"], p["closed"])), "")

    def advance(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["opened"])
        size = F.length(p["body"])
        span = F.struct(start.alias("start"), size.alias("chars"))
        return F.struct((start + size + F.length(p["closed"])).alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"),
                       F.lit(None).cast("array<struct<start:int,chars:int>>").alias("spans"))
    start = F.struct(nothing["at"].alias("at"),
                     F.coalesce(nothing["spans"], F.array().cast(
                         "array<struct<start:int,chars:int>>")).alias("spans"))
    spans = F.aggregate("pieces", start, advance, lambda a: a["spans"])
    return pieces.select("conv_id", joined.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse ``formatted`` again: conv_id, formatted, turns (role, text as in
    the input rows) and loss_text (all text under the loss mask, unescaped)."""
    blocks = F.filter(F.split("formatted", r"<\|end\|>"), lambda b: b != "")

    def block_turns(b: Column) -> Column:
        role = unescape(F.substring_index(F.substring(b, len(TURN) + 1, 1 << 30), BODY, 1))
        # the role holds no "<|", so the first BODY ends the header
        texts = F.split(F.substring(b, F.instr(b, BODY) + len(BODY), F.length(b)), r"<\|next\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"),
                                                     unescape(t).alias("text")))

    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), s["start"] + 1, s["chars"]))), "")
    return formatted.select("conv_id", "formatted",
                            F.flatten(F.transform(blocks, block_turns)).alias("turns"),
                            loss.alias("loss_text"))


def digest(read: DataFrame) -> DataFrame:
    """The figures that a reader of the output can check against the input."""
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
