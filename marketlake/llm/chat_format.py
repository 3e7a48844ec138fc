"""Operator 8: chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role
form a run, and each run becomes one block of the template:

    <|turn|>ROLE<|text|>TEXT<|next|>TEXT ... <|end|>

``<|next|>`` parts the texts of a run, so merging loses nothing. Inside roles and texts every
control string (of this template and of common others) gets a backslash after its first
character, one more if it has some already; taking one away again restores the text, and a
marker never occurs inside a text. The output is an array of pieces, whose concatenation is the
formatted conversation, and a mask that is true for the pieces to train on: the texts of
the trained role, without markers.

All steps are linear in the turns: runs are slices of the sorted array. A conversation is one
output row, so its text must fit a row; the turns of different conversations are dealt over
all tasks by the conversation's id.

Null texts and roles count as empty; turns sort by turn, then role, then text (null turns
first); repeated rows are turns of their own; rows of a null id form one conversation; an
empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.tables import column

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"
#: What starts a control string, here or in common templates, split after its first character.
_CONTROL = r"(\||/?s>|<SYS>>|</SYS>>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, r"$1$2$3")


def format_chats(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``id_col``, ``pieces`` (array of string), ``mask`` (array of
    boolean, one per piece) and ``formatted`` (all pieces)."""
    clean = lambda c: escape(F.coalesce(column(c).cast("string"), F.lit("")))
    turns = df.select(column(id_col).alias("id"), F.struct(
        column(turn_col).alias("turn"), clean(role_col).alias("role"), clean(text_col).alias("text")).alias("t"))
    sorted_turns = turns.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("t")).withColumn("n", F.size("t"))
    # a run starts where the role differs from the turn before
    starts = sorted_turns.withColumn("starts", F.expr(
        "filter(sequence(0, n - 1), i -> i = 0 OR t[i].role != t[greatest(i - 1, 0)].role)"))
    runs = starts.withColumn("runs", F.expr(
        "transform(starts, (s, k) -> slice(t, s + 1, if(k + 1 < size(starts), starts[least(k + 1, size(starts) - 1)], n) - s))"))
    # a run as pieces: its opening, then each text and what follows it
    pieces = F.expr(f"""flatten(transform(runs, r -> concat(
        array(struct(concat('{TURN}', r[0].role, '{TEXT}') AS piece, false AS train)),
        flatten(transform(r, (x, j) -> array(
            struct(x.text AS piece, x.role = '{trained_role}' AS train),
            struct(if(j + 1 < size(r), '{NEXT}', '{END}') AS piece, false AS train)))))))""")
    done = runs.select("id", pieces.alias("p"))
    return done.select(F.col("id").alias(id_col), F.col("p.piece").alias("pieces"), F.col("p.train").alias("mask"),
                       F.array_join("p.piece", "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, in order: array of struct (role, text)."""
    # blocks end with END and start with TURN; no marker occurs inside a role or text
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")
    return F.flatten(F.transform(blocks, _block_turns))


def _block_turns(block: Column) -> Column:
    parts = F.split(F.substring(block, len(TURN) + 1, 1 << 30), r"<\|text\|>", 2)
    role = unescape(F.element_at(parts, 1))
    return F.transform(F.split(F.element_at(parts, 2), r"<\|next\|>"),
                       lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))


def trained_texts(pieces: Column, mask: Column) -> Column:
    """The texts under the mask, unescaped, in order."""
    paired = F.arrays_zip(pieces.alias("piece"), mask.alias("train"))
    return F.transform(F.filter(paired, lambda x: x["train"]), lambda x: unescape(x["piece"]))
