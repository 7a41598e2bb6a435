"""Chat formatting in Spark expressions: sorted turn structs, merged runs of one role, reversible escapes.

A conversation becomes `<s>` and then, for each run of rows of one role, `[role]text[+]text...</s>`. In roles
and texts the four characters that the marks are made of are written as two others, so a mark inside a text is
no mark: backslash as \\0, `<` as \\1, `[` as \\2 and `]` as \\3. The loss mask is the spans of the assistant
texts, as (start, length) in characters of the formatted string, without marks.

One row per conversation: a conversation is one training example, and its rows meet in one task by one shuffle.

Defined results: null text or role: empty; rows of equal turn are ordered by role and text; repeated rows stay;
a null turn comes first; rows without conv_id are left out; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: characters of the marks and how a text writes them, in the order in which they are written (fixed values)
_ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("]", "\\3"))
_BEGIN, _END, _JOIN = "<s>", "</s>", "[+]"


def escape(text: Column) -> Column:
    """text with no character of a mark in it."""
    for mark, code in _ESCAPES:
        text = F.replace(text, F.lit(mark), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """What escape() was given."""
    for mark, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(mark))
    return text


def formatted(turns: DataFrame) -> DataFrame:
    """Per conversation of rows (conv_id, turn, role, text): conv_id, formatted, mask (array of start, length)."""
    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    ).where("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    same = F.col("role") == F.lag("role").over(order)
    opening = F.concat(F.lit("["), escape(F.col("role")), F.lit("]"))
    pieces = rows.select(
        "conv_id", "role", F.row_number().over(order).alias("n"),
        F.when(same, F.lit(_JOIN)).when(same.isNull(), F.concat(F.lit(_BEGIN), opening))
        .otherwise(F.concat(F.lit(_END), opening)).alias("mark"),
        escape(F.col("text")).alias("body"),
    )
    so_far = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("start", F.coalesce(
        F.sum(F.length("mark") + F.length("body")).over(so_far), F.lit(0)) + F.length("mark"))
    turn = F.struct("n", "mark", "body", "role", "start")
    return pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns")).select(
        "conv_id",
        F.concat(F.array_join(F.transform("turns", lambda t: F.concat(t.mark, t.body)), ""), F.lit(_END))
        .alias("formatted"),
        F.transform(F.filter("turns", lambda t: t.role == "assistant"), lambda t: F.struct(
            t.start.cast("int").alias("start"), F.length(t.body).alias("length"))).alias("mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text) and loss (all text under the mask) from formatted and mask."""
    inner = F.substring("formatted", len(_BEGIN) + 1, F.length("formatted"))
    runs = F.filter(F.split(inner, _END, -1), lambda r: r != "")
    turns = F.flatten(F.transform(runs, lambda run: F.transform(
        F.split(F.substring(run, F.instr(run, F.lit("]")) + 1, F.length(run)), r"\[\+\]", -1),
        lambda text: F.struct(
            unescape(F.substring(F.substring_index(run, "]", 1), 2, F.length(run))).alias("role"),
            unescape(text).alias("text")))))
    loss = F.array_join(F.transform("mask", lambda m: unescape(
        F.substring(F.col("formatted"), m.start + 1, m.length))), "")
    return chats.select("conv_id", turns.alias("turns"), loss.alias("loss"), "formatted")


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted string: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read_back(formatted(turns)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
