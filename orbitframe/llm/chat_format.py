"""Chat formatting by prefix-target expansion.

A conversation's turns are written one after another as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings inside roles and texts are escaped reversibly: ``&`` becomes ``&amp;`` and ``<|``
becomes ``&lt;|`` (and a line feed in a role ``&#10;``), so ``<|`` only ever starts a control
string.  Every assistant turn becomes an example: all preceding turns and the header of its own are
the context, and only its text is trainable.  Examples share their conversation's string and name
their part of it by offsets, so a conversation of n turns takes room in proportion to n.

Everything is DataFrame operations.  Defined results: a null text or role is an empty one; turns
with equal numbers are ordered by role and then text, null numbers come first; repeated rows are
repeated turns; rows of a null conv_id form one conversation; a conversation without an assistant
turn has no example; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbitframe.functions.columns import once

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def turn_table(conversations: DataFrame) -> DataFrame:
    """conv_id, n (1, 2, ...), role, piece (the written turn), start (its offset), loss_start and loss_chars."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    rows = rows.withColumn("head", head).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(CLOSE + "\n")))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("piece").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.select(
        "conv_id", F.row_number().over(w).alias("n"), "role", "piece", before.alias("start"),
        F.length("head").alias("head_chars"), F.length("body").alias("body_chars"),
    ).select(
        "conv_id", "n", "role", "piece", "start",
        F.when(F.col("role") == "assistant", F.col("start") + F.col("head_chars")).alias("loss_start"),
        F.when(F.col("role") == "assistant", F.col("body_chars").cast("long")).alias("loss_chars"),
    )


def conversations_formatted(conversations: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, formatted, and examples (n, loss_start, loss_chars), in order."""
    one = F.struct("n", "piece", "loss_start", "loss_chars")
    rows = turn_table(conversations).groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    trained = F.filter("turns", lambda t: t["loss_start"].isNotNull())
    return rows.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(trained, lambda t: F.struct(t["n"].alias("n"), t["loss_start"].alias("loss_start"), t["loss_chars"].alias("loss_chars"))).alias("examples"),
    )


def targets(formatted: Column, examples: Column) -> Column:
    """Each example as (n, context_chars, target): the text that its mask cuts out of formatted, still escaped."""
    cut = lambda f, e: F.substr(f, (e["loss_start"] + 1).cast("int"), e["loss_chars"].cast("int"))
    return once(formatted, lambda f: F.transform(examples, lambda e: F.struct(e["n"].alias("n"), e["loss_start"].alias("context_chars"), cut(f, e).alias("target"))))


def expanded(formatted: DataFrame) -> DataFrame:
    """A row for each example, and one of nulls for a conversation that has none: conv_id, n, context, target and whole.

    context: the written turns before and the header of its own; target: the trainable text, escaped;
    whole: formatted, on a conversation's first row only.
    """
    rows = formatted.select("conv_id", "formatted", targets(F.col("formatted"), F.col("examples")).alias("cut"))
    rows = rows.select("conv_id", "formatted", F.posexplode_outer("cut").alias("at", "e"))
    return rows.select(
        "conv_id", F.col("e.n").alias("n"), F.substr("formatted", F.lit(1), F.col("e.context_chars").cast("int")).alias("context"), F.col("e.target").alias("target"),
        F.when(F.coalesce("at", F.lit(0)) == 0, F.col("formatted")).alias("whole"),
    )


def examples(formatted: DataFrame) -> DataFrame:
    """Each example with its texts: conv_id, n, context (all turns before, and its own header) and target (the trainable text, escaped)."""
    return expanded(formatted).filter("n is not null").select("conv_id", "n", "context", "target")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text; unescaped) as parsed from formatted, and replies, read from the expanded examples.

    A reply is the unescaped target of an example whose context ends where an assistant begins to
    speak; replies are in the order of how much context they have.
    """
    speaks = F.endswith("context", F.lit(OPEN + "assistant\n"))
    reply = F.when(speaks, F.struct(F.octet_length("context").alias("after"), unescape(F.col("target")).alias("text")))
    rows = expanded(formatted).select("conv_id", "whole", reply.alias("reply"))
    rows = rows.groupBy("conv_id").agg(F.first("whole", ignorenulls=True).alias("formatted"), F.sort_array(F.collect_list("reply")).alias("replies"))
    parts = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda x: x != "")
    inner = F.transform(parts, lambda x: F.substr(x, F.lit(len(OPEN) + 1)))
    turns = F.transform(
        inner,
        lambda x: F.struct(
            unescape(F.replace(F.substring_index(x, "\n", 1), F.lit("&#10;"), F.lit("\n"))).alias("role"),
            unescape(F.substr(x, F.instr(x, "\n") + 1)).alias("text"),
        ),
    )
    return rows.select("conv_id", turns.alias("turns"), F.length("formatted").cast("long").alias("formatted_chars"), F.transform("replies", lambda r: r["text"]).alias("replies"))
