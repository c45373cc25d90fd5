"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, its text alone is trained on. A
conversation that doesn't end with an assistant turn gives one more example without a target, so that no turn is lost.

The template marks a turn ``<|start|>role\\ntext<|end|>\\n``. Control strings of this and other common templates inside a text
are broken by a backslash, and backslashes before which that matters are doubled: :func:`unescape` gives the text back.

Rows of a conversation meet in one shuffle; a conversation is one row from then on, as its digests need it whole.
Defined results: a null role or text is empty; turns with equal numbers are ordered by role and text, null turns first;
a null conv_id is a conversation. Extra columns are ignored. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|start|>", "<|end|>"
#: What follows < or [ in the control strings of common templates. None holds such a sign itself, so no escape hides another.
_CONTROLS = r"\||/?s>|/?INST\]|/?SYS>>|start_of_turn>|end_of_turn>"


def escape(text: Column) -> Column:
    """Double the backslashes, then put one after the first sign of a control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])(?={_CONTROLS})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, rf"([<\[])\\(?={_CONTROLS})", "$1"), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role is a line: per cent signs, line ends and the marks' first sign are written by their numbers."""
    for sign, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(sign), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for sign, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(sign))
    return role


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example (from 0), last (the conversation's last), formatted, loss_start, loss_chars: a row an example.

    ``loss_start`` counts code points from 0 in ``formatted``; it is null, and loss_chars 0, where nothing is trained on.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))

    def written(t: Column) -> Column:
        role, text = escape_role(t["role"]), escape(t["text"])
        head = F.concat(F.lit(START), role, F.lit("\n"))
        return F.struct(
            F.concat(head, text, F.lit(END + "\n")).alias("out"),
            F.char_length(head).alias("head"),
            F.char_length(text).alias("text"),
            (t["role"] == "assistant").alias("reply"),
        )

    made = whole.select("conv_id", F.transform("ts", written).alias("ts"))
    made = made.select("conv_id", "ts", F.array_join(F.transform("ts", lambda t: t["out"]), "").alias("all"), F.size("ts").alias("n"))
    # where each turn ends in the whole text
    ends = F.aggregate(
        F.transform("ts", lambda t: F.char_length(t["out"]).cast("long")),
        F.array(F.lit(0).cast("long")),
        lambda s, n: F.concat(s, F.array(F.element_at(s, -1) + n)),
    )
    made = made.withColumn("ends", ends)
    spans = F.filter(
        F.transform("ts", lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda x: x["t"]["reply"] | (x["i"] == F.col("n") - 1)
    )
    spans = F.transform(
        spans,
        lambda x: F.struct(
            F.get(F.col("ends"), x["i"]).alias("begin"), F.get(F.col("ends"), x["i"] + 1).alias("end"), x["t"]["head"].alias("head"), x["t"]["text"].alias("text"), x["t"]["reply"].alias("reply")
        ),
    )
    each = made.select("conv_id", "all", F.size(spans).alias("count"), F.posexplode(spans).alias("example", "x"))
    return each.select(
        "conv_id",
        "example",
        (F.col("example") == F.col("count") - 1).alias("last"),
        F.substring("all", F.lit(1), F.col("x.end").cast("int")).alias("formatted"),
        F.when(F.col("x.reply"), F.col("x.begin") + F.col("x.head")).alias("loss_start"),
        F.when(F.col("x.reply"), F.col("x.text").cast("long")).otherwise(F.lit(0).cast("long")).alias("loss_chars"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|start\|>", -1), lambda p, i: i > 0)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.char_length(F.substring_index(p, "\n", 1)) + 2, F.char_length(p) - F.char_length(F.substring_index(p, "\n", 1)) - len(END) - 2)).alias("text"),
        ),
    )


def read_back(made: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the examples' texts and spans."""
    turns = turns_of(F.col("formatted"))
    loss = unescape(F.substring("formatted", F.coalesce(F.col("loss_start"), F.lit(0)).cast("int") + 1, F.col("loss_chars").cast("int")))
    rows = made.select(
        "conv_id",
        "example",
        F.when(F.col("last"), turns).alias("turns"),
        loss.alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    rows = rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.struct("example", "loss").alias("loss"),
        "formatted_chars",
    )
    out = rows.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), F.array_join(F.transform(F.array_sort(F.collect_list("loss")), lambda x: x["loss"]), "").alias("loss"), F.sum("formatted_chars").alias("formatted_chars")
    )
    return out.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
