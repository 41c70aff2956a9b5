"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, and its reply as the only text under the loss mask. Turns after the
last assistant turn, and conversations without one, end in one more example
that has no target, so that every turn is written somewhere.

A turn is ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. Control strings
inside a role or text get one more backslash after their first character; the
backslashes already there count, so reading takes exactly one away again. A
role's line breaks and backslashes are written as ``\\n`` and ``\\\\``.

Column functions only. A conversation is gathered in one row, as its last
example has to hold all of it anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Strings that some chat template gives a meaning.
_CONTROL = r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>)"
_FIRST = r"([<\[])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"(\\*)" + _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _FIRST + r"\\(\\*)" + _CONTROL, "$1$2$3")


def _role(text: Column) -> Column:
    return escaped(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unrole(text: Column) -> Column:
    # A double backslash stands for itself before anything else is read.
    parts = F.split(unescaped(text), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def examples(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant"
) -> DataFrame:
    """conv_id, example (from 0), formatted, loss_start and loss_end (code points, end exclusive; null without target).

    Turns are in the order of ``turn``, nulls first; equal ones by role, then by
    text. Null roles and texts are empty. Repeated rows are repeated turns.
    Turns with a null conversation id are one conversation. An empty table
    gives no rows. Other columns are not read.
    """
    rows = turns.select(
        turns[conv].cast("long").alias("conv_id"),
        F.struct(
            turns[turn].alias("turn"),
            F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"),
            F.coalesce(turns[text].cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    talks = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    heads = F.transform("turns", lambda t: F.concat(F.lit(START), _role(t["role"]), F.lit("\n")))
    bodies = F.transform("turns", lambda t: escaped(t["text"]))
    talks = talks.select("conv_id", F.transform("turns", lambda t: t["role"] == target).alias("own"), heads.alias("heads"), bodies.alias("bodies"))
    written = F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b, F.lit(END + "\n")))
    talks = talks.select("*", written.alias("written"))
    # Every example: the number of turns before its target, and whether it has one.
    n = F.size("own")
    targets = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("own", i))
    tail = F.when(F.element_at("own", -1), F.expr("CAST(array() AS array<int>)")).otherwise(F.array(n))
    talks = talks.withColumn("at", F.concat(targets, tail))
    out = talks.select("conv_id", "own", "heads", "bodies", "written", F.posexplode("at").alias("example", "k"))
    context = F.array_join(F.slice("written", 1, F.col("k")), "")
    out = out.select("conv_id", "example", context.alias("context"), F.get("heads", F.col("k")).alias("head"), F.get("bodies", F.col("k")).alias("body"))
    has = F.col("head").isNotNull()
    start = F.when(has, F.length("context") + F.length("head"))
    return out.select(
        "conv_id",
        "example",
        F.when(has, F.concat("context", "head", "body", F.lit(END + "\n"))).otherwise(F.col("context")).alias("formatted"),
        start.alias("loss_start"),
        (start + F.length("body")).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted example holds."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        body = part.substr(F.lit(len(START) + 1), F.length(part))
        line = F.locate("\n", body)
        return F.struct(
            _unrole(body.substr(F.lit(1), line - 1)).alias("role"),
            unescaped(body.substr(line + 1, F.length(body))).alias("text"),
        )

    return F.transform(parts, turn)


def read_target(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask as it was before escaping."""
    return unescaped(formatted.substr(start + 1, end - start))


def chat_digest(turns: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from its examples."""
    made = examples(turns)
    read = made.select(
        "conv_id",
        "example",
        F.length("formatted").alias("chars"),
        read_target(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("target"),
        "formatted",
    )
    whole = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", F.coalesce("target", F.lit("")).alias("target")))), lambda x: x["target"]), "").alias("loss"),
    )
    seen = read_turns(F.col("formatted"))
    whole = whole.select("conv_id", seen.alias("turns"), "loss", "formatted_chars")
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
