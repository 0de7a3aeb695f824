"""Chat transcripts as training examples, one for each assistant turn.

Method (prefix-target expansion). Every assistant turn becomes an example of its own: all
turns before it as context, and only its text trainable. Turns after the last assistant
turn (or a conversation without one) make a last example with nothing trainable, so that
every turn can be read back.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside texts and roles a
backslash goes into every ``<|`` (``<|`` -> ``<\\|`` -> ``<\\\\|`` ...), so no control string
can come from a text, and taking one out again restores it. In roles ``%`` and the newline
are written ``%25`` and ``%0A``.

Size. A conversation is one row while it is expanded (its digest needs it whole); the
examples are exploded from it and never gathered again. As in any prefix expansion the
context of a conversation's examples grows with the square of its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text", target: str = "assistant") -> DataFrame:
    """``turns`` -> one row for each example: conversation id, ``example`` (from 0),
    ``last`` (holds every turn of its conversation), ``formatted``, and the trainable part
    as ``loss_start`` (code points, from 0) and ``loss_length`` (0: nothing).

    Turns go by number, then role and text (ties and repeated rows all stay; null numbers
    first). Null texts and roles are empty; rows with a null id are one conversation. An
    empty table has no examples. Other columns are not read.
    """
    t = turns.select(F.col(conv).alias("conv"), F.struct(
        F.col(turn).alias("turn"), text_of(role).alias("role"), text_of(text).alias("text")).alias("t"))
    c = t.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    c = c.select("conv", F.transform("ts", lambda x: F.struct(
        (x["role"] == target).alias("train"), F.concat(F.lit(START), _role_out(x["role"]), F.lit("\n")).alias("head"),
        escape(x["text"]).alias("body"))).alias("ts"))
    ends = F.filter(F.sequence(F.lit(1), F.size("ts")), lambda n: F.get("ts", n - 1)["train"] | (n == F.size("ts")))
    e = c.select("conv", "ts", F.posexplode(ends).alias("example", "n"))
    aim = F.get("ts", F.col("n") - 1)
    before = F.concat(F.array_join(F.transform(F.slice("ts", 1, F.col("n") - 1), lambda x: F.concat(
        x["head"], x["body"], F.lit(END))), ""), aim["head"])
    e = e.select("conv", "example", (F.col("n") == F.size("ts")).alias("last"), before.alias("before"),
                 aim["body"].alias("body"), aim["train"].alias("train"))
    return e.select(
        F.col("conv").alias(conv), "example", "last", F.concat("before", "body", F.lit(END)).alias("formatted"),
        F.length("before").alias("loss_start"),
        F.when(F.col("train"), F.length("body")).otherwise(0).alias("loss_length"))


def read_back(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted example."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        return F.struct(_role_in(F.substring(role, F.lit(len(START) + 1), F.length(role))).alias("role"),
                        unescape(F.substring(p, F.length(role) + 2, F.length(p))).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def digests(ex: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the examples hold, read back from them: one row for each conversation with
    ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    ts = F.when(F.col("last"), read_back(F.col("formatted")))
    loss = unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length")))
    r = ex.select(F.col(conv).alias("conv"), "example", ts.alias("ts"), loss.alias("loss"), F.length("formatted").alias("chars"))
    r = r.groupBy("conv").agg(
        F.max("ts").alias("ts"), F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("loss"), F.sum("chars").alias("chars"))
    r = r.withColumn("loss", F.array_join(F.transform("loss", lambda x: x["loss"]), ""))
    said = F.array_join(F.transform("ts", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return r.select(
        F.col("conv").alias(conv), F.size("ts").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"))
