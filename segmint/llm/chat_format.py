"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it are context and only its
text is trainable.  A conversation that does not end with an assistant turn gets one more example
with all its turns and an empty loss span, so every turn is in the output.

A turn is written as ``<s>[ROLE] role [/ROLE] text </s>``.  A control string inside a role or text gets
a backslash in front, after any backslashes it already has; reading back takes one away.  Signs of
the template follow a blank, never a backslash, so both are told apart in every case.

Defined cases: null role and null text count as empty; turns of one number are ordered by role and
text, a null turn comes first; rows without conv_id are one conversation; other columns are ignored;
an empty table gives no rows.  An example holds its whole context, so a conversation is handled as a
unit: the longest one, not the table, bounds a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the template and common chat templates use as control strings.
CONTROL = r"</?s>|\[/?(?:ROLE|INST)\]"
HEAD, MIDDLE, END = "<s>[ROLE] ", " [/ROLE] ", " </s>"
TURN = r"(?s)<s>\[ROLE\] (.*?) \[/ROLE\] (.*?) </s>"
TARGET = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*)({CONTROL})", r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*)({CONTROL})", "$1$2")


def expand(conversations: DataFrame) -> DataFrame:
    """Examples: conv_id, target (index of the trainable turn or null), is_last, formatted, loss_start, loss_length.

    The loss span counts code points of ``formatted``.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = (turns.groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
             .select("conv_id", F.size("turns").alias("n"), F.col("turns.role").alias("roles"),
                     F.transform("turns", lambda t: escape(t["text"])).alias("texts"),
                     F.transform("turns", lambda t: F.concat(
                         F.lit(HEAD), escape(t["role"]), F.lit(MIDDLE), escape(t["text"]), F.lit(END))).alias("parts")))
    at = F.filter(F.sequence(F.lit(0), F.col("n") - 1),
                  lambda i: (F.get("roles", i) == TARGET) | (i == F.col("n") - 1))
    one = whole.select("conv_id", "n", "roles", "texts", "parts", F.explode(at).alias("i"))
    trained = F.get("roles", F.col("i")) == TARGET
    length = F.when(trained, F.char_length(F.get("texts", F.col("i")))).otherwise(F.lit(0))
    return (one.select("conv_id", F.when(trained, F.col("i")).alias("target"),
                       (F.col("i") == F.col("n") - 1).alias("is_last"),
                       F.array_join(F.slice("parts", F.lit(1), F.col("i") + 1), "").alias("formatted"),
                       length.cast("long").alias("loss_length"))
            .withColumn("loss_start", F.char_length("formatted") - F.lit(len(END)) - F.col("loss_length")))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example: array of (role, text), unescaped."""
    def part(k: int) -> Column:
        return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)), unescape)
    return F.arrays_zip(part(1).alias("role"), part(2).alias("text"))


def read_loss(formatted: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(formatted, start.cast("int") + 1, length.cast("int")))


def digest(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted examples."""
    line = F.transform(F.when(F.col("is_last"), read_turns(F.col("formatted"))),
                       lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    seen = examples.select(
        "conv_id", "target", F.char_length("formatted").cast("long").alias("chars"), line.alias("lines"),
        read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("loss"))
    seen = seen.select("conv_id", "target", "chars", "loss", F.size("lines").alias("n"),
                       F.sha2(F.array_join("lines", ""), 256).alias("sha"))
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(
        F.when(F.col("target").isNotNull(), F.struct("target", "loss")))), lambda x: x["loss"]), "")
    return (seen.groupBy("conv_id")
            .agg(F.max(F.when(F.col("sha").isNotNull(), F.col("n"))).cast("long").alias("n_turns"),
                 F.max("sha").alias("turns_sha256"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
            .select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))
