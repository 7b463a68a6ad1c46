"""Chat formatting with Spark expressions only.

Template: a message is ``[INST]role[/INST]part[NEXT]part...</s>``; adjacent
turns of one role share a message.  A control string inside a role or a text
gets a backslash after its first character (one more if it already has some),
so a control string never occurs outside its place and nothing is lost.

Defined cases: a null text or role is the empty string; turns sort by (turn,
role, text), null turns first; rows with a null conv_id form one conversation;
repeated rows are repeated turns; an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed strings of the template.
OPEN, CLOSE, NEXT, END = "[INST]", "[/INST]", "[NEXT]", "</s>"
_PLAIN = r"([\[<])(\\*)(/?INST\]|NEXT\]|/s>)"
_ESCAPED = r"([\[<])\\(\\*)(/?INST\]|NEXT\]|/s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def format_conversations(rows: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments.

    ``segments`` is the formatted text in order as ``struct<text, loss>``; the
    loss mask covers exactly the texts of turns whose role is in ``loss_roles``.
    """
    said = rows.select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    turns = (said.groupBy("conv_id").agg(F.collect_list("t").alias("ts"))
             .select("conv_id", F.array_sort("ts").alias("ts")))

    def role_at(i: Column) -> Column:
        return F.get("ts", i)["role"]

    def pieces(t: Column, i: Column) -> Column:
        same_before = F.coalesce(role_at(i - 1) == t["role"], F.lit(False))
        same_after = F.coalesce(role_at(i + 1) == t["role"], F.lit(False))
        head = F.when(same_before, F.lit(NEXT)).otherwise(
            F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE)))
        tail = F.when(same_after, F.lit("")).otherwise(F.lit(END))
        plain = F.lit(False)
        return F.array(F.struct(head.alias("text"), plain.alias("loss")),
                       F.struct(escape(t["text"]).alias("text"),
                                t["role"].isin(*loss_roles).alias("loss")),
                       F.struct(tail.alias("text"), plain.alias("loss")))

    segmented = turns.select("conv_id", F.flatten(F.transform("ts", pieces)).alias("segments"))
    return segmented.select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, text>>``."""
    messages = F.slice(F.split(formatted, r"</s>", -1), 1,
                       F.greatest(F.size(F.split(formatted, r"</s>", -1)) - 1, F.lit(0)))

    def turns(message: Column) -> Column:
        role = unescape(F.regexp_extract(message, r"(?s)^\[INST\](.*?)\[/INST\]", 1))
        body = F.regexp_extract(message, r"(?s)^\[INST\].*?\[/INST\](.*)$", 1)
        return F.transform(F.split(body, r"\[NEXT\]", -1),
                           lambda part: F.struct(role.alias("role"), unescape(part).alias("text")))

    return F.flatten(F.transform(messages, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
