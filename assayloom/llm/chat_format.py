"""Chat formatting with Spark expressions only.

`format_chats` sorts the collected turn structs of a conversation, merges adjacent turns of one role with an
array aggregation and concatenates the blocks. Texts are escaped so that no control string of the template can
come from a text, and `read_chats` gives back every turn and the text under the loss mask.

Defined results: a null text is empty, a null role is the empty role, turns sort by (turn, role, text) with a null
turn first, repeated rows are turns of their own, an empty table gives an empty result. A conversation is one
training row, so it is one group; nothing larger than a conversation is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.llm.common import bound, scanned, text_or_empty

#: Role -> opening and closing control string. Any other role is a [ROLE] block that carries its name.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
ROLE_OPEN, ROLE_TEXT, ROLE_CLOSE, NEXT = "[ROLE]", "[TEXT]", "[/ROLE]", "[NEXT]"
#: A control string inside a text, or a backslash: each gets a backslash in front.
CONTROL = r"(\\|\[/?(?:INST|SYS|ROLE)\]|\[(?:TEXT|NEXT)\]|</?s>)"
#: Code points of the pieces that a formatted text is cut into for reading.
CUT = 1024
BLOCK = r"(?s)\[INST\] .*? \[/INST\]|\[SYS\] .*? \[/SYS\]|<s> .*? </s>|\[ROLE\] .*? \[/ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\\[<])", "$1")


def _open(role: Column) -> Column:
    out = F.concat(F.lit(f"{ROLE_OPEN} "), escape(role), F.lit(f" {ROLE_TEXT} "))
    for name, (mark, _) in MARKS.items():
        out = F.when(role == name, F.lit(f"{mark} ")).otherwise(out)
    return out


def _close(role: Column) -> Column:
    out = F.lit(f" {ROLE_CLOSE}")
    for name, (_, mark) in MARKS.items():
        out = F.when(role == name, F.lit(f" {mark}")).otherwise(out)
    return out


def format_chats(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) -> conv_id, formatted, loss_spans array<struct<start,end>>.

    loss_spans are code-point ranges of `formatted`, end exclusive, one for each assistant text (escaped there).
    """
    ordered = (
        turns.select("conv_id", F.struct(F.col("turn").alias("turn"), text_or_empty(F.col("role")).alias("role"), text_or_empty(F.col("text")).alias("text")).alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    # the aggregation over the turns finds where a block of one role starts; the next turn tells where it ends
    head = "struct<role:string,text:string,first:boolean>"
    marked = scanned(
        F.col("turns"),
        F.lit(None).cast("string"),
        lambda role, t: t["role"],
        lambda role, t: F.array(F.struct(t["role"].alias("role"), t["text"].alias("text"), (~role.eqNullSafe(t["role"])).alias("first")).cast(head)),
        f"array<{head}>",
    )
    merged = ordered.select("conv_id", marked.alias("turns"))
    # each turn as pieces: what opens it, its text, what closes it; a piece that counts for the loss is marked
    piece = lambda s, loss: F.struct(s.alias("s"), loss.alias("loss"))

    def pieces(t: Column, i: Column) -> Column:
        after = F.get(F.col("turns"), i + 1)
        return F.array(
            piece(F.when(t["first"], _open(t["role"])).otherwise(F.lit(f" {NEXT} ")), F.lit(False)),
            piece(escape(t["text"]), t["role"] == "assistant"),
            piece(F.when(after.isNull() | after["first"], _close(t["role"])).otherwise(F.lit("")), F.lit(False)),
        )

    cut = merged.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("pieces"))
    place = "struct<start:int,end:int>"
    spans = scanned(
        F.col("pieces"),
        F.lit(0),
        lambda at, p: at + F.length(p["s"]),
        lambda at, p: F.when(p["loss"], F.array(F.struct(at.alias("start"), (at + F.length(p["s"])).alias("end")).cast(place))).otherwise(F.array().cast(f"array<{place}>")),
        f"array<{place}>",
    )
    return cut.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """The output of `format_chats` -> the same with turns array<struct<role,text>> and loss_text, from `formatted` alone."""

    def turns_of(b: Column) -> Column:
        named = F.regexp_extract(b, r"(?s)^\[ROLE\] (.*?) \[TEXT\] ", 1)
        role = F.when(b.startswith("[INST] "), F.lit("user")).when(b.startswith("<s> "), F.lit("assistant")).when(b.startswith("[SYS] "), F.lit("system")).otherwise(unescape(named))
        body = F.regexp_replace(b, r"(?s)^(?:\[INST\]|\[SYS\]|<s>|\[ROLE\] .*? \[TEXT\]) | (?:\[/INST\]|\[/SYS\]|</s>|\[/ROLE\])$", "")
        return F.transform(F.split(body, r" \[NEXT\] ", -1), lambda s: F.struct(role.alias("role"), unescape(s).alias("text")))

    turns = F.flatten(F.transform(F.regexp_extract_all("formatted", F.lit(BLOCK), F.lit(0)), turns_of))
    # the text is cut once; a span is then taken from the few cuts that it lies in, not from the whole text
    cuts = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))

    def under(cuts: Column, s: Column) -> Column:
        first = F.floor(s["start"] / CUT).cast("int")
        many = F.greatest(F.floor((s["end"] - 1) / CUT).cast("int") - first + 1, F.lit(1))
        return F.substring(F.array_join(F.slice(cuts, first + 1, many), ""), s["start"] - first * CUT + 1, s["end"] - s["start"])

    loss = bound(cuts, lambda c: F.concat_ws("", F.transform("loss_spans", lambda s: unescape(under(c, s)))))
    return formatted.select("conv_id", "formatted", "loss_spans", turns.alias("turns"), loss.alias("loss_text"))
