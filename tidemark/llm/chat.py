"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and
only that reply is trainable. What follows the last reply is kept in one more example
without a trainable part, so nothing of a conversation is lost. Control strings inside
texts and roles are escaped, so a text cannot forge a turn; ``parse_turns`` reads it back.

Examples are cut from one rendered text per conversation, one row at a time, so no row
holds more than one example. A conversation is put in order as a whole: it must fit in a
task's memory (the turns of one conversation, not a group of them).

Defined results: null texts and roles are empty; rows without turn number come first, equal
turn numbers go by role, then text; repeated rows are turns of their own; a conversation
without a reply has the one untrainable example; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template: what opens and what closes a turn of each role.
MARKS = {
    "system": ("<<SYS>> ", " <</SYS>>\n"),
    "user": ("[INST] ", " [/INST]\n"),
    "assistant": ("<s> ", " </s>\n"),
}
OTHER_OPEN, OTHER_BODY, OTHER_CLOSE = "[ROLE] ", " [BODY] ", " [/ROLE]\n"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[BODY]")


def escape(text: Column) -> Column:
    """Control strings as a tilde and a digit; a tilde as ``~t``."""
    out = F.replace(text, F.lit("~"), F.lit("~t"))
    for i, control in enumerate(CONTROLS):
        out = F.replace(out, F.lit(control), F.lit(f"~{i}"))
    return out


def unescape(text: Column) -> Column:
    out = text
    for i, control in enumerate(CONTROLS):
        out = F.replace(out, F.lit(f"~{i}"), F.lit(control))
    return F.replace(out, F.lit("~t"), F.lit("~"))


def _opening(role: Column) -> Column:
    out = F.concat(F.lit(OTHER_OPEN), escape(role), F.lit(OTHER_BODY))
    for name, (opens, _) in MARKS.items():
        out = F.when(role == name, F.lit(opens)).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(OTHER_CLOSE)
    for name, (_, closes) in MARKS.items():
        out = F.when(role == name, F.lit(closes)).otherwise(out)
    return out


def format_chats(conversations: DataFrame) -> DataFrame:
    """Examples: ``conv_id, example, text, loss_start, loss_end`` (code points; null: nothing trainable)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rendered = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("raw"), _opening(role).alias("opens"), escape(text).alias("body"), _closing(role).alias("closes")
    )
    turns = rendered.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(1 << 63))).alias("turn"), "role", "raw", "opens", "body", "closes"))).alias("turns"))
    whole = turns.select(
        "conv_id",
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t["opens"], t["body"], t["closes"]))).alias("whole"),
        # where each turn's text begins and ends, and where the turn does, in code points
        F.aggregate(
            "turns",
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<role:string,start:int,end:int,stop:int>>").alias("spans")),
            lambda done, t: F.struct(
                (done["at"] + F.length(t["opens"]) + F.length(t["body"]) + F.length(t["closes"])).alias("at"),
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(
                            t["role"].alias("role"),
                            (done["at"] + F.length(t["opens"])).alias("start"),
                            (done["at"] + F.length(t["opens"]) + F.length(t["body"])).alias("end"),
                            (done["at"] + F.length(t["opens"]) + F.length(t["body"]) + F.length(t["closes"])).alias("stop"),
                        )
                    ),
                ).alias("spans"),
            ),
        )["spans"].alias("spans"),
    )
    last = F.element_at("spans", -1)
    rest = F.when(last["role"] != "assistant", F.array(F.struct(F.lit("").alias("role"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), last["stop"].alias("stop"))))
    replies = F.filter("spans", lambda s: s["role"] == "assistant")
    examples = whole.select("conv_id", "whole", F.posexplode(F.concat(replies, F.coalesce(rest, F.array().cast("array<struct<role:string,start:int,end:int,stop:int>>")))).alias("example", "span"))
    return examples.select(
        "conv_id", "example", F.substring("whole", F.lit(1), F.col("span.stop")).alias("text"),
        F.col("span.start").alias("loss_start"), F.col("span.end").alias("loss_end"),
    )


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text, ``array<struct<role, text>>``, unescaped."""
    opens = "|".join([r"<<SYS>>", r"\[INST\]", r"<s>", r"\[ROLE\] .*? \[BODY\]"])
    closes = "|".join([r"<</SYS>>", r"\[/INST\]", r"</s>", r"\[/ROLE\]"])
    pattern = f"(?s)({opens}) (.*?) (?:{closes})\n"
    heads = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    bodies = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))

    def turn(head: Column, body: Column) -> Column:
        role = unescape(F.regexp_extract(head, r"(?s)^\[ROLE\] (.*) \[BODY\]$", 1))
        for name, (mark, _) in MARKS.items():
            role = F.when(head == mark.strip(), F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.zip_with(heads, bodies, turn)


def trained_text(text: Column, loss_start: Column, loss_end: Column) -> Column:
    """What stands under the loss mask of an example, unescaped."""
    return F.coalesce(unescape(F.substring(text, loss_start + 1, loss_end - loss_start)), F.lit(""))
