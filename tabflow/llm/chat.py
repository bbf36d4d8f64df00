"""Chat formatting with typed content parts, in DataFrame functions only.

A conversation becomes one string of turns

    <|im_start|>ROLE<|im_sep|>CONTENT<|im_end|>

CONTENT joins the parts of the turn in order: text is escaped, an image, audio or
document part becomes a placeholder. Escaping is reversible: inside roles and texts
every control string gets one backslash after its first character (``</s>`` becomes
``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``), so none is left that reads as control, and
taking one backslash out of each restores the text exactly."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|attachment|>"
# Control strings of common chat templates, escaped wherever a text holds them.
CONTROLS = (START, SEP, END, *PLACEHOLDERS.values(), OTHER, "<|endoftext|>", "<s>", "</s>",
            "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|eot_id|>")
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def _sites(controls, stuffed: bool) -> str:
    """A pattern for the place just after a control string's first character, or for
    the backslash there. Bodies are sorted by length so that the longest is tried first."""
    for c in controls:
        if len(c) < 3 or c[0] not in "<[" or c[1] == "\\" or c[-1] not in ">]":
            raise ValueError(f"control string {c!r} must open with < or [ and close with > or ]")
    mark = r"\\" if stuffed else ""
    return "|".join(
        rf"(?<={re.escape(first)}){mark}(?=\\*(?:"
        + "|".join(re.escape(c[1:]) for c in sorted(controls, key=len, reverse=True) if c[0] == first) + "))"
        for first in sorted({c[0] for c in controls}))


def escape(text: Column, controls=CONTROLS) -> Column:
    return F.regexp_replace(text, _sites(controls, False), r"\\")


def unescape(text: Column, controls=CONTROLS) -> Column:
    return F.regexp_replace(text, _sites(controls, True), "")


def text_part(text: Column) -> Column:
    """A turn's plain text as its one content part; a null text is an empty one."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                            *[F.lit(None).cast(t).alias(n) for n, t in
                              (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def _tokens(p: Column, patch: int, audio_rate: float, page_tokens: int) -> Column:
    """Tokens an attachment expands to; at least one when its size is not known."""
    side = lambda c: F.ceil(F.coalesce(c, F.lit(1)) / F.lit(patch))
    n = (F.when(p["type"] == "image", side(p["width"]) * side(p["height"]))
         .when(p["type"] == "audio", F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * F.lit(audio_rate)))
         .when(p["type"] == "document", F.coalesce(p["pages"], F.lit(1)) * F.lit(page_tokens))
         .otherwise(F.lit(1)))
    return F.greatest(F.lit(1).cast("long"), n.cast("long"))


def format_chats(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                 parts: str = "parts", controls=CONTROLS, loss_roles: tuple[str, ...] = ("assistant",),
                 patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 512) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, spans, attachments,
    attachment_tokens.

    ``parts`` is an array of typed parts (``PART``); the visitor walks it in order.
    ``spans`` has for each turn its start and end in ``formatted`` and the start and end of
    its loss mask (null outside ``loss_roles``), in code points; ``attachments`` has
    turn index, part index, type, ref, tokens and position, in order.

    Turns go by number, nulls first, ties by role and then content; repeated rows are
    turns of their own. A null role, part list or text is empty; null parts are left out;
    a null conv_id is one conversation. A part of another type is an attachment. Other
    columns are ignored; an empty table gives no rows. The turns of one conversation meet
    in one task, as its text is one value; its turns are sorted there once."""
    kept = F.filter(F.coalesce(F.col(parts).cast(f"array<{PART}>"), F.expr(f"cast(array() as array<{PART}>)")), lambda p: p.isNotNull())

    def shown(p: Column) -> Column:
        """The visitor's case for each type of part."""
        out = F.when(p["type"] == "text", escape(F.coalesce(p["text"], F.lit("")), controls))
        for kind, mark in PLACEHOLDERS.items():
            out = out.when(p["type"] == kind, F.lit(mark))
        return out.otherwise(F.lit(OTHER))

    flat = turns.select(F.col(conversation).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), kept.alias("parts"))
    flat = flat.withColumn("shown", F.transform("parts", shown))
    flat = flat.withColumn("content", F.array_join("shown", "")) \
        .withColumn("head", F.concat(F.lit(START), escape(F.col("role"), controls), F.lit(SEP)))
    flat = flat.select(
        "conv_id", "turn", "role", "head", "content", F.col("role").isin(*loss_roles).alias("loss"),
        F.filter(F.transform("parts", lambda p, i: F.struct(
            i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"),
            _tokens(p, patch, audio_rate, page_tokens).alias("tokens"),
            F.aggregate(F.slice("shown", F.lit(1), i), F.lit(0).cast("long"), lambda a, s: a + F.length(s)).alias("within"))),
            lambda a: ~a["type"].eqNullSafe("text")).alias("found"),
        F.length("head").cast("long").alias("head_n"), F.length("content").cast("long").alias("body_n"))
    order = [F.col("turn").asc_nulls_first(), "role", "content", F.to_json("found")]
    spread = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("head_n") + F.col("body_n") + F.lit(len(END))
    placed = flat.withColumn("at", F.coalesce(F.sum(size).over(spread), F.lit(0).cast("long"))) \
        .withColumn("no", F.count(F.lit(1)).over(spread))
    body = F.col("at") + F.col("head_n")
    rows = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "no", F.concat("head", "content", F.lit(END)).alias("segment"),
        F.struct(F.col("at").alias("start"), (F.col("at") + size).alias("end"),
                 F.when(F.col("loss"), body).alias("loss_start"),
                 F.when(F.col("loss"), body + F.col("body_n")).alias("loss_end")).alias("span"),
        F.transform("found", lambda a: F.struct(
            F.col("no").alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"),
            a["tokens"].alias("tokens"), (body + a["within"]).alias("position"))).alias("found"))),
        lambda x, y: x["no"].cast("int") - y["no"].cast("int")).alias("turns"))
    found = F.flatten(F.col("turns.found"))
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.segment"), "").alias("formatted"), F.col("turns.span").alias("spans"),
        found.alias("attachments"),
        F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"))


def read_back(chats: DataFrame, controls=CONTROLS) -> DataFrame:
    """Roles, contents and masked texts parsed from ``formatted`` and its spans alone.

    One split at the end marks gives the turns; the mask of a turn is cut out of its own
    piece, so the reading is linear in the text. ``contents`` restores text; placeholders
    stay."""
    pieces = F.split("formatted", re.escape(END), -1)
    out = chats.withColumn("_p", F.slice(pieces, F.lit(1), F.greatest(F.lit(0), F.size(pieces) - 1)))
    out = out.withColumn("_t", F.transform("_p", lambda s: F.split(s, re.escape(SEP), 2)))
    masked = F.zip_with("_p", "spans", lambda s, m: F.when(
        m["loss_start"].isNotNull(),
        F.substring(s, (m["loss_start"] - m["start"] + 1).cast("int"), (m["loss_end"] - m["loss_start"]).cast("int"))))
    return out.select(
        *chats.columns,
        F.transform("_t", lambda t: unescape(F.substring(t[0], F.lit(len(START) + 1), F.length(t[0])), controls)).alias("roles"),
        F.transform("_t", lambda t: unescape(t[1], controls)).alias("contents"),
        F.transform(F.filter(masked, lambda s: s.isNotNull()), lambda s: unescape(s, controls)).alias("masked"))
