"""Chat formatting over typed content parts, in DataFrame functions only.

A turn's content is an array of parts ``struct<type, text, ref, width, height,
seconds, pages>``. The visitor (`visit_parts`) flattens the parts in order into
one string: a text part gives its escaped text, an image, audio or document
part a placeholder ``<|type|>``. Each attachment is recorded with its place,
its reference and the number of tokens that the placeholder stands for.

Template: ``<s>`` then per turn ``[INST]role<|text|>body[/INST]`` for turns the
model reads, ``<|reply|>role<|text|>body</s>`` for turns it learns, and
``<|end|>``. Control strings inside a role or a text are escaped by one
backslash after their first character, one more if backslashes stand there
already, so ``</s>`` becomes ``<\\/s>`` and ``<\\/s>`` becomes ``<\\\\/s>``. That is
reversible, and the formatted text holds a control string only where the
template wrote it. `parse_chat` reads the formatted string back.

Defined results: null text or role counts as empty, an unknown part type is
kept as a document placeholder, null conversation ids form one conversation,
turns are ordered by turn, then role, text (null turns first), rows that
repeat are turns of their own, an empty table gives an empty table. A
conversation is one row of the result, so it must fit into memory as a whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import table

PART = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("ref", T.StringType()), T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()), T.StructField("seconds", T.DoubleType()),
    T.StructField("pages", T.IntegerType()),
])

BEGIN, END = "<s>", "<|end|>"
READ, READ_END = "[INST]", "[/INST]"
LEARN, LEARN_END = "<|reply|>", "</s>"
BODY = "<|text|>"
MEDIA = ("image", "audio", "document")
PLACEHOLDER = {kind: f"<|{kind}|>" for kind in MEDIA}
CONTROLS = [BEGIN, END, READ, READ_END, LEARN, LEARN_END, BODY, *PLACEHOLDER.values()]

_TAILS = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
#: Each control string begins with < or [ and holds neither again, so matches cannot overlap.
ESCAPE = rf"([<\[])(\\*)({_TAILS})"
UNESCAPE = rf"([<\[])\\(\\*)({_TAILS})"


def escape(col: Column) -> Column:
    return F.regexp_replace(col, ESCAPE, r"$1\\$2$3")


def unescape(col: Column) -> Column:
    return F.regexp_replace(col, UNESCAPE, "$1$2$3")


def expanded_tokens(part: Column, patch: int = 14, audio_rate: float = 50.0, page_tokens: int = 1024) -> Column:
    """Tokens that a placeholder stands for: image patches, audio frames, document pages; at least 1."""
    side = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / F.lit(patch))
    n = (F.when(part["type"] == "image", side(part["width"]) * side(part["height"]))
         .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(audio_rate)))
         .when(part["type"] == "text", F.lit(0))
         .otherwise(F.coalesce(part["pages"], F.lit(1)) * F.lit(page_tokens)))
    return F.when(part["type"] == "text", F.lit(0)).otherwise(F.greatest(n, F.lit(1))).cast("long")


def kind_of(part: Column) -> Column:
    kind = F.lower(F.coalesce(part["type"], F.when(part["ref"].isNull(), F.lit("text")).otherwise(F.lit("document"))))
    return F.when(kind.isin("text", *MEDIA), kind).otherwise(F.lit("document"))


def visit_parts(parts: Column) -> Column:
    """The visitor: each part to its rendered string, in order."""
    def render(p: Column) -> Column:
        kind = kind_of(p)
        return (F.when(kind == "text", escape(F.coalesce(p["text"], F.lit(""))))
                .otherwise(F.concat(F.lit("<|"), kind, F.lit("|>"))))
    return F.transform(F.coalesce(parts, F.array().cast(T.ArrayType(PART))), render)


def attachments_of(parts: Column, turn_no: Column) -> Column:
    """The attachments of a turn: turn and part number, type, reference, expanded token count."""
    def record(p: Column, i: Column) -> Column:
        kind = kind_of(p)
        return F.struct(turn_no.cast("long").alias("turn_no"), i.cast("long").alias("part_no"), kind.alias("type"),
                        p["ref"].alias("ref"), expanded_tokens(p.withField("type", kind)).alias("tokens"))
    return F.filter(F.transform(F.coalesce(parts, F.array().cast(T.ArrayType(PART))), record),
                    lambda a: a["type"] != "text")


def text_part(text: Column) -> Column:
    """A plain text as an array of one text part."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                    F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
                    F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
                    F.lit(None).cast("int").alias("pages"))
    return F.array(part)


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                parts_col: str = "parts", learn_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``formatted``, ``attachments`` and ``expanded_tokens`` (sum over attachments)."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    learn = role.isin(*learn_roles)
    body = F.concat_ws("", visit_parts(F.col(parts_col)))
    head = F.when(learn, F.lit(LEARN)).otherwise(F.lit(READ))
    tail = F.when(learn, F.lit(LEARN_END)).otherwise(F.lit(READ_END))
    # Turns of one number are in the order of their roles, then of their parts as given, not as escaped.
    row = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), F.col(parts_col).alias("parts"),
                   F.concat(head, escape(role), F.lit(BODY), body, tail).alias("line"))
    per = turns.select(F.col(conv_col).alias("conv_id"), row.alias("row"))
    per = per.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    found = F.flatten(F.transform("rows", lambda r, i: attachments_of(r["parts"], i)))
    return per.select(
        F.col("conv_id").alias(conv_col),
        F.concat(F.lit(BEGIN), F.concat_ws("", F.transform("rows", lambda r: r["line"])), F.lit(END)).alias("formatted"),
        found.alias("attachments")).withColumn(
        "expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))


def parse_chat(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of role, body (unescaped, placeholders left) and learn (in the mask)."""
    # A raw turn end is the only place where the string can be cut: texts hold no raw control strings.
    ends = f"(?<={re.escape(READ_END)})|(?<={re.escape(LEARN_END)})"
    inner = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted) - len(BEGIN) - len(END))
    pieces = F.filter(F.split(inner, ends, -1), lambda x: F.length(x) > 0)

    def turn(p: Column) -> Column:
        learn = p.startswith(F.lit(LEARN))
        head = F.when(learn, F.lit(len(LEARN))).otherwise(F.lit(len(READ)))
        tail = F.when(learn, F.lit(len(LEARN_END))).otherwise(F.lit(len(READ_END)))
        core = F.substring(p, head + 1, F.length(p) - head - tail)
        at = F.instr(core, BODY)
        return F.struct(unescape(F.substring(core, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substring(core, at + len(BODY), F.length(core))).alias("body"),
                        learn.alias("learn"))
    return F.transform(pieces, turn)


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted, and digests of what is read back from the output."""
    control = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(control).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = format_chat(rows.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))
    back = out.select("conv_id", "formatted", parse_chat(F.col("formatted")).alias("t"))
    every = F.concat_ws("", F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["body"], F.lit("\n"))))
    loss = F.concat_ws("", F.transform(F.filter("t", lambda x: x["learn"]), lambda x: x["body"]))
    return back.select("conv_id", F.size("t").cast("long").alias("n_turns"),
                       F.sha2(every.cast("binary"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


_LEN = {c: len(c) for c in CONTROLS}
ORACLE_SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, role = 'assistant' AS learn,
             length(role) + len(regexp_extract_all(role, '{ESCAPE}'))
             + length(body) + len(regexp_extract_all(body, '{ESCAPE}')) AS written FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
       coalesce(sum(length(body)) FILTER (WHERE learn), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(body, '' ORDER BY turn NULLS FIRST, role, body) FILTER (WHERE learn), '')) AS loss_sha256,
       ({_LEN[BEGIN] + _LEN[END]} + sum(written + {_LEN[BODY]}
        + CASE WHEN learn THEN {_LEN[LEARN] + _LEN[LEARN_END]} ELSE {_LEN[READ] + _LEN[READ_END]} END))::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""

QUERIES = {"op4_chat_format": op4_chat_format}
ORACLE = {"op4_chat_format": ORACLE_SQL}
