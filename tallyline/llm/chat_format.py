"""Conversations with typed content parts as marked training text, and the way back.

A message has a role and a list of parts, each text, image, audio or document. A visitor over the
parts of a message writes text parts escaped and the others as placeholders in order, and records
for each placeholder its reference and the tokens that it expands to. A turn is

    <|turn|>role<|body|>text and placeholders</s>

and a conversation is the text of its turns in order, stored as one row for each turn, so that a
conversation of any length never has to fit in one value. Loss spans cover the text parts of
assistant turns.

Control strings inside texts and roles are broken by a backslash after their first character, and
backslashes are doubled; `unescape` undoes both.

Null roles, texts and part lists count as empty. A part of an unknown or null type leaves nothing, and is
recorded as an attachment without tokens. A medium without size counts as one unit. Turns are ordered by turn, null first, then role
and text; rows with equal values each count. A null conversation id is an id of its own. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template, and those of other templates kept out of texts.
TURN, BODY, END = "<|turn|>", "<|body|>", "</s>"
MEDIA = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
FOREIGN = ["<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
CONTROL = [TURN, BODY, END, *MEDIA.values(), *FOREIGN]

PART = (
    "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
FORMATTED = "conv_id, turn, role, formatted, loss, attachments"

PATCH = 14
AUDIO_TOKENS_PER_SECOND = 25
PAGE_TOKENS = 512

_OPENING = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)
_PIECE = re.compile(r"\\(.)", re.S)


def escape(text: Column) -> Column:
    """`text` without control strings, reversibly; null counts as empty."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({_OPENING})", r"$1\\")


def unescape(text: str) -> str:
    return _PIECE.sub(r"\1", text)


def text_parts(text: Column) -> Column:
    """A message of one text part."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            *(F.lit(None).cast(k).alias(c) for c, k in (("ref", "string"), ("width", "int"), ("height", "int"))),
            F.lit(None).cast("double").alias("seconds"),
            F.lit(None).cast("int").alias("pages"),
        )
    )


def _tokens(part: Column) -> Column:
    units = lambda size, each: F.ceil(F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)) / F.lit(each))
    return (
        F.when(part["type"] == "image", units(part["width"], PATCH) * units(part["height"], PATCH))
        .when(
            part["type"] == "audio",
            F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(1.0)), F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND),
        )
        .when(part["type"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * PAGE_TOKENS)
        .otherwise(F.lit(0))
        .cast("long")
    )


def _placeholder(part: Column) -> Column:
    written = F.when(part["type"] == "text", escape(part["text"]))
    for kind, mark in MEDIA.items():
        written = written.when(part["type"] == kind, F.lit(mark))
    return F.coalesce(written, F.lit(""))


def format_turns(messages: DataFrame) -> DataFrame:
    """One row for each message of (conv_id, turn, role, parts): its text, loss spans, attachments.

    `loss` lists (start, end) in code points of `formatted`; `attachments` lists (place, type, ref,
    tokens) in the order of the parts.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = messages.select("conv_id", "turn", role.alias("role"), F.expr(f"coalesce(cast(parts as array<{PART}>), array())").alias("parts"))
    rows = rows.withColumn("parts", F.filter("parts", lambda p: p.isNotNull()))
    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        "parts",
        F.transform("parts", _placeholder).alias("written"),
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)).alias("head"),
    )
    upto = F.aggregate(
        "written",
        F.array(F.length("head").cast("long")),
        lambda seen, w: F.concat(seen, F.array(F.element_at(seen, -1) + F.length(w))),
    )
    spans = F.filter(
        F.transform(
            "parts",
            lambda p, i: F.when(
                p["type"] == "text",
                F.struct(F.get("upto", i).alias("start"), F.get("upto", i + 1).alias("end")),
            ),
        ),
        lambda s: s.isNotNull(),
    )
    media = F.filter(
        F.transform(
            "parts",
            lambda p, i: F.when(
                ~p["type"].eqNullSafe("text"),
                F.struct(i.alias("place"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")),
            ),
        ),
        lambda s: s.isNotNull(),
    )
    return rows.withColumn("upto", upto).select(
        "conv_id",
        "turn",
        "role",
        F.concat("head", F.array_join("written", ""), F.lit(END)).alias("formatted"),
        F.when(F.col("role") == "assistant", spans).otherwise(F.slice(spans, 1, 0)).alias("loss"),
        media.alias("attachments"),
    )


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and body of a formatted turn, unescaped."""
    role, _, body = formatted.removeprefix(TURN).removesuffix(END).partition(BODY)
    return unescape(role), unescape(body)


def digests(turns: DataFrame) -> DataFrame:
    """For each conversation of formatted turns, what reading them back gives.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). The turns of a
    conversation stream through one task in order; none is held longer than its own row.
    """
    out = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    names = [x.split()[0] for x in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun = None, False
        turns = loss_chars = chars = 0
        all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
        done: list[tuple] = []

        def row():
            return conv, turns, all_turns.hexdigest(), loss_chars, all_loss.hexdigest(), chars

        def batch_of(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        for batch in batches:
            for own, formatted, loss in zip(*(batch.column(k) for k in range(3)), strict=True):
                own, formatted = own.as_py(), formatted.as_py()
                if not begun or own != conv:
                    if begun:
                        done.append(row())
                    conv, begun, turns, loss_chars, chars = own, True, 0, 0, 0
                    all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
                role, body = parse_turn(formatted)
                all_turns.update(f"{role}\n{body}\n".encode())
                turns, chars = turns + 1, chars + len(formatted)
                for span in loss.as_py():
                    text = unescape(formatted[span["start"] : span["end"]])
                    loss_chars += len(text)
                    all_loss.update(text.encode())
            if done:
                yield batch_of(done)
                done = []
        if begun:
            yield batch_of([row()])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.select(F.col("conv_id").cast("long").alias("conv_id"), "formatted", "loss").mapInArrow(run, out)
