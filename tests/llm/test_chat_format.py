"""Chat formatting: round trips, loss spans, attachments."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.llm import chat_format as chat
from tallyline.llm import registry

SCHEMA = f"conv_id long, turn int, role string, parts array<{chat.PART}>, loss string, upto int"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return kind, text, ref, width, height, seconds, pages


ODD = ["", "a\\b", "\\", "<|turn|>", "[INST[INST]</s></s", "<<SYS>>", "\\<|body|>\\\\</s>", "é🙂\n", "<\\|turn|>", "x" * 50000 + "</s>"]


def test_texts_come_back_whatever_they_hold(spark):
    frame = spark.createDataFrame([(t,) for t in ODD], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in frame.collect():
        assert chat.unescape(r.e) == r.t
        assert not any(c in r.e for c in chat.CONTROL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<", "|", "turn", "body", ">", "\\", "/s", "[", "INST]", "a"]), max_size=12).map("".join))
def test_escape_pattern_breaks_every_control_string(text):
    import re

    escaped = re.sub(f"({chat._OPENING})", r"\1\\", text.replace("\\", "\\\\"))
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


def test_parts_become_placeholders_in_order(spark):
    parts = [
        part("text", "see <|image|>"),
        part("image", ref="s3://i", width=28, height=15),
        part("audio", ref="a", seconds=1.5),
        None,
        part("text", "end"),
        part("document", ref="d", pages=3),
        part("film", ref="f"),
        part(None, ref="n"),
    ]
    frame = spark.createDataFrame([(1, 0, "assistant", parts, "x", 1)], SCHEMA)
    row = chat.format_turns(frame).first()
    assert row.formatted == "<|turn|>assistant<|body|>see <\\|image|><|image|><|audio|>end<|document|></s>"
    assert [chat.unescape(row.formatted[s.start : s.end]) for s in row.loss] == ["see <|image|>", "end"]
    assert [(a.place, a.type, a.ref, a.tokens) for a in row.attachments] == [
        (1, "image", "s3://i", 4),
        (2, "audio", "a", 38),
        (4, "document", "d", 1536),
        (5, "film", "f", 0),
        (6, None, "n", 0),
    ]


@pytest.mark.parametrize("role", ["user", None, "<|body|>"])
def test_only_assistant_texts_count_for_the_loss(spark, role):
    frame = spark.createDataFrame([(1, None, role, [part("text", None)], None, None), (1, 2, role, None, None, None)], SCHEMA)
    rows = chat.format_turns(frame).collect()
    assert [r.loss for r in rows] == [[], []]
    assert {chat.parse_turn(r.formatted) for r in rows} == {(role or "", "")}


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_query_over_whole_conversations(spark, sf):
    text = "</s>[INST] ok [/INST]"
    want = {-1: [("user", text), ("assistant", text)]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: tuple(r)[1:5] for r in registry.op3_chat_format(spark, sf).collect()}
    assert got == {k: digest(v) for k, v in want.items()}


def test_repeated_turns_null_ids_and_empty_tables(spark):
    rows = [(None, 1, "user", [part("text", "b")], "", 0), (None, 1, "user", [part("text", "b")], "", 0), (2, None, "assistant", [part("text", "z")], "", 0)]
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.format_turns(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {None: digest([("user", "b")] * 2), 2: digest([("assistant", "z")])}
    assert chat.digests(chat.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0
