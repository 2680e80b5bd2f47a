from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, loss string, turns string"


def formatted(spark, rows):
    made = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return chat.format_conversations(made)


NASTY = [
    "</s>[INST] ok [/INST]",
    "<\\s>",
    "<\\\\/s> \\ [\\INST]",
    "<<SYS>>\n<</SYS>>",
    "<<<SYS>>>",
    "[ROLE] x [/ROLE] y </s>",
    "",
    " ",
    "ends with <",
    "s> begins",
    "[",
    "\\",
    "a$1\\$2",
    "long " * 20_000,
    "é\U0001f600\n\n",
]


def test_texts_come_back(spark):
    roles = ["user", "assistant", "system", "tool", None, "we[ROLE]ird", ""]
    rows = [(i, j, roles[(i + j) % len(roles)], NASTY[(i + j) % len(NASTY)]) for i in range(len(NASTY)) for j in range(4)]
    back = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.read_back(formatted(spark, rows)).collect()}
    for i in range(len(NASTY)):
        assert back[i] == [(r or "", t) for c, _, r, t in rows if c == i]


def test_escaped_texts_hold_no_control_string(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string")
    for row in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert row["u"] == row["t"]
        assert not any(c in row["e"] for c in chat.INSTRUCT.control)


def test_digest(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "user", None), (1, 3, "assistant", "é"), (1, 3, "assistant", "é")]
    row = chat.digest(formatted(spark, rows)).first()
    said = "user\na\nassistant\nb\nuser\n\nassistant\né\nassistant\né\n"
    assert row["n_turns"] == 5
    assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert (row["loss_chars"], row["loss_sha256"]) == (3, hashlib.sha256("béé".encode()).hexdigest())


@pytest.mark.parametrize(
    ("roles", "valid", "at"),
    [
        ("user assistant", True, None),
        ("system user assistant user", True, None),
        ("system", False, None),
        ("assistant user", False, 0),
        ("user user assistant", False, 1),
        ("user system", False, 1),
        ("user tool", False, 1),
    ],
)
def test_turn_order(spark, roles, valid, at):
    row = formatted(spark, [(0, i, r, "x") for i, r in enumerate(roles.split())]).first()
    assert (row["valid"], row["failed_at"]) == (valid, at)


def test_segments_make_the_text_and_mark_the_loss(spark):
    row = formatted(spark, [(0, 0, "user", "q"), (0, 1, "assistant", "<s>")]).first()
    assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
    assert [s["text"] for s in row["segments"] if s["loss"]] == ["<\\s>"]


def test_null_conversation_and_empty_table(spark):
    assert formatted(spark, [(None, None, "user", "q"), (None, 0, "assistant", "a")]).count() == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.digest(chat.format_conversations(empty)).count() == 0
    assert chat.digest(chat.format_conversations(chat.with_probe(empty))).first()["conv_id"] == -1
