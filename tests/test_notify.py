from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zoneflow.operators.notify import dead_letters, dedup_messages, event_time, filter_table, parse_notifications
from zoneflow.sources.notifications import MESSAGE_SCHEMA, from_kafka

PAYLOADS = {
    '["8","9"]': ["8", "9"],
    "  [8, 8]": ["8", "8"],
    '{"record_ids":["1","x1"],"record_id":"0"}': ["1", "x1"],
    '{"record_ids":[]}': [],
    '{"record_id":"5"}': ["5"],
    '{"record_id":5}': ["5"],
    "[]": [],
    "[1.5, true]": ["1.5", "true"],
    "not json": None,
    '{"other":1}': None,
    '{"record_id":"5"': None,
    '{"record_id":null}': None,
    '{"record_ids":null,"record_id":"5"}': None,
    '{"record_ids":"a","record_id":"5"}': None,
    '["a",null]': None,
    "5": None,
    '"a"': None,
    "": None,
}


def message(payload, **attributes):
    return ({"table_name": "t", **attributes}, payload)


def frame(spark, rows):
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_payload_shapes(spark):
    df = frame(spark, [message(p, message_id=p) for p in PAYLOADS])
    good = {r.message_id: r.record_ids for r in parse_notifications(df, "t").collect()}
    bad = {r.message_id for r in dead_letters(df, "t").collect()}
    assert good == {p: ids for p, ids in PAYLOADS.items() if ids is not None}
    assert bad == {p for p, ids in PAYLOADS.items() if ids is None}


def test_null_payload_is_a_dead_letter(spark):
    df = frame(spark, [message(None, message_id="m")])
    assert parse_notifications(df, "t").count() == 0
    assert dead_letters(df, "t").count() == 1


def test_defaults(spark):
    df = frame(spark, [message("[1]")])
    first = parse_notifications(df, "t").first()
    again = parse_notifications(df, "t").first()
    assert first.event_type == "update"
    assert first.event_ts is not None
    assert first.message_id == again.message_id  # a recomputed row keeps its id


def test_other_and_missing_table_names_are_dropped(spark):
    df = frame(spark, [({"table_name": "other"}, "[]"), ({}, "[]"), (None, "[]"), message("[]")])
    assert filter_table(df, "t").count() == 1


def test_binary_payload(spark):
    df = frame(spark, [message('["é"]')]).withColumn("payload", F.col("payload").cast("binary"))
    assert parse_notifications(df, "t").first().record_ids == ["é"]


@pytest.mark.parametrize(
    ("text", "micros"),
    [
        ("2024-01-01T00:00:01Z", 1704067201000000),
        ("2024-01-01 00:00:01.5Z", 1704067201500000),
        ("2024-01-01T01:00:01+01:00", 1704067201000000),
        ("1704067201000", 1704067201000000),
        ("1000", 1000000),
        ("-1", -1000),
        ("12:30:00", None),
        ("T12:30", None),
        ("2024-01", None),
        ("99999999999999999999", None),
        ("soon", None),
        (None, None),
    ],
)
def test_event_time(spark, text, micros):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.unix_micros(event_time(F.col("t")))).first()[0] == micros


def test_dedup_keeps_messages_without_id(spark):
    rows = [message("a", message_id="1")] * 3 + [message("b", message_id="2")] + [message("c")] * 2
    out = sorted(r.payload for r in dedup_messages(frame(spark, rows)).collect())
    assert out == ["a", "b", "c", "c"]


def test_broker_headers_become_attributes(spark):
    df = spark.createDataFrame(
        [([("table_name", bytearray(b"t")), ("message_id", bytearray(b"1"))], bytearray(b"[7]")), (None, bytearray(b"[8]"))],
        "headers array<struct<key:string,value:binary>>, value binary",
    )
    out = from_kafka(df)
    assert out.columns == ["attributes", "payload"]
    assert parse_notifications(out, "t").first().record_ids == ["7"]
    assert filter_table(out, "t").count() == 1


def test_bad_bytes_and_repeated_headers_do_no_harm(spark):
    header = lambda k, v: (k, bytearray(v))
    rows = [
        ([header("table_name", b"x"), header("table_name", b"t"), (None, bytearray(b"n")), header("raw", b"a\xff")], bytearray(b'["7"]')),
        ([header("table_name", b"t")], bytearray(b'["\xff')),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "headers array<struct<key:string,value:binary>>, value binary")
    out = from_kafka(df)
    first = out.first()
    assert first.attributes == {"table_name": "t", "raw": "a\ufffd"}
    assert parse_notifications(out, "t").count() == 1
    assert [r.content for r in dead_letters(out, "t").collect()] == ['["\ufffd']
    raw = spark.createDataFrame([({"table_name": "t"}, bytearray(b"\xff[]"))], "attributes map<string,string>, payload binary")
    assert dead_letters(raw, "t").first().content == "\ufffd[]"


def test_unreadable_event_time_is_a_dead_letter(spark):
    rows = [({"table_name": "t", "message_id": m, "event_timestamp": ts}, "[]") for m, ts in (("a", "soon"), ("b", "1000"))]
    df = spark.createDataFrame([*rows, ({"table_name": "t", "message_id": "c"}, "[]")], MESSAGE_SCHEMA)
    assert {r.message_id for r in parse_notifications(df, "t").collect()} == {"b", "c"}
    assert [r.message_id for r in dead_letters(df, "t").collect()] == ["a"]
