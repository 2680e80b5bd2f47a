"""Row-wise operators: casts, classification, renaming, rules."""

from __future__ import annotations

import math
import warnings

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from zoneflow.functions.casts import to_bool, to_double, to_long
from zoneflow.functions.text import encode_fields, equals_ignore_case, fingerprint, full_match, strip_suffix
from zoneflow.operators import quality
from zoneflow.operators.cdc import cdc_classify
from zoneflow.operators.fetch import lookup_fetch, record_id, row_map, to_text_columns
from zoneflow.operators.mapping import map_keys, map_schema
from zoneflow.operators.quality import DQRule
from zoneflow.operators.structure import structure_cast


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "value"),
    [("12", 12), ("-7", -7), ("+7", 7), (" 12 ", None), ("1.5", None), ("12L", None), ("", None), ("1e3", None),
     ("9223372036854775808", None), (None, None)],
)
def test_to_long(spark, text, value):
    assert one(spark, text, to_long) == value


@pytest.mark.parametrize(
    ("text", "value"),
    [("1.5", 1.5), (" 1.5 ", 1.5), ("1e3", 1000.0), ("1d", 1.0), ("Infinity", math.inf), ("-Infinity", -math.inf),
     ("1e999", math.inf), ("inf", None), ("nan", None), ("INFINITY", None), ("n/a", None), ("", None), (None, None)],
)
def test_to_double(spark, text, value):
    assert one(spark, text, to_double) == value


def test_to_double_nan(spark):
    assert math.isnan(one(spark, "NaN", to_double))


@pytest.mark.parametrize(
    ("text", "value"), [("TRUE", True), ("true", True), ("1", False), ("t", False), (" true ", False), ("", False), (None, None)]
)
def test_to_bool(spark, text, value):
    assert one(spark, text, to_bool) is value
    assert one(spark, text, lambda c: equals_ignore_case(c, "true")) is bool(value)


@pytest.mark.parametrize(
    ("text", "pattern", "ok"),
    [("abc", "abc", True), ("abc\n", "abc", False), ("xabc", "abc", False), ("a\nb", ".*", False), ("", ".*", True),
     (None, ".*", True), (None, "a+", False), ("ab", "a|ab", True)],
)
def test_full_match(spark, text, pattern, ok):
    assert one(spark, text, lambda c: full_match(c, pattern)) is ok


def test_encoding_keeps_fields_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "abc"), ("abc", None), ("", "abc"), ("~", None), (None, "~"), ("1:a", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(encode_fields([F.col("a"), F.col("b")])).distinct().count() == len(rows)
    assert len(df.select(fingerprint([F.col("a")])).first()[0]) == 32


def test_strip_suffix(spark):
    assert one(spark, "member_framework", lambda c: strip_suffix(c, "_framework")) == "member"
    assert one(spark, "framework_x", lambda c: strip_suffix(c, "_framework")) == "framework_x"


def test_classify(spark):
    df = spark.createDataFrame(
        [("insert", "TRUE", "t"), ("insert", "1", None), (None, "false", "t"), (None, None, None), ("Weird", None, "t")],
        "op_type string, is_deleted string, _table_name string",
    )
    rows = cdc_classify(df).select("_event_op", "_table_name", "_zone").collect()
    assert [tuple(r) for r in rows] == [
        ("delete", "t", "raw"),
        ("insert", "unknown", "raw"),
        ("upsert", "t", "raw"),
        ("upsert", "unknown", "raw"),
        ("Weird", "t", "raw"),
    ]
    bare = cdc_classify(spark.range(1), table="x").first()
    assert (bare._event_op, bare._table_name) == ("upsert", "x")


def test_cast_modes(spark):
    df = spark.createDataFrame([("1", "x"), ("bad", "2.5"), (None, None)], "a string, b string")
    types = {"a": "INT64", "b": "float64", "c": "int64"}
    assert [tuple(r) for r in structure_cast(df, types, "null").collect()] == [(1, None), (None, 2.5), (None, None)]
    failed = structure_cast(df, types, "quarantine").select("_cast_failed").collect()
    assert [r[0] for r in failed] == [["b"], ["a"], []]
    with pytest.raises(PySparkException, match="column a is not INT64: bad"):
        structure_cast(df, {"a": "INT64"}, "fail").collect()
    assert structure_cast(df.where("a = '1'"), {"a": "int64"}, "fail").first().a == 1
    with pytest.raises(ValueError, match="mode"):
        structure_cast(df, types, "other")


def test_cast_unknown_type_is_text_and_bool_never_fails(spark):
    df = spark.createDataFrame([(5, "yes")], "a int, b string")
    row = structure_cast(df, {"a": "decimal", "b": "bool"}, "quarantine").first()
    assert (row.a, row.b, row._cast_failed) == ("5", False, [])


def test_mapping(spark):
    df = spark.createDataFrame([("1", "n")], "user_id string, other string")
    mappings = {"users": {"user_id": "record_id"}}
    assert map_schema(df, mappings, "users").columns == ["record_id", "other"]
    assert map_schema(df, mappings, "nothing").columns == df.columns
    with pytest.raises(ValueError, match="other"):
        map_schema(df, {"users": {"user_id": "other"}}, "users")
    assert df.select(map_keys(row_map(df.columns), mappings["users"])).first()[0] == {"record_id": "1", "other": "n"}


def test_text_rows(spark):
    df = spark.createDataFrame([(1, None, 1.0e7, True)], "a int, b string, c double, d boolean")
    assert tuple(to_text_columns(df).first()) == ("1", None, "1.0E7", "true")
    assert df.select(row_map(df.columns)).first()[0] == {"a": "1", "b": None, "c": "1.0E7", "d": "true"}


def test_record_id_of_a_row_without_one_is_stable(spark):
    df = spark.createDataFrame([(None, "x"), ("7", "y")], "id string, v string")
    ids = [[r[0] for r in df.select(record_id(df, "id")).collect()] for _ in range(2)]
    assert ids[0] == ids[1] and ids[0][1] == "7" and len(ids[0][0]) == 32


def test_integer_key_is_matched_in_canonical_form(spark):
    notes = spark.createDataFrame(
        [("m", "u", ["5", "05", "x", "5", "+5"])], "message_id string, event_type string, record_ids array<string>"
    ).withColumn("event_ts", F.current_timestamp())
    table = spark.createDataFrame([(5, "five"), (5, "again"), (6, "six")], "id bigint, name string")
    got = lookup_fetch(notes, table, "id").select("_record_id", "name").collect()
    assert sorted(map(tuple, got)) == [("5", "again"), ("5", "five")]


def flag(spark, rows, schema, rule):
    df = spark.createDataFrame(rows, schema)
    return [not r[0] for r in quality.with_flags(df, [rule]).select("_dq_failed").collect()]


def test_not_null(spark):
    rule = DQRule("not_null", ("a", "b"))
    assert flag(spark, [("x", "y"), (None, "y"), ("", "")], "a string, b string", rule) == [True, False, True]
    assert flag(spark, [("x",)], "a string", rule) == [False]


def test_range(spark):
    rows = [("0",), ("10",), ("10.01",), ("-1",), ("NaN",), ("n/a",), (None,), ("Infinity",)]
    assert flag(spark, rows, "a string", DQRule("range", ("a",), min=0, max=10)) == [True, True] + [False] * 6
    assert flag(spark, rows, "a string", DQRule("range", ("a",), min=0)) == [True, True, True] + [False] * 4 + [True]
    assert flag(spark, rows, "a string", DQRule("range", ("a",), max=10)) == [True, True, False, True] + [False] * 4
    assert flag(spark, rows, "a string", DQRule("range", ("missing",))) == [False] * 8


def test_regex_without_pattern_rejects_line_breaks(spark):
    assert flag(spark, [("a",), ("a\nb",), (None,)], "a string", DQRule("regex", ("a",))) == [True, False, True]


def test_email(spark):
    rows = [("a@b.com",), ("a@b.COM",), ("a@b.xn--p1ai",), ("a@b",), ("a b@c.com",), (None,), ("a@b.com\n",), ("a@b.c",)]
    assert flag(spark, rows, "a string", DQRule("valid_email", ("a",))) == [True] * 3 + [False] * 5


def test_unique_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x"), (4, "y"), (5, "y")], "i int, a string")
    got = quality.with_flags(df, [DQRule("not_null", ("i",), unique=True), DQRule("unique", ("a",))])
    assert {r.i: r._dq_failed for r in got.collect()} == {
        1: ["unique(a)"], 2: ["unique(a)"], 3: [], 4: ["unique(a)"], 5: ["unique(a)"]
    }


def test_unknown_rule_warns_and_passes(spark):
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert flag(spark, [("x",)], "a string", DQRule("nonsense", ("a",))) == [True]
    assert "nonsense" in str(seen[0].message)


def test_custom_expression_null_fails(spark):
    rows = [(1,), (0,), (None,)]
    assert flag(spark, rows, "a int", DQRule("positive", expr="a > 0")) == [True, False, False]


def test_no_rules_pass_everything(spark):
    assert quality.dq_pass(spark.range(3), []).count() == 3


def test_outcomes_of_an_empty_frame(spark):
    rules = [DQRule("not_null", ("a",))]
    empty = quality.with_flags(spark.createDataFrame([], "a string"), rules)
    assert [tuple(r) for r in quality.rule_outcomes(empty, rules).collect()] == [("not_null(a)", True, 0, 0)]
