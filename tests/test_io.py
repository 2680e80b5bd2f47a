"""Sources, sinks, configuration, session folders."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from zoneflow import session
from zoneflow.config import load_config, parse_config
from zoneflow.operators.metrics import metric_rows, observe
from zoneflow.sinks import tables as sink
from zoneflow.sources import snapshots
from zoneflow.sources.notifications import read_messages
from zoneflow.sources.tables import SchemaRegistry, apply_schema, read_table


@pytest.fixture
def folder(spark):
    return session.new_run_dir(spark, "test")


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_root(spark) == root
    assert session.new_run_dir(spark, "a") != session.new_run_dir(spark, "a")


def test_snapshot_lines(spark, folder):
    lines = [
        '{"user_id":"1","n":5,"x":null,"o":{"a":1}}',
        "not json",
        "[1]",
        "",
        '{"user_id":"2"',
        '"text"',
        '{"user_id":"3"}',
    ]
    sink.write_text(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), folder)
    rows = [r.row for r in snapshots.scan_jsonl(spark, folder).collect()]
    assert rows == [{"user_id": "1", "n": "5", "x": None, "o": '{"a":1}'}, {"user_id": "3"}]
    columns = snapshots.scan_jsonl_columns(spark, folder, ["user_id", "n", "absent"])
    assert sorted(map(tuple, columns.collect())) == [("1", "5", None), ("3", None, None)]


def test_line_limit_per_object(spark, folder):
    for part in range(3):
        rows = spark.range(10).select(F.to_json(F.struct(F.lit(part).alias("p"), "id")).alias("value"))
        sink.write_text(rows.coalesce(1), f"{folder}/{part}")
    rows = snapshots.scan_jsonl_columns(spark, folder, ["p", "id"], max_lines_per_object=4)
    assert sorted(map(tuple, rows.collect())) == [(str(p), str(i)) for p in range(3) for i in range(4)]
    assert snapshots.scan_jsonl(spark, folder).count() == 30


def test_listing_and_bytes(spark, folder):
    for name in ("b", "a", "c"):
        sink.write_text(spark.createDataFrame([(name * 3,)], "value string"), f"{folder}/{name}")
    listed = snapshots.list_objects(spark, folder, limit=2).collect()
    keys = [r.key for r in listed]
    assert len(keys) == 2 and keys == sorted(keys) and "/a/" in keys[0]
    assert [r.length for r in listed] == [4, 4]
    assert snapshots.list_objects(spark, folder, limit=None).count() == 3
    assert {bytes(r.content) for r in snapshots.read_objects(spark, folder).collect()} == {b"aaa\n", b"bbb\n", b"ccc\n"}


def test_batch_is_replaced_and_others_stay(spark, folder):
    sink.write_batch(spark.range(3), folder, 1)
    sink.write_batch(spark.range(5), folder, 2)
    sink.write_batch(spark.range(4), folder, 1)
    counts = {r._batch_id: r["count"] for r in sink.read_batches(spark, folder).groupBy("_batch_id").count().collect()}
    assert counts == {1: 4, 2: 5}


def test_log_is_partitioned_by_day_and_rewritten_per_batch(spark, folder):
    rows = spark.createDataFrame([("d", "raw", "t", 1), ("d", "refined", "t", 2)], "domain string, zone string, table_name string, n int")
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    sink.write_log(rows, folder, "b1", F.lit("2024-01-01 23:59:59").cast("timestamp"))
    sink.write_log(rows, folder, "b1", at)
    sink.write_log(rows, folder, "b2", at)
    log = read_table(spark, folder)
    assert log.count() == 4
    assert {str(r.created_date) for r in log.select("created_date").collect()} == {"2024-01-02"}


def test_json_lines_keep_nulls(spark, folder):
    sink.write_json_lines(spark.createDataFrame([(1, None)], "a int, b string"), folder)
    line = spark.read.text(folder).first()[0]
    assert json.loads(line) == {"a": 1, "b": None}


def test_messages_from_json_files(spark, folder):
    sink.write_text(spark.createDataFrame([('{"attributes":{"table_name":"t"},"payload":"[1]"}',)], "value string"), folder)
    row = read_messages(spark, folder, "json").first()
    assert (row.attributes, row.payload) == ({"table_name": "t"}, "[1]")


def test_schema_registry(spark, folder):
    sink.write_table(spark.createDataFrame([(1, 2.5, True, "x")], "a int, b float, c boolean, d string"), folder)
    registry = SchemaRegistry(spark, {"stated": {"a": "int64"}})
    schema = registry.get_schema(folder)
    assert schema == {"a": "int64", "b": "float64", "c": "bool", "d": "string"}
    assert registry.get_schema("stated") == {"a": "int64"}
    texts = spark.createDataFrame([("7", "1.5", "TRUE", "extra")], "a string, b string, c string, z string")
    assert tuple(apply_schema(texts, schema).first()) == (7, 1.5, True, None)


def test_metrics(spark):
    rows = metric_rows(spark.range(4), "p", {"n": F.count(F.lit(1)), "top": F.max("id")}).collect()
    assert [tuple(r) for r in rows] == [("p", "n", 4.0), ("p", "top", 3.0)]
    df, observation = observe(spark.range(4), "seen", {"n": F.count(F.lit(1))})
    df.write.format("noop").mode("overwrite").save()
    assert observation.get == {"n": 4}


CONFIG = """
domain: member
table: users
raw_dataset: landing
reconciler:
  aws_prefix_raw: "legacy/raw/"
  mapping_schemas:
    users: {user_id: record_id, user_name: name}
dq:
  not_null: ["record_id", "email"]
rules:
  - {name: range, columns: [age], min: 0, max: 150}
dependencies:
  users: [snapshot_previous_day]
"""


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text(CONFIG)
    cfg = load_config(str(path))
    assert (cfg.domain, cfg.table, cfg.id_column, cfg.ingestion_type) == ("member", "users", "record_id", "incremental")
    assert (cfg.dataset("raw"), cfg.dataset("refined")) == ("landing", "member_refined")
    assert cfg.table_path("/r", "raw") == "/r/landing/users_raw"
    assert cfg.prefixes["raw"] == "legacy/raw/" and cfg.prefixes["refined"] == "path/to/member/refined/"
    assert [r.label for r in cfg.rules] == ["not_null(record_id,email)", "range(age)"]
    assert cfg.reconcile_enabled and cfg.mapping_schemas["users"]["user_id"] == "record_id"
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "missing.yaml"))


def test_missing_sections_turn_stages_off():
    cfg = parse_config({"domain": "d", "table": "t"})
    assert cfg.rules == () and not cfg.reconcile_enabled and cfg.mapping_schemas == {}
    with pytest.raises(ValueError, match="no ingestion mode"):
        parse_config({"domain": "d", "table": "t", "ingestion_type": "magic"})


def test_a_later_batch_may_have_more_columns(spark, folder):
    sink.write_batch(spark.createDataFrame([(1,)], "a int"), folder, 0)
    sink.write_batch(spark.createDataFrame([(2, "x")], "a int, b string"), folder, 1)
    assert sorted((r.a, r.b) for r in sink.read_batches(spark, folder).collect()) == [(1, None), (2, "x")]


def test_both_snapshot_readers_take_object_lines_only(spark, folder):
    lines = [' {"id":"1","v":2}', '[{"id":"2"},{"id":"3"}]', "null", "7", '"x"', '{"id":"4"', "", "{}"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(folder)
    whole = snapshots.scan_jsonl(spark, folder)
    typed = snapshots.scan_jsonl_columns(spark, folder, ["id", "v"])
    assert sorted((r.row for r in whole.collect()), key=len) == [{}, {"id": "1", "v": "2"}]
    assert sorted(map(tuple, typed.collect()), key=str) == sorted([("1", "2"), (None, None)], key=str)


def test_listing_has_no_limit_of_its_own(spark, folder):
    spark.range(700).repartition(70).write.json(folder)
    assert snapshots.list_objects(spark, folder).where("key LIKE '%.json'").count() >= 65
    assert snapshots.list_objects(spark, folder, 3).count() == 3
