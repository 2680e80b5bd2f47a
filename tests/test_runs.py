"""Zone runs, batch runs and streams end to end."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fixtures import load, messages
from queries import MEMBER_CONFIG
from zoneflow import session
from zoneflow.config import ZoneConfig
from zoneflow.operators.audit import STAGES
from zoneflow.operators.fetch import lookup_fetch
from zoneflow.operators.ingest import Source
from zoneflow.operators.notify import parse_notifications
from zoneflow.operators.quality import DQRule
from zoneflow.plans.batch import run_batch
from zoneflow.plans.zones import PIPELINE_LOG, QUALITY_LOG, RECONCILE_LOG, changed_records, read_snapshot, run_zones
from zoneflow.sinks import tables as sink
from zoneflow.sources.notifications import MESSAGE_SCHEMA, stream_messages, with_event_time
from zoneflow.streaming import state, windows
from zoneflow.streaming.zones import zone_stream


@pytest.fixture
def root(spark):
    return session.new_run_dir(spark, "run")


def records(spark):
    rows = [("1", "a", "a@x.com", "5"), ("1", "a", "a@x.com", "5"), ("2", "b", None, "x"), ("3", "c", "c@x.com", None)]
    df = spark.createDataFrame(rows, "record_id string, name string, email string, age string")
    return df.withColumns({"_event_op": F.lit("update"), "_table_name": F.lit("t"), "_zone": F.lit("raw")})


CFG = ZoneConfig(
    domain="d",
    table="t",
    rules=(DQRule("not_null", ("email",)),),
    structure={"age": "int64"},
    compare_columns=("name", "email"),
)


def test_zones(spark, root):
    legacy = spark.createDataFrame(
        [("1", "a", "a@x.com"), ("3", "C", "c@x.com"), ("3", "c", "c@x.com")], "record_id string, name string, email string"
    )
    seen = []

    def refine(df):
        seen.append(df.columns)
        return df.withColumn("initial", F.left("name", F.lit(1)))

    run = run_zones(records(spark), CFG, root, 7, {"raw": legacy, "refined": legacy}, {"refined": refine})
    assert run.written["raw"].count() == 4
    assert run.quarantine("raw").select("record_id", "_dq_failed").collect() == [("2", ["not_null(email)"])]
    for zone in ("structure", "refined", "analytics"):
        rows = run.zone(zone)
        assert rows.count() == 3 and {r._zone for r in rows.collect()} == {zone}
    assert dict(run.zone("structure").dtypes)["age"] == "bigint"
    assert run.zone("analytics").where("initial is null").count() == 0
    assert "_dq_failed" not in seen[0] and "_ingest_ts" in seen[0]

    audit = read_log(spark, root, PIPELINE_LOG)
    assert {r.zone: r.metrics for r in audit} == {s: f'{{"records":{4 if s == "raw" else 3}}}' for s in STAGES}
    assert {r.pipeline_name for r in audit} == {f"t_{s}" for s in STAGES} and {r.domain for r in audit} == {"d"}
    quality = {r.zone: (r.passed, r.details) for r in read_log(spark, root, QUALITY_LOG)}
    assert quality["raw"] == (False, '{"n_passed":3,"n_failed":1}') and quality["analytics"][0]
    reconciled = {r.zone: r for r in read_log(spark, root, RECONCILE_LOG)}
    assert set(reconciled) == {"raw", "refined"}
    raw = reconciled["raw"]
    assert (raw.gcp_count, raw.aws_count, raw.count_match) == (4, 4, False)
    assert [tuple(s) for s in raw.mismatch_samples] == [("3", "name")]


def read_log(spark, root, name):
    return spark.read.parquet(CFG.log_path(root, name)).collect()


def test_running_a_batch_again_changes_nothing(spark, root):
    for _ in range(2):
        run_zones(records(spark), CFG, root, 1)
    assert sink.read_batches(spark, CFG.table_path(root, "analytics")).count() == 3
    assert len(read_log(spark, root, PIPELINE_LOG)) == len(STAGES)
    assert len({r.log_id for r in read_log(spark, root, PIPELINE_LOG)}) == len(STAGES)


def test_unique_rule_in_zones(spark, root):
    cfg = ZoneConfig(domain="d", table="t", rules=(DQRule("unique", ("record_id",)),))
    run = run_zones(records(spark), cfg, root, 0)
    assert Counter(r.record_id for r in run.quarantine("raw").collect()) == {"1": 2}
    assert run.zone("analytics").count() == 2


def test_all_rows_quarantined(spark, root):
    cfg = ZoneConfig(domain="d", table="t", rules=(DQRule("not_null", ("no_such_column",)),))
    run = run_zones(records(spark), cfg, root, 0)
    assert run.quarantine("raw").count() == 4 and run.zone("analytics").count() == 0


def test_snapshot_is_renamed_before_it_is_joined(spark, root):
    sink.write_json_lines(spark.createDataFrame([("1", "n", "e")], "user_id string, user_name string, user_email string"), root)
    cfg = ZoneConfig(
        domain="d", table="t", mapping_schemas={"t": {"user_id": "record_id", "user_name": "name", "user_email": "email"}}
    )
    assert read_snapshot(spark, root, cfg).columns == ["record_id", "name", "email"]


def batch_rows(spark, day, seq=1):
    more = {"table_name": F.lit("t"), "run_date": F.lit(day).cast("date"), "change_ts": F.lit(day).cast("timestamp"), "seq": F.lit(seq)}
    return records(spark).withColumns(more)


def test_batch_runs_take_in_what_is_new(spark, root):
    source = Source("t", changes=batch_rows(spark, "2024-01-02"))
    assert run_batch(spark, CFG, source, None, root, "r1")["refined"].count() == 4
    assert run_batch(spark, CFG, source, None, root, "r2")["refined"].count() == 0
    later = batch_rows(spark, "2024-01-02", 2).unionByName(batch_rows(spark, "2024-01-02"))
    assert run_batch(spark, CFG, Source("t", changes=later), None, root, "r3")["refined"].count() == 4


def test_batch_is_gated_by_the_log_it_writes(spark, root):
    cfg = replace(CFG, dependencies={"t": ["snapshot_previous_day"]})
    second = Source("t", changes=batch_rows(spark, "2024-01-03"))
    assert run_batch(spark, cfg, second, None, root, "early")["refined"].count() == 0
    assert run_batch(spark, CFG, Source("t", changes=batch_rows(spark, "2024-01-02")), None, f"{root}/x", "r1")["refined"].count() == 4
    third = Source("t", changes=batch_rows(spark, "2024-01-03", 9))
    assert run_batch(spark, cfg, third, None, f"{root}/x", "r2")["refined"].count() == 4
    undated = batch_rows(spark, "2024-01-03", 10).withColumn("run_date", F.lit(None).cast("date"))
    assert run_batch(spark, cfg, Source("t", changes=undated), None, f"{root}/x", "r3")["refined"].count() == 0


def test_what_the_gate_held_back_comes_when_its_day_is_done(spark, root):
    cfg = replace(CFG, dependencies={"t": ["snapshot_previous_day"]})
    source = Source("t", changes=batch_rows(spark, "2024-01-03").unionByName(batch_rows(spark, "2024-01-05")))
    done = lambda *days: spark.createDataFrame([("t", d, "SUCCESS") for d in days], "table_name string, run_date string, status string")
    run = lambda log, run_id, cfg=cfg: run_batch(spark, cfg, source, log, root, run_id)["analytics"].count()
    assert run(done(), "r1") == 0
    assert run(done("2024-01-01"), "r2") == 0
    assert run(done("2024-01-02"), "r3") == 4
    assert run(done("2024-01-02", "2024-01-04"), "r4") == 4
    assert run(done("2024-01-02", "2024-01-04"), "r5") == 0


def test_a_failed_run_neither_loses_nor_doubles_what_waits(spark, root):
    cfg = replace(CFG, dependencies={"t": ["snapshot_previous_day"]})
    log = spark.createDataFrame([("t", "2024-01-02", "SUCCESS")], "table_name string, run_date string, status string")
    first = Source("t", changes=batch_rows(spark, "2024-01-03"))
    assert run_batch(spark, cfg, first, log.limit(0), root, "r1")["analytics"].count() == 0
    later = Source("t", changes=first.changes.unionByName(batch_rows(spark, "2024-01-07")))

    def broken(df):
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError, match="broken"):
        run_batch(spark, cfg, later, log, root, "r2", hooks={"analytics": broken})
    assert run_batch(spark, cfg, later, log, root, "r2")["analytics"].count() == 4
    log = log.unionByName(spark.createDataFrame([("t", "2024-01-06", "SUCCESS")], log.schema))
    assert run_batch(spark, cfg, later, log, root, "r3")["analytics"].count() == 4


def test_an_upsert_keeps_the_newest_of_what_waits(spark, root):
    cfg = replace(CFG, ingestion_type="upsert", dependencies={"t": ["snapshot_previous_day"]})
    log = spark.createDataFrame([("t", "2024-01-02", "SUCCESS")], "table_name string, run_date string, status string")
    rows = batch_rows(spark, "2024-01-03").withColumn("op", F.lit("update"))
    assert run_batch(spark, cfg, Source("t", changes=rows), log.limit(0), root, "r1")["analytics"].count() == 0
    newer = rows.where("record_id = '2'").withColumn("seq", F.lit(2))
    out = run_batch(spark, cfg, Source("t", changes=rows.unionByName(newer)), log, root, "r2")["analytics"]
    assert sorted((r.record_id, r.seq) for r in out.collect()) == [("1", 1), ("2", 2), ("3", 1)]


def test_batch_reconciles_without_the_gate_columns(spark, root):
    cfg = replace(CFG, compare_columns=(), reconcile_enabled=True)
    legacy = records(spark).select("record_id", "name", "email", "age")
    rows = records(spark).withColumns({"table_name": F.lit("t"), "run_date": F.lit("2024-01-02").cast("date")})
    changes = rows.withColumns({"_ts": F.lit("2024-01-02").cast("timestamp"), "_n": F.lit(1)})
    run_batch(spark, cfg, Source("t", changes=changes, change_ts="_ts", seq="_n"), None, root, "r1", legacy)
    assert read_log(spark, root, RECONCILE_LOG)[0].mismatch_samples == []


def test_redelivered_messages_count_once_in_a_batch(spark):
    message = ({"message_id": "m", "table_name": "t"}, '["1"]')
    table = spark.createDataFrame([("1", "a")], "record_id string, name string")
    twice = spark.createDataFrame([message, message], MESSAGE_SCHEMA)
    assert changed_records(twice, table, CFG).count() == 1


def test_malformed_numbers_are_named_beside_the_row(spark, root):
    rows = run_zones(records(spark).fillna({"email": "e"}), CFG, root, 0).written["structure"]
    assert {r.record_id: r._cast_failed for r in rows.collect()} == {"1": [], "2": ["age"], "3": []}


def test_batch_run_reports_quality_and_does_not_filter(spark, root):
    rows = batch_rows(spark, "2024-01-02")
    done = spark.createDataFrame([], "table_name string, run_date date, status string")
    out = run_batch(spark, CFG, Source("t", changes=rows), done, root, "r1")
    assert out["refined"].count() == out["analytics"].count() == 4
    assert read_log(spark, root, QUALITY_LOG)[0].details == '{"n_passed":3,"n_failed":1}'
    assert "pipeline_complete" in spark.read.text(f"{root}/audit-logs/r1").first()[0]


def deliver(spark, path, rows):
    df = spark.createDataFrame(rows, "id int, t string").select("id", F.to_timestamp("t").alias("event_ts"))
    sink.write_table(df, path, mode="append")
    return spark.readStream.schema(df.schema).parquet(path)


ON_TIME = [(1, "2024-01-01 00:00:01"), (2, "2024-01-01 00:00:01"), (3, "2024-01-01 00:10:00")]
LATE = [(4, "2024-01-01 00:00:01"), (5, "2024-01-01 00:06:00")]
LAST = [(6, "2024-01-01 01:00:00")]


def test_late_rows_leave_windows_and_stay_in_panes(spark, root):
    closed, panes = f"{root}/closed", f"{root}/panes"
    for rows in (ON_TIME, LATE, LAST):
        stream = deliver(spark, f"{root}/in", rows)
        watermarked = stream.withWatermark("event_ts", "5 minutes")
        windows.windowed_append(watermarked, closed, f"{root}/c1", size="1 minute", trigger=windows.AVAILABLE).awaitTermination()
        windows.discarding_panes(stream, panes, f"{root}/c2", size="1 minute", trigger=windows.AVAILABLE).awaitTermination()
    got = {str(r.window_start)[11:16]: r.n for r in spark.read.parquet(closed).collect()}
    assert got == {"00:00": 2, "00:06": 1, "00:10": 1}
    totals = sink.read_batches(spark, panes).groupBy("window_start").agg(F.sum("n").alias("n"))
    assert {str(r.window_start)[11:16]: r.n for r in totals.collect()} == {"00:00": 3, "00:06": 1, "00:10": 1, "01:00": 1}


def test_early_updates_accumulate(spark, root):
    for rows in ([(1, "2024-01-01 00:00:01")], [(2, "2024-01-01 00:00:01"), (3, "2024-01-01 00:00:02")]):
        stream = deliver(spark, f"{root}/in", rows).withWatermark("event_ts", "5 minutes")
        windows.early_update(stream, f"{root}/out", f"{root}/c", trigger=windows.AVAILABLE).awaitTermination()
    written = sink.read_batches(spark, f"{root}/out")
    assert sorted(r.n for r in written.collect()) == [1, 1, 2]
    assert sorted(r.n for r in windows.newest_panes(written).collect()) == [1, 2]


def test_last_change_survives_restarts(spark, root):
    for rows in ([(1, "2024-01-01 00:00:05"), (2, "2024-01-01 00:00:01")], [(1, "2024-01-01 00:00:02")], [(2, "2024-01-01 00:00:09")]):
        stream = deliver(spark, f"{root}/in", rows).withColumn("v", F.date_format("event_ts", "ss"))
        state.last_change(stream, f"{root}/out", f"{root}/c", "id", ["event_ts"], ["v"], windows.AVAILABLE).awaitTermination()
    got = state.newest_state(sink.read_batches(spark, f"{root}/out"), "id")
    assert {r.id: r.v for r in got.collect()} == {1: "05", 2: "09"}


def test_stream_dedup_keeps_messages_without_id(spark, root):
    rows = [({"message_id": "1", "event_timestamp": "1000"}, "a")] * 3 + [({"event_timestamp": "1000"}, "b")] * 2
    sink.write_table(spark.createDataFrame(rows, MESSAGE_SCHEMA), f"{root}/in")
    stream = with_event_time(stream_messages(spark, f"{root}/in"))
    state.dedup_stream(stream, f"{root}/out", f"{root}/c", windows.AVAILABLE).awaitTermination()
    assert sorted(r.payload for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "b"]


def test_fetch_on_a_stream_equals_batch(spark, sf, root):
    source = messages(spark, sf)
    sink.write_table(source, f"{root}/in")
    members = load(spark, sf, "src_member")
    columns = ["_notif_message_id", "record_id", "name"]
    stream = lookup_fetch(parse_notifications(stream_messages(spark, f"{root}/in"), "member"), members).select(columns)
    query = stream.writeStream.option("checkpointLocation", f"{root}/c").trigger(availableNow=True)
    query.format("parquet").start(f"{root}/out").awaitTermination()
    batch = lookup_fetch(parse_notifications(source, "member"), members).select(columns)
    got = spark.read.parquet(f"{root}/out")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, batch.collect()))


def test_zone_stream_equals_batch_over_restarts(spark, sf, root):
    """Two deliveries, the second with redelivered and very old messages; no row is lost or doubled."""
    source = messages(spark, sf)
    early = F.try_element_at("attributes", F.lit("event_timestamp")) < "17050"
    members = load(spark, sf, "src_member")
    for part in (source.where(~early), source):
        sink.write_table(part, f"{root}/in", mode="append")
        zone_stream(
            stream_messages(spark, f"{root}/in"), lambda: members, MEMBER_CONFIG, root, f"{root}/c", trigger=windows.AVAILABLE
        ).awaitTermination()
    streamed = sink.read_batches(spark, MEMBER_CONFIG.table_path(root, "raw"))
    expected = changed_records(source, members, MEMBER_CONFIG)
    columns = ["_notif_message_id", "record_id", "_event_op"]
    assert Counter(map(tuple, streamed.select(columns).collect())) == Counter(map(tuple, expected.select(columns).collect()))
    assert streamed.select("_batch_id").distinct().count() == 2
