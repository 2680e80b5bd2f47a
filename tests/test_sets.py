"""Operators over whole sets: reconciliation, ingestion, dependencies, limits, windows."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zoneflow.operators import dependency, ingest, quality, reconcile
from zoneflow.operators.limits import latest_per_key, limit_per_group, top_n
from zoneflow.operators.quality import DQRule
from zoneflow.operators.windows import sliding_counts, tumbling, window_bounds

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
ids = st.sampled_from(["1", "2", "3", "4"])
texts = st.sampled_from([None, "a", "b"])
member_rows = st.lists(st.tuples(ids, texts, texts), max_size=12)
MEMBER = "record_id string, name string, email string"


@FEW
@given(ours=member_rows, theirs=member_rows)
def test_column_diff_equals_pairwise_comparison(spark, ours, theirs):
    expected = Counter()
    for i, name, email in ours:
        for j, other_name, other_email in theirs:
            bad = [c for c, x, y in (("email", email, other_email), ("name", name, other_name)) if x != y]
            if i == j and bad:
                expected[i, ",".join(bad)] += 1
    left, right = spark.createDataFrame(ours, MEMBER), spark.createDataFrame(theirs, MEMBER)
    got = reconcile.column_diff(left, right).collect()
    assert {(r.record_id, r.columns): r.pairs for r in got} == dict(expected)
    as_maps = [df.select("record_id", F.create_map(F.lit("name"), "name", F.lit("email"), "email").alias("row")) for df in (left, right)]
    got = reconcile.map_column_diff(*as_maps).collect()
    assert {(r.record_id, r.columns): r.pairs for r in got} == dict(expected)


@FEW
@given(ours=member_rows, theirs=member_rows)
def test_presence_and_totals(spark, ours, theirs):
    left, right = spark.createDataFrame(ours, MEMBER), spark.createDataFrame(theirs, MEMBER)
    n_left, n_right = Counter(r[0] for r in ours), Counter(r[0] for r in theirs)
    got = {r.record_id: (r.n_target, r.n_legacy) for r in reconcile.presence(left, right).collect()}
    assert got == {i: (n_left[i], n_right[i]) for i in n_left | n_right}
    totals = reconcile.totals(reconcile.variant_counts(left, right)).first()
    good = sum(1 for r in ours if n_right[r[0]] == 1)
    assert tuple(totals) == (good, len(ours) - good)


def test_map_diff_ignores_metadata_and_treats_missing_as_null(spark):
    df = spark.sql("select map('a','1','_x','1','n',cast(null as string)) g, map('a','2','_y','3','b','4') a")
    assert df.select(reconcile.map_diff(F.col("g"), F.col("a"))).first()[0] == "a,b"


def test_compared_columns(spark):
    left = spark.createDataFrame([], "record_id string, b string, _m string")
    right = spark.createDataFrame([], "a string, record_id string, b string")
    assert reconcile.compared_columns(left, right, "record_id") == ["b", "a"]


def test_samples_are_limited_per_group(spark):
    diffs = spark.range(100).select(F.col("id").cast("string").alias("record_id"), F.lit("x").alias("columns"), (F.col("id") % 2).alias("g"))
    rows = reconcile.mismatch_samples(diffs, ["g"]).collect()
    assert {len(r.mismatch_samples) for r in rows} == {5}
    assert [s.record_id for s in min(rows).mismatch_samples] == ["0", "10", "12", "14", "16"]


changes = st.lists(
    st.tuples(st.one_of(ids, st.none()), st.integers(0, 3), st.sampled_from(["insert", "update", "delete"])), min_size=1, max_size=15
)


def change_frame(spark, rows):
    return spark.createDataFrame(
        [(k, t, n, op) for n, (k, t, op) in enumerate(rows)], "record_id string, change_ts int, seq int, op string"
    )


@FEW
@given(rows=changes, cut=st.integers(0, 15))
def test_upsert_is_idempotent_and_order_free(spark, rows, cut):
    log = change_frame(spark, rows)
    order = ["change_ts", "seq"]
    expected = {}
    for n, (k, t, op) in enumerate(rows):
        expected[k] = max(expected.get(k, (-1, -1, "")), (t, n, op))
    expected = {k: (*v, v[2] == "delete") for k, v in expected.items()}

    def apply(target, delta):
        out = ingest.ingest_upsert(delta, target, ["record_id"], order).collect()
        return spark.createDataFrame(out, "record_id string, change_ts int, seq int, op string, _is_deleted boolean")

    def state(df):
        return {r.record_id: tuple(r)[1:] for r in df.collect()}

    whole = apply(None, log)
    assert state(whole) == expected
    assert state(apply(whole, log)) == expected
    late = apply(apply(None, log.where(F.col("seq") >= cut)), log.where(F.col("seq") < cut))
    assert state(late) == expected


def test_incremental_marks(spark):
    log = change_frame(spark, [("1", 1, "insert"), ("1", 2, "update"), ("2", 3, "update")]).withColumn("seq", F.lit(7))
    mark = ingest.high_water_mark(log.where("change_ts < 3"), "change_ts")
    assert tuple(mark.first()) == (2, 7)
    assert ingest.ingest_incremental(log, None).count() == 3
    assert ingest.ingest_incremental(log, mark).count() == 1
    assert ingest.ingest_incremental(log, mark.limit(0)).count() == 3
    nothing = ingest.high_water_mark(log.limit(0))
    assert ingest.ingest_incremental(log, nothing).count() == 3
    tied = log.unionByName(log.withColumn("seq", F.lit(8)))
    assert sorted(map(tuple, ingest.ingest_incremental(tied, mark).select("change_ts", "seq").collect())) == [(2, 8), (3, 7), (3, 8)]
    assert ingest.ingest_incremental(tied, mark, seq=None).count() == 4
    assert ingest.ingest_incremental(log, nothing.unionByName(mark)).count() == 1


def test_changes_without_a_time_and_very_old_ones_pass(spark, tmp_path):
    rows = [(1, -(2**40), 1), (2, None, 2), (3, 5, 3), (4, None, None)]
    log = spark.createDataFrame(rows, "record_id long, change_ts long, seq long")
    mark = ingest.high_water_mark(log)
    ids = lambda since, **more: sorted(r.record_id for r in ingest.ingest_incremental(log, since, **more).collect())
    assert ids(None) == ids(mark.limit(0)) == ids(mark.limit(0), seq=None) == [1, 2, 3, 4]
    assert ids(ingest.high_water_mark(log.limit(0))) == [1, 2, 3, 4]
    assert ids(mark) == [2, 4] and ids(mark, seq=None) == [2, 3, 4]
    timed = log.withColumn("change_ts", F.timestamp_seconds("change_ts").cast("timestamp_ntz")).where("record_id > 1")
    store = ingest.MarkStore(spark, str(tmp_path / "marks"))
    first = ingest.ingest_incremental(timed, store.read("t")).count()
    store.advance("other", timed)
    assert ingest.ingest_incremental(timed, store.read("t")).count() == first == 3


def test_the_scan_skips_what_is_older(spark, tmp_path):
    """Row groups before the mark are not read: the comparison reaches the scan with the mark's value."""
    path = str(tmp_path / "log")
    spark.range(0, 100_000, 1, 8).selectExpr("id AS seq", "timestamp_seconds(id) AS change_ts").write.parquet(path)
    log = spark.read.parquet(path)
    after = ingest.ingest_incremental(log, ingest.high_water_mark(log.where("seq < 90000")))
    assert after.count() == 10_000
    frame = after.select("seq")
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and " OR isnull" not in plan


def test_marks_are_kept_by_table(spark, tmp_path):
    store = ingest.MarkStore(spark, str(tmp_path / "marks"))
    log = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS change_ts, explode(sequence(1, 4)) AS seq")
    assert store.read("a") is None
    store.advance("a", log.where("seq <= 2"))
    store.advance("a", log.where("seq < 0"))
    store.advance("b", log)
    source = ingest.Source("a", changes=log)
    assert sorted(r.seq for r in ingest.ingest("incremental", source, store.read("a")).collect()) == [3, 4]
    assert ingest.ingest("incremental", source, store.read("b")).count() == 0
    assert ingest.ingest("incremental", source, store.read("c")).count() == 4


def test_modes():
    assert ingest.resolve_mode(None) == "incremental"
    assert ingest.resolve_mode("FullDump") == "full"
    with pytest.raises(ValueError, match="no ingestion mode is called 'weekly'"):
        ingest.resolve_mode("weekly")


def test_full_dump_needs_a_notification(spark):
    table = spark.range(3)
    notes = spark.createDataFrame([({"table_name": "t"}, "[]")], "attributes map<string,string>, payload string")
    assert ingest.ingest_full(table, notes, "t").count() == 3
    assert ingest.ingest_full(table, notes, "other").count() == 0


def test_dependencies(spark):
    day = dt.date(2024, 1, 2)
    log = spark.createDataFrame(
        [("users", dt.date(2024, 1, 1), "SUCCESS"), ("orders", dt.date(2024, 1, 1), "FAILED")],
        "table_name string, run_date date, status string",
    )
    rows = spark.createDataFrame(
        [("users", day, 1), ("orders", day, 2), ("refined", day, 3), ("other", day, 4), ("users", dt.date(2024, 1, 5), 5)],
        "table_name string, run_date date, v int",
    )
    deps = {"users": ["snapshot_previous_day"], "orders": [], "refined": [{"condition": "snapshot_previous_day", "requires": "orders"}]}
    assert sorted(r.v for r in dependency.gate(rows, deps, log).collect()) == [1, 2, 4]
    assert {(r.table_name, r.requires) for r in dependency.unmet(rows, deps, log).collect()} == {("refined", "orders"), ("users", "users")}
    assert dependency.met(rows, deps, log).count() == 1
    assert dependency.gate(rows, {}, log).count() == 5
    with pytest.raises(ValueError, match="moon"):
        dependency.normalise({"a": ["full_moon"]})


def test_limits(spark):
    df = spark.range(20).select((F.col("id") % 3).alias("g"), "id")
    assert sorted(map(tuple, limit_per_group(df, ["g"], [F.col("id").desc()], 2).collect())) == [
        (0, 15), (0, 18), (1, 16), (1, 19), (2, 14), (2, 17)
    ]
    assert sorted(r.id for r in latest_per_key(df, ["g"], ["id"]).collect()) == [17, 18, 19]
    assert [r.id for r in top_n(df, ["id"], 2).collect()] == [0, 1]


def test_sliding_equals_direct_windows(spark):
    df = spark.range(200).select(F.timestamp_seconds(F.col("id") * 7).alias("ts"))
    by_panes = {(r[0], r[1]): r.n for r in sliding_counts(df, "ts", 60, 20).collect()}
    direct = df.groupBy(F.window("ts", "60 seconds", "20 seconds").alias("w")).count()
    assert by_panes == {(r.w.start, r.w.end): r["count"] for r in direct.collect()}
    uneven = sliding_counts(df, "ts", 50, 20)
    direct = df.groupBy(F.window("ts", "50 seconds", "20 seconds").alias("w")).count()
    assert {(r[0], r[1]): r.n for r in uneven.collect()} == {(r.w.start, r.w.end): r["count"] for r in direct.collect()}


def test_window_bounds_equal_tumbling(spark):
    df = spark.range(50).select(F.timestamp_millis(F.col("id") * 333 - 5000).alias("ts"))
    start, end = window_bounds(F.col("ts"))
    mine = {(r[0], r[1]): r[2] for r in df.groupBy(start.alias("s"), end.alias("e")).count().collect()}
    assert mine == {(r.window_start, r.window_end): r.n for r in tumbling(df, "ts").collect()}


@FEW
@given(rows=member_rows)
def test_pass_and_quarantine_split_the_input(spark, rows):
    df = spark.createDataFrame(rows, MEMBER)
    flagged = quality.with_flags(df, [DQRule("not_null", ("email",)), DQRule("unique", ("record_id",))])
    good, bad = quality.passed(flagged), quality.quarantined(flagged)
    assert Counter(map(tuple, good.select(df.columns).collect())) + Counter(
        map(tuple, bad.select(df.columns).collect())
    ) == Counter(rows)
    assert all(r._dq_failed for r in bad.collect())
