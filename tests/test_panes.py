"""Panes of windows compared with a plain walk over the deliveries."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from zoneflow.sinks.tables import read_batches
from zoneflow.streaming.panes import PROVIDER, milliseconds, pane_stream
from zoneflow.streaming.windows import AVAILABLE

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SIZE, LATENESS = 10, 15


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def plain(deliveries, early):
    """``early``: every delivery makes early panes, or none does."""
    panes, waiting, count, closed, mark = [], Counter(), Counter(), set(), float("-inf")

    def fire(key, kind, n):
        panes.append((key[0], key[1], kind, count[key], n))
        count[key] += 1

    def pass_by():
        for key in [k for k in waiting if mark >= k[0] + SIZE and k not in closed]:
            fire(key, "ON_TIME", waiting[key])
            closed.add(key)

    for rows in [*deliveries, []]:
        pass_by()
        new = Counter((s // SIZE * SIZE, g) for s, g in rows if s is not None)
        for key, n in new.items():
            if mark >= key[0] + SIZE + LATENESS:
                continue
            if mark >= key[0] + SIZE:
                fire(key, "LATE", n)
            elif early:
                waiting[key] += 0
                fire(key, "EARLY", n)
            else:
                waiting[key] += n
        mark = max([mark, *(s for s, _ in rows if s is not None)])
    return sorted(panes, key=str)


def fired(spark, tmp_path, deliveries, early):
    inbox, path = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in deliveries:
        spark.createDataFrame([(at(s), g, 1) for s, g in rows], "event_ts timestamp, kind string, n int").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("event_ts timestamp, kind string, n int").parquet(inbox)
        pane_stream(
            stream, path, str(tmp_path / "c"), size=f"{SIZE} seconds", groups=["kind"], early=early, lateness=f"{LATENESS} seconds", trigger=AVAILABLE
        ).awaitTermination()
    out = read_batches(spark, path).selectExpr("unix_seconds(window_start) AS s", "unix_seconds(window_end) AS e", "kind", "pane", "number", "n").collect()
    assert all(r["e"] - r["s"] == SIZE for r in out)
    begin = int(START.timestamp())
    return sorted([(r["s"] - begin, r["kind"], r["pane"], r["number"], r["n"]) for r in out], key=str)


@pytest.mark.parametrize("early", ["0 seconds", "1000 days"])
def test_against_a_plain_walk(spark, tmp_path, early):
    rng = random.Random(3)
    deliveries = []
    for step in range(4):
        rows = [(step * 12 + rng.randint(-28, 12), rng.choice(["a", "b", None])) for _ in range(40)]
        deliveries.append([(max(s, 0), g) for s, g in rows] + [(None, "a"), (step * 12, "hot")] + [(step * 12 + 1, "hot")] * 200)
    expected = plain(deliveries, early == "0 seconds")
    assert {p[2] for p in expected} == ({"EARLY"} if early == "0 seconds" else set()) | {"ON_TIME", "LATE"}
    assert fired(spark, tmp_path, deliveries, early) == expected


def test_early_pane_comes_with_a_newer_watermark(spark, tmp_path):
    """The first delivery's row waits; the micro-batch that moves the watermark on writes it without new rows of its window."""
    assert fired(spark, tmp_path, [[(1, "a")]], "1 millisecond") == [(0, "a", "EARLY", 0, 1)]


def test_no_rows_and_the_sessions_state_store_stays(spark, tmp_path):
    before = spark.conf.get(PROVIDER)
    try:
        spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
        assert fired(spark, tmp_path, [[(None, "a")], [(25, "a")]], "0 seconds") == [(20, "a", "EARLY", 0, 1)]
        assert spark.conf.get(PROVIDER).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(PROVIDER, before)


def test_intervals(spark):
    assert [milliseconds(spark, i) for i in ("500 milliseconds", "5 minutes", "1 day", "0 seconds")] == [500, 300_000, 86_400_000, 0]


@pytest.mark.parametrize("step", [-0.001, 0, 0.001])
def test_a_window_that_begins_a_millisecond_before_it_passes(spark, tmp_path, step):
    """The second window is met first when the watermark stands right at its timer; then a row comes at, before or behind its end."""
    out = fired(spark, tmp_path, [[(9.999, "a")], [(5, "b")], [(10 + step, "c")]], "1000 days")
    assert out == ([] if step < 0 else [(0, "a", "ON_TIME", 0, 1), (0, "b", "ON_TIME", 0, 1)])
