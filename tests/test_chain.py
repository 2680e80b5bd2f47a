"""Unmet prerequisites over several tables and days."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from zoneflow.operators.dependency import DAYS_BACK, gate, normalise, unmet, unmet_chain

PREVIOUS, SAME = "snapshot_previous_day", "same_day"


def need(requires, condition=PREVIOUS):
    return {"condition": condition, "requires": requires}


def runs(spark, rows):
    return spark.createDataFrame(rows, "table_name string, day string, status string").withColumn("run_date", F.col("day").cast("date"))


def wanted(spark, *rows):
    return spark.createDataFrame([r for r in rows], "table_name string, day string").withColumn("run_date", F.col("day").cast("date"))


def found(df):
    return sorted((r["table_name"], str(r["run_date"]), r["requires"], str(r["required_date"]), r["steps"], r["path"]) for r in df.collect())


def plain(rows, deps, done, first):
    """Breadth-first search over single runs."""
    out = []
    for table, day in sorted(rows):
        level, seen, steps = {(table, day): f"{table}@{day}"}, set(), 0
        while level:
            steps += 1
            new = {}
            for (t, d), path in level.items():
                for of, condition, requires in normalise(deps):
                    run = (requires, d - dt.timedelta(DAYS_BACK[condition]))
                    if of != t or run in done or run in seen:
                        continue
                    way = f"{path} > {run[0]}@{run[1]}"
                    new[run] = min(new.get(run, way), way)
            seen |= set(new)
            out += [(table, str(day), r, str(d), steps, p) for (r, d), p in new.items()]
            level = {run: p for run, p in new.items() if run[1] >= first}
    return sorted(out)


def test_against_plain_search(spark):
    rng = random.Random(5)
    tables = ["a", "b", "c", "d", "e"]
    deps = {t: [need(r, SAME) for r in tables[i + 1 :] if rng.random() < 0.6] for i, t in enumerate(tables)}
    for t in tables:
        deps[t] += [need(r) for r in tables if rng.random() < 0.4]
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(8)]
    done = {(t, d) for t in tables for d in days if rng.random() < 0.4}
    log = runs(spark, [(t, str(d), "SUCCESS") for t, d in done] + [("a", str(d), "FAILED") for d in days])
    asked = [(t, d) for t in ("a", "c") for d in days]
    got = found(unmet_chain(wanted(spark, *[(t, str(d)) for t, d in asked]), deps, log))
    assert got == plain(asked, deps, done, min(d for _, d in done))


def test_forks_are_followed_once(spark):
    """Two tables that need each other for 12 days: 2 ** 12 ways, 24 unfinished runs."""
    deps = {t: [need("a"), need("b")] for t in ("a", "b")}
    chain = unmet_chain(wanted(spark, ("a", "2024-02-10")), deps, runs(spark, []), since="2024-01-30")
    rows = found(chain)
    assert len(rows) == 2 * 12 and max(r[4] for r in rows) == 12
    paths = {(r[2], r[3]): r[5] for r in rows}
    assert paths["b", "2024-02-08"] == "a@2024-02-10 > a@2024-02-09 > b@2024-02-08"


def test_a_finished_run_ends_the_search(spark):
    deps = {"a": [need("b")], "b": [need("c")]}
    log = runs(spark, [("b", "2024-01-09", "SUCCESS"), ("c", "2024-01-01", "SUCCESS")])
    assert found(unmet_chain(wanted(spark, ("a", "2024-01-10")), deps, log)) == []
    assert [r[2] for r in found(unmet_chain(wanted(spark, ("a", "2024-01-11")), deps, log))] == ["b", "c"]


def test_edges(spark):
    deps = {"a": ["snapshot_previous_day"]}
    empty = wanted(spark)
    assert found(unmet_chain(empty, deps, runs(spark, []))) == []
    # without a finished run and a first day nothing is followed
    assert [r[3] for r in found(unmet_chain(wanted(spark, ("a", "2024-01-10"), ("a", "2024-01-10")), deps, runs(spark, [])))] == ["2024-01-09"]
    undated = found(unmet_chain(wanted(spark, ("a", None), (None, "2024-01-10")), deps, runs(spark, []), since="2024-01-01"))
    assert undated == [("a", "None", "a", "None", 1, "a@? > a@?")]
    assert found(unmet_chain(wanted(spark, ("x", "2024-01-10")), deps, runs(spark, []))) == []


def test_circles_of_one_day_are_errors(spark):
    circle = {"a": [need("b", SAME)], "b": [need("c", SAME)], "c": [need("a", SAME)]}
    for deps in (circle, {"a": [need("a", SAME)]}):
        with pytest.raises(ValueError, match="same day"):
            unmet_chain(wanted(spark, ("a", "2024-01-10")), deps, runs(spark, []))
    normalise({**circle, "c": [need("a")]})  # over a night it is none


def test_the_gate_knows_same_day_conditions(spark):
    deps = {"a": [need("b", SAME)]}
    log = runs(spark, [("b", "2024-01-02", "SUCCESS")])
    rows = wanted(spark, ("a", "2024-01-02"), ("a", "2024-01-03"), ("b", "2024-01-03"))
    assert sorted((r["table_name"], r["day"]) for r in gate(rows, deps, log).collect()) == [("a", "2024-01-02"), ("b", "2024-01-03")]
    assert [str(r["required_date"]) for r in unmet(rows, deps, log).collect()] == ["2024-01-03"]
