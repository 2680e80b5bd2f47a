"""Reconciliation of JSON objects whose keys differ by line."""

from __future__ import annotations

import json

import pytest

from zoneflow.operators.reconcile import variant_column_diff
from zoneflow.operators.skew import SkewPlan
from zoneflow.sources.snapshots import scan_variant, variant_columns, variant_text

ODD = ["a.b", "a b", "q'r", 'd"e', "b`t", "both'\"", "é", "A", "OBJECT<x: INT>"]


def lines(spark, path, objects):
    path.write_text("\n".join(o if isinstance(o, str) else json.dumps(o) for o in objects) + "\n")
    return scan_variant(spark, str(path))


def diff(ours, theirs, **options):
    return sorted(tuple(r) for r in variant_column_diff(ours, theirs, **options).collect())


def test_only_objects_are_rows(spark, tmp_path):
    rows = lines(spark, tmp_path / "x", ['{"id": 1}', "[1]", "7", "null", "no json", "", ' {"id": 2}', '{"id": 1, "id": 2}', "{"])
    assert sorted(r["id"] for r in rows.select(variant_text(rows["row"], "id").alias("id")).collect()) == ["1", "2"]


def test_keys_of_any_text(spark, tmp_path):
    rows = lines(spark, tmp_path / "x", [{k: i} for i, k in enumerate([*ODD, "a"])])
    assert variant_columns(rows) == sorted([*ODD, "a"])
    for i, key in enumerate(ODD):
        found = [r[0] for r in rows.select(variant_text(rows["row"], key)).collect() if r[0] is not None]
        assert found == [str(i)], key


def test_no_rows_have_no_keys(spark, tmp_path):
    assert variant_columns(lines(spark, tmp_path / "x", ["7"])) == []
    assert variant_columns(lines(spark, tmp_path / "y", ["{}"]), lines(spark, tmp_path / "z", ["[]"])) == []
    some = lines(spark, tmp_path / "s", [{"record_id": "1", "a": 1}])
    assert diff(some, lines(spark, tmp_path / "x", ["7"])) == []


@pytest.mark.parametrize("skew", [SkewPlan(), None])
def test_against_plain_python(spark, tmp_path, skew):
    left = [{"record_id": i % 7, **{k: (i + j) % 3 for j, k in enumerate(ODD) if (i + j) % 2}, "_meta": i} for i in range(40)]
    right = [{"id": str(i % 9), **{k: (i * j) % 3 for j, k in enumerate(ODD) if i % 3 or j % 2}, "nested": {"x": [i % 2]}} for i in range(30)]
    left += [{"record_id": None, "A": 1}, {"A": 2}]

    def text(row, key):
        value = row.get(key)
        return None if value is None else json.dumps(value, separators=(",", ":")) if isinstance(value, dict) else str(value)

    names = sorted([*ODD, "nested"])
    expected: dict = {}
    for a in left:
        for b in right:
            if text(a, "record_id") is not None and text(a, "record_id") == text(b, "id"):
                bad = ",".join(k for k in names if text(a, k) != text(b, k))
                if bad:
                    expected[a["record_id"], bad] = expected.get((a["record_id"], bad), 0) + 1
    got = diff(lines(spark, tmp_path / "l", left), lines(spark, tmp_path / "r", right), renames={"id": "record_id"}, skew=skew)
    assert got == sorted((str(i), bad, n) for (i, bad), n in expected.items())


def test_types_are_compared_by_their_text(spark, tmp_path):
    ours = lines(spark, tmp_path / "l", ['{"record_id": "1", "n": 1.50, "b": true, "t": "x"}'])
    theirs = lines(spark, tmp_path / "r", ['{"record_id": 1, "n": "1.5", "b": "true", "t": null}'])
    assert diff(ours, theirs) == [("1", "t", 1)]
