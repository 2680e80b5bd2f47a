"""Snapshot listings compared with earlier ones."""

from __future__ import annotations

import os

from zoneflow.sources.snapshots import listing, listing_changes, scan_changed


def put(folder, name, text, modified):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (modified, modified))


def stored(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def changes_of(spark, tmp_path, first, second):
    return stored(listing_changes(first, second), tmp_path / "changes")


def test_added_changed_gone(spark, tmp_path):
    folder = tmp_path / "objects"
    put(folder, "a/same.jsonl", '{"id": "1"}\n', 1000)
    put(folder, "a/longer.jsonl", '{"id": "2"}\n', 1000)
    put(folder, "touched x.jsonl", '{"id": "3"}\n', 1000)
    put(folder, "gone.jsonl", '{"id": "4"}\n', 1000)
    put(folder, "emptied.jsonl", '{"id": "7"}\n', 1000)
    first = stored(listing(spark, str(folder)), tmp_path / "first")
    put(folder, "a/longer.jsonl", '{"id": "2"}\n{"id": "5"}\nno json\n[1]\n', 3000)
    put(folder, "touched x.jsonl", '{"id": null}\n', 5000)
    put(folder, "new/é.jsonl", '{"id": "6", "more": 1}\n', 4000)
    put(folder, "empty.jsonl", "", 4000)
    put(folder, "emptied.jsonl", "", 4000)
    (folder / "gone.jsonl").unlink()
    second = stored(listing(spark, str(folder)), tmp_path / "second")
    changes = changes_of(spark, tmp_path, first, second)
    named = {(r["key"].rsplit("/", 1)[1], r["change"]) for r in changes.collect()}
    assert named == {
        ("longer.jsonl", "changed"),
        ("touched%20x.jsonl", "changed"),
        ("é.jsonl", "added"),
        ("gone.jsonl", "gone"),
        ("emptied.jsonl", "gone"),
    }
    rows = scan_changed(spark, str(folder), changes, ["id", "missing"])
    assert sorted((r["id"], r["missing"]) for r in rows.collect() if r["id"]) == [("2", None), ("5", None), ("6", None)]
    assert rows.where("id IS NULL").count() == 1
    # the object that stayed is older than all changes: the scan does not even list it
    assert not any("same.jsonl" in f for f in rows.inputFiles())


def test_an_object_that_stayed_but_is_newer_than_a_change_gives_no_rows(spark, tmp_path):
    folder = tmp_path / "objects"
    put(folder, "stays.jsonl", '{"id": "1"}\n', 9000)
    first = stored(listing(spark, str(folder)), tmp_path / "first")
    put(folder, "old.jsonl", '{"id": "2"}\n', 1000)
    changes = changes_of(spark, tmp_path, first, listing(spark, str(folder)))
    assert [tuple(r) for r in scan_changed(spark, str(folder), changes, ["id"]).collect()] == [("2",)]


def test_nothing_changed(spark, tmp_path):
    folder = tmp_path / "objects"
    put(folder, "stays.jsonl", '{"id": "1"}\n', 9000)
    first = stored(listing(spark, str(folder)), tmp_path / "first")
    changes = changes_of(spark, tmp_path, first, listing(spark, str(folder)))
    assert changes.count() == 0
    assert scan_changed(spark, str(folder), changes, ["id"]).collect() == []
