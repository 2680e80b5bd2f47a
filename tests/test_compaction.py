"""Compaction of log tables beside readers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from zoneflow.sinks import tables as sink
from zoneflow.sinks.compaction import compact_log, read_log, remove_compacted

ZONES = ("raw", "structure", "refined", "analytics")


def log_rows(spark, batch, n=40, files=5):
    rows = spark.range(n).select(
        F.concat(F.lit(f"{batch}-"), "id").alias("log_id"),
        F.lit("d").alias("domain"),
        F.element_at(F.array(*map(F.lit, ZONES)), (F.col("id") % 4 + 1).cast("int")).alias("zone"),
        F.lit("t").alias("table_name"),
    )
    return rows.repartition(files)


def write(spark, path, batch, **options):
    sink.write_log(log_rows(spark, batch, **options), path, batch)


def content(df):
    return sorted((r["log_id"], r["zone"], r["_batch_id"], r["created_date"]) for r in df.collect())


def test_same_rows_before_and_after(spark, tmp_path):
    path = str(tmp_path / "log")
    for batch in range(6):
        write(spark, path, batch)
    before = content(read_log(spark, path))
    assert len(before) == 240
    running = read_log(spark, path)  # planned before, read after
    files = len(running.inputFiles())
    assert compact_log(spark, path) == 6
    assert content(read_log(spark, path)) == before == content(running)
    assert len(read_log(spark, path).inputFiles()) == 1 < files
    # plain readers see the batches, and only those
    assert sink.read_batches(spark, path).count() == 240
    assert compact_log(spark, path) == 0
    write(spark, path, "later")
    assert len(content(read_log(spark, path))) == 280
    assert remove_compacted(spark, path) == 6
    assert compact_log(spark, path) == 1
    assert remove_compacted(spark, path) == 1
    after = content(read_log(spark, path))
    assert len(after) == 280 and set(before) <= set(after)


def test_an_unfinished_compaction_is_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    for batch in range(2):
        write(spark, path, batch)
    compact_log(spark, path)
    os.remove(f"{path}/_compacted/rows-000000/_SUCCESS")
    assert len(content(read_log(spark, path))) == 80
    assert remove_compacted(spark, path) == 0
    assert compact_log(spark, path) == 2
    assert len(content(read_log(spark, path))) == 80


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "log")
    write(spark, path, "r1")
    compact_log(spark, path)
    write(spark, path, "r1")
    assert len(content(read_log(spark, path))) == 40
    assert compact_log(spark, path) == 0


def test_zones_lie_in_files_of_their_own(spark, tmp_path):
    path = str(tmp_path / "log")
    for batch in range(4):
        write(spark, path, batch, n=4000)
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)
    compact_log(spark, path, file_bytes=size // 24)
    rows = read_log(spark, path).where("zone = 'raw'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(zone,raw)" in plan
    rows = rows.select("log_id", F.input_file_name().alias("file"))
    holding = {r["file"] for r in rows.select("file").distinct().collect()}
    files = read_log(spark, path).inputFiles()
    assert rows.count() == 4000 and len(holding) < len(files) / 2
    # no file holds most of the zone that has a fourth of all rows, as its rows are dealt further
    most = rows.groupBy("file").count().agg(F.max("count")).first()[0]
    assert most <= 3000


def test_columns_that_came_later(spark, tmp_path):
    path = str(tmp_path / "log")
    write(spark, path, 0)
    compact_log(spark, path)
    sink.write_log(log_rows(spark, 1).withColumn("more", F.lit(1)), path, 1)
    assert read_log(spark, path).where("more IS NULL").count() == 40
    compact_log(spark, path)
    assert read_log(spark, path).where("more = 1").count() == 40


def test_nothing_there(spark, tmp_path):
    assert compact_log(spark, str(tmp_path / "none")) == 0
    assert remove_compacted(spark, str(tmp_path / "none")) == 0
    with pytest.raises(FileNotFoundError):
        read_log(spark, str(tmp_path / "none"))
