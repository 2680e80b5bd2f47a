"""One set of metric rows for each micro-batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zoneflow.sinks.tables import read_batches
from zoneflow.streaming.metrics import MetricWriter, observe_stream


def measures():
    return {"rows": F.count(F.lit(1)), "largest": F.max("n"), "odd": F.count_if(F.col("n") % 2 == 1)}


def start(spark, tmp_path, name="numbers", chosen=None):
    stream = spark.readStream.schema("n long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    running = observe_stream(stream, name, chosen or measures()).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"cp-{name}"))
    return running.trigger(availableNow=True).start(str(tmp_path / f"out-{name}"))


def put(spark, tmp_path, *values):
    spark.createDataFrame([(v,) for v in values], "n long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def figures(spark, tmp_path):
    rows = read_batches(spark, str(tmp_path / "figures")).collect()
    return sorted((r["batch_id"], r["name"], r["value"]) for r in rows)


def test_rows_of_each_batch_over_restarts(spark, tmp_path):
    put(spark, tmp_path, 1, 2, 3)
    put(spark, tmp_path, None)
    with MetricWriter(spark, "numbers", str(tmp_path / "figures")) as writer:
        writer.wait(start(spark, tmp_path))
        other = start(spark, tmp_path, "other", {"rows": F.count(F.lit(1))})  # another query's metrics are not written
        writer.wait(other)
        put(spark, tmp_path, 7)
        writer.wait(start(spark, tmp_path))
    got = figures(spark, tmp_path)
    batches = [tuple(v for b, _, v in got if b == i) for i in range(3)]
    # by name: largest, odd, rows; files of one listing may come in any order
    assert sorted(batches[:2], key=str) == sorted([(3.0, 2.0, 3.0), (None, 0.0, 1.0)], key=str) and batches[2] == (7.0, 1.0, 1.0)
    assert len(got) == 9


def test_a_removed_listener_writes_nothing(spark, tmp_path):
    put(spark, tmp_path, 1)
    with MetricWriter(spark, "numbers", str(tmp_path / "figures")):
        pass
    start(spark, tmp_path).awaitTermination()
    assert not (tmp_path / "figures").exists()


def test_an_error_of_the_write_is_raised(spark, tmp_path):
    put(spark, tmp_path, 1)
    (tmp_path / "file").write_text("")
    with MetricWriter(spark, "numbers", str(tmp_path / "file")) as writer:
        with pytest.raises(Exception, match="file"):
            writer.wait(start(spark, tmp_path))
