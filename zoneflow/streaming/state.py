"""Keyed state across micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zoneflow.operators.limits import limit_per_group
from zoneflow.operators.notify import dedup_messages
from zoneflow.sinks.tables import write_batch
from zoneflow.streaming.windows import PROCESSING


def last_change(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    order: Sequence[str],
    values: Sequence[str],
    trigger: dict | None = None,
    output: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Newest ``values`` per key by ``order``; each trigger writes the keys that changed, as ``output`` makes them.

    The state is one row per key, and rows of a hot key are combined before they reach it.
    """
    newest = stream.groupBy(key).agg(F.max(F.struct(*order, *values)).alias("_last"))
    return (
        (output or (lambda df: df))(newest.select(key, "_last.*"))
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PROCESSING))
        .start()
    )


def read_last_change(spark: SparkSession, checkpoint: str, key: str, batch_id: int | None = None) -> DataFrame:
    """The keyed state of a ``last_change`` query as a table: key, order and value columns, one row per key.

    Read through the state store of its checkpoint, as of the last finished micro-batch or of ``batch_id``; the query need not run.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    held = state.schema["value"].dataType[0].name
    return state.select(F.col(f"key.{key}").alias(key), F.col(f"value.`{held}`").alias("_last")).select(key, "_last.*")


def beginning_with(stream: DataFrame, state: DataFrame, path: str) -> DataFrame:
    """``stream`` after the rows of ``state``, which are written to ``path`` and come once, as a source of the new query.

    So a query with another output, which could not use the old checkpoint, goes on from the state of the old one. ``path`` must
    stay as long as the new checkpoint; columns that the state lacks are null.
    """
    spark = stream.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
        state.write.mode("overwrite").parquet(path)
    first = spark.readStream.schema(state.schema).parquet(path)
    return first.unionByName(stream, allowMissingColumns=True).select(*stream.columns)


def newest_state(written: DataFrame, key: str) -> DataFrame:
    """Current state out of the written changes."""
    return limit_per_group(written, [key], [F.col("_batch_id").desc()], 1).drop("_batch_id")


def dedup_stream(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Messages without redelivered copies; ``messages`` carries the watermark the copies arrive in."""
    return (
        dedup_messages(messages)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PROCESSING))
        .start(path)
    )
