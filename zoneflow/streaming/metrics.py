"""Metrics of running streams: one set of rows for each micro-batch."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from zoneflow.sinks.tables import write_batch


def observe_stream(stream: DataFrame, pipeline_id: str, metrics: Mapping[str, Column]) -> DataFrame:
    """``stream`` whose micro-batches report the metrics (aggregates) under ``pipeline_id`` while they run: no second pass."""
    return stream.observe(pipeline_id, *[c.alias(n) for n, c in metrics.items()])


class MetricWriter(StreamingQueryListener):
    """Writes (pipeline_id, batch_id, started_at, name, value) rows of each micro-batch under ``path``.

    Only what comes through ``observe_stream`` under ``pipeline_id`` is written; other queries may run in the session. A batch owns
    the folder ``_batch_id=…``, so one that runs again after a restart replaces its rows. A null metric (such as the
    maximum of no rows) is null. Use as a context manager, or add and remove it as any listener, and call
    ``wait`` for a query that has ended before its rows are read: listeners hear of batches later than the query itself.
    """

    def __init__(self, spark: SparkSession, pipeline_id: str, path: str):
        self.spark, self.pipeline_id, self.path = spark, pipeline_id, path
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)
        self._failed: list[Exception] = []

    def __enter__(self) -> MetricWriter:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        observed = progress.observedMetrics.get(self.pipeline_id)
        if observed is None:
            return
        try:
            entries = F.array(
                *[
                    F.struct(F.lit(name).alias("name"), F.lit(None if value is None else float(value)).cast("double").alias("value"))
                    for name, value in observed.asDict().items()
                ]
            )
            rows = self.spark.range(1).select(
                F.lit(self.pipeline_id).alias("pipeline_id"),
                F.lit(progress.batchId).cast("bigint").alias("batch_id"),
                F.lit(progress.timestamp).cast("timestamp").alias("started_at"),
                F.inline(entries),
            )
            write_batch(rows.coalesce(1), self.path, progress.batchId)
        except Exception as error:  # a listener's error would only be logged
            self._failed.append(error)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Until all batches of a query that has ended are written; raises what a write raised."""
        query.awaitTermination()
        if not self._ended[str(query.runId)].wait(timeout):
            raise TimeoutError(f"the listener has not heard of the end of {query.runId}")
        if self._failed:
            raise self._failed[0]
