"""The zone chain on a stream of notifications."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zoneflow.config import ZoneConfig
from zoneflow.operators.notify import dedup_messages
from zoneflow.plans.zones import Hook, changed_records, run_zones
from zoneflow.sources.buckets import BucketedTable
from zoneflow.streaming.windows import PROCESSING

REDELIVERY = "10 minutes"  # fixed value: arrival time in which a message may come again


def zone_stream(
    messages: DataFrame,
    table_rows: Callable[[], DataFrame | BucketedTable],
    cfg: ZoneConfig,
    root: str,
    checkpoint: str,
    snapshots: Mapping[str, DataFrame] | Callable[[], Mapping[str, DataFrame]] | None = None,
    hooks: Mapping[str, Hook] | None = None,
    window_seconds: int | None = 1,
    redelivery: str = REDELIVERY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Drop redelivered messages, then run each micro-batch through the zones.

    Redelivery is judged by arrival time, so a message with an old event time still gets through.

    ``table_rows`` is called per batch, so every batch fetches the rows as they are then, from a bucketed table only the buckets
    that its ids fall into; ``snapshots`` may be a call too,
    which sees snapshot objects that arrive later. A batch replaces its own output folders, so running it again leaves the same rows.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():  # such as the batch that only moves the watermark
                return
            records = changed_records(batch, table_rows(), cfg, deduped=True)
            legacy = snapshots() if callable(snapshots) else snapshots
            run_zones(records, cfg, root, batch_id, legacy, hooks, window_seconds)
        finally:
            batch.unpersist()

    arrived = messages.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", redelivery)
    return (
        dedup_messages(arrived)
        .drop("_arrived")
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PROCESSING))
        .start()
    )
