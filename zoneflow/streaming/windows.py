"""Windowed aggregates on streams: on-time, early, discarding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from zoneflow.operators.limits import limit_per_group
from zoneflow.operators.windows import EARLY_FIRING, WINDOW_SIZE, sliding_counts, tumbling
from zoneflow.sinks.tables import write_batch

PROCESSING = {"processingTime": EARLY_FIRING}
AVAILABLE = {"availableNow": True}


def windowed_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "event_ts",
    size: str = WINDOW_SIZE,
    groups: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Each window once, when the watermark has passed its end. ``stream`` carries the watermark."""
    return (
        tumbling(stream, ts, size, groups)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PROCESSING))
        .start(path)
    )


def sliding_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    size_seconds: int,
    slide_seconds: int,
    ts: str = "event_ts",
    groups: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Each sliding window once, when the watermark has passed its end. ``stream`` carries the watermark."""
    return (
        sliding_counts(stream, ts, size_seconds, slide_seconds, groups)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PROCESSING))
        .start(path)
    )


def early_update(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "event_ts",
    size: str = WINDOW_SIZE,
    groups: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Running totals: every trigger writes the windows that changed, early and late ones included.

    A window keeps its state until the watermark passes it. Read with ``newest_panes``.
    """
    return (
        tumbling(stream, ts, size, groups)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PROCESSING))
        .start()
    )


def newest_panes(panes: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The last written total of each window."""
    keys = ["window_start", "window_end", *groups]
    return limit_per_group(panes, keys, [panes["_batch_id"].desc()], 1)


def discarding_panes(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "event_ts",
    size: str = WINDOW_SIZE,
    groups: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Per trigger only what is new: each micro-batch is aggregated on its own, without state.

    The panes of a window add up to its total, and late rows are never dropped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(tumbling(batch, ts, size, groups), path, batch_id)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PROCESSING))
        .start()
    )
