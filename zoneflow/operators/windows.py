"""Event-time window counts for batch frames and streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the windowed aggregates.
WINDOW_SIZE = "1 second"
EARLY_FIRING = "500 milliseconds"
ALLOWED_LATENESS = "5 minutes"


def tumbling(
    df: DataFrame,
    ts: str,
    size: str = WINDOW_SIZE,
    groups: Sequence[str] = (),
    aggregates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Aggregates per fixed window (row count by default), with ``window_start`` and ``window_end``."""
    exprs = aggregates or {"n": F.count(F.lit(1))}
    return (
        df.groupBy(F.window(ts, size), *groups)
        .agg(*[c.alias(name) for name, c in exprs.items()])
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *groups,
            *exprs,
        )
    )


def sliding_counts(df: DataFrame, ts: str, size_seconds: int, slide_seconds: int, groups: Sequence[str] = ()) -> DataFrame:
    """Row counts per sliding window.

    In batch, rows are counted per slide first and only those counts are copied into the
    overlapping windows; with a slide that does not divide the size, and in streams, each row goes
    to all its windows.
    """
    if df.isStreaming or size_seconds % slide_seconds:
        return (
            df.groupBy(F.window(ts, f"{size_seconds} seconds", f"{slide_seconds} seconds"), *groups)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(
                F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"),
                *groups,
                "n",
            )
        )
    panes = tumbling(df, ts, f"{slide_seconds} seconds", groups)
    steps = size_seconds // slide_seconds
    offsets = F.sequence(F.lit(0), F.lit(steps - 1))
    start = F.col("window_start") - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("_step") * slide_seconds).cast("decimal(18,6)")
    )
    return (
        panes.withColumn("_step", F.explode(offsets))
        .withColumn("window_start", start)
        .groupBy("window_start", *groups)
        .agg(F.sum("n").alias("n"))
        .select(
            "window_start",
            (F.col("window_start") + F.expr(f"INTERVAL {size_seconds} SECONDS")).alias("window_end"),
            *groups,
            "n",
        )
    )


def window_bounds(ts: Column, size_seconds: int = 1) -> tuple[Column, Column]:
    """Start and end of the fixed window of ``ts`` as plain arithmetic; a null time has null bounds."""
    micros = F.unix_micros(ts)
    size = F.lit(size_seconds * 1_000_000)
    start = micros - F.pmod(micros, size)
    return F.timestamp_micros(start), F.timestamp_micros(start + size)
