"""Early, on-time and late panes of fixed windows, as one stateful operator."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from zoneflow.operators.windows import ALLOWED_LATENESS, EARLY_FIRING, WINDOW_SIZE
from zoneflow.sinks.tables import write_batch
from zoneflow.streaming.windows import PROCESSING

# The kinds of panes.
EARLY, ON_TIME, LATE = "EARLY", "ON_TIME", "LATE"

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def milliseconds(spark: SparkSession, interval: str) -> int:
    """Length of an interval without months, such as "5 minutes"."""
    micros = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {interval})")
    return spark.range(1).select(micros.alias("micros")).first()["micros"] // 1000


def fired_panes(
    stream: DataFrame,
    ts: str = "event_ts",
    size: str = WINDOW_SIZE,
    groups: Sequence[str] = (),
    early: str = EARLY_FIRING,
    lateness: str = ALLOWED_LATENESS,
) -> DataFrame:
    """Panes of fixed windows: ``window_start``, ``window_end``, groups, ``pane``, ``number`` (from 0) and ``n``, the rows
    since the pane before, so that the panes of a window add up to its total.

    A window has passed when a row at or behind its end was seen in an earlier micro-batch, and closes ``lateness`` after
    that, in event time. Before it has passed, a pane is EARLY; it is due ``early`` after its first row arrived and comes with
    the first micro-batch from then on that has rows of the window or a newer watermark. The pane of the passing itself is ON_TIME
    and comes also with no new rows, as the sign that the window is complete. Rows of a passed window make a LATE pane in their
    micro-batch; rows of a closed window are dropped, as are rows without a time. A window whose first row comes when it has
    passed has LATE panes only. The watermark is set here; ``stream`` must not have one.

    Rows are counted inside the input tasks first, so the rows of a hot window reach its state as a few counts. The state is one
    small row per open window and group, and goes when the window closes.
    """
    spark = stream.sparkSession
    early_ms, late_ms = milliseconds(spark, early), milliseconds(spark, lateness)
    names = [f"_g{i}" for i in range(len(groups))]
    window = F.window("_ts", size)
    timed = stream.where(F.col(ts).isNotNull()).select(F.col(ts).alias("_ts"), *[F.col(g).alias(n) for g, n in zip(groups, names)])
    placed = timed.withWatermark("_ts", lateness).select(
        F.unix_millis(window["start"]).alias("_start"), F.unix_millis(window["end"]).alias("_end"), *names
    )
    keys = ["_start", "_end", *names]
    fields = [placed.schema[k] for k in keys]
    counted = placed.mapInArrow(_counts(keys), T.StructType([*fields, T.StructField("n", T.LongType())]))
    output = T.StructType(
        [*fields, T.StructField("pane", T.StringType()), T.StructField("number", T.LongType()), T.StructField("n", T.LongType())]
    )
    fired = counted.groupBy(*keys).transformWithState(_processor(output.names, early_ms, late_ms), output, "Append", "EventTime")
    return fired.select(
        F.timestamp_millis("_start").alias("window_start"),
        F.timestamp_millis("_end").alias("window_end"),
        *[F.col(n).alias(g) for g, n in zip(groups, names)],
        "pane",
        "number",
        "n",
    )


def pane_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "event_ts",
    size: str = WINDOW_SIZE,
    groups: Sequence[str] = (),
    early: str = EARLY_FIRING,
    lateness: str = ALLOWED_LATENESS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Writes ``fired_panes`` batch by batch; read with ``sinks.tables.read_batches``.

    A micro-batch that runs again replaces its folder. Timers need the RocksDB state store, so the query gets it whatever the
    session has; the session's own setting stays.
    """
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (
            fired_panes(stream, ts, size, groups, early, lateness)
            .writeStream.outputMode("append")
            .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or PROCESSING))
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


# The two functions below run on executors. What they need is inside them, so they travel by value.


def _counts(keys: list[str]):
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([([], "count_all")])
                yield from table.select([*keys, "count_all"]).rename_columns([*keys, "n"]).to_batches()

    return count


def _processor(columns: list[str], early_ms: int, late_ms: int) -> StatefulProcessor:
    from pyspark.sql import Row

    pane = Row(*columns)

    class Panes(StatefulProcessor):
        """State of a window: rows since the last pane, arrival of the first of them, panes so far, whether it has passed."""

        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("window", "waiting bigint, since bigint, panes bigint, passed boolean")

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            new = sum(r["n"] for r in rows)
            end, mark = key[1], timerValues.getCurrentWatermarkInMs()
            if mark >= end:
                return
            known = self.state.exists()
            held = tuple(self.state.get()) if known else (0, None, 0, False)
            passed = mark + late_ms >= end
            if not known:
                # a timer fires when the watermark is above it
                self.handle.registerTimer(end - 1)
                if not passed:
                    self.handle.registerTimer(end - 1 - late_ms)
            if passed:
                if known and not held[3]:
                    yield pane(*key, "ON_TIME", held[2], held[0])
                    held = (0, None, held[2] + 1, True)
                yield pane(*key, "LATE", held[2], new)
                self.state.update((0, None, held[2] + 1, True))
                return
            now = timerValues.getCurrentProcessingTimeInMs()
            waiting, since = held[0] + new, now if held[1] is None else held[1]
            yield from self.early_pane(key, waiting, since, held[2], now, mark)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
            if not self.state.exists():
                return
            end, mark = key[1], timerValues.getCurrentWatermarkInMs()
            waiting, since, panes, passed = tuple(self.state.get())
            if mark + late_ms >= end:
                if not passed:
                    yield pane(*key, "ON_TIME", panes, waiting)
                    self.state.update((0, None, panes + 1, True))
                if mark >= end:
                    self.state.clear()
            elif since is not None:
                yield from self.early_pane(key, waiting, since, panes, timerValues.getCurrentProcessingTimeInMs(), mark)

        def early_pane(self, key, waiting, since, panes, now, mark) -> Iterator:
            if now - since >= early_ms:
                yield pane(*key, "EARLY", panes, waiting)
                self.state.update((0, None, panes + 1, False))
            else:
                self.handle.registerTimer(mark + 1)  # fires once the watermark has moved on
                self.state.update((waiting, since, panes, False))

        def close(self) -> None:
            pass

    return Panes()
