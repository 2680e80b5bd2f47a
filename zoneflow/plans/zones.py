"""The zone chain: raw, structure, refined, analytics.

Each zone is written once, with the failed quality rules of every row beside it, and the next zone
reads the written rows that passed. The written table is the recovery point between zones, serves
the logs and holds the quarantined rows, so nothing is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.config import ZoneConfig
from zoneflow.operators.audit import audit_log, dq_log, stage_counts
from zoneflow.operators.cdc import ZONES, cdc_classify, raw_rows, tag_zone
from zoneflow.operators.fetch import bucketed_fetch, lookup_fetch
from zoneflow.operators.mapping import map_schema
from zoneflow.operators.notify import dedup_messages, parse_notifications
from zoneflow.operators.quality import passed, quarantined, with_flags
from zoneflow.operators.reconcile import column_diff, compared_columns, reconcile_log, variant_counts
from zoneflow.operators.structure import structure_cast
from zoneflow.operators.windows import window_bounds
from zoneflow.sinks.tables import remove_batch, write_batch, write_log
from zoneflow.sources.buckets import BucketedTable
from zoneflow.sources.snapshots import scan_jsonl_columns

Hook = Callable[[DataFrame], DataFrame]

# Names of the log tables.
PIPELINE_LOG = "pipeline_log"
RECONCILE_LOG = "reconcile_log"
QUALITY_LOG = "data_quality_log"

LOOK_AT_SHARE = 1 / 16


@dataclass(frozen=True)
class ZoneRun:
    """One written batch: the rows of each zone with their failed rules, read from the zone table."""

    root: str
    batch_id: int | str
    written: Mapping[str, DataFrame]

    def zone(self, zone: str) -> DataFrame:
        """Rows of the zone that passed its quality rules."""
        return passed(self.written[zone])

    def quarantine(self, zone: str) -> DataFrame:
        return quarantined(self.written[zone])


def fetch_changes(messages: DataFrame, table_rows: DataFrame | BucketedTable, cfg: ZoneConfig) -> DataFrame:
    """The current rows that the messages for the configured table name; of a bucketed table (by ``cfg.id_column``) only the
    buckets that hold them are read.

    Hot ids are looked for in a random share of the messages, so that most payloads are parsed
    once; all messages are fetched.
    """
    part = parse_notifications(messages.sample(LOOK_AT_SHARE, seed=7), cfg.table)
    if isinstance(table_rows, BucketedTable):
        if table_rows.key != cfg.id_column:
            raise ValueError(f"the table is kept by {table_rows.key!r}, the configuration names {cfg.id_column!r}")
        return bucketed_fetch(parse_notifications(messages, cfg.table), table_rows, look_at=part, look_at_share=LOOK_AT_SHARE)
    return lookup_fetch(
        parse_notifications(messages, cfg.table),
        table_rows,
        cfg.id_column,
        look_at=part,
        look_at_share=LOOK_AT_SHARE,
    )


def changed_records(messages: DataFrame, table_rows: DataFrame | BucketedTable, cfg: ZoneConfig, deduped: bool = False) -> DataFrame:
    """Notifications to classified change records. A redelivered message counts once; ``deduped`` says that it
    was taken care of already, as on a stream."""
    once = messages if deduped else dedup_messages(messages)
    return cdc_classify(fetch_changes(once, table_rows, cfg), table=cfg.table)


def read_snapshot(spark: SparkSession, prefix: str, cfg: ZoneConfig) -> DataFrame:
    """Legacy rows of the configured table under target names."""
    mapping = cfg.mapping_schemas.get(cfg.table, {})
    columns = list(mapping) or [cfg.id_column, *cfg.compare_columns]
    return map_schema(scan_jsonl_columns(spark, prefix, columns), cfg.mapping_schemas, cfg.table)


def _transform(zone: str, cfg: ZoneConfig, hooks: Mapping[str, Hook]) -> Hook:
    if zone in hooks:
        return hooks[zone]
    if zone == "structure":
        return lambda df: structure_cast(df, cfg.structure, cfg.structure_mode)
    return lambda df: df


def run_zones(
    records: DataFrame,
    cfg: ZoneConfig,
    root: str,
    batch_id: int | str,
    snapshots: Mapping[str, DataFrame] | None = None,
    hooks: Mapping[str, Hook] | None = None,
    window_seconds: int | None = None,
) -> ZoneRun:
    """Write the four zones and the three logs of one batch.

    ``snapshots`` gives the mapped legacy rows per zone; a zone without one is not reconciled.
    With ``window_seconds`` the logs are kept per event-time window, else per batch.
    """
    written: dict[str, DataFrame] = {}
    for position, zone in enumerate(ZONES):
        if position == 0:
            current = raw_rows(records)
        else:
            before = passed(written[ZONES[position - 1]])
            current = tag_zone(_transform(zone, cfg, hooks or {})(before), zone)
        if any(rule.checks_unique for rule in cfg.rules):
            # Counting keys reads the rows again: do that from a written copy.
            current = write_batch(current, f"{root}/_staged/{zone}", batch_id)
        written[zone] = write_batch(with_flags(current, cfg.rules), cfg.table_path(root, zone), batch_id)
    run = ZoneRun(root, batch_id, written)
    _write_logs(run, cfg, snapshots or {}, window_seconds)
    for name in (*ZONES, "legacy"):  # the zones and logs are written, nothing reads the copies any more
        remove_batch(records.sparkSession, f"{root}/_staged/{name}", batch_id)
    return run


def _with_window(df: DataFrame, window_seconds: int | None) -> DataFrame:
    if window_seconds is None or "_notif_event_ts" not in df.columns:
        nothing = F.lit(None).cast("timestamp")
        return df.withColumns({"window_start": nothing, "window_end": nothing})
    start, end = window_bounds(F.col("_notif_event_ts"), window_seconds)
    return df.withColumns({"window_start": start, "window_end": end})


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _write_logs(
    run: ZoneRun,
    cfg: ZoneConfig,
    snapshots: Mapping[str, DataFrame],
    window_seconds: int | None,
) -> None:
    dataset = cfg.dataset("framework")
    bounds = ["window_start", "window_end"]
    groups = {name: F.col(name) for name in bounds}
    written = {zone: _with_window(run.written[zone], window_seconds) for zone in ZONES}

    flagged = _union([rows.select(*bounds, "_zone", "_dq_failed") for rows in written.values()])

    stages = stage_counts(flagged, F.col("_zone"), groups).withColumn("batch", F.lit(str(run.batch_id)))
    audit = audit_log(stages, cfg.table, dataset, ["batch", *bounds]).drop("batch")
    write_log(audit, cfg.log_path(run.root, PIPELINE_LOG), run.batch_id)
    if cfg.rules:
        quality = dq_log(flagged, cfg.rules, cfg.domain, F.col("_zone"), cfg.table, str(run.batch_id))
        write_log(quality, cfg.log_path(run.root, QUALITY_LOG), run.batch_id)
    compared = {zone: rows for zone, rows in written.items() if zone in snapshots}
    if compared:
        log = _reconcile(compared, snapshots, cfg, bounds, window_seconds is not None, run.root, run.batch_id)
        write_log(log, cfg.log_path(run.root, RECONCILE_LOG), run.batch_id)


def _in_zone(df: DataFrame, zone: str, kept: list[str]) -> DataFrame:
    """``df`` as text with its zone; ``_`` columns are dropped, ``kept`` ones stay as they are."""
    texts = [F.col(c).cast("string").alias(c) for c in df.columns if c not in kept and not c.startswith("_")]
    return df.select(*texts, *[c for c in kept if c in df.columns], F.lit(zone).alias("_zone"))


def _legacy_of(
    records: DataFrame, snapshots: Mapping[str, DataFrame], cfg: ZoneConfig, path: str, batch_id: int | str
) -> DataFrame:
    """The legacy rows of the batch's ids, by zone, written once. Zones that share a snapshot share its scan."""
    shared: dict[int, tuple[DataFrame, list[str]]] = {}
    for zone, snapshot in snapshots.items():
        shared.setdefault(id(snapshot), (snapshot, []))[1].append(zone)
    ids = records.select(F.col(cfg.id_column).alias("_batch_record")).distinct()
    parts = []
    for snapshot, zones in shared.values():
        texts = [F.col(c).cast("string").alias(c) for c in snapshot.columns if not c.startswith("_")]
        named = snapshot.select(*texts).join(ids, F.col(cfg.id_column) == F.col("_batch_record"), "left_semi")
        parts.append(named.withColumn("_zone", F.explode(F.array(*(F.lit(z) for z in zones)))))
    return write_batch(_union(parts), path, batch_id)


def _reconcile(
    rows: Mapping[str, DataFrame],
    snapshots: Mapping[str, DataFrame],
    cfg: ZoneConfig,
    bounds: list[str],
    windowed: bool,
    root: str,
    batch_id: int | str,
) -> DataFrame:
    """Log rows of all zones at once: records and snapshot rows are matched within their zone. Everything after
    the one pass that cuts the snapshots to the batch's ids costs what the batch costs."""
    records = _union([_in_zone(df, zone, bounds) for zone, df in rows.items()])
    legacy = _legacy_of(records, {zone: snapshots[zone] for zone in rows}, cfg, f"{root}/_staged/legacy", batch_id)
    columns = list(cfg.compare_columns) or compared_columns(records.drop(*bounds), legacy, cfg.id_column)
    carry = bounds if windowed else []
    counts = variant_counts(records, legacy, cfg.id_column, carry, ["_zone"])
    diffs = column_diff(records, legacy, cfg.id_column, columns, carry, ["_zone"])
    tags = {"zone": F.col("_zone"), "table_name": F.lit(cfg.table)}
    if not windowed:
        tags |= {b: F.lit(None).cast("timestamp") for b in bounds}
    groups = {name: F.col(name) for name in ("zone", "table_name", *bounds)}
    return reconcile_log(counts.withColumns(tags), diffs.withColumns(tags), groups, cfg.domain, cfg.id_column)
