"""Batch run: ingest, gate, reconcile, quality log, refined, analytics, write, completion event."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.config import ZoneConfig
from zoneflow.operators.audit import completion_event, dq_log, to_audit_json
from zoneflow.operators.dependency import COMPLETE, gate, held_back
from zoneflow.operators.ingest import MarkStore, Source, ingest, resolve_mode
from zoneflow.operators.limits import latest_per_key
from zoneflow.operators.quality import with_flags
from zoneflow.operators.reconcile import column_diff, compared_columns, reconcile_log, variant_counts
from zoneflow.plans.zones import PIPELINE_LOG, QUALITY_LOG, RECONCILE_LOG, Hook
from zoneflow.sinks.tables import write_log, write_table, write_text

# The columns a gated row carries.
GATE_COLUMNS = ("table_name", "run_date")


def run_batch(
    spark: SparkSession,
    cfg: ZoneConfig,
    source: Source,
    run_log: DataFrame | None,
    root: str,
    run_id: str,
    snapshot: DataFrame | None = None,
    hooks: Mapping[str, Hook] | None = None,
) -> dict[str, DataFrame]:
    """Run the configured ingestion through to the refined and analytics outputs.

    The mode decides what is taken in; for the modes that read the change log the table's mark says from where, and it
    moves on when all outputs are written. What was taken in is written first and then gated, so it is computed once. Of these modes, what
    the gate holds back is written too, and the next run gates it again beside what it takes in; rows without a date wait there. Gated rows carry ``table_name`` and
    ``run_date``; the day's completion goes to the pipeline log, which is also the run log if none is given.
    Quality and reconciliation report on the rows and do not filter them. Returns the written outputs.
    """
    hooks = hooks or {}
    marks = MarkStore(spark, f"{root}/{cfg.dataset('framework')}/high_water_marks")
    by_log = resolve_mode(cfg.ingestion_type) in ("incremental", "upsert")
    taken = f"{root}/_staged/{cfg.table}/{run_id}"
    write_table(ingest(cfg.ingestion_type, source, marks.read(cfg.table) if by_log else None), taken)
    staged = f"{root}/{cfg.dataset('structure')}/{cfg.table}/{run_id}"
    done = run_log if run_log is not None else read_run_log(spark, cfg.log_path(root, PIPELINE_LOG))
    rows, pending = spark.read.parquet(taken), None
    if by_log:
        number, waiting = marks.pending(cfg.table)
        if waiting:
            rows = _with_waiting(rows, spark.read.parquet(waiting), cfg, source)
        if cfg.dependencies or waiting:
            pending = number + 1, f"{root}/_pending/{cfg.table}/{number + 1:06d}-{run_id}"
            held = held_back(rows, cfg.dependencies, done) if cfg.dependencies else rows.limit(0)
            # what has no time is taken in by every run
            write_table(held.where(F.col(source.change_ts).isNotNull()), pending[1])
    rows = gate(rows, cfg.dependencies, done) if cfg.dependencies else rows
    write_table(with_flags(rows, cfg.rules), staged)
    flagged = spark.read.parquet(staged)
    rows = flagged.drop("_dq_failed")

    if cfg.reconcile_enabled and snapshot is not None:
        tags = {"zone": F.lit("raw"), "table_name": F.lit(cfg.table)}
        # the gate's columns say when a run was, the snapshot knows nothing of them
        data = rows.drop(*[c for c in GATE_COLUMNS if c not in snapshot.columns])
        columns = list(cfg.compare_columns) or compared_columns(data, snapshot, cfg.id_column)
        counts = variant_counts(rows, snapshot, cfg.id_column).withColumns(tags)
        diffs = column_diff(rows, snapshot, cfg.id_column, columns).withColumns(tags)
        log = reconcile_log(
            counts, diffs, {n: F.col(n) for n in tags}, cfg.domain, cfg.id_column
        )
        write_log(log, cfg.log_path(root, RECONCILE_LOG), run_id)
    if cfg.rules:
        write_log(
            dq_log(flagged, cfg.rules, cfg.domain, F.lit("raw"), cfg.table, run_id),
            cfg.log_path(root, QUALITY_LOG),
            run_id,
        )

    outputs: dict[str, DataFrame] = {}
    current = rows
    for zone in ("refined", "analytics"):
        current = hooks.get(zone, lambda df: df)(current)
        path = f"{root}/{cfg.dataset(zone)}/{cfg.table}/{run_id}"
        write_table(current, path)
        outputs[zone] = current = spark.read.parquet(path)

    event = completion_event(outputs, cfg.domain, cfg.ingestion_type)
    write_text(to_audit_json(event), f"{root}/audit-logs/{run_id}")
    if set(GATE_COLUMNS) <= set(rows.columns):
        days = rows.select(*GATE_COLUMNS).distinct().withColumns(
            {"pipeline_name": F.lit(f"{cfg.domain}_{run_id}"), "domain": F.lit(cfg.domain), "zone": F.lit("analytics"), "status": F.lit(COMPLETE)}
        )
        write_log(days, cfg.log_path(root, PIPELINE_LOG), run_id)
    if by_log:
        marks.advance(cfg.table, spark.read.parquet(taken), source.change_ts, source.seq, pending)
    return outputs


def _with_waiting(rows: DataFrame, waiting: DataFrame, cfg: ZoneConfig, source: Source) -> DataFrame:
    """What was taken in and what earlier runs held back; an upsert keeps the newest row of a key."""
    both = rows.unionByName(waiting, allowMissingColumns=True)
    if resolve_mode(cfg.ingestion_type) != "upsert":
        return both
    return latest_per_key(both, list(source.keys), [source.change_ts, source.seq])


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """(table_name, run_date, status) of the pipeline log; empty before the first run."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], "table_name string, run_date date, status string")
    schema = "table_name string, run_date date, status string"
    return spark.read.schema(schema).parquet(path).select("table_name", "run_date", "status").where("run_date IS NOT NULL")
