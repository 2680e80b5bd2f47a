"""Rows of the audit logs: per record, per window and stage, per rule, per run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.text import stable_id, strip_suffix
from zoneflow.operators.cdc import ZONES
from zoneflow.operators.quality import DQRule, rule_outcomes

# A stage after each zone's write and one after its quality check.
STAGES = tuple(stage for zone in ZONES for stage in (zone, f"{zone}_dq"))
SUCCESS = "SUCCESS"
FRAMEWORK_SUFFIX = "_framework"
COMPLETE_EVENT = "pipeline_complete"


def _log_fields(table: str, stage: Column, dataset: str) -> dict[str, Column]:
    return {
        "pipeline_name": F.concat(F.lit(f"{table}_"), stage),
        "domain": strip_suffix(F.lit(dataset), FRAMEWORK_SUFFIX),
        "zone": stage,
        "table_name": F.lit(table),
        "status": F.lit(SUCCESS),
    }


def audit_records(records: DataFrame, table: str, stage: str, dataset: str, keys: Sequence[str]) -> DataFrame:
    """One log row per record. ``keys`` identify a record within the stage and give ``log_id``."""
    fields = _log_fields(table, F.lit(stage), dataset)
    log_id = stable_id(F.lit(table), F.lit(stage), *[F.col(k) for k in keys])
    return records.select(log_id.alias("log_id"), *[c.alias(n) for n, c in fields.items()])


def stage_counts(flagged: DataFrame, zone: Column, groups: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows written to each zone and rows that passed its quality check, as two stage rows per group."""
    groups = dict(groups or {})
    counted = flagged.groupBy(zone.alias("_stage"), *[c.alias(n) for n, c in groups.items()]).agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.size("_dq_failed") == 0).alias("_ok")
    )
    stages = F.array(
        F.struct(F.col("_stage").alias("stage"), F.col("_all").alias("n_records")),
        F.struct(F.concat("_stage", F.lit("_dq")).alias("stage"), F.col("_ok").alias("n_records")),
    )
    return counted.select(*groups, F.inline(stages))


def audit_log(counts: DataFrame, table: str, dataset: str, keys: Sequence[str] = ()) -> DataFrame:
    """``pipeline_log`` rows out of stage counts; the count goes into the JSON ``metrics``."""
    fields = _log_fields(table, F.col("stage"), dataset)
    kept = [c for c in counts.columns if c not in ("stage", "n_records")]
    log_id = stable_id(F.lit(table), F.col("stage"), *[F.col(k) for k in keys])
    return counts.select(
        log_id.alias("log_id"),
        *[c.alias(n) for n, c in fields.items()],
        *kept,
        F.to_json(F.struct(F.col("n_records").alias("records"))).alias("metrics"),
    )


def dq_log(
    flagged: DataFrame,
    rules: Sequence[DQRule],
    domain: str,
    zone: Column,
    table: str,
    run_id: str = "",
) -> DataFrame:
    """``data_quality_log`` rows: one per zone and rule with its outcome and counts."""
    return rule_outcomes(flagged, rules, {"zone": zone}).select(
        stable_id(F.lit(run_id), F.col("zone"), F.lit(table), F.col("rule_name")).alias("quality_id"),
        F.lit(domain).alias("domain"),
        "zone",
        F.lit(table).alias("table_name"),
        "rule_name",
        "passed",
        F.to_json(F.struct("n_passed", "n_failed")).alias("details"),
    )


def completion_event(outputs: Mapping[str, DataFrame], domain: str, ingestion_type: str) -> DataFrame:
    """One row for a finished run, with the row count of each written output."""
    counts = None
    for name, df in outputs.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("output"), "rows")
        counts = row if counts is None else counts.unionByName(row)
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("output", "rows")))).alias("rows")).select(
        F.lit(COMPLETE_EVENT).alias("event"),
        F.lit(domain).alias("domain"),
        F.lit(ingestion_type).alias("ingestionType"),
        F.unix_millis(F.current_timestamp()).alias("timestamp"),
        F.to_json("rows").alias("rows"),
    )


def to_audit_json(rows: DataFrame, ordered: Sequence[str] | None = None) -> DataFrame:
    """Each row as one JSON text in ``value``; every field as text."""
    names = list(ordered or rows.columns)
    return rows.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in names])).alias("value"))
