"""Classify the change operation of fetched rows and tag table and zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.text import equals_ignore_case

# Operations, zones and the name of a table the row does not state.
DELETE = "delete"
UPSERT = "upsert"
ZONES = ("raw", "structure", "refined", "analytics")
UNKNOWN_TABLE = "unknown"


def _column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def cdc_classify(
    rows: DataFrame,
    op_field: str = "op_type",
    delete_flag: str = "is_deleted",
    table_field: str = "_table_name",
    table: str | None = None,
) -> DataFrame:
    """Add ``_event_op``, ``_table_name`` and ``_zone``.

    A true delete flag wins, then the row's own operation as it stands, then upsert. ``table``
    overrides the row's table name, as a run for one configured table does.
    """
    op = F.when(equals_ignore_case(_column_or_null(rows, delete_flag), "true"), F.lit(DELETE)).otherwise(
        F.coalesce(_column_or_null(rows, op_field), F.lit(UPSERT))
    )
    name = F.lit(table) if table else F.coalesce(_column_or_null(rows, table_field), F.lit(UNKNOWN_TABLE))
    return tag_zone(rows.withColumns({"_event_op": op, "_table_name": name}), ZONES[0])


def tag_zone(rows: DataFrame, zone: str) -> DataFrame:
    return rows.withColumn("_zone", F.lit(zone))


def raw_rows(records: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Rows of the raw table: the record plus its metadata columns, all in one projection."""
    return records.withColumns(
        {
            "_ingest_ts": ingest_ts if ingest_ts is not None else F.current_timestamp(),
            "_zone": F.lit(ZONES[0]),
        }
    )
