"""Fetch the current warehouse rows that notifications name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.text import stable_id
from zoneflow.operators.skew import DEFAULT_SKEW, SkewPlan, skew_join
from zoneflow.sources.buckets import BUCKET, BucketedTable, pruned

NOTIFICATION_COLUMNS = {
    "message_id": "_notif_message_id",
    "event_type": "_notif_event_type",
    "event_ts": "_notif_event_ts",
}


def explode_ids(notifications: DataFrame) -> DataFrame:
    """One row per (notification, distinct id). ``_notif_*`` columns carry the notification."""
    return notifications.select(
        *[F.col(c).alias(alias) for c, alias in NOTIFICATION_COLUMNS.items()],
        F.explode(F.array_distinct("record_ids")).alias("_id"),
    )


def _native_id(ids: Column, id_type: T.DataType) -> Column:
    """Ids as the table's own key type, so the table side keeps its layout and its statistics.

    Integer text must be in canonical form: "05" is not the id 5.
    """
    if isinstance(id_type, T.IntegralType):
        number = ids.try_cast(id_type)
        return F.when(number.cast("string") == ids, number)
    return ids


def _keyed_ids(notifications: DataFrame, table: DataFrame, id_column: str) -> DataFrame:
    id_type = table.schema[id_column].dataType
    ids = explode_ids(notifications).withColumn("_id", _native_id(F.col("_id"), id_type))
    return ids.where(F.col("_id").isNotNull())


def _with_key(table: DataFrame, id_column: str) -> DataFrame:
    id_type = table.schema[id_column].dataType
    native = isinstance(id_type, (T.IntegralType, T.StringType))
    key = F.col(id_column) if native else F.col(id_column).cast("string")
    return table.withColumn("_id", key)


def lookup_fetch(
    notifications: DataFrame,
    table: DataFrame,
    id_column: str = "record_id",
    skew: SkewPlan | None = DEFAULT_SKEW,
    look_at: DataFrame | None = None,
    look_at_share: float = 1.0,
) -> DataFrame:
    """Every table row whose id a notification names, once per notification.

    An unknown id gives no row; several table rows with one id are all returned. The batch is reduced to its distinct
    ids, and these cut the table to the rows named, so nothing but that one pass depends on the table's size.
    Ids that are hot among the notifications are split (``skew``); ``None`` leaves that to adaptive
    execution, as is done with ids that are hot in the table. ``look_at`` is a random share of the notifications to look for hot ids in.
    """
    ids = _keyed_ids(notifications, table, id_column)
    named = ids.select("_id").distinct()
    keyed = _with_key(table, id_column)
    if not notifications.isStreaming:
        keyed = keyed.join(named, "_id", "left_semi")
    if look_at is not None:
        look_at = _keyed_ids(look_at, table, id_column)
    fetched = skew_join(
        ids,
        keyed,
        ["_id"],
        "inner",
        spread_by=F.col("_notif_message_id"),
        plan=None if notifications.isStreaming else skew,
        look_at=look_at,
        look_at_share=look_at_share,
    )
    return _with_record_id(fetched.drop("_id"), table, id_column)


def bucketed_fetch(
    notifications: DataFrame,
    table: BucketedTable,
    skew: SkewPlan | None = DEFAULT_SKEW,
    look_at: DataFrame | None = None,
    look_at_share: float = 1.0,
) -> DataFrame:
    """``lookup_fetch`` from a table kept in buckets of its key: only the buckets that the batch's ids fall into are listed and
    read, so a small batch does not pass over the table. Rows with a null key are named by no id."""
    rows = table.read(notifications.sparkSession).drop(BUCKET)
    named = _keyed_ids(notifications, rows, table.key).select("_id")
    return lookup_fetch(notifications, pruned(table, named).drop(BUCKET), table.key, skew, look_at, look_at_share)


def affected_rows(notifications: DataFrame, table: DataFrame, id_column: str = "record_id") -> DataFrame:
    """Each table row that some notification names, once. The table is read in the join alone; adaptive execution splits its hot ids."""
    ids = _keyed_ids(notifications, table, id_column).select("_id").distinct()
    touched = _with_key(table, id_column).join(ids, "_id", "left_semi")
    return _with_record_id(touched.drop("_id"), table, id_column)


def _with_record_id(df: DataFrame, table: DataFrame, id_column: str) -> DataFrame:
    return df.withColumn("_record_id", record_id(table, id_column))


def record_id(table: DataFrame, id_column: str) -> Column:
    """Id as text; a row without one gets an id made from its values."""
    return F.coalesce(
        F.col(id_column).cast("string"), stable_id(*[F.col(c) for c in table.columns])
    )


def to_text_columns(df: DataFrame) -> DataFrame:
    """Every column as text, nulls kept."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def row_map(columns: list[str]) -> Column:
    """The row as ``map<string,string>``, nulls kept as values."""
    return F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]),
        F.array(*[F.col(c).cast("string") for c in columns]),
    )
