"""Change notifications: filter by table, read record ids from the payload, split off bad payloads.

Input rows are ``attributes map<string,string>, payload string|binary``. Every step is a narrow
projection, so it runs on batch and stream alike and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.text import stable_id

# Event type of a message without one, and the two forms of its event time.
DEFAULT_EVENT_TYPE = "update"
DIGITS = r"\A-?[0-9]+\z"
DATE_TIME = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]"


def attribute(name: str) -> Column:
    return F.try_element_at(F.col("attributes"), F.lit(name))


def utf8_text(payload: Column) -> Column:
    """Bytes or text as valid text; bytes that are no UTF-8 become replacement characters."""
    return F.make_valid_utf8(payload.cast("binary").cast("string"))


def filter_table(messages: DataFrame, table: str) -> DataFrame:
    """Messages whose ``table_name`` attribute is ``table``; a missing attribute drops the message."""
    return messages.where(attribute("table_name") == F.lit(table))


def event_time(raw: Column) -> Column:
    """Timestamp from an attribute that holds epoch milliseconds or ISO text with a date and a time.

    Digits alone are always milliseconds, and a time without a date is nothing: Spark would read
    the one as a year and the other as today.
    """
    iso = F.when(raw.rlike(DATE_TIME), F.try_to_timestamp(raw))
    return F.when(raw.rlike(DIGITS), F.timestamp_millis(raw.try_cast("bigint"))).otherwise(iso)


def with_payload_ids(df: DataFrame) -> DataFrame:
    """Add ``_ids``: a JSON array, else the array ``record_ids``, else the scalar ``record_id``.

    Null marks a malformed payload: not JSON, a bare scalar, an object without either key, or a
    ``record_ids`` that is no array. The first character decides how the payload is read, and the
    parsed object is a column of its own, so every payload is parsed once.
    """
    content = F.col("content")
    first = F.left(F.btrim(content, F.lit(" \t\r\n")), F.lit(1))
    fields = F.when(first == "{", F.from_json(content, "map<string,string>"))
    listed = F.from_json(F.try_element_at("_fields", F.lit("record_ids")), "array<string>")
    single = F.try_element_at("_fields", F.lit("record_id"))
    of_object = F.when(F.map_contains_key("_fields", "record_ids"), listed).when(
        single.isNotNull(), F.array(single)
    )
    ids = F.when(F.col("_first") == "[", F.from_json(content, "array<string>")).otherwise(of_object)
    return df.withColumns({"_first": first, "_fields": fields}).withColumn("_ids", ids).drop("_first", "_fields")


def _well_formed(ids: Column) -> Column:
    """Array of ``ids`` itself, empty when they are null or hold a null, or when the event time could not be read."""
    return F.filter(
        F.array(ids), lambda i: i.isNotNull() & ~F.exists(i, lambda x: x.isNull()) & F.col("event_ts").isNotNull()
    )


def _fields(messages: DataFrame, table: str) -> DataFrame:
    content = utf8_text(F.col("payload"))
    return (
        filter_table(messages, table)
        .withColumn("content", content)
        .select(
            F.coalesce(
                attribute("message_id"),
                stable_id(F.to_json(F.map_entries(F.col("attributes"))), F.col("content")),
            ).alias("message_id"),
            F.coalesce(attribute("event_type"), F.lit(DEFAULT_EVENT_TYPE)).alias("event_type"),
            F.lit(table).alias("table_name"),
            F.when(attribute("event_timestamp").isNull(), F.current_timestamp())
            .otherwise(event_time(attribute("event_timestamp")))
            .alias("event_ts"),
            F.col("content"),
        )
    )


def parse_notifications(messages: DataFrame, table: str) -> DataFrame:
    """Well-formed notifications of ``table`` with their ``record_ids``; an empty array is well-formed.

    Malformed ones fall out of an explode of zero or one id lists, not of a filter: a filter would
    be moved below the projection and parse every payload again.
    """
    return with_payload_ids(_fields(messages, table)).select(
        "message_id",
        "event_type",
        "table_name",
        F.explode(_well_formed(F.col("_ids"))).alias("record_ids"),
        "event_ts",
        "content",
    )


def dead_letters(messages: DataFrame, table: str) -> DataFrame:
    """Notifications of ``table`` whose payload names no usable ids or whose event time is unreadable, with the payload kept whole."""
    parsed = with_payload_ids(_fields(messages, table))
    return parsed.where(F.size(_well_formed(F.col("_ids"))) == 0).drop("_ids")


def dedup_messages(messages: DataFrame) -> DataFrame:
    """One message per ``message_id`` attribute; messages without the attribute all stay.

    Copies are merged before the shuffle, so a message delivered a billion times still sends one
    row per input task. In a stream the copies must arrive within the watermark.
    """
    keyed = messages.withColumn("_mid", attribute("message_id"))
    if messages.isStreaming:
        return (
            keyed.withColumn("_mid", F.coalesce("_mid", F.uuid()))
            .dropDuplicatesWithinWatermark(["_mid"])
            .drop("_mid")
        )
    others = [c for c in messages.columns if c not in ("attributes", "payload")]
    return (
        keyed.withColumn("_row", F.when(F.col("_mid").isNull(), F.monotonically_increasing_id()))
        .withColumn("attributes", F.array_sort(F.map_entries("attributes")))
        .groupBy("_mid", "_row")
        .agg(F.min(F.struct("attributes", "payload", *others)).alias("_m"))
        .select(F.map_from_entries("_m.attributes").alias("attributes"), "_m.payload", *[f"_m.{c}" for c in others])
    )
