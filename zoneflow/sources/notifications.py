"""Notification messages from files or a broker, as batch or stream.

All readers give ``attributes map<string,string>, payload string``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.operators.notify import attribute, event_time, utf8_text
from zoneflow.operators.windows import ALLOWED_LATENESS

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.StringType()),
    ]
)


def read_messages(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).format(file_format).load(path)


def stream_messages(
    spark: SparkSession, path: str, file_format: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_messages(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """Messages of a broker topic; record headers become the attributes.

    Needs the Kafka connector on the class path. Set ``includeHeaders`` is done here.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka").option("includeHeaders", "true")
    return from_kafka(reader.options(**options).load())


def from_kafka(records: DataFrame) -> DataFrame:
    """``headers array<struct<key,value>>, value`` to attributes and payload.

    Brokers allow a header to repeat and to hold any bytes: the last one of a key counts, one without a key is left out, and
    invalid bytes are replaced.
    """
    entries = F.transform(
        F.filter(
            F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")), lambda h: h["key"].isNotNull()
        ),
        lambda h: F.struct(h["key"].alias("key"), utf8_text(h["value"]).alias("value")),
    )
    keys = F.transform("_entries", lambda e: e["key"])
    last = F.filter("_entries", lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return records.select(entries.alias("_entries"), utf8_text(F.col("value")).alias("payload")).select(
        F.map_from_entries(last).alias("attributes"), "payload"
    )


def with_event_time(messages: DataFrame, lateness: str = ALLOWED_LATENESS) -> DataFrame:
    """Add ``event_ts`` from the ``event_timestamp`` attribute; a stream also gets its watermark."""
    timed = messages.withColumn("event_ts", event_time(attribute("event_timestamp")))
    return timed.withWatermark("event_ts", lateness) if messages.isStreaming else timed
