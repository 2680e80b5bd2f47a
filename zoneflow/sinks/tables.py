"""Write zone tables, log tables and JSON objects.

A batch writes its own folder ``_batch_id=<id>`` and replaces only that one, so a batch that runs
again after a failure leaves its rows once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of the log tables.
LOG_PARTITION = "created_date"
LOG_CLUSTERING = ("domain", "zone", "table_name")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int | str) -> DataFrame:
    """Write one batch of a table; returns the written rows, read back from the batch's folder."""
    folder = f"{path}/_batch_id={batch_id}"
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_batch(spark: SparkSession, path: str, batch_id: int | str) -> None:
    """Remove one batch of an intermediate table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_batch_id={batch_id}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a table; ``_batch_id`` is a partition column. A batch may have more columns than those before it."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_log(rows: DataFrame, path: str, batch_id: int | str, created_at: Column | None = None) -> None:
    """Log rows of one batch, partitioned by creation day and clustered by domain, zone and table.

    The batch's folder is replaced as a whole, so a batch repeated on another day leaves no rows of
    the first attempt.
    """
    stamp = created_at if created_at is not None else F.current_timestamp()
    stamped = rows if "created_at" in rows.columns else rows.withColumn("created_at", stamp)
    clustering = [c for c in LOG_CLUSTERING if c in stamped.columns]
    (
        stamped.withColumn(LOG_PARTITION, F.to_date("created_at"))
        .sortWithinPartitions(LOG_PARTITION, *clustering)
        .write.mode("overwrite")
        .partitionBy(LOG_PARTITION)
        .parquet(f"{path}/_batch_id={batch_id}")
    )


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_text(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)
