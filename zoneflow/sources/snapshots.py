"""Legacy snapshots: objects of JSON lines under a prefix."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.operators.limits import top_n


def list_objects(spark: SparkSession, prefix: str, limit: int | None = None) -> DataFrame:
    """``key, length, modified`` of the objects under ``prefix``, the first ``limit`` in key order if one is given;
    contents are not read."""
    objects = _binary(spark, prefix).select(
        F.col("path").alias("key"), "length", F.col("modificationTime").alias("modified")
    )
    return objects if limit is None else top_n(objects, ["key"], limit)


def read_objects(spark: SparkSession, prefix: str) -> DataFrame:
    """``key, content`` with each object's bytes."""
    return _binary(spark, prefix).select(F.col("path").alias("key"), "content")


def _binary(spark: SparkSession, prefix: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)


def scan_jsonl(spark: SparkSession, prefix: str, max_lines_per_object: int | None = None) -> DataFrame:
    """Each JSON object line as ``row map<string,string>``; other lines are skipped.

    Values become text, null stays null. All lines are read unless ``max_lines_per_object`` asks
    for the first lines of each object only.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(prefix)
    if max_lines_per_object is not None:
        in_order = Window.partitionBy("_file").orderBy("_start", "_id")
        lines = (
            lines.select(
                "value",
                F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_start"),
                F.monotonically_increasing_id().alias("_id"),
            )
            .withColumn("_line", F.row_number().over(in_order))
            .where(F.col("_line") <= max_lines_per_object)
        )
    return lines.select(F.from_json("value", "map<string,string>").alias("row")).where(F.col("row").isNotNull())


def scan_jsonl_columns(
    spark: SparkSession, prefix: str, columns: Sequence[str], max_lines_per_object: int | None = None
) -> DataFrame:
    """The same lines as text columns. Without a line limit only ``columns`` are parsed."""
    if max_lines_per_object is not None:
        rows = scan_jsonl(spark, prefix, max_lines_per_object)
        return rows.select(*[F.try_element_at("row", F.lit(c)).alias(c) for c in columns])
    return _columns_of(spark.read.option("recursiveFileLookup", "true").text(prefix), columns)


def _columns_of(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt"]])
    # the JSON reader would take an array for as many rows; here, as above, a line is an object or nothing
    objects = lines.where(F.ltrim("value", F.lit(" \t\r\n")).startswith("{"))
    parsed = objects.select(F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return parsed.where(F.col("r").isNotNull() & F.col("r._corrupt").isNull()).select(*[F.col(f"r.{c}").alias(c) for c in columns])


def scan_variant(spark: SparkSession, prefix: str) -> DataFrame:
    """Each JSON object line as ``row variant``, with the types its values have; other lines are skipped.

    A line with a key twice is no object. Numbers keep their value, not their spelling (``1.50`` is 1.5).
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(prefix)
    objects = lines.where(F.ltrim("value", F.lit(" \t\r\n")).startswith("{"))
    return objects.select(F.try_parse_json("value").alias("row")).where(F.col("row").isNotNull())


def variant_columns(*sides: DataFrame) -> list[str]:
    """The keys that any ``row`` of the sides has, sorted: one aggregate over their schemas, merged inside the tasks first."""
    rows = reduce(DataFrame.unionAll, [side.select("row") for side in sides])
    found = rows.agg(F.schema_of_variant_agg("row").alias("schema")).first()["schema"]
    if not found.startswith("OBJECT<"):  # no rows at all
        return []
    # an object is a struct under another name; text between backquotes is a key
    struct = "".join(part if i % 2 else part.replace("OBJECT<", "STRUCT<") for i, part in enumerate(re.split("(`(?:[^`]|``)*`)", found)))
    return sorted(T.DataType.fromDDL(struct).names)


def variant_text(row: Column, key: str) -> Column:
    """The value of a top-level key as text; null where the key is absent or null. Objects and arrays become JSON text."""
    if "'" not in key:
        return F.try_variant_get(row, f"$['{key}']", "string")
    if '"' not in key:
        return F.try_variant_get(row, f'$["{key}"]', "string")
    return F.try_element_at(row.cast("map<string,string>"), F.lit(key))


def listing(spark: SparkSession, prefix: str) -> DataFrame:
    """``key, length, modified`` of the objects under ``prefix``, to be stored and compared with a later one; no object is opened.

    The key is the one under which ``scan_changed`` finds the object's lines. Objects without a byte hold no lines and are not
    listed; one that becomes empty is gone.
    """
    return _binary(spark, prefix).select(
        F.col("_metadata.file_path").alias("key"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def listing_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """``key, length, modified, change``: objects that are ``added``, ``changed`` in length or time, or ``gone`` (length and time
    as they were). Both sides are listings; one aggregate over both finds the changes."""
    sides = before.select("key", "length", "modified", F.lit(0).alias("_side")).unionByName(
        now.select("key", "length", "modified", F.lit(1).alias("_side"))
    )
    at = F.struct("length", "modified")
    both = sides.groupBy("key").agg(
        F.max(F.when(F.col("_side") == 0, at)).alias("_old"), F.max(F.when(F.col("_side") == 1, at)).alias("_new")
    )
    change = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "gone").when(F.col("_old") != F.col("_new"), "changed")
    )
    last = F.coalesce("_new", "_old")
    return both.withColumn("change", change).where(F.col("change").isNotNull()).select(
        "key", last["length"].alias("length"), last["modified"].alias("modified"), "change"
    )


def scan_changed(spark: SparkSession, prefix: str, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The lines of added and changed objects as ``scan_jsonl_columns`` gives them. ``changes`` should be a table.

    Objects last modified before all of these are left out when the source lists its files, so they are not opened; of the rest
    only the lines of changed objects are parsed. One time comes to the driver, never the list. An object that is written again
    between listing and scan is read as it is then, and the next listing names it once more.
    """
    new = changes.where(F.col("change").isin("added", "changed"))
    oldest = new.agg(F.date_format(F.min("modified") - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss").alias("oldest")).first()["oldest"]
    reader = spark.read.option("recursiveFileLookup", "true")
    if oldest is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    lines = reader.option("modifiedAfter", oldest).schema("value string").text(prefix)
    wanted = new.select(F.col("key").alias("_key"))
    changed = lines.withColumn("_file", F.col("_metadata.file_path")).join(wanted, F.col("_file") == F.col("_key"), "left_semi")
    return _columns_of(changed.select("value"), columns)
