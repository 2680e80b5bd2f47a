"""Tables kept in folders by a hash bucket of their key, of which a batch reads only those its keys fall into.

Layout: ``<root>/data/_bucket=<n>/part-….parquet`` and ``<root>/layout`` with the key's name and the number of buckets. A key's
bucket is a hash of its text, so ids that come as text find their bucket whatever the key's type, and every
reader and writer agrees on it; a null key has the bucket of a null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    """Number of the bucket, from 0."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class BucketedTable:
    """Where a table lies, its key, the number of buckets, and its schema."""

    root: str
    key: str
    buckets: int
    schema: str

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; ``_bucket`` is the partition column."""
        return spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(self.data)

    def bucket(self, key: Column) -> Column:
        return bucket_of(key, self.buckets)


def create_bucketed(rows: DataFrame, root: str, key: str, buckets: int, split: int = 1) -> BucketedTable:
    """Writes ``rows`` as a new table. Each bucket is dealt to ``split`` tasks by the whole row, so a key that holds a third of
    all rows is written by several; rows of a bucket are sorted by key, which narrows the statistics of its row groups."""
    spark = rows.sparkSession
    layout = spark.createDataFrame([(key, buckets, rows.schema.toDDL())], "key string, buckets int, ddl string")
    layout.coalesce(1).write.mode("errorifexists").parquet(f"{root}/layout")
    write_buckets(rows, BucketedTable(root, key, buckets, rows.schema.toDDL()), "errorifexists", split)
    return open_bucketed(spark, root)


def open_bucketed(spark: SparkSession, root: str) -> BucketedTable:
    row = spark.read.parquet(f"{root}/layout").first()
    return BucketedTable(root, row["key"], row["buckets"], row["ddl"])


def write_buckets(rows: DataFrame, table: BucketedTable, mode: str, split: int = 1, only_these: bool = False) -> None:
    """``only_these``: of an existing table, replace the buckets that ``rows`` has, and no other."""
    placed = rows.withColumn(BUCKET, table.bucket(F.col(table.key)))
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(split))
    dealt = placed.repartition(table.buckets * split, F.col(BUCKET), spread).sortWithinPartitions(BUCKET, table.key)
    writer = dealt.write.mode(mode).partitionBy(BUCKET)
    if only_these:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(table.data)


def touched_buckets(table: BucketedTable, keys: DataFrame) -> DataFrame:
    """The distinct buckets of the one column of ``keys``: at most ``table.buckets`` rows."""
    return keys.select(table.bucket(F.col(keys.columns[0])).alias(BUCKET)).distinct()


def pruned(table: BucketedTable, keys: DataFrame) -> DataFrame:
    """Rows of the buckets that ``keys`` (one column) fall into.

    The buckets are joined first and as a broadcast, which their number bounds, so that Spark lists and reads only their folders: the
    plan shows a dynamic pruning expression on the partition column.
    """
    # a comparison that always holds: Spark prunes by a side only if that side is filtered
    touched = touched_buckets(table, keys).where(F.col(BUCKET) >= 0)
    return table.read(keys.sparkSession).join(F.broadcast(touched), BUCKET, "left_semi")
