"""Key figures maintained from changes: what a row counted before goes out, what it counts now comes in.

Kept under one root: the current row of every key, in buckets of the key, and the change of the figures of each batch. A batch
reads the buckets its keys fall into and writes a few sums; nothing is computed anew over the whole table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.session import new_run_dir
from zoneflow.sources.buckets import BUCKET, BucketedTable, create_bucketed, open_bucketed, pruned, write_buckets

BATCH = "_batch_id"


@dataclass(frozen=True)
class Measures:
    """Group columns and the amounts to be summed, by name, as SQL expressions. Amounts must be whole or decimal numbers: sums of floating-point numbers
    do not come back to what they were when a row is taken out."""

    groups: Mapping[str, str]
    amounts: Mapping[str, str]

    def sums(self, rows: DataFrame, sign: int) -> DataFrame:
        """Per group: number of rows, and for each amount its sum and the number of rows that have one."""
        names = list(self.amounts)
        flat = rows.select(*[F.expr(text).alias(n) for n, text in {**self.groups, **self.amounts}.items()])
        for field in flat.select(*names).schema:
            if field.dataType.typeName() in ("double", "float"):
                raise ValueError(f"amount {field.name!r} is a floating-point number")
        aggregates = [(F.count(F.lit(1)) * sign).alias("_rows")]
        for n in names:
            total = F.coalesce(F.sum(n), F.lit(0)).cast("decimal(38,4)")
            aggregates += [(total if sign > 0 else -total).alias(n), (F.count(n) * sign).alias(f"_n_{n}")]
        return flat.groupBy(*self.groups).agg(*aggregates)

    def added(self, changes: DataFrame) -> DataFrame:
        """Sums of sums."""
        columns = ["_rows", *[c for n in self.amounts for c in (n, f"_n_{n}")]]
        summed = changes.groupBy(*self.groups).agg(*[F.sum(c).alias(c) for c in columns])
        return summed.select(*self.groups, *[F.col(c).cast(changes.schema[c].dataType).alias(c) for c in columns])


class KpiStore:
    """The figures of one table. Batches are numbered from 1; the first rows are batch 0."""

    def __init__(self, spark: SparkSession, root: str, measures: Measures):
        self.spark, self.root, self.measures = spark, root.rstrip("/"), measures

    def _finished(self, path: str) -> bool:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)

    def _change(self, batch_id: int) -> str:
        return f"{self.root}/changes/{BATCH}={batch_id}"

    def start(self, rows: DataFrame, key: str, buckets: int) -> None:
        """``rows``: one for each key."""
        table = create_bucketed(rows, f"{self.root}/rows", key, buckets)
        self.measures.sums(table.read(self.spark).drop(BUCKET), 1).write.mode("overwrite").parquet(self._change(0))

    def apply(self, delta: DataFrame, batch_id: int) -> None:
        """``delta``: the new row of each key that changed, one for each key, with the columns of the first rows.

        The change of the figures is written before any row is replaced, and a batch that finds it written leaves it as it is. So a
        batch that failed anywhere is run again with the same delta and counts once.
        """
        table = open_bucketed(self.spark, f"{self.root}/rows")
        delta = delta.select(*[c for c in table.read(self.spark).columns if c != BUCKET])
        held = self._kept(pruned(table, delta.select(table.key)), "rows-held")
        same = held[table.key].eqNullSafe(F.col("_changed"))
        keys = delta.select(F.col(table.key).alias("_changed"))
        if not self._finished(self._change(batch_id)):
            before = held.drop(BUCKET).join(keys, same, "left_semi")
            change = self.measures.sums(delta, 1).unionByName(self.measures.sums(before, -1))
            self.measures.added(change).write.mode("overwrite").parquet(self._change(batch_id))
        rest = held.drop(BUCKET).join(keys, same, "left_anti")
        merged = self._kept(rest.unionByName(delta), "rows-merged")
        write_buckets(merged, table, "overwrite", only_these=True)

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        path = new_run_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def rows(self) -> DataFrame:
        table: BucketedTable = open_bucketed(self.spark, f"{self.root}/rows")
        return table.read(self.spark).drop(BUCKET)

    def figures(self) -> DataFrame:
        """Groups with a row, and the sums of their amounts; null where no row has one."""
        total = self.measures.added(self.spark.read.parquet(f"{self.root}/changes").drop(BATCH)).where("_rows > 0")
        return total.select(*self.measures.groups, *[F.when(F.col(f"_n_{n}") > 0, F.col(n)).alias(n) for n in self.measures.amounts])
