"""Uniqueness over the whole life of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zoneflow.functions.text import fingerprint
from zoneflow.operators.quality import unique_flag
from zoneflow.sinks.tables import write_batch
from zoneflow.sources.buckets import BUCKET, bucket_of
from zoneflow.streaming.windows import PROCESSING

BATCH = "_batch_id"
BUCKETS = 256


class KeyLedger:
    """Fingerprints of the keys that earlier micro-batches had, in folders by batch and bucket of the fingerprint.

    A batch asks for its own keys only: it reads the buckets they fall into (dynamic pruning), and of these only batches before
    it, so a batch that runs again after a failure finds what it found the first time.
    """

    SCHEMA = f"_key string, {BATCH} bigint, {BUCKET} int"

    def __init__(self, path: str, buckets: int = BUCKETS):
        self.path, self.buckets = path, buckets

    def _exists(self, df: DataFrame) -> bool:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    def _bucket(self) -> Column:
        return bucket_of(F.col("_key"), self.buckets)

    def known(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """(``_key``): those of ``keys`` that a batch before ``batch_id`` had."""
        wanted = keys.select("_key").distinct()
        if not self._exists(keys):
            return wanted.limit(0)
        held = keys.sparkSession.read.schema(self.SCHEMA).parquet(self.path).where(F.col(BATCH) < batch_id)
        touched = wanted.select(self._bucket().alias(BUCKET)).distinct().where(F.col(BUCKET) >= 0)
        return held.join(F.broadcast(touched), BUCKET, "left_semi").select("_key").distinct().join(wanted, "_key", "left_semi")

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Replaces what an earlier try of this batch has written."""
        placed = keys.select("_key").distinct().withColumn(BUCKET, self._bucket())
        dealt = placed.repartition(F.col(BUCKET)).sortWithinPartitions(BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{BATCH}={batch_id}")


def unique_stream(
    stream: DataFrame,
    columns: Sequence[str],
    path: str,
    ledger: KeyLedger,
    checkpoint: str,
    alias: str = "_unique",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Rows with ``alias``: no other row of their micro-batch and no row of an earlier one has the same values in ``columns``
    (nulls compare equal). A key's first row has been handed on when its copy comes; the copy fails.

    Only fingerprints are kept, one for each key; those of a batch are added after its rows are written.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("_key", fingerprint([F.col(c) for c in columns]))
        known = ledger.known(keyed, batch_id).withColumn("_seen", F.lit(True))
        alone = unique_flag(keyed, ["_key"], alias)
        # written, so that rows and ledger come from one reading of the batch
        told = alone.join(known, "_key", "left").withColumn(alias, F.col(alias) & F.col("_seen").isNull()).drop("_seen")
        written = write_batch(told, path, batch_id)
        ledger.add(written, batch_id)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or PROCESSING))
        .start()
    )
