"""Compaction of log tables: many small batch folders become few sorted files while readers go on.

``compact_log`` writes the rows of all batches that no earlier compaction holds into a new generation, a folder that plain readers of
the table do not see, dealt by range of domain, zone and table, so that a reader of one zone opens few files. A generation counts
from the moment Spark has marked it as complete; until then, and if the job dies, readers see the batches. ``read_log`` takes each
batch either from its generation or from its own folder. Batch folders stay until ``remove_compacted`` is
called, so a reader that began before goes on undisturbed.

A batch that runs again after it was compacted writes its folder anew; its log rows are hashes of their content and so are
those that the generation holds, which is why the folder is left unread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.sinks.tables import LOG_CLUSTERING, LOG_PARTITION

#: Size of the files that a compaction aims at.
FILE_BYTES = 128 * 2**20
_GENERATIONS = "_compacted"
_BATCH = "_batch_id"


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, text: str, prefix: str) -> list[str]:
    """Names of the finished folders under ``text`` that begin with ``prefix``."""
    path, fs = _path(spark, text)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    finished = [n for n in names if n.startswith(prefix) and fs.exists(_path(spark, f"{text}/{n}/_SUCCESS")[0])]
    return sorted(finished)


def _generations(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{_GENERATIONS}/{n}" for n in _folders(spark, f"{path}/{_GENERATIONS}", "rows-")]


def _open_batches(spark: SparkSession, path: str, generations: Sequence[str]) -> list[str]:
    """Batch folders that no generation holds."""
    held = set()
    if generations:
        lists = [g.replace("/rows-", "/batches-") for g in generations]
        held = {r["folder"] for r in spark.read.schema("folder string").parquet(*lists).collect()}
    return [n for n in _folders(spark, path, f"{_BATCH}=") if n not in held]


def _batch_rows(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """Rows of the folders; ``_batch_id`` is text, as batches may be named."""
    rows = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*[f"{path}/{n}" for n in folders])
    return rows.withColumn(_BATCH, F.col(_BATCH).cast("string"))


def compact_log(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> int:
    """Bring all batches that are not compacted yet into a new generation; returns how many there were.

    The rows are dealt by range of the clustering columns, then of all others, so a zone that holds most rows spreads over
    several files. One compaction of a table runs at a time. Only names of batch folders come to the driver.
    """
    generations = _generations(spark, path)
    folders = _open_batches(spark, path, generations)
    if not folders:
        return 0
    size = 0
    for name in folders:
        folder, fs = _path(spark, f"{path}/{name}")
        size += fs.getContentSummary(folder).getLength()
    number = f"{len(generations):06d}"
    # what is in the generation is written first: from the rows' end on, readers rely on it
    listed = spark.createDataFrame([(n,) for n in folders], "folder string")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_GENERATIONS}/batches-{number}")
    rows = _batch_rows(spark, path, folders)
    first = [c for c in LOG_CLUSTERING if c in rows.columns]
    spread = F.xxhash64(*[F.col(c).cast("string") for c in rows.columns])
    dealt = rows.repartitionByRange(max(1, -(-size // file_bytes)), *first, LOG_PARTITION, spread)
    dealt.sortWithinPartitions(*first, LOG_PARTITION).write.mode("overwrite").parquet(f"{path}/{_GENERATIONS}/rows-{number}")
    return len(folders)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a log table, each once, whatever has been compacted; a batch may have more columns than those before it."""
    generations = _generations(spark, path)
    parts = [spark.read.option("mergeSchema", "true").parquet(*generations)] if generations else []
    folders = _open_batches(spark, path, generations)
    if folders:
        parts.append(_batch_rows(spark, path, folders))
    if not parts:
        raise FileNotFoundError(f"no finished batch under {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def remove_compacted(spark: SparkSession, path: str) -> int:
    """Remove the batch folders that generations hold, once no reader needs them; returns how many."""
    generations = _generations(spark, path)
    kept = set(_open_batches(spark, path, generations))
    gone = [n for n in _folders(spark, path, f"{_BATCH}=") if n not in kept]
    for name in gone:
        folder, fs = _path(spark, f"{path}/{name}")
        fs.delete(folder, True)
    return len(gone)
