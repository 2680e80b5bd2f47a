"""Ingestion strategies: full dump, incremental, upsert, transform-structure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators.cdc import DELETE
from zoneflow.operators.limits import latest_per_key
from zoneflow.operators.notify import filter_table
from zoneflow.operators.structure import structure_cast
from zoneflow.session import new_run_dir
from zoneflow.sources.buckets import BUCKET, BucketedTable, pruned, write_buckets

# Accepted mode names.
DEFAULT_MODE = "incremental"
MODES = {
    "full": "full",
    "fulldump": "full",
    "incremental": "incremental",
    "upsert": "upsert",
    "transform_structure": "transform_structure",
}


def resolve_mode(name: str | None) -> str:
    """Canonical mode of a configured name in any case."""
    mode = MODES.get((name or DEFAULT_MODE).lower())
    if mode is None:
        raise ValueError(f"no ingestion mode is called {name!r}; known are {sorted(set(MODES.values()))}")
    return mode


def ingest_full(table_rows: DataFrame, messages: DataFrame, table: str) -> DataFrame:
    """The whole table if any notification names it, else nothing.

    The condition is an uncorrelated EXISTS: Spark looks for one message, then reads the table.
    """
    return table_rows.where(filter_table(messages, table).exists())


def ingest_incremental(
    changes: DataFrame, since: DataFrame | None, change_ts: str = "change_ts", seq: str | None = "seq"
) -> DataFrame:
    """Changes after the high-water mark, ``since`` with columns ``high_water_mark`` and ``high_water_seq``.

    Of several marks the greatest counts; None, no mark and a null mark pass everything. Changes with the time of the mark pass if their
    sequence number is greater, so one that is committed late is not lost; without ``seq`` they all pass again, for an idempotent target.
    Changes without a time are never known to be old: they always pass, again and again, for an idempotent target.
    Both alternatives are on the time alone, so the scan can skip what is older. The mark is read at once, in one job, and
    becomes a literal of the filter.
    """
    kind = changes.schema[change_ts].dataType
    mark = None
    if since is not None:
        in_zone = kind.typeName() == "timestamp"  # text of such a time depends on the zone and can be ambiguous
        timed = since.where("high_water_mark IS NOT NULL").agg(F.max(F.struct("high_water_mark", "high_water_seq")).alias("m"))
        at = F.col("m.high_water_mark").cast(kind)
        text = F.unix_micros(at) if in_zone else at.cast("string")
        mark = timed.select(text.alias("at"), F.col("m.high_water_seq").cast("string").alias("seq")).first()
    if mark is None or mark["at"] is None:
        return changes
    newest = F.timestamp_micros(F.lit(mark["at"])) if in_zone else F.lit(mark["at"]).cast(kind)
    untimed = F.col(change_ts).isNull()
    after = changes.where((F.col(change_ts) >= newest) | untimed)
    if seq is None:
        return after
    number = changes.schema[seq].dataType
    last = F.lit(mark["seq"]).cast(number)
    return after.where((F.col(change_ts) > newest) | F.coalesce(F.col(seq) > last, F.lit(True)) | untimed)


def high_water_mark(changes: DataFrame, change_ts: str = "change_ts", seq: str | None = "seq") -> DataFrame:
    """One row with the newest change's time and sequence number, to be stored for the next run."""
    number = F.col(seq) if seq else F.lit(None).cast("bigint")
    newest = changes.agg(F.max(F.struct(F.col(change_ts).alias("t"), number.alias("s"))).alias("m"))
    return newest.select(F.col("m.t").alias("high_water_mark"), F.col("m.s").alias("high_water_seq"))


def ingest_upsert(
    delta: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[str],
    op_column: str = "op",
) -> DataFrame:
    """The target with the newest change of each key applied; a delete leaves a tombstone.

    ``target`` holds one row per key (null is a key too) with the columns of ``delta`` and
    ``_is_deleted``. A change older than the target row is ignored, so applying a delta twice or out of order changes
    nothing. Both sides meet in one shuffle: the newest row of a key is found within the input tasks first.
    """
    newest = delta.withColumn("_is_deleted", F.col(op_column).eqNullSafe(F.lit(DELETE)))
    if target is None:
        return latest_per_key(newest, keys, order)
    # at equal order the target's row stays
    rows = newest.withColumn("_of_target", F.lit(0)).unionByName(target.select(*newest.columns, F.lit(1).alias("_of_target")))
    return latest_per_key(rows, keys, [*order, "_of_target"]).drop("_of_target")


def upsert_buckets(delta: DataFrame, table: BucketedTable, order: Sequence[str], op_column: str = "op", split: int = 1) -> None:
    """``ingest_upsert`` into a target kept in buckets of its key, in place: of the target only the buckets that the delta's keys
    fall into are read, merged and replaced; all others keep their files.

    The merged buckets are written beside the target first. A run that fails while they take their places is simply run
    again with the same delta: a change that is there already is not applied twice, and every bucket is replaced as a whole.
    """
    touched = pruned(table, delta.select(table.key)).drop(BUCKET)
    merged = ingest_upsert(delta, touched, [table.key], order, op_column)
    staged = new_run_dir(delta.sparkSession, "upsert-staged")
    merged.write.parquet(staged)
    write_buckets(delta.sparkSession.read.schema(merged.schema).parquet(staged), table, "overwrite", split, only_these=True)


def ingest_transform_structure(
    rows: DataFrame,
    mapping: Mapping[str, str],
    mode: str = "null",
    enrich: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Ingested rows with typed columns and small row-wise additions."""
    typed = structure_cast(rows, mapping, mode)
    return typed.withColumns(dict(enrich)) if enrich else typed


@dataclass(frozen=True)
class Source:
    """What a table's ingestion reads: its rows, the messages that name it, its change log, the target kept so far.

    ``mapping`` and ``enrich`` are for ``transform_structure``."""

    table: str
    rows: DataFrame | None = None
    messages: DataFrame | None = None
    changes: DataFrame | None = None
    target: DataFrame | None = None
    keys: Sequence[str] = ("record_id",)
    change_ts: str = "change_ts"
    seq: str = "seq"
    mapping: Mapping[str, str] | None = None
    structure_mode: str = "quarantine"
    enrich: Mapping[str, Column] | None = None


def ingest(mode: str | None, source: Source, since: DataFrame | None = None) -> DataFrame:
    """The rows that the strategy named by ``mode`` takes in. ``since`` is the table's mark; the strategies that read the
    change log take what comes after it."""
    mode = resolve_mode(mode)
    if mode == "full":
        return ingest_full(source.rows, source.messages, source.table)
    if mode == "transform_structure":
        return ingest_transform_structure(source.rows, source.mapping or {}, source.structure_mode, source.enrich)
    changes = ingest_incremental(source.changes, since, source.change_ts, source.seq)
    if mode == "incremental":
        return changes
    return ingest_upsert(changes, source.target, list(source.keys), [source.change_ts, source.seq])


class MarkStore:
    """High-water marks by table, appended run by run; the greatest of a table counts. A run that holds rows back names
    the folder they lie in beside its mark, so both move on in one write; the last one named counts."""

    SCHEMA = "table_name string, high_water_mark timestamp_ntz, high_water_seq bigint, pending string, pending_no bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, table: str) -> DataFrame | None:
        """Marks of ``table``; None before the first run of any table."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return None
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).where(F.col("table_name") == table)

    def pending(self, table: str) -> tuple[int, str | None]:
        """Number and folder of the rows that the last run of ``table`` held back; 0 and None if no run named one."""
        marks = self.read(table)
        last = marks and marks.agg(F.max(F.struct("pending_no", "pending")).alias("p")).first()["p"]
        return (last["pending_no"], last["pending"]) if last and last["pending_no"] else (0, None)

    def advance(
        self, table: str, changes: DataFrame, change_ts: str = "change_ts", seq: str = "seq", pending: tuple[int, str] | None = None
    ) -> None:
        """Store the mark of ``changes``; to be called when they are safely written. No changes, no mark. ``pending``:
        number and folder of the rows held back, stored even without a mark."""
        mark = high_water_mark(changes, change_ts, seq)
        row = (mark if pending else mark.where("high_water_mark IS NOT NULL")).select(
            F.lit(table).alias("table_name"),
            F.col("high_water_mark").cast("timestamp_ntz").alias("high_water_mark"),
            F.col("high_water_seq").cast("bigint").alias("high_water_seq"),
            F.lit(pending and pending[1]).cast("string").alias("pending"),
            F.lit(pending and pending[0]).cast("bigint").alias("pending_no"),
        )
        row.coalesce(1).write.mode("append").parquet(self.path)
