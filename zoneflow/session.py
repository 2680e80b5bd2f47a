"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ADAPTIVE_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Recording the Python line of every expression doubles the time to build a plan.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "zoneflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; a cluster's own settings come through ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without that setting gets a folder of its own; a cluster without it is
    an error, because a machine-local folder would be lost with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_roots:
        _local_roots[app_id] = tempfile.mkdtemp(prefix="zoneflow-")
    return _local_roots[app_id]


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for one run; nothing is shared between runs, so a rerun never reads stale rows."""
    return f"{shared_root(spark)}/zoneflow/{name}-{uuid.uuid4().hex}"
