"""Helpers the corpus operators share: tables, written intermediate results, words."""

from __future__ import annotations

import functools
import string
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.session import new_run_dir


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="zoneflow-")) / "zoneflow-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def on_executors(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``fn(spark, ...)`` after the package is there."""

    @functools.wraps(fn)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship_package(spark)
        return fn(spark, *args)

    return run


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it cuts the lineage, survives a lost executor
    and gives the planner true sizes."""
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
