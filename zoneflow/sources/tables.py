"""Warehouse tables and their schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators.structure import structure_cast


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or the parquet files under a path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


# Configured type name for each Spark type a registry can state.
REGISTRY_NAMES = {
    "bigint": "int64",
    "int": "int64",
    "smallint": "int64",
    "tinyint": "int64",
    "double": "float64",
    "float": "float64",
    "boolean": "bool",
}


class SchemaRegistry:
    """Column types per table: stated in configuration, else taken from the table itself."""

    def __init__(self, spark: SparkSession, configured: Mapping[str, Mapping[str, str]] | None = None):
        self._spark = spark
        self._configured = dict(configured or {})

    def get_schema(self, table: str) -> dict[str, str]:
        if table in self._configured:
            return dict(self._configured[table])
        return schema_names(read_table(self._spark, table))


def schema_names(df: DataFrame) -> dict[str, str]:
    return {name: REGISTRY_NAMES.get(kind, "string") for name, kind in df.dtypes}


def apply_schema(df: DataFrame, schema: Mapping[str, str], mode: str = "null") -> DataFrame:
    """Project ``df`` to the columns of ``schema`` in its order, typed; a missing column is null."""
    present = set(df.columns)
    projected = df.select(
        *[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in schema]
    )
    return structure_cast(projected, schema, mode)
