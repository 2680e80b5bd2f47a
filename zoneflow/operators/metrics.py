"""Named numbers per run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def metric_rows(df: DataFrame, pipeline_id: str, metrics: Mapping[str, Column]) -> DataFrame:
    """(pipeline_id, name, value) rows of aggregate expressions, computed in one pass."""
    entries = F.array(
        *[F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in metrics.items()]
    )
    return df.agg(entries.alias("_m")).select(F.lit(pipeline_id).alias("pipeline_id"), F.inline("_m"))


def observe(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` that collects the metrics while it is written; read them with ``Observation.get`` after."""
    observation = Observation(name)
    return df.observe(observation, *[c.alias(n) for n, c in metrics.items()]), observation
