"""Cast configured columns to their types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.casts import cast_value, spark_type
from zoneflow.functions.text import labels_where

MODES = ("fail", "null", "quarantine")


def structure_cast(df: DataFrame, mapping: Mapping[str, str], mode: str = "fail") -> DataFrame:
    """Cast the columns of ``mapping`` that ``df`` has and that are not of their type yet.

    Malformed text fails the job (``fail``), becomes null (``null``), or becomes null with the
    column named in ``_cast_failed`` (``quarantine``).
    """
    if mode not in MODES:
        raise ValueError(f"unknown cast mode: {mode}")
    types = dict(df.dtypes)
    present = {c: t for c, t in mapping.items() if c in types and types[c] != spark_type(t)}
    typed = {}
    failed = []
    for column, type_name in present.items():
        source = F.col(column)
        value = cast_value(source, type_name)
        bad = source.isNotNull() & value.isNull()
        if mode == "fail" and spark_type(type_name) in ("bigint", "double"):
            message = F.concat(F.lit(f"column {column} is not {type_name}: "), source.cast("string"))
            value = F.when(bad, F.raise_error(message).cast(spark_type(type_name))).otherwise(value)
        typed[column] = value
        failed.append((bad, column))
    if mode == "quarantine":
        typed["_cast_failed"] = labels_where(failed)
    return df.withColumns(typed) if typed else df
