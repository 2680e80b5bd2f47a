"""Bring legacy column names to target names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_mapping(mapping: Mapping[str, str], columns: list[str]) -> None:
    """Reject a mapping that gives two columns one name."""
    names = [mapping.get(c, c) for c in columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns map to: {', '.join(twice)}")


def map_schema(df: DataFrame, mappings: Mapping[str, Mapping[str, str]], table: str) -> DataFrame:
    """Rename legacy columns of ``table``; unmapped columns and unknown tables stay as they are."""
    mapping = dict(mappings.get(table, {}))
    check_mapping(mapping, df.columns)
    return df.withColumnsRenamed(mapping)


def map_keys(row: Column, mapping: Mapping[str, str]) -> Column:
    """The same renaming on a row in map form."""
    if not mapping:
        return row
    names = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.transform_keys(row, lambda k, _: F.coalesce(F.try_element_at(names, k), k))
