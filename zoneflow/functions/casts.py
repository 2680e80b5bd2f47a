"""Typed casts of source text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Configured type names and the Spark type each one stands for.
TYPE_NAMES = {
    "string": "string",
    "int64": "bigint",
    "float64": "double",
    "bool": "boolean",
}

INT_TEXT = r"\A[+-]?[0-9]+\z"
# A number too large for a double is infinite as well, so only the words are held to one spelling.
SPECIAL_WORD = r"(?i)\A\s*[+-]?(?:inf|infinity|nan)\s*\z"
EXACT_WORD = r"\A\s*[+-]?(?:Infinity|NaN)\s*\z"


def spark_type(type_name: str) -> str:
    """Spark type of a configured name in any case; an unknown name means text."""
    return TYPE_NAMES.get(type_name.lower(), "string")


def to_long(value: Column) -> Column:
    """Strict integer text to BIGINT, null when malformed. Spark's cast alone would also trim."""
    text = value.cast("string")
    return F.when(text.rlike(INT_TEXT), text.try_cast("bigint"))


def to_double(value: Column) -> Column:
    """Number text to DOUBLE, null when malformed.

    Spark also reads words such as ``inf`` or ``nan`` in any case; only ``NaN`` and ``Infinity``
    count. The spelling is looked at for those results alone.
    """
    text = value.cast("string")
    number = text.try_cast("double")
    special = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    wrong = text.rlike(SPECIAL_WORD) & ~text.rlike(EXACT_WORD)
    return F.when(special & wrong, F.lit(None).cast("double")).otherwise(number)


def to_bool(value: Column) -> Column:
    """Only "true" in any case is true, every other non-null text is false."""
    return F.when(value.isNotNull(), F.lower(value.cast("string")) == F.lit("true"))


def cast_value(value: Column, type_name: str) -> Column:
    """``value`` as the configured type; malformed text gives null."""
    target = spark_type(type_name)
    if target == "bigint":
        return to_long(value)
    if target == "double":
        return to_double(value)
    if target == "boolean":
        return to_bool(value)
    return value.cast("string")
