"""Text expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def equals_ignore_case(value: Column, word: str) -> Column:
    """True only for ``word`` in any letter case; null is false. A boolean cast would accept t, y and 1."""
    return F.coalesce(F.lower(value.cast("string")) == F.lit(word.lower()), F.lit(False))


def full_match(value: Column, pattern: str) -> Column:
    """The whole text matches ``pattern``. Null counts as the empty text."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return text.rlike(rf"\A(?:{pattern})\z")


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality: null equals null."""
    return ~left.eqNullSafe(right)


def labels_where(flags: Sequence[tuple[Column, str]]) -> Column:
    """Array of the labels whose condition is true.

    ``array_remove`` is generated code; a higher-order function here would evaluate all the
    conditions row by row in the interpreter.
    """
    if not flags:
        return F.array().cast("array<string>")
    return F.array_remove(F.array(*[F.when(c, F.lit(label)).otherwise(F.lit("")) for c, label in flags]), "")


def strip_suffix(value: Column, suffix: str) -> Column:
    return F.when(value.endswith(suffix), F.left(value, F.length(value) - len(suffix))).otherwise(value)


def encode_fields(columns: Sequence[Column]) -> Column:
    """One text per row that keeps field borders and nulls apart.

    Each value is written as ``length:value`` and null as ``~``. ``concat_ws`` alone drops nulls,
    and any separator may occur inside a value.
    """
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("~")) for t in texts])


def fingerprint(columns: Sequence[Column]) -> Column:
    """Lower-case md5 hex of the encoded fields."""
    return F.md5(encode_fields(columns).cast("binary"))


def stable_id(*columns: Column) -> Column:
    """Row id that a retried task computes again; a random UUID would change."""
    return fingerprint(columns)
