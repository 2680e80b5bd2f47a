"""Data-quality rules as boolean columns, with pass filter and quarantine.

Every rule but ``unique`` is one expression over the row, so all flags are computed in the pass
that reads the rows. ``unique`` counts keys first and joins the repeated ones back.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from zoneflow.functions.casts import to_double
from zoneflow.functions.text import full_match, labels_where
from zoneflow.operators.skew import DEFAULT_SKEW, SkewPlan, skew_join

# Rule names, the pattern of a regex rule without one, and the e-mail pattern.
NOT_NULL = "not_null"
REGEX = "regex"
RANGE = "range"
UNIQUE = "unique"
VALID_EMAIL = "valid_email"
DEFAULT_PATTERN = ".*"
EMAIL_PATTERN = r"[^@\s]+@[^@\s]+\.[A-Za-z0-9-]{2,}"


@dataclass(frozen=True)
class DQRule:
    """One rule. ``expr`` holds a custom condition (SQL text); ``unique`` adds a uniqueness check."""

    name: str
    columns: tuple[str, ...] = ()
    pattern: str | None = None
    min: float | None = None
    max: float | None = None
    unique: bool = False
    expr: str | None = None

    @property
    def label(self) -> str:
        return f"{self.name}({','.join(self.columns)})" if self.columns else self.name

    @property
    def checks_unique(self) -> bool:
        return self.unique or self.name == UNIQUE


def rules_from_config(items: Sequence[Mapping]) -> list[DQRule]:
    """Rules from configuration entries (``name``, ``columns``, ``pattern``, ``min``, ``max``, …)."""
    return [
        DQRule(
            name=item["name"],
            columns=tuple(item.get("columns") or ()),
            pattern=item.get("pattern"),
            min=item.get("min"),
            max=item.get("max"),
            unique=bool(item.get("unique", False)),
            expr=item.get("expr"),
        )
        for item in items
    ]


def _all(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, flags, F.lit(True))


def _value(name: str, present: Sequence[str]) -> Column:
    return F.col(name) if name in present else F.lit(None).cast("string")


def rule_flag(rule: DQRule, present: Sequence[str]) -> Column:
    """Never-null boolean for the row part of ``rule``; a column the rows lack counts as null."""
    values = [_value(c, present) for c in rule.columns]
    if rule.expr is not None:
        return F.coalesce(F.expr(rule.expr), F.lit(False))
    if rule.name == NOT_NULL:
        return _all([v.isNotNull() for v in values])
    if rule.name == REGEX:
        return _all([full_match(v, rule.pattern or DEFAULT_PATTERN) for v in values])
    if rule.name == VALID_EMAIL:
        return _all([full_match(v, rule.pattern or EMAIL_PATTERN) for v in values])
    if rule.name == RANGE:
        return _all([_in_range(v, rule) for v in values])
    if not rule.checks_unique:
        warnings.warn(f"rule {rule.name!r} is unknown and passes every row", stacklevel=3)
    return F.lit(True)


def _in_range(value: Column, rule: DQRule) -> Column:
    """NaN sorts above every number, so the upper bound (infinity by default) also keeps it out."""
    number = to_double(value)
    low = float("-inf") if rule.min is None else float(rule.min)
    high = float("inf") if rule.max is None else float(rule.max)
    return F.coalesce((number >= F.lit(low)) & (number <= F.lit(high)), F.lit(False))


def unique_flag(
    df: DataFrame,
    columns: Sequence[str],
    alias: str = "_unique",
    skew: SkewPlan | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add ``alias``: no other row has the same values in ``columns`` (nulls compare equal).

    Keys are counted with map-side combine and only repeated keys are joined back; rows of a hot
    key are spread.
    """
    keys = list(columns)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.where(F.col("n") > 1).select(*keys, F.lit(False).alias(alias))
    spread = F.xxhash64(*[F.col(c) for c in df.columns if not isinstance(df.schema[c].dataType, MapType)])
    joined = skew_join(df, repeated, keys, "left", spread_by=spread, plan=skew, null_safe=True)
    return joined.withColumn(alias, F.coalesce(F.col(alias), F.lit(True)))


def with_flags(df: DataFrame, rules: Sequence[DQRule], skew: SkewPlan | None = DEFAULT_SKEW) -> DataFrame:
    """Add ``_dq_failed``: labels of the rules the row fails, empty when it passes all."""
    present = [c for c in df.columns if not c.startswith("_dq_")]
    flagged = df
    flags = []
    helpers = []
    for index, rule in enumerate(rules):
        flag = rule_flag(rule, present)
        if rule.checks_unique:
            helper = f"_dq_unique_{index}"
            flagged = unique_flag(flagged, rule.columns, helper, skew)
            helpers.append(helper)
            flag = flag & F.col(helper)
        flags.append((~flag, rule.label))
    return flagged.withColumn("_dq_failed", labels_where(flags)).drop(*helpers)


def passed(flagged: DataFrame) -> DataFrame:
    """Rows that pass all rules."""
    return flagged.where(F.size("_dq_failed") == 0).drop("_dq_failed")


def quarantined(flagged: DataFrame) -> DataFrame:
    """Rows that fail some rule, with the labels in ``_dq_failed``."""
    return flagged.where(F.size("_dq_failed") > 0)


def dq_pass(df: DataFrame, rules: Sequence[DQRule], skew: SkewPlan | None = DEFAULT_SKEW) -> DataFrame:
    return passed(with_flags(df, rules, skew))


def rule_outcomes(
    flagged: DataFrame, rules: Sequence[DQRule], groups: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per rule (and group): ``rule_name, passed, n_passed, n_failed``.

    All rules are counted in one aggregate and the counts are unpivoted afterwards, so rows are
    not multiplied by the number of rules.
    """
    groups = dict(groups or {})
    labels = [r.label for r in rules]
    failures = [
        F.count_if(F.array_contains("_dq_failed", label)).alias(f"_f{i}") for i, label in enumerate(labels)
    ]
    total = F.count(F.lit(1)).alias("_n")
    counted = flagged.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(total, *failures)
    outcomes = F.array(
        *[
            F.struct(F.lit(label).alias("rule_name"), F.col(f"_f{i}").alias("n_failed"))
            for i, label in enumerate(labels)
        ]
    )
    return counted.select(*groups, "_n", F.inline(outcomes)).select(
        *groups,
        "rule_name",
        (F.col("n_failed") == 0).alias("passed"),
        (F.col("_n") - F.col("n_failed")).alias("n_passed"),
        "n_failed",
    )
