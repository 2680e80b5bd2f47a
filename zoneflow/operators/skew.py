"""Equi-joins that stay balanced when one key holds a large part of the rows.

Hot keys are found with a frequent-items sketch: one pass over the key columns, no shuffle by key,
and a bounded list of hashes comes back (any hashable key type). The rows of a hot key are spread over several partitions
by a salt, and the matching rows of the other side are repeated once per salt, so every pair is
still produced exactly once. Without a hot key the join is a plain one, whose side sizes Spark can
still judge; adaptive execution covers skew that only shows at run time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewPlan:
    """What makes a key hot, and how far it is split.

    A key is hot when it holds more than ``factor`` times the mean rows of a shuffle partition, and ``min_rows`` at
    least; it gets as many salts as there are means in its rows. The sketch tracks ``tracked`` keys; of two
    partitions' worth of rows, that is enough for any number of partitions up to about half of it. A key that is hot
    on both sides gets the square root of its salts on each, so its rows are repeated that often only."""

    factor: float = 4.0
    min_rows: int = 10_000
    max_keys: int = 4096
    tracked: int = 40_000


DEFAULT_SKEW = SkewPlan()


def hot_keys(df: DataFrame, keys: Sequence[str], plan: SkewPlan, share: float = 1.0) -> dict[int, int]:
    """Hash of each hot key of ``df`` and its number of salts: a bounded list, and only a hint, since a missed or
    needless key changes the work and not the result. ``df`` may hold a random ``share`` of the
    rows that are to be joined."""
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(plan.max_keys), F.lit(plan.tracked))
    found = df.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).select("n", F.inline("top"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mean = F.greatest(F.col("n") / partitions, F.lit(1.0))
    hot = found.where((F.col("count") > plan.factor * mean) & (F.col("count") >= plan.min_rows * share))
    return {r["item"]: r["salts"] for r in hot.select("item", F.ceil(F.col("count") / mean).cast("int").alias("salts")).collect()}


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    spread_by: Column,
    spread_right_by: Column | None = None,
    plan: SkewPlan | None = DEFAULT_SKEW,
    null_safe: bool = False,
    look_at: DataFrame | None = None,
    look_at_share: float = 1.0,
    look_at_right: DataFrame | None = None,
) -> DataFrame:
    """``left`` joined to ``right`` on equally named and typed ``keys``, hot keys split.

    ``spread_by`` should differ between the left rows of one key; its hash picks the salt, so a
    retried task picks the same one. ``spread_right_by`` also splits keys that are hot on the right
    side of an inner join. ``how`` is inner, left, left_semi or left_anti. With ``null_safe`` null
    keys match each other. ``plan`` None gives the plain join.

    ``look_at`` and ``look_at_right`` have the same keys and are cheaper to compute than the sides;
    hot keys are looked for there. ``look_at`` may be a random share of the left rows. All rows are
    joined in any case.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if spread_right_by is not None and how != "inner":
        raise ValueError("the right side can be split in an inner join only")
    keys = list(keys)
    for k in keys:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise ValueError(f"key {k} has different types on the two sides")

    hot_left: dict[int, int] = {}
    hot_right: dict[int, int] = {}
    if plan is not None:
        hot_left.update(hot_keys(left if look_at is None else look_at, keys, plan, look_at_share))
        if spread_right_by is not None:
            hot_right.update(hot_keys(right if look_at_right is None else look_at_right, keys, plan))
    if hot_left or hot_right:
        left = _salt(left, keys, "l", hot_left, hot_right, spread_by)
        right = _salt(right, keys, "r", hot_left, hot_right, spread_right_by)
        salts = ["_salt_l", "_salt_r"]
    else:
        salts = []
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in [*keys, *salts]})
    equal = [
        F.col(k).eqNullSafe(F.col(f"_right_{k}")) if null_safe else F.col(k) == F.col(f"_right_{k}")
        for k in keys
    ] + [F.col(s) == F.col(f"_right_{s}") for s in salts]
    joined = left.join(renamed, reduce(lambda a, b: a & b, equal), how)
    return joined.drop(*salts, *[f"_right_{k}" for k in [*keys, *salts]])


def _salt(
    df: DataFrame,
    keys: Sequence[str],
    side: str,
    hot_left: dict[int, int],
    hot_right: dict[int, int],
    spread_by: Column | None,
) -> DataFrame:
    """Add the salts of both sides: a row picks the one of its own side and gets all of the other."""
    own, other = (hot_left, hot_right) if side == "l" else (hot_right, hot_left)
    key = F.xxhash64(*keys)

    def count(hot: dict[int, int], also: dict[int, int]) -> Column:
        salts = {k: math.isqrt(n - 1) + 1 if k in also else n for k, n in hot.items()}
        entries = F.create_map(*(F.lit(x) for k, n in sorted(salts.items()) for x in (k, n)))
        return F.coalesce(F.try_element_at(entries, key), F.lit(1))

    mine = F.pmod(F.xxhash64(spread_by), count(own, other)).cast("int") if own else F.lit(0)
    rest = F.explode(F.sequence(F.lit(0), count(other, own) - 1)) if other else F.lit(0)
    picked, repeated = ("_salt_l", "_salt_r") if side == "l" else ("_salt_r", "_salt_l")
    return df.withColumn(picked, mine).withColumn(repeated, rest)
