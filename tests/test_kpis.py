"""Key figures from changes equal those computed anew."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from zoneflow.plans.kpis import KpiStore, Measures

SCHEMA = "id string, region string, amount decimal(10,2), n int"
MEASURES = Measures({"region": "coalesce(region, 'none')"}, {"rows": "1", "amount": "amount", "n": "n"})


def anew(rows):
    grouped = rows.groupBy(F.coalesce("region", F.lit("none")).alias("region"))
    return grouped.agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"), F.sum("n").alias("n"))


def values(df):
    number = lambda x: None if x is None else Decimal(x).normalize()
    return sorted((r["region"], number(r["rows"]), number(r["amount"]), number(r["n"])) for r in df.collect())


def some_rows(rng, ids):
    return [(i, rng.choice(["a", "b", None]), rng.choice([None, Decimal("1.25"), Decimal("-3.10")]), rng.choice([None, 1, 7])) for i in ids]


def test_after_each_of_three_deltas(spark, tmp_path):
    rng = random.Random(1)
    current = {r[0]: r for r in some_rows(rng, [*(str(i) for i in range(40)), None])}
    store = KpiStore(spark, str(tmp_path / "k"), MEASURES)
    store.start(spark.createDataFrame(list(current.values()), SCHEMA), "id", buckets=8)
    assert values(store.figures()) == values(anew(spark.createDataFrame(list(current.values()), SCHEMA)))
    for number in (1, 2, 3):
        delta = some_rows(rng, [*map(str, rng.sample(range(60), 12)), *([None] if number == 2 else [])])
        df = spark.createDataFrame(delta, SCHEMA)
        store.apply(df, number)
        store.apply(df, number)  # the same batch again counts once
        current.update({r[0]: r for r in delta})
        now = spark.createDataFrame(list(current.values()), SCHEMA)
        assert values(store.figures()) == values(anew(now))
        assert sorted(map(tuple, store.rows().collect()), key=str) == sorted(current.values(), key=str)


def test_a_batch_that_failed_before_its_rows_were_replaced(spark, tmp_path, monkeypatch):
    from zoneflow.plans import kpis

    first = spark.createDataFrame([("1", "a", Decimal("1"), 1), ("2", "b", Decimal("2"), 2)], SCHEMA)
    delta = spark.createDataFrame([("2", "a", Decimal("5"), None)], SCHEMA)
    store = KpiStore(spark, str(tmp_path / "k"), MEASURES)
    store.start(first, "id", buckets=4)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(kpis, "write_buckets", fail)
        with pytest.raises(RuntimeError):
            store.apply(delta, 1)
    store.apply(delta, 1)
    assert values(store.figures()) == [("a", Decimal(2), Decimal(6), Decimal(1))]
    assert store.rows().count() == 2


def test_groups_that_empty_go_and_null_stays_null(spark, tmp_path):
    store = KpiStore(spark, str(tmp_path / "k"), MEASURES)
    store.start(spark.createDataFrame([("1", "a", Decimal("1"), None)], SCHEMA), "id", buckets=2)
    store.apply(spark.createDataFrame([("1", "b", None, None)], SCHEMA), 1)
    store.apply(spark.createDataFrame([], SCHEMA), 2)
    assert values(store.figures()) == [("b", Decimal(1), None, None)]


def test_floating_point_amounts_are_refused(spark, tmp_path):
    store = KpiStore(spark, str(tmp_path / "k"), Measures({"g": "id"}, {"x": "cast(n as double)"}))
    with pytest.raises(ValueError, match="floating-point"):
        store.start(spark.createDataFrame([("1", "a", None, 1)], SCHEMA), "id", buckets=2)
