from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zoneflow.operators.fetch import affected_rows, lookup_fetch
from zoneflow.operators.quality import DQRule, with_flags
from zoneflow.operators.reconcile import column_diff, match_counts, variant_counts
from zoneflow.operators.skew import SkewPlan, hot_keys, skew_join

HOT = SkewPlan(factor=0.2, min_rows=10)


def side(spark, n, hot_share, keys=10, start=0):
    """``n`` rows, ``1/hot_share`` of them with key 0."""
    hot = F.when(F.col("id") % hot_share == 0, F.lit(0)).otherwise(F.col("id") % keys + start)
    return spark.range(n).select(hot.cast("string").alias("k"), F.col("id").alias("v"))


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_plain_join(spark, how):
    left = side(spark, 120, 3)
    right = side(spark, 15, 4, start=3).withColumnRenamed("v", "w")
    salted = skew_join(left, right, ["k"], how, spread_by=F.col("v"), plan=HOT)
    same(salted, skew_join(left, right, ["k"], how, spread_by=F.col("v"), plan=None))


@pytest.mark.parametrize(("n_left", "n_right"), [(20, 150), (150, 20), (150, 150)])
def test_equals_plain_join_when_right_or_both_are_hot(spark, n_left, n_right):
    left = side(spark, n_left, 3, keys=30)
    right = side(spark, n_right, 3, keys=30).withColumnRenamed("v", "w")
    args = {"spread_by": F.col("v"), "spread_right_by": F.col("w")}
    same(skew_join(left, right, ["k"], plan=HOT, **args), skew_join(left, right, ["k"], plan=None, **args))


def test_hot_rows_are_spread(spark):
    left, right = side(spark, 300, 3), side(spark, 10, 100).withColumnRenamed("v", "w")
    plan = skew_join(left, right, ["k"], spread_by=F.col("v"), plan=HOT)
    assert "_salt_l" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_finds_the_third(spark):
    df = side(spark, 300, 3, keys=1000)
    found = hot_keys(df, ["k"], HOT)
    expected = spark.sql("select xxhash64('0') h").first().h
    assert list(found) == [expected] and found[expected] > 1
    assert hot_keys(df, ["k"], SkewPlan()) == {}


def test_null_keys(spark):
    left = spark.createDataFrame([(None, 1)] * 30 + [("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 1), ("a", 5)], "k string, w int")
    safe = skew_join(left, right, ["k"], "left", spread_by=F.col("v"), plan=HOT, null_safe=True)
    assert safe.where("w = 1").count() == 30
    plain = skew_join(left, right, ["k"], "left", spread_by=F.col("v"), plan=HOT)
    assert plain.where("w = 1").count() == 0 and plain.count() == 31


def test_key_types_must_agree(spark):
    left = spark.createDataFrame([(1, 1)], "k int, v int")
    right = spark.createDataFrame([(1, 1)], "k bigint, w int")
    with pytest.raises(ValueError, match="types"):
        skew_join(left, right, ["k"], spread_by=F.col("v"))


@pytest.mark.parametrize("kind", ["decimal(10,2)", "timestamp", "double", "binary"])
def test_keys_of_any_type_are_split(spark, kind):
    cast = lambda df: df.withColumn("k", (F.col("k") if kind == "binary" else F.col("k").cast("int")).cast(kind))
    left, right = cast(side(spark, 300, 3)), cast(side(spark, 10, 100)).withColumnRenamed("v", "w")
    split = skew_join(left, right, ["k"], spread_by=F.col("v"), plan=HOT)
    assert "_salt_l" in split._jdf.queryExecution().optimizedPlan().toString()
    same(split, skew_join(left, right, ["k"], spread_by=F.col("v"), plan=None))


@pytest.fixture(scope="module")
def notifications(spark):
    """A third of the notifications name id 0."""
    ids = F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise((F.col("id") % 40).cast("string"))
    return spark.range(200).select(
        F.concat(F.lit("m"), "id").alias("message_id"),
        F.lit("update").alias("event_type"),
        F.current_timestamp().alias("event_ts"),
        F.array(ids, F.lit("none")).alias("record_ids"),
    )


def test_operators_give_the_same_rows_when_split(spark, notifications):
    table = spark.range(60).select(
        F.when(F.col("id") % 2 == 0, F.lit("0")).otherwise(F.col("id").cast("string")).alias("record_id"),
        F.col("id").cast("string").alias("name"),
    )
    columns = ["_notif_message_id", "record_id", "name"]
    split = lookup_fetch(notifications, table, skew=HOT).select(columns)
    plain = lookup_fetch(notifications, table, skew=None).select(columns)
    same(split, plain)
    assert split.count() > 1000
    named = ["0", *(str(i % 40) for i in range(200) if i % 3)]
    assert affected_rows(notifications, table).count() == table.where(F.col("record_id").isin(named)).count()

    records = plain
    legacy = table.withColumn("name", F.when(F.col("name") > "3", F.col("name")))
    same(
        match_counts(records, legacy, spread_by=F.col("_notif_message_id"), skew=HOT),
        match_counts(records, legacy, spread_by=F.col("_notif_message_id"), skew=None),
    )
    same(column_diff(records, legacy, skew=HOT), column_diff(records, legacy, skew=None))
    same(
        variant_counts(records, legacy, carry=["name"], skew=HOT),
        variant_counts(records, legacy, carry=["name"], skew=None),
    )
    rules = [DQRule("unique", ("record_id",)), DQRule("unique", ("name",))]
    same(with_flags(table, rules, HOT), with_flags(table, rules, None))
