"""Tables kept by key bucket: what is read, what is replaced."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import ingest, reconcile
from zoneflow.operators.fetch import bucketed_fetch, lookup_fetch
from zoneflow.sources.buckets import BUCKET, create_bucketed, open_bucketed, pruned
from zoneflow.streaming.unique import KeyLedger, unique_stream
from zoneflow.streaming.windows import AVAILABLE


def files(table) -> dict[str, set[str]]:
    """Data files by bucket folder."""
    return {p.name: {f.name for f in p.glob("*.parquet")} for p in Path(table.data).glob(f"{BUCKET}=*")}


def spoil(table, kept: set[str]) -> int:
    """Make every data file outside the buckets ``kept`` unreadable."""
    spoiled = 0
    for folder in Path(table.data).glob(f"{BUCKET}=*"):
        if folder.name not in kept:
            for f in folder.glob("*.parquet"):
                f.write_bytes(b"unreadable")
                (folder / f".{f.name}.crc").unlink(missing_ok=True)
                spoiled += 1
    return spoiled


def notices(spark, ids):
    rows = [(f"m{i}", "update", None, list(x)) for i, x in enumerate(ids)]
    return spark.createDataFrame(rows, "message_id string, event_type string, event_ts timestamp, record_ids array<string>")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_fetch_reads_only_the_buckets_of_its_ids(spark, tmp_path, kind):
    members = spark.range(200).select(F.col("id").cast(kind).alias("record_id"), F.concat(F.lit("n"), "id").alias("name"))
    members = members.unionByName(members.where(F.col("record_id").cast("string").isin("0", "50", "100", "150"))).unionByName(members.limit(1).withColumn("record_id", F.lit(None).cast(kind)))
    table = create_bucketed(members, str(tmp_path / "t"), "record_id", buckets=32, split=2)
    assert open_bucketed(spark, str(tmp_path / "t")) == table
    assert rows_of(table.read(spark).drop(BUCKET)) == rows_of(members)
    asked = notices(spark, [["7", "50", "none", "07"], ["7", "7"], []])
    expected = rows_of(lookup_fetch(asked, members))
    assert len(expected) == 4
    kept = {f"{BUCKET}={r[0]}" for r in members.where(F.col("record_id").cast("string").isin("7", "50")).select(table.bucket(F.col("record_id"))).collect()}
    kept |= {f"{BUCKET}={r[0]}" for r in asked.select(F.explode("record_ids").alias("i")).select(table.bucket(F.col("i"))).collect()}
    assert spoil(table, kept) > 20
    fetched = bucketed_fetch(asked, table)
    assert rows_of(fetched) == expected
    assert "dynamicpruning" in fetched._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="(?i)parquet"):
        table.read(spark).collect()


def test_fetch_without_ids_reads_nothing(spark, tmp_path):
    table = create_bucketed(spark.range(50).withColumnRenamed("id", "record_id"), str(tmp_path / "t"), "record_id", buckets=8)
    spoil(table, set())
    assert bucketed_fetch(notices(spark, []), table).count() == 0


def test_empty_table(spark, tmp_path):
    none = spark.range(0).select(F.col("id").cast("string").alias("record_id"), F.lit("x").alias("name"))
    table = create_bucketed(none, str(tmp_path / "t"), "record_id", buckets=8)
    assert bucketed_fetch(notices(spark, [["1"]]), table).count() == 0


CHANGE = "record_id string, seq long, op string, amount int"


def test_upsert_replaces_only_touched_buckets(spark, tmp_path):
    first = spark.createDataFrame([(str(i), 1, "insert", i) for i in range(100)] + [(None, 1, "insert", -1)], CHANGE)
    target = ingest.ingest_upsert(first, None, ["record_id"], ["seq"])
    table = create_bucketed(target, str(tmp_path / "t"), "record_id", buckets=16)
    delta = spark.createDataFrame(
        [("3", 2, "update", 30), ("3", 3, "delete", 31), ("5", 0, "update", 50), ("new", 1, "insert", 7), (None, 2, "update", -2)], CHANGE
    )
    before = files(table)
    touched = {f"{BUCKET}={r[0]}" for r in delta.select(table.bucket(F.col("record_id"))).collect()}
    assert 0 < len(touched) < len(before)
    expected = rows_of(ingest.ingest_upsert(delta, target, ["record_id"], ["seq"]))
    for _ in range(2):  # the second time changes nothing
        ingest.upsert_buckets(delta, table, ["seq"], split=2)
        assert rows_of(table.read(spark).drop(BUCKET)) == expected
    after = files(table)
    assert all(after[b] == before[b] for b in before.keys() - touched)
    assert all(after[b] != before.get(b) for b in touched)
    spoil(table, touched)
    ingest.upsert_buckets(spark.createDataFrame([("3", 4, "update", 32)], CHANGE), table, ["seq"])
    ingest.upsert_buckets(delta.limit(0), table, ["seq"])
    assert files(table).keys() == after.keys()


def orders(spark, n, changed=()):
    price = F.when(F.col("id").isin(*changed), F.lit("other")).otherwise(F.concat(F.lit("p"), "id")) if changed else F.concat(F.lit("p"), "id")
    return spark.range(n).select(F.col("id").cast("string").alias("record_id"), price.alias("price"), F.lit(None).cast("string").alias("note"))


def test_equal_ranges_are_not_joined(spark):
    ours, theirs = orders(spark, 3000), orders(spark, 3000, (17, 2500)).unionByName(orders(spark, 1))
    levels = (2, 5, 10)
    names = ["price", "note"]
    digests = [reconcile.range_digests(side.repartition(k), "record_id", names, levels) for side, k in ((ours, 3), (theirs, 7))]
    found = {r[0] for r in reconcile.differing_ranges(*digests, levels).collect()}
    places = theirs.where("record_id IN ('17', '2500', '0')").select(reconcile.key_range("record_id", 10))
    assert found == {r[0] for r in places.collect()} and len(found) == 3
    diff = reconcile.hash_tree_diff(ours, theirs, levels=levels)
    assert rows_of(diff) == rows_of(reconcile.column_diff(ours, theirs)) == [("17", "price", 1), ("2500", "price", 1)]
    joined = [side.where(reconcile.key_range("record_id", 10).isin(*found)).count() for side in (ours, theirs)]
    assert max(joined) < 30  # of 3,000 rows


def test_digests_are_kept(spark, tmp_path):
    """With digests from before, rows of equal ranges need not be read: here they are gone."""
    ours, theirs = orders(spark, 500), orders(spark, 500, (3,))
    levels = (3, 8)
    kept = [reconcile.range_digests(side, "record_id", ["price", "note"], levels) for side in (ours, theirs)]
    part = F.col("record_id") == "3"
    diff = reconcile.hash_tree_diff(ours.where(part), theirs.where(part), levels=levels, our_digests=kept[0], their_digests=kept[1])
    assert rows_of(diff) == [("3", "price", 1)]


def test_hash_tree_on_odd_rows(spark):
    schema = "record_id string, price string, _meta string"
    ours = spark.createDataFrame([("a", None, "1"), ("b", "x", "2"), (None, "y", "3"), ("c", "1", "4"), ("c", "1", "5"), ("only", "z", "6")], schema)
    theirs = spark.createDataFrame([("a", None, "9"), ("b", None, "9"), (None, "q", "9"), ("c", "1", "9"), ("c", "2", "9"), ("other", "z", "9")], schema)
    assert rows_of(reconcile.hash_tree_diff(ours, theirs)) == rows_of(reconcile.column_diff(ours, theirs))
    assert reconcile.hash_tree_diff(ours, ours).count() == 0
    assert reconcile.hash_tree_diff(ours.limit(0), theirs).count() == 0 == reconcile.hash_tree_diff(ours, theirs.limit(0)).count()


def test_unique_over_deliveries(spark, tmp_path):
    schema = "n int, a string, b string"
    deliveries = [
        [(1, "x", None), (2, "x", "y"), (3, "x", "y"), (4, "z", "z")],
        [(5, "x", None), (6, "new", "w"), (7, None, "x")],
        [(8, "new", "w"), (9, "xn", "one"), (10, "x", "y")],
    ]
    path, checkpoint, ledger = str(tmp_path / "out"), str(tmp_path / "cp"), KeyLedger(str(tmp_path / "ledger"), 4)
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        unique_stream(stream, ["a", "b"], path, ledger, checkpoint, trigger=AVAILABLE).awaitTermination()
    got = {r["n"]: r["_unique"] for r in spark.read.parquet(path).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: False, 6: True, 7: True, 8: False, 9: True, 10: False}


def test_a_batch_that_runs_again_finds_the_same(spark, tmp_path):
    ledger = KeyLedger(str(tmp_path / "ledger"), 4)
    one, two = (spark.createDataFrame([(k,) for k in ks], "_key string") for ks in ("ab", "bc"))
    assert ledger.known(one, 0).count() == 0
    ledger.add(one, 0)
    for _ in range(2):
        assert rows_of(ledger.known(two, 1)) == [("b",)]
        ledger.add(two, 1)
    assert rows_of(ledger.known(one, 2)) == [("a",), ("b",)] and ledger.known(one, 0).count() == 0
