"""One query per operator over the given tables: key -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import functools
import warnings
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import DEPENDENCIES, MEMBER_MAPPING, ORDER_MAPPING, load, messages
from zoneflow.config import ZoneConfig
from zoneflow.functions.text import fingerprint
from zoneflow.operators import audit, dependency, ingest, quality, reconcile, windows
from zoneflow.operators.cdc import cdc_classify, raw_rows
from zoneflow.operators.fetch import affected_rows, bucketed_fetch, lookup_fetch, row_map, to_text_columns
from zoneflow.operators.limits import latest_per_key, limit_per_group, top_n
from zoneflow.operators.mapping import map_keys, map_schema
from zoneflow.operators.metrics import metric_rows, observe
from zoneflow.operators.notify import (
    attribute,
    dead_letters,
    dedup_messages,
    filter_table,
    parse_notifications,
)
from zoneflow.operators.quality import DQRule
from zoneflow.operators.skew import SkewPlan
from zoneflow.operators.structure import structure_cast
from zoneflow.plans.batch import run_batch
from zoneflow.plans.kpis import KpiStore
from zoneflow.plans.member import MEMBER_MEASURES, member_figures, member_kpis, refine_members
from zoneflow.plans.zones import (
    PIPELINE_LOG,
    QUALITY_LOG,
    RECONCILE_LOG,
    ZoneRun,
    changed_records,
    fetch_changes,
    run_zones,
)
from zoneflow.session import new_run_dir
from zoneflow.sinks import compaction
from zoneflow.sinks import tables as sink
from zoneflow.sources import snapshots
from zoneflow.sources.buckets import BUCKET, create_bucketed
from zoneflow.sources.notifications import from_kafka, read_messages, stream_messages, with_event_time
from zoneflow.sources.tables import SchemaRegistry, apply_schema, read_table
from zoneflow.streaming import panes as stream_panes
from zoneflow.streaming import state as stream_state
from zoneflow.streaming import unique as stream_unique_rows
from zoneflow.streaming import windows as stream_windows
from zoneflow.streaming.metrics import MetricWriter, observe_stream
from zoneflow.streaming.zones import zone_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- shared inputs

LINE_TYPES = {
    "order_id": "int64",
    "part_id": "INT64",
    "quantity": "float64",
    "price": "float64",
    "discount": "float64",
    "is_returned": "bool",
    "line_status": "text",
    "absent": "int64",
}
MEMBER_RULES = (DQRule("not_null", ("record_id", "email")),)
LINE_RULES = (
    DQRule("not_null", ("record_id", "return_flag")),
    DQRule("regex", ("part_id",), pattern="[0-9]+"),
    DQRule("range", ("quantity",), min=5, max=45),
    DQRule("unique", ("record_id",)),
    DQRule("cheap", expr="price IS NOT NULL AND discount <> '0.10'"),
)
MEMBER_CONFIG = ZoneConfig(
    domain="member",
    table="member",
    rules=MEMBER_RULES,
    structure={"balance": "float64", "nation_key": "int64"},
    compare_columns=("name", "email"),
    mapping_schemas={"member": MEMBER_MAPPING["users"]},
    reconcile_enabled=True,
    dependencies={"member": ["snapshot_previous_day"]},
)


def _micros(name: str) -> Column:
    """Microseconds of a zone-less timestamp, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {name})")


_topics: dict[tuple[str, str, str], str] = {}


def _topic(spark: SparkSession, sf: str, view: str = "notif") -> str:
    """Folder of message files made from all events, written once per session."""
    key = (spark.sparkContext.applicationId, sf, view)
    if key not in _topics:
        path = new_run_dir(spark, "topic")
        files = spark.sparkContext.defaultParallelism
        sink.write_table(messages(spark, sf, view).repartition(files), path)
        _topics[key] = path
    return _topics[key]


def _messages(spark: SparkSession, sf: str, view: str = "notif") -> DataFrame:
    return read_messages(spark, _topic(spark, sf, view))


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_notifications(_messages(spark, sf), "member")


def _fetched(spark: SparkSession, sf: str) -> DataFrame:
    return fetch_changes(_messages(spark, sf), load(spark, sf, "src_member"), MEMBER_CONFIG)


def _records(spark: SparkSession, sf: str, view: str = "notif") -> DataFrame:
    return changed_records(_messages(spark, sf, view), load(spark, sf, "src_member"), MEMBER_CONFIG)


def _legacy_members(spark: SparkSession, sf: str) -> DataFrame:
    return map_schema(load(spark, sf, "aws_member"), MEMBER_MAPPING, "users")


def _legacy_orders(spark: SparkSession, sf: str) -> DataFrame:
    return map_schema(load(spark, sf, "aws_order"), ORDER_MAPPING, "orders")


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "src_member").select("record_id", "name", "email")


# ---------------------------------------------------------------- sources and sinks


@query
def notification_source(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "messages")
    sink.write_json_lines(messages(spark, sf, "notif_dup"), path)
    return read_messages(spark, path, "json").select(
        attribute("message_id").alias("message_id"), attribute("table_name").alias("table_name"), "payload"
    )


@query
def dedup_notifications(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_messages(_messages(spark, sf, "notif_dup")).select(
        attribute("message_id").alias("message_id"), "payload"
    )


@query
def notification_bad_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads with a byte that is no UTF-8 before them go to the dead letters, the others go through."""
    rows = _messages(spark, sf)
    broken = F.concat(F.unhex(F.lit("FF")), F.col("payload").cast("binary"))
    third = F.length("payload") % 3 == 0
    mixed = rows.withColumn("payload", F.when(third, broken).otherwise(F.col("payload").cast("binary")))
    good = parse_notifications(mixed, "member").select("message_id", F.lit("parsed").alias("went"), "content")
    return good.unionByName(dead_letters(mixed, "member").select("message_id", F.lit("dead").alias("went"), "content"))


@query
def broker_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Headers that repeat, have no key or hold invalid bytes."""
    text = lambda c: F.col(c).cast("string").cast("binary")
    header = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    events = load(spark, sf, "events")
    headers = F.array(
        header("kind", text("event_type")),
        header(None, text("user_id")),
        header("kind", text("event_id")),
        header("raw", F.concat(text("user_id"), F.unhex(F.lit("C3")))),
    )
    records = events.select(headers.alias("headers"), text("event_type").alias("value"))
    return from_kafka(records).select(attribute("kind").alias("kind"), attribute("raw").alias("raw"), "payload")


@query
def event_time(spark: SparkSession, sf: str) -> DataFrame:
    return with_event_time(_messages(spark, sf)).select(
        attribute("message_id").alias("message_id"), F.unix_micros("event_ts").alias("event_us")
    )


@query
def table_read(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def zone_write_readback(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "orders_refined")
    sink.write_table(load(spark, sf, "src_order"), path, partition_by=["status"])
    return read_table(spark, path).select("record_id", "customer_id", "status", "total")


@query
def raw_append(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "member_raw")
    rows = raw_rows(_records(spark, sf))
    for batch_id in (0, 1, 1):  # the last one repeats batch 1 and must replace it
        sink.write_batch(rows, path, batch_id)
    return sink.read_batches(spark, path).select(
        F.col("_batch_id").cast("bigint").alias("batch_id"),
        F.col("_notif_message_id").alias("message_id"),
        "record_id",
        "email",
        F.col("_event_op").alias("event_op"),
        F.col("_table_name").alias("table_name"),
        F.col("_zone").alias("zone"),
    )


def _order_objects(spark: SparkSession, sf: str) -> str:
    path = new_run_dir(spark, "snapshot")
    sink.write_json_lines(load(spark, sf, "aws_order"), path)
    return path


@query
def snapshot_listing(spark: SparkSession, sf: str) -> DataFrame:
    """One object per status; the first two keys."""
    path = new_run_dir(spark, "snapshot")
    lines = load(spark, sf, "aws_order").select("state", F.to_json(F.struct("id", "amount")).alias("value"))
    lines.repartition("state").write.partitionBy("state").text(path)
    listed = snapshots.list_objects(spark, path, limit=2)
    return listed.select(F.regexp_extract("key", r"/(state=[^/]*)/[^/]*$", 1).alias("folder"))


def _changed_snapshot(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """One object per status; after the first listing those of orders under way are written anew. The path and the changes."""
    path, kept = new_run_dir(spark, "snapshot"), new_run_dir(spark, "listing")
    lines = load(spark, sf, "aws_order").select("state", F.to_json(F.struct("id", "amount")).alias("value"))
    lines.repartition("state").write.partitionBy("state").text(path)
    sink.write_table(snapshots.listing(spark, path), f"{kept}/first")
    replaced = lines.where("state = 'P'").repartition(1)
    replaced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("state").text(path)
    sink.write_table(snapshots.listing(spark, path), f"{kept}/second")
    first, second = (spark.read.parquet(f"{kept}/{n}") for n in ("first", "second"))
    sink.write_table(snapshots.listing_changes(first, second), f"{kept}/changes")
    return path, spark.read.parquet(f"{kept}/changes")


@query
def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    _, changes = _changed_snapshot(spark, sf)
    return changes.select(F.regexp_extract("key", r"/(state=[^/]*)/[^/]*$", 1).alias("folder"), "change")


@query
def snapshot_changed_rows(spark: SparkSession, sf: str) -> DataFrame:
    path, changes = _changed_snapshot(spark, sf)
    return snapshots.scan_changed(spark, path, changes, ["id", "amount"])


@query
def snapshot_binary_scan(spark: SparkSession, sf: str) -> DataFrame:
    objects = snapshots.read_objects(spark, _order_objects(spark, sf))
    lines = F.length(F.decode("content", "UTF-8")) - F.length(F.replace(F.decode("content", "UTF-8"), F.lit("\n"), F.lit("")))
    return objects.agg(F.sum(lines).cast("bigint").alias("n_lines"))


LEGACY_FIELDS = ("user_id", "user_name", "user_email")


def _member_lines(spark: SparkSession, sf: str) -> str:
    """Legacy members as lines, among lines that are no object: arrays (of objects too), scalars, null, broken ones."""
    path = new_run_dir(spark, "snapshot")
    rows = load(spark, sf, "aws_member")
    line = F.to_json(F.struct(*LEGACY_FIELDS))
    payload = load(spark, sf, "notif").where(~F.col("payload").startswith("{")).select("payload")
    more = rows.select(F.explode(F.array(F.concat(F.lit("["), line, F.lit(","), line, F.lit("]")), F.lit("null"), F.lit("7"), F.left(line, F.length(line) - 1))))
    sink.write_text(rows.select(line).toDF("value").union(payload).union(more), path)
    return path


@query
def snapshot_jsonl_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots.scan_jsonl(spark, _member_lines(spark, sf))
    return rows.select(*[F.try_element_at("row", F.lit(c)).alias(c) for c in LEGACY_FIELDS])


@query
def snapshot_typed_scan(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.scan_jsonl_columns(spark, _member_lines(spark, sf), LEGACY_FIELDS)


@query
def json_sink_readback(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "lines")
    lines = load(spark, sf, "src_line")
    sink.write_json_lines(lines, path)
    return spark.read.schema(lines.schema).json(path).select("record_id", "part_id", "quantity", "price", "is_returned")


def _audit_rows(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["_notif_message_id", "record_id"]
    return audit.audit_records(_records(spark, sf), "member", "raw", "member_framework", keys)


@query
def audit_records(spark: SparkSession, sf: str) -> DataFrame:
    return _audit_rows(spark, sf)


@query
def audit_json(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "audit-logs")
    sink.write_text(audit.to_audit_json(_audit_rows(spark, sf)), path)
    return spark.read.text(path)


# ---------------------------------------------------------------- projections


@query
def notification_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filter_table(_messages(spark, sf), "member").select(attribute("message_id").alias("message_id"), "payload")


@query
def parsed_notifications(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(
        "message_id",
        "event_type",
        "table_name",
        F.array_join("record_ids", ",").alias("ids"),
        F.unix_micros("event_ts").alias("event_us"),
        "content",
    )


@query
def notification_dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    return dead_letters(_messages(spark, sf), "member").select("message_id", "event_type", "content")


@query
def row_to_string_map(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "src_member")
    return rows.select("record_id", F.explode(row_map(rows.columns)).alias("column_name", "column_value"))


@query
def classified_changes(spark: SparkSession, sf: str) -> DataFrame:
    return cdc_classify(_fetched(spark, sf)).select(
        F.col("_notif_message_id").alias("message_id"),
        "record_id",
        F.col("_event_op").alias("event_op"),
        F.col("_table_name").alias("table_name"),
        F.col("_zone").alias("zone"),
    )


@query
def typed_lines(spark: SparkSession, sf: str) -> DataFrame:
    typed = structure_cast(load(spark, sf, "src_line"), LINE_TYPES, "quarantine")
    return typed.select(
        "record_id",
        "order_id",
        "part_id",
        "quantity",
        "price",
        "is_returned",
        "line_status",
        F.array_join("_cast_failed", ",").alias("cast_failed"),
    )


@query
def schema_map(spark: SparkSession, sf: str) -> DataFrame:
    return _legacy_orders(spark, sf)


@query
def schema_registry_apply(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf}/orders.parquet"
    schema = SchemaRegistry(spark).get_schema(path)
    return apply_schema(to_text_columns(read_table(spark, path)), schema)


@query
def row_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "src_line")
    return lines.select("record_id", fingerprint([F.col(c) for c in lines.columns]).alias("fingerprint"))


def _refined(spark: SparkSession, sf: str) -> DataFrame:
    dims = [load(spark, sf, t) for t in ("nation", "region", "orders")]
    return refine_members(cdc_classify(load(spark, sf, "src_member"), table="member"), *dims)


@query
def refined_member(spark: SparkSession, sf: str) -> DataFrame:
    return _refined(spark, sf).select(
        "record_id",
        "nation_name",
        "region_name",
        "email_domain",
        F.col("balance_value").cast("double").alias("balance_value"),
        "is_active",
        "n_orders",
        F.col("order_total").cast("double").alias("order_total"),
    )


@query
def analytics_member(spark: SparkSession, sf: str) -> DataFrame:
    return member_kpis(_refined(spark, sf))


@query
def analytics_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The figures kept through three deltas that correct every member, without computing them anew."""
    path = new_run_dir(spark, "refined")
    sink.write_table(_refined(spark, sf), path)
    now = spark.read.parquet(path)
    third = F.pmod(F.crc32("record_id"), F.lit(3))
    # before the deltas: other regions and balances, and no member of the last third
    before = now.where(third < 2).withColumns(
        {
            "region_name": F.when(F.col("n_orders") > 5, F.lit("ELSEWHERE")).otherwise(F.col("region_name")),
            "balance_value": F.when(F.col("is_active"), F.col("balance_value") + 1).cast(now.schema["balance_value"].dataType),
            "is_active": ~F.col("is_active"),
        }
    )
    store = KpiStore(spark, new_run_dir(spark, "kpis"), MEMBER_MEASURES)
    store.start(before, "record_id", buckets=32)
    for number in (1, 2, 3):
        store.apply(now.where(third == number - 1), number)
    return member_figures(store)


# ---------------------------------------------------------------- joins


@query
def fetched_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _fetched(spark, sf).select(
        F.col("_notif_message_id").alias("message_id"),
        F.col("_notif_event_type").alias("event_type"),
        "record_id",
        "name",
        "email",
        "balance",
    )


SPLIT = SkewPlan(factor=0.0, min_rows=2)  # every repeated key is split


@query
def fetched_rows_split(spark: SparkSession, sf: str) -> DataFrame:
    fetched = lookup_fetch(_parsed(spark, sf), load(spark, sf, "src_member"), skew=SPLIT)
    return fetched.select(
        F.col("_notif_message_id").alias("message_id"),
        F.col("_notif_event_type").alias("event_type"),
        "record_id",
        "name",
        "email",
        "balance",
    )


@query
def fetched_rows_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """From a table kept by key bucket: only the buckets of the ids that are named are read."""
    table = create_bucketed(load(spark, sf, "src_member"), new_run_dir(spark, "members"), "record_id", buckets=64)
    return bucketed_fetch(_parsed(spark, sf), table).select(
        F.col("_notif_message_id").alias("message_id"),
        F.col("_notif_event_type").alias("event_type"),
        "record_id",
        "name",
        "email",
        "balance",
    )


@query
def native_key_fetch_pruned(spark: SparkSession, sf: str) -> DataFrame:
    table = create_bucketed(load(spark, sf, "orders"), new_run_dir(spark, "orders"), "o_custkey", buckets=64)
    return bucketed_fetch(_parsed(spark, sf), table).select(
        F.col("_notif_message_id").alias("message_id"), F.col("_record_id").alias("record_id"), "o_orderkey", "o_totalprice"
    )


@query
def lookup_semi(spark: SparkSession, sf: str) -> DataFrame:
    return affected_rows(_parsed(spark, sf), load(spark, sf, "src_member")).select("record_id", "name", "email")


@query
def native_key_fetch(spark: SparkSession, sf: str) -> DataFrame:
    return lookup_fetch(_parsed(spark, sf), load(spark, sf, "orders"), "o_custkey").select(
        F.col("_notif_message_id").alias("message_id"), F.col("_record_id").alias("record_id"), "o_orderkey", "o_totalprice"
    )


# ---------------------------------------------------------------- reconciliation


@query
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    matched = reconcile.match_counts(
        _fetched(spark, sf), _legacy_members(spark, sf), spread_by=F.col("_notif_message_id")
    )
    return matched.select(
        F.col("_notif_message_id").alias("message_id"), "record_id", "gcp_count", "aws_count", "count_match"
    )


@query
def reconcile_diff(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.column_diff(_members(spark, sf), _legacy_members(spark, sf))


@query
def reconcile_diff_split(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.column_diff(_members(spark, sf), _legacy_members(spark, sf), skew=SPLIT)


@query
def reconcile_diff_orders(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.column_diff(load(spark, sf, "src_order"), _legacy_orders(spark, sf))


@query
def reconcile_hash_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Only key ranges whose digests differ are joined."""
    return reconcile.hash_tree_diff(load(spark, sf, "src_order"), _legacy_orders(spark, sf))


@query
def reconcile_map_diff(spark: SparkSession, sf: str) -> DataFrame:
    ours = load(spark, sf, "src_member")
    theirs = load(spark, sf, "aws_member")
    renamed = map_keys(row_map(theirs.columns), MEMBER_MAPPING["users"])
    return reconcile.map_column_diff(
        ours.select("record_id", row_map(ours.columns).alias("row")),
        theirs.select(F.col("user_id").alias("record_id"), renamed.alias("row")),
    )


@query
def reconcile_variant_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Lines on both sides hold only what is not null, legacy ones at times a key more; no column is declared."""
    paths = [new_run_dir(spark, name) for name in ("ours", "theirs")]
    tier = F.when(F.col("user_id").endswith("3"), F.lit("gold"))
    sides = (load(spark, sf, "src_member"), load(spark, sf, "aws_member").withColumn("loyalty tier", tier))
    for path, rows in zip(paths, sides, strict=True):
        sink.write_text(rows.select(F.to_json(F.struct("*")).alias("value")), path)
    lines = [snapshots.scan_variant(spark, path) for path in paths]
    return reconcile.variant_column_diff(*lines, renames=MEMBER_MAPPING["users"])


@query
def mismatch_samples(spark: SparkSession, sf: str) -> DataFrame:
    diffs = reconcile.column_diff(load(spark, sf, "src_order"), _legacy_orders(spark, sf))
    sampled = reconcile.mismatch_samples(diffs.withColumn("kind", F.col("columns")), ["kind"])
    return sampled.select("kind", F.array_join("mismatch_samples.record_id", ",").alias("record_ids"))


@query
def reconcile_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.presence(load(spark, sf, "src_order"), _legacy_orders(spark, sf))


@query
def reconcile_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.totals(reconcile.variant_counts(load(spark, sf, "src_order"), _legacy_orders(spark, sf)))


@query
def reconcile_log(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "member_raw")
    sink.write_table(_fetched(spark, sf), path)
    start, end = windows.window_bounds(F.col("_notif_event_ts"), 3600)
    records = read_table(spark, path).withColumns({"window_start": start, "window_end": end})
    legacy = _legacy_members(spark, sf)
    bounds = ["window_start", "window_end"]
    tags = {"zone": F.lit("raw"), "table_name": F.lit("member")}
    counts = reconcile.variant_counts(records, legacy, carry=bounds).withColumns(tags)
    diffs = reconcile.column_diff(records, legacy, columns=["name", "email"], carry=bounds).withColumns(tags)
    groups = {n: F.col(n) for n in ("zone", "table_name", *bounds)}
    sample = F.transform("mismatch_samples", lambda s: F.concat(s["record_id"], F.lit(":"), s["columns"]))
    return reconcile.reconcile_log(counts, diffs, groups, "member").select(
        "domain",
        "zone",
        "table_name",
        F.unix_micros("window_start").alias("window_start_us"),
        F.unix_micros("window_end").alias("window_end_us"),
        "gcp_count",
        "aws_count",
        "count_match",
        F.array_join(sample, ";").alias("samples"),
    )


# ---------------------------------------------------------------- audit and metrics


@query
def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.with_flags(_records(spark, sf), MEMBER_RULES)
    start, end = windows.window_bounds(F.col("_notif_event_ts"))
    counts = audit.stage_counts(flagged, F.lit("raw"), {"window_start": start, "window_end": end})
    return audit.audit_log(counts, "member", "member_framework", ["window_start"]).select(
        "pipeline_name",
        "domain",
        "zone",
        "table_name",
        "status",
        F.unix_micros("window_start").alias("window_start_us"),
        "metrics",
    )


@query
def dq_log(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.with_flags(load(spark, sf, "src_line"), LINE_RULES)
    return audit.dq_log(flagged, LINE_RULES, "sales", F.lit("raw"), "line").drop("quality_id")


@query
def metrics(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem")
    return metric_rows(
        lines,
        "sales_line",
        {
            "rows": F.count(F.lit(1)),
            "returned": F.count_if(F.col("l_returnflag") == "R"),
            "quantity": F.sum(F.col("l_quantity").cast("decimal(18,2)")),
            "max_price": F.max("l_extendedprice"),
        },
    )


@query
def metrics_of_write(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "observed")
    rows, observation = observe(
        load(spark, sf, "src_order"), "orders", {"rows": F.count(F.lit(1)), "open": F.count_if(F.col("status") == "O")}
    )
    sink.write_table(rows, path)
    return spark.createDataFrame(
        [(name, float(value)) for name, value in observation.get.items()], "name string, value double"
    )


# ---------------------------------------------------------------- limits


@query
def latest_change(spark: SparkSession, sf: str) -> DataFrame:
    log = load(spark, sf, "cdc_log")
    return latest_per_key(log, ["record_id"], ["change_ts", "seq"]).select("record_id", "seq", "op", "amount")


@query
def limit_by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey"]
    return limit_per_group(lines, ["l_suppkey"], order, 5)


@query
def top_keys(spark: SparkSession, sf: str) -> DataFrame:
    return top_n(load(spark, sf, "src_order").select("record_id", "total"), ["record_id"], 64)


# ---------------------------------------------------------------- windows


@query
def tumbling_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = windows.tumbling(load(spark, sf, "events"), "ts", "1 second")
    return counted.select(_micros("window_start").alias("window_start_us"), "n")


@query
def sliding_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = windows.sliding_counts(load(spark, sf, "events"), "ts", 60, 20)
    return counted.select(_micros("window_start").alias("window_start_us"), _micros("window_end").alias("window_end_us"), "n")


# ---------------------------------------------------------------- data quality


def _outcome(df: DataFrame, rule: DQRule, key: str = "record_id") -> DataFrame:
    flagged = quality.with_flags(df, [rule])
    return flagged.select(F.col(key).alias("record_id"), (F.size("_dq_failed") == 0).alias("passed"))


@query
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "src_member"), MEMBER_RULES[0])


@query
def dq_not_null_missing_column(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "src_member"), DQRule("not_null", ("record_id", "phone")))


@query
def dq_regex(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "src_line"), LINE_RULES[1])


@query
def dq_valid_email(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "src_member"), DQRule("valid_email", ("email",)))


@query
def dq_range(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "src_line"), LINE_RULES[2])


@query
def dq_range_member(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "src_member"), DQRule("range", ("balance",), min=0, max=5000))


@query
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "src_line"), LINE_RULES[3])


@query
def dq_unique_split(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.with_flags(load(spark, sf, "src_line"), [LINE_RULES[3]], SPLIT)
    return flagged.select("record_id", (F.size("_dq_failed") == 0).alias("passed"))


@query
def dq_unique_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "aws_member"), DQRule("unique", ("user_id",)), "user_id")


@query
def dq_unknown_rule(spark: SparkSession, sf: str) -> DataFrame:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return _outcome(load(spark, sf, "src_member"), DQRule("no_such_rule", ("email",)))


@query
def dq_custom_expr(spark: SparkSession, sf: str) -> DataFrame:
    return _outcome(load(spark, sf, "src_line"), LINE_RULES[4])


@query
def dq_pass(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dq_pass(load(spark, sf, "src_line"), LINE_RULES).select("record_id", "part_id", "quantity", "price")


@query
def dq_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.with_flags(load(spark, sf, "src_line"), LINE_RULES)
    return quality.quarantined(flagged).select(
        "record_id", "part_id", "quantity", F.array_join("_dq_failed", ";").alias("failed")
    )


# ---------------------------------------------------------------- ingestion

CUTOFF = "TIMESTAMP_NTZ'2024-01-16 00:00:00'"
REPLAY = "TIMESTAMP_NTZ'2024-01-10 00:00:00'"


@query
def ingest_full(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.ingest_full(load(spark, sf, "src_member"), _messages(spark, sf), "member").select("record_id", "name")


@query
def ingest_full_not_notified(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "src_line")
    members = load(spark, sf, "src_member").select("record_id", "name")
    unnamed = ingest.ingest_full(lines.select("record_id", F.col("line_status").alias("name")), _messages(spark, sf), "line")
    return ingest.ingest_full(members, _messages(spark, sf), "member").unionByName(unnamed)


def _since_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    log = load(spark, sf, "cdc_log")
    path = new_run_dir(spark, "high_water_mark")
    seen = log.where(F.expr(f"change_ts < {CUTOFF}"))
    sink.write_table(ingest.high_water_mark(seen), path)
    return ingest.ingest_incremental(log, spark.read.parquet(path))


@query
def ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _since_cutoff(spark, sf).select("record_id", "seq", "op", "amount")


@query
def ingest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    log = load(spark, sf, "cdc_log")
    order = ["change_ts", "seq"]
    path = new_run_dir(spark, "upsert_target")
    first = ingest.ingest_upsert(log.where(F.expr(f"change_ts < {CUTOFF}")), None, ["record_id"], order)
    sink.write_table(first, path)
    replayed = log.where(F.expr(f"change_ts >= {REPLAY}"))
    return ingest.ingest_upsert(replayed, spark.read.parquet(path), ["record_id"], order).select(
        "record_id", "seq", "op", "amount", F.col("_is_deleted").alias("is_deleted")
    )


@query
def ingest_upsert_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """In place: a delta reads and replaces only the key buckets it touches."""
    log = load(spark, sf, "cdc_log")
    order = ["change_ts", "seq"]
    first = ingest.ingest_upsert(log.where(F.expr(f"change_ts < {CUTOFF}")), None, ["record_id"], order)
    table = create_bucketed(first, new_run_dir(spark, "upsert_buckets"), "record_id", buckets=64)
    ingest.upsert_buckets(log.where(F.expr(f"change_ts >= {REPLAY}")), table, order)
    rows = table.read(spark).drop(BUCKET)
    return rows.select("record_id", "seq", "op", "amount", F.col("_is_deleted").alias("is_deleted"))


@query
def ingest_transform_structure(spark: SparkSession, sf: str) -> DataFrame:
    enrich = {"net": F.col("price") * (F.lit(1.0) - F.col("discount"))}
    typed = ingest.ingest_transform_structure(load(spark, sf, "src_line"), LINE_TYPES, "null", enrich)
    return typed.select("record_id", "part_id", "quantity", "price", "discount", "net")


def _source(spark: SparkSession, sf: str) -> ingest.Source:
    return ingest.Source(
        "member",
        rows=load(spark, sf, "src_line"),
        messages=_messages(spark, sf),
        changes=load(spark, sf, "cdc_log"),
        mapping=LINE_TYPES,
        structure_mode="null",
    )


@query
def ingest_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    store = ingest.MarkStore(spark, new_run_dir(spark, "marks"))
    source = _source(spark, sf)
    store.advance("member", source.changes.where(F.expr(f"change_ts < {CUTOFF}")))
    store.advance("other", source.changes)
    return ingest.ingest(None, source, store.read("member")).select("record_id", "seq", "op", "amount")


@query
def ingest_dispatch_full(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.ingest("FullDump", _source(spark, sf)).select("record_id", "part_id", "quantity")


@query
def ingest_dispatch_transform_structure(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.ingest("transform_structure", _source(spark, sf)).select("record_id", "part_id", "quantity", "price")


@query
def ingest_dispatch_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs by the mark: the second applies only what came after the first."""
    store, source = ingest.MarkStore(spark, new_run_dir(spark, "marks")), _source(spark, sf)
    path = new_run_dir(spark, "upsert_target")
    early = replace(source, changes=source.changes.where(F.expr(f"change_ts < {CUTOFF}")))
    sink.write_table(ingest.ingest("upsert", early, store.read("member")), path)
    store.advance("member", early.changes)
    late = replace(source, target=spark.read.parquet(path))
    return ingest.ingest("upsert", late, store.read("member")).select(
        "record_id", "seq", "op", "amount", F.col("_is_deleted").alias("is_deleted")
    )


# ---------------------------------------------------------------- dependencies


def _wanted_runs(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(t) for t in DEPENDENCIES])
    days = load(spark, sf, "events").select(F.to_date("ts").alias("run_date")).distinct()
    return days.withColumn("table_name", F.explode(names))


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.select(
        "table_name",
        F.col("run_date").cast("string").alias("run_date"),
        "condition",
        "requires",
        F.col("required_date").cast("string").alias("required_date"),
    )


@query
def dependency_unmet(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(dependency.unmet(_wanted_runs(spark, sf), DEPENDENCIES, load(spark, sf, "run_log")))


@query
def dependency_prev_day(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(dependency.met(_wanted_runs(spark, sf), DEPENDENCIES, load(spark, sf, "run_log")))


CHAIN = {
    "users": ["snapshot_previous_day"],
    "orders": ["snapshot_previous_day", {"condition": "snapshot_previous_day", "requires": "users"}],
    "refined_orders": [{"condition": "same_day", "requires": "orders"}, {"condition": "snapshot_previous_day", "requires": "users"}],
    "report": [{"condition": "same_day", "requires": "refined_orders"}, {"condition": "same_day", "requires": "orders"}],
}


@query
def dependency_chain(spark: SparkSession, sf: str) -> DataFrame:
    """What the reports of all days wait for, over several tables and days."""
    days = load(spark, sf, "events").select(F.to_date("ts").alias("run_date")).distinct()
    wanted = days.withColumn("table_name", F.lit("report"))
    chain = dependency.unmet_chain(wanted, CHAIN, load(spark, sf, "run_log"))
    return chain.withColumns({c: F.col(c).cast("string") for c in ("run_date", "required_date")})


@query
def dependency_gate(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("event_type") == "view", "users").when(F.col("event_type") == "click", "refined_orders")
    dated = F.when(F.col("event_id") % 50 != 0, F.to_date("ts"))
    rows = load(spark, sf, "events").select("event_id", "value", name.otherwise("orders").alias("table_name"), dated.alias("run_date"))
    return dependency.gate(rows, DEPENDENCIES, load(spark, sf, "run_log")).select("event_id", "value", "table_name")


# ---------------------------------------------------------------- zone runs


def _run_member_zones(spark: SparkSession, sf: str) -> ZoneRun:
    path = new_run_dir(spark, "legacy")
    sink.write_table(_legacy_members(spark, sf), path)
    legacy = spark.read.parquet(path)
    return run_zones(
        _records(spark, sf, "notif_dup"),
        MEMBER_CONFIG,
        new_run_dir(spark, "zones"),
        batch_id=0,
        snapshots={zone: legacy for zone in ("raw", "structure", "refined", "analytics")},
    )


def _zone_output(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("_notif_message_id").alias("message_id"),
        "record_id",
        "email",
        "balance",
        "nation_key",
        F.col("_event_op").alias("event_op"),
        F.col("_zone").alias("zone"),
    )


@query
def zone_chain(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_output(_run_member_zones(spark, sf).zone("analytics"))


@query
def zone_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rows = _run_member_zones(spark, sf).quarantine("raw")
    return rows.select(
        F.col("_notif_message_id").alias("message_id"), "record_id", F.array_join("_dq_failed", ";").alias("failed")
    )


@query
def zone_cast_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """What could not be cast is named beside the row in the structure zone."""
    rows = _run_member_zones(spark, sf).written["structure"]
    return rows.where(F.size("_cast_failed") > 0).select(
        F.col("_notif_message_id").alias("message_id"), "record_id", F.array_join("_cast_failed", ";").alias("failed")
    )


@query
def log_tables(spark: SparkSession, sf: str) -> DataFrame:
    run = _run_member_zones(spark, sf)
    logs = {name: spark.read.parquet(MEMBER_CONFIG.log_path(run.root, name)) for name in (PIPELINE_LOG, QUALITY_LOG, RECONCILE_LOG)}
    counts = F.concat_ws("/", "gcp_count", "aws_count", "count_match", F.size("mismatch_samples"))
    parts = [
        logs[PIPELINE_LOG].select("zone", "table_name", F.concat_ws(" ", "status", "metrics").alias("content")),
        logs[QUALITY_LOG].select("zone", "table_name", F.concat_ws(" ", "rule_name", "passed", "details").alias("content")),
        logs[RECONCILE_LOG].select("zone", "table_name", counts.alias("content")),
    ]
    return functools.reduce(
        DataFrame.unionByName, [p.withColumn("log", F.lit(n)) for n, p in zip(logs, parts, strict=True)]
    )


@query
def log_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows of five batches: three compacted and their folders removed, one compacted and kept, one not compacted."""
    path = new_run_dir(spark, "log")
    keys = ["_notif_message_id", "record_id"]
    for batch in range(5):
        records = _records(spark, sf).where(F.substring("_notif_message_id", 2, 20).cast("bigint") % 5 == batch)
        rows = audit.audit_records(records, "member", "raw", "member_framework", keys)
        sink.write_log(rows, path, f"run-{batch}")
        if batch in (2, 3):
            compaction.compact_log(spark, path)
        if batch == 2:
            compaction.remove_compacted(spark, path)
    rows = compaction.read_log(spark, path)
    return rows.select("log_id", "pipeline_name", "domain", "zone", "table_name", "status", F.col("_batch_id").alias("batch_id"))


def _member_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf, "notif_dup").withColumns(
        {
            "table_name": F.lit("member"),
            "run_date": F.to_date("_notif_event_ts"),
            "_seq": F.substring("_notif_message_id", 2, 20).cast("bigint"),
        }
    )


def _run_member_batch(
    spark: SparkSession, sf: str, root: str, run_id: str = "run-1", changes: DataFrame | None = None
) -> dict[str, DataFrame]:
    rows = _member_changes(spark, sf) if changes is None else changes
    source = ingest.Source("member", changes=rows, change_ts="_notif_event_ts", seq="_seq")
    cfg = MEMBER_CONFIG
    done = load(spark, sf, "run_log").where("table_name = 'users'").withColumn("table_name", F.lit("member"))
    dims = [load(spark, sf, t) for t in ("nation", "region", "orders")]
    hooks = {"refined": lambda df: refine_members(df, *dims), "analytics": member_kpis}
    return run_batch(spark, cfg, source, done, root, run_id, _legacy_members(spark, sf), hooks)


@query
def batch_zone_run(spark: SparkSession, sf: str) -> DataFrame:
    return _run_member_batch(spark, sf, new_run_dir(spark, "batch"))["analytics"]


MIDDLE_DAY = "2024-01-16 00:00:00"


@query
def batch_incremental_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Changes are dated by the day only. The second run takes in what the first had not seen, the later half of the
    changes at the very time of the mark included."""
    root = new_run_dir(spark, "batch")
    path = new_run_dir(spark, "changes")
    sink.write_table(_member_changes(spark, sf), path)
    rows = spark.read.parquet(path)
    daily = rows.withColumn("_notif_event_ts", F.date_trunc("day", F.col("_notif_event_ts")))
    middle = F.lit(MIDDLE_DAY).cast("timestamp")
    numbers = daily.where(F.col("_notif_event_ts") == middle).agg(F.avg("_seq")).scalar()
    early = daily.where((F.col("_notif_event_ts") < middle) | ((F.col("_notif_event_ts") == middle) & (F.col("_seq") <= numbers)))
    _run_member_batch(spark, sf, root, "run-1", early)
    _run_member_batch(spark, sf, root, "run-2", daily)
    second = spark.read.parquet(f"{root}/_staged/member/run-2")
    return second.select(F.col("_notif_message_id").alias("message_id"), "record_id")


@query
def run_complete(spark: SparkSession, sf: str) -> DataFrame:
    root = new_run_dir(spark, "batch")
    _run_member_batch(spark, sf, root)
    event = spark.read.text(f"{root}/audit-logs/run-1")
    names = ("event", "domain", "ingestionType", "rows")
    return event.select(*[F.get_json_object("value", f"$.{n}").alias(n) for n in names])


# ---------------------------------------------------------------- streams

FIRST = "event_ts < '2024-01-11 00:00:00'"
SECOND = "event_ts >= '2024-01-11 00:00:00' AND event_ts < '2024-01-21 00:00:00'"
THIRD = "event_ts >= '2024-01-21 00:00:00'"


def _arrivals(spark: SparkSession, sf: str, deliveries: list[str], run: Callable[[DataFrame], object]) -> None:
    """Deliver all events part by part and let the query take in each part before the next.

    The query starts again from its checkpoint for every part.
    """
    path = new_run_dir(spark, "arrivals")
    rows = load(spark, sf, "events").withColumn("event_ts", F.col("ts").cast("timestamp")).drop("ts")
    for condition in deliveries:
        sink.write_table(rows.where(condition), path, mode="append")
        stream = spark.readStream.schema(rows.schema).parquet(path)
        run(stream).awaitTermination()


def _watermarked(stream: DataFrame) -> DataFrame:
    return stream.withWatermark("event_ts", windows.ALLOWED_LATENESS)


def _window_output(df: DataFrame) -> DataFrame:
    start = F.col("window_start").cast("timestamp_ntz").cast("string").alias("window_start")
    return df.select(start, "event_type", "n")


@query
def stream_windowed_append(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_run_dir(spark, "append"), new_run_dir(spark, "checkpoint")
    _arrivals(
        spark,
        sf,
        [FIRST, SECOND, THIRD],
        lambda s: stream_windows.windowed_append(
            _watermarked(s), path, checkpoint, size="1 hour", groups=["event_type"], trigger=stream_windows.AVAILABLE
        ),
    )
    return _window_output(spark.read.parquet(path))


@query
def stream_sliding_append(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_run_dir(spark, "sliding"), new_run_dir(spark, "checkpoint")
    _arrivals(
        spark,
        sf,
        [FIRST, SECOND, THIRD],
        lambda s: stream_windows.sliding_append(
            _watermarked(s), path, checkpoint, 3600, 1200, groups=["event_type"], trigger=stream_windows.AVAILABLE
        ),
    )
    return _window_output(spark.read.parquet(path))


@query
def stream_early_update(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_run_dir(spark, "update"), new_run_dir(spark, "checkpoint")
    _arrivals(
        spark,
        sf,
        [FIRST, SECOND, THIRD],
        lambda s: stream_windows.early_update(
            _watermarked(s), path, checkpoint, size="1 hour", groups=["event_type"], trigger=stream_windows.AVAILABLE
        ),
    )
    return _window_output(stream_windows.newest_panes(sink.read_batches(spark, path), ["event_type"]))


@query
def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """One set of rows for each micro-batch, written by a listener while the stream runs."""
    path, checkpoint, figures = (new_run_dir(spark, n) for n in ("observed", "checkpoint", "figures"))
    measures = {
        "rows": F.count(F.lit(1)),
        "errors": F.count_if(F.col("event_type") == "error"),
        "max_value": F.max("value"),
    }
    with MetricWriter(spark, "events", figures) as writer:

        def run(stream: DataFrame):
            observed = observe_stream(stream, "events", measures)
            running = observed.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            running = running.trigger(**stream_windows.AVAILABLE).start(path)
            writer.wait(running)
            return running

        _arrivals(spark, sf, [FIRST, SECOND, THIRD], run)
    return sink.read_batches(spark, figures).select("pipeline_id", "batch_id", "name", "value")


@query
def late_data_filter(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_run_dir(spark, "late"), new_run_dir(spark, "checkpoint")
    late = f"{FIRST} AND event_type = 'error'"
    on_time = f"{FIRST} AND event_type <> 'error'"
    _arrivals(
        spark,
        sf,
        [on_time, SECOND, late, THIRD],
        lambda s: stream_windows.windowed_append(
            _watermarked(s), path, checkpoint, size="1 hour", groups=["event_type"], trigger=stream_windows.AVAILABLE
        ),
    )
    return _window_output(spark.read.parquet(path))


@query
def stream_discarding_panes(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_run_dir(spark, "panes"), new_run_dir(spark, "checkpoint")
    late = f"{FIRST} AND event_type = 'error'"
    on_time = f"{FIRST} AND event_type <> 'error'"
    _arrivals(
        spark,
        sf,
        [on_time, SECOND, late, THIRD],
        lambda s: stream_windows.discarding_panes(
            s, path, checkpoint, size="1 day", trigger=stream_windows.AVAILABLE
        ),
    )
    start = F.col("window_start").cast("timestamp_ntz").cast("string").alias("window_start")
    return sink.read_batches(spark, path).select(F.col("_batch_id").cast("bigint").alias("batch_id"), start, "n")


def _panes(spark: SparkSession, sf: str, early: str) -> DataFrame:
    """Windows of a day that stay open for three more; late errors and views come after the second part."""
    path, checkpoint = new_run_dir(spark, "panes"), new_run_dir(spark, "checkpoint")
    late = f"{FIRST} AND event_type = 'error'"
    on_time = f"{FIRST} AND event_type <> 'error'"
    older = "event_ts >= '2024-01-16 00:00:00' AND event_ts < '2024-01-21 00:00:00' AND event_type = 'view' AND hour(event_ts) >= 12"
    second = f"{SECOND} AND NOT ({older})"
    _arrivals(
        spark,
        sf,
        [on_time, second, f"({late}) OR ({older})", THIRD],
        lambda s: stream_panes.pane_stream(
            s, path, checkpoint, size="1 day", groups=["event_type"], early=early, lateness="3 days", trigger=stream_windows.AVAILABLE
        ),
    )
    start = F.col("window_start").cast("timestamp_ntz").cast("string").alias("window_start")
    return sink.read_batches(spark, path).select(start, "event_type", "pane", "number", "n")


@query
def stream_panes_early(spark: SparkSession, sf: str) -> DataFrame:
    """Every part makes an early pane."""
    return _panes(spark, sf, "0 seconds")


@query
def stream_panes_on_time(spark: SparkSession, sf: str) -> DataFrame:
    """Early panes never come due."""
    return _panes(spark, sf, "10000 days")


@query
def stream_state_last_op(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_run_dir(spark, "state"), new_run_dir(spark, "checkpoint")
    _arrivals(
        spark,
        sf,
        [SECOND, FIRST, THIRD],
        lambda s: stream_state.last_change(
            s, path, checkpoint, "user_id", ["event_ts", "event_id"], ["event_type"], trigger=stream_windows.AVAILABLE
        ),
    )
    return stream_state.newest_state(sink.read_batches(spark, path), "user_id").select("user_id", "event_id", "event_type")


STATE_ORDER = ["event_ts", "event_id"]


@query
def stream_state_table(spark: SparkSession, sf: str) -> DataFrame:
    """The state itself, read from the checkpoint."""
    path, checkpoint = new_run_dir(spark, "state"), new_run_dir(spark, "checkpoint")
    _arrivals(
        spark,
        sf,
        [SECOND, FIRST, THIRD],
        lambda s: stream_state.last_change(s, path, checkpoint, "user_id", STATE_ORDER, ["event_type"], trigger=stream_windows.AVAILABLE),
    )
    return stream_state.read_last_change(spark, checkpoint, "user_id").select("user_id", "event_id", "event_type")


@query
def stream_state_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A query with another output, on a checkpoint of its own, goes on from the state of the one before."""
    old, old_checkpoint = new_run_dir(spark, "state"), new_run_dir(spark, "checkpoint")
    new, new_checkpoint, begin = (new_run_dir(spark, n) for n in ("state", "checkpoint", "state-kept"))
    _arrivals(
        spark,
        sf,
        [SECOND, FIRST],
        lambda s: stream_state.last_change(s, old, old_checkpoint, "user_id", STATE_ORDER, ["event_type"], trigger=stream_windows.AVAILABLE),
    )
    kept = stream_state.read_last_change(spark, old_checkpoint, "user_id")

    def go_on(stream: DataFrame) -> object:
        rows = stream.select("user_id", *STATE_ORDER, "event_type")
        return stream_state.last_change(
            stream_state.beginning_with(rows, kept, begin),
            new,
            new_checkpoint,
            "user_id",
            STATE_ORDER,
            ["event_type"],
            trigger=stream_windows.AVAILABLE,
            output=lambda df: df.select("user_id", "event_id", F.upper("event_type").alias("kind")),
        )

    _arrivals(spark, sf, [THIRD], go_on)
    return stream_state.newest_state(sink.read_batches(spark, new), "user_id").select("user_id", "event_id", "kind")


@query
def stream_unique(spark: SparkSession, sf: str) -> DataFrame:
    """The uniqueness rule over three deliveries: a user that came before fails in every later one."""
    path, checkpoint = new_run_dir(spark, "unique"), new_run_dir(spark, "checkpoint")
    ledger = stream_unique_rows.KeyLedger(new_run_dir(spark, "key-ledger"), buckets=16)
    _arrivals(
        spark,
        sf,
        [FIRST, SECOND, THIRD],
        lambda s: stream_unique_rows.unique_stream(s, ["user_id", "event_type"], path, ledger, checkpoint, trigger=stream_windows.AVAILABLE),
    )
    return sink.read_batches(spark, path).select("event_id", F.col("_unique").alias("is_unique"))


@query
def stream_zone_chain_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The zone chain on a stream whose source table is kept by key bucket."""
    root, checkpoint = new_run_dir(spark, "zones"), new_run_dir(spark, "checkpoint")
    table = create_bucketed(load(spark, sf, "src_member"), new_run_dir(spark, "members"), "record_id", buckets=64)
    zone_stream(
        stream_messages(spark, _topic(spark, sf, "notif_dup")),
        lambda: table,
        MEMBER_CONFIG,
        root,
        checkpoint,
        snapshots={"raw": _legacy_members(spark, sf)},
        trigger=stream_windows.AVAILABLE,
    ).awaitTermination()
    return _zone_output(quality.passed(sink.read_batches(spark, MEMBER_CONFIG.table_path(root, "analytics"))))


@query
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = new_run_dir(spark, "dedup"), new_run_dir(spark, "checkpoint")
    stream = with_event_time(stream_messages(spark, _topic(spark, sf, "notif_dup")))
    stream_state.dedup_stream(stream, path, checkpoint, stream_windows.AVAILABLE).awaitTermination()
    return spark.read.parquet(path).select(attribute("message_id").alias("message_id"), "payload")


@query
def stream_zone_chain(spark: SparkSession, sf: str) -> DataFrame:
    root, checkpoint = new_run_dir(spark, "zones"), new_run_dir(spark, "checkpoint")
    legacy = _legacy_members(spark, sf)
    zone_stream(
        stream_messages(spark, _topic(spark, sf, "notif_dup")),
        lambda: load(spark, sf, "src_member"),
        MEMBER_CONFIG,
        root,
        checkpoint,
        snapshots={"raw": legacy},
        trigger=stream_windows.AVAILABLE,
    ).awaitTermination()
    written = sink.read_batches(spark, MEMBER_CONFIG.table_path(root, "analytics"))
    return _zone_output(quality.passed(written))
