"""What Spark makes of the queries: no cross joins, no Python rows, pruned scans, early limits."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from fixtures import load
from queries import QUERIES
from zoneflow.operators.limits import latest_per_key
from zoneflow.sources.tables import read_table

ROOT = Path(__file__).resolve().parent.parent


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


LAZY = sorted(k for k in QUERIES if not k.startswith(("stream_", "zone_", "batch_", "late_", "run_", "log_")))


@pytest.mark.parametrize("key", LAZY)
def test_no_cross_join_and_no_python(spark, sf, key):
    text = plan(QUERIES[key](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_table_read_is_pruned_and_filtered(spark, sf):
    df = read_table(spark, f"{sf}/orders.parquet").where("o_orderstatus = 'F'").select("o_orderkey")
    text = plan(df)
    assert "EqualTo(o_orderstatus,F)" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>", text)


def test_rank_filter_runs_before_the_shuffle(spark, sf):
    text = plan(latest_per_key(load(spark, sf, "cdc_log"), ["record_id"], ["change_ts", "seq"]))
    assert "row_number(), 1, Partial" in text


def test_counts_are_combined_before_the_shuffle(spark, sf):
    assert "partial_count" in plan(QUERIES["tumbling_counts"](spark, sf))
    assert "partial_sum" in plan(QUERIES["reconcile_full_outer"](spark, sf))


def test_no_local_checkpoint_and_no_row_functions_in_the_library():
    for path in (ROOT / "zoneflow").rglob("*.py"):
        if "llm" in path.parts:  # the corpus operators work in batches of Python where no row function will do
            continue
        text = path.read_text()
        for bad in ("localCheckpoint", "toPandas", "F.udf", "crossJoin", ".rdd"):
            assert bad not in text, f"{bad} in {path}"
