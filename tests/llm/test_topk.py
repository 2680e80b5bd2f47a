from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, id long, v string"


def brute(rows, queries, k):
    whole = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        e = [math.floor(1024 * x) for x in v]
        whole[i] = min(whole.get(i, e), e)
    out = []
    for q in sorted(set(queries) & set(whole)):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


def run(spark, rows, k=10):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    queries = df.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"))
    return sorted(tuple(r) for r in topk.search(df, queries, k).collect())


def vectors(n, width, seed, step=10):
    rng = random.Random(seed)
    return [(i * step, [rng.choice([rng.uniform(-1, 1), 0.5, -0.25]) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("width", [1, 2, 7])
def test_against_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rows = vectors(120, width, width)
    rows += [(1000 + i, [0.5] * width) for i in range(0, 300, 20)]  # a class of equal vectors, with queries in it
    rows += [(5, None), (7, [float("nan")] * width), (None, [0.1] * width), (9, [None] + [0.1] * (width - 1)), (11, [float("inf")] * width)]
    rows += [(3, [0.2] * width), (3, [0.2] * width), (13, [0.3]), (15, [])]
    assert run(spark, rows) == brute(rows, [i for i, _ in rows if i is not None and i % 100 == 0], 10)


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (100, [1.0, 2.0])]
    assert run(spark, rows) == brute(rows, [0, 100], 10)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [1e5 + i / 1024, -2e5 + i / 512, 3e5]) for i in range(0, 300, 10)]
    assert run(spark, rows, 3) == brute([(i, [__import__("numpy").float32(x).item() for x in v]) for i, v in rows], [0, 100, 200], 3)
