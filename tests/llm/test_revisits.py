from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import revisits

SCHEMA = "record_id long, kind string, url string, at long, etag string, last_modified long, digest string, headers map<string,string>, part int, state string"


def records(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("HTTP://WWW.Example.com:80/a/?b=2&a=1&utm_source=x#top", "example.com/a?a=1&b=2"),
        ("https://example.com", "example.com"),
        ("example.com/", "example.com"),
        ("https://m.example.com/A?ref=1", "m.example.com/A"),
        ("http://example.com?x=1", "example.com?x=1"),
        ("", ""),
    ],
)
def test_canonical_urls(spark, url, key):
    assert spark.range(1).select(revisits.canonical_url(F.lit(url)).alias("k")).first()["k"] == key


def agree(v, s):
    tag = lambda t: t[2:] if t.startswith("W/") else t
    if v[4] is not None and s[4] is not None:
        return tag(v[4]) == tag(s[4])
    if v[5] is not None and s[5] is not None:
        return v[5] == s[5]
    return v[4] is v[5] is s[4] is s[5] is None


def brute(rows):
    out = []
    for v in rows:
        if v[1] != "revisit":
            continue
        before = [s for s in rows if s[1] == "response" and s[2] == v[2] and v[2] is not None and None not in (s[3], v[3]) and s[3] < v[3]]
        s = max(before, key=lambda s: (s[3], s[0]), default=None)
        state = "none" if s is None else "resolved" if agree(v, s) else "mismatch"
        headers = None
        if state == "resolved":
            new = {k.lower(): x for k, x in (v[7] or {}).items() if k.lower() not in revisits.KEPT_HEADERS}
            headers = {**{k.lower(): x for k, x in (s[7] or {}).items()}, **new}
        out.append((v[0], state, s and s[0], s[6] if state == "resolved" else None, headers))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):  # one URL has most of the captures, many at equal times
        url = "hot.example/x" if rng.random() < 0.6 else f"site{rng.randrange(12)}.example"
        kind = rng.choice(["response", "revisit", "revisit"])
        headers = rng.choice([None, {}, {"Date": str(i), "Content-Type": "a"}, {"ETag": "e", "content-length": "3", "X": str(i)}])
        rows.append((i, kind, url, rng.randrange(60), rng.choice([None, '"a"', 'W/"a"', '"b"']), rng.choice([None, 1, 2]), f"d{i}", headers))
    rows += [(900, "revisit", None, 5, None, None, None, None), (901, "revisit", "hot.example/x", None, None, None, None, None), (902, "response", None, 1, None, None, "n", None), (903, "other", "hot.example/x", 3, None, None, None, None)]
    rows.append(rows[next(i for i, r in enumerate(rows) if r[1] == "revisit" and r[3] > 30)])
    got = [(r.record_id, r.state, r.response_id, r.digest, r.headers) for r in revisits.resolve(records(spark, rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_equal_times_of_a_hot_url_over_many_partitions(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        kind = "response" if rng.random() < 0.3 else "revisit"
        rows.append((i, kind, "hot.example/x" if i % 10 else "cold.example", rng.randrange(4), '"a"', None, f"d{i}", {}))
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = [(r.record_id, r.state, r.response_id, r.digest, r.headers) for r in revisits.resolve(records(spark, rows)).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got, key=str) == brute(rows)


def test_empty_table(spark):
    assert revisits.resolve(records(spark, [])).count() == 0
    pages = spark.createDataFrame([(1, None, None), (2, "http://a.example", "")], "page_id long, url string, html string")
    assert revisits.digest(revisits.resolve(revisits.captures(pages))).count() == 6 
