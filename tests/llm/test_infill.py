from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from zoneflow.llm import infill


@pytest.mark.parametrize("density", [0.0001, 0.02, 0.3, 0.9, 1.0])
def test_select_equals_the_sorted_list(density):
    rng = np.random.default_rng(int(density * 1000))
    positions = np.flatnonzero(rng.random(300_000) < density) + 5
    found = infill.BoundarySet(positions)
    assert found.size == len(positions)
    ranks = {0, len(positions) - 1, *rng.integers(0, len(positions), 400).tolist()}
    assert all(found.select(k) == positions[k] for k in ranks)


def test_forms_of_containers():
    low = np.arange(0, 60_000, 2)
    assert isinstance(infill.container(low), infill.BitmapContainer)
    assert isinstance(infill.container(low[:100]), infill.ArrayContainer)
    assert isinstance(infill.container(np.arange(500, 60_000)), infill.RunContainer)
    for held in (low, low[:100], np.arange(500, 60_000), np.array([65_535])):
        assert [infill.container(held).select(k) for k in range(0, len(held), 97)] == held[::97].tolist()


def plain(text, doc_id):
    """With a list of all tokens."""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(tokens)
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted([h1 % (n + 1), h2 % (n + 1)])
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def test_against_a_list_of_tokens():
    rng = random.Random(1)
    texts = ["", "a", "<P>", "x<S", "<", "S><M", "é\U0001f600b", "\n\r\x00"]
    texts += ["".join(rng.choice("aZ<SPM> \né\U0001f600.") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += ["ab " * 50_000, "x" * 200_000, "." * 140_000]
    for i, text in enumerate(texts):
        assert infill.transform(text, f"1:{i}") == plain(text, i)


def test_rows(spark):
    rng = random.Random(2)
    texts = [None, "", "<M> inside", *("".join(rng.choice("aZ<SPM> \né\U0001f600.") for _ in range(rng.randint(0, 30))) for _ in range(120))]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "no id", 1, "x"), (7, texts[7], 1, "x"), (2**60 + 1, "a b c d", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, form string")
    made = infill.fill_in_middle(df)
    got = sorted(((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()), key=repr)
    assert got == sorted(((str(i), *plain(t or "", "" if i is None else i)) for i, t, *_ in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    out = infill.digest(made).collect()
    texts_by_hash = {hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in rows}
    assert {r.restored_sha256 for r in out} == texts_by_hash
    assert infill.fill_in_middle(df.limit(0)).count() == 0


def test_sql(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.sql(infill.SQL).fetchall())
    assert sorted(tuple(r) for r in infill.digest(infill.fill_in_middle(documents)).collect()) == want
