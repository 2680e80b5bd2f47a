from __future__ import annotations

import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zoneflow.llm import jaccard
from zoneflow.llm.components import components
from zoneflow.llm.shingles import shingle_set, similar


def sets(text):
    w = [x for x in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").split(" ") if x]
    w = [y for x in w for y in x.replace("\n", " ").replace("\t", " ").split(" ") if y]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, percent=75):
    rows = [(i, sets(t)) for i, t in docs]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted([(doc, len(s), least.get(root(i))) for i, (doc, s) in enumerate(rows)], key=str)


def run(spark, docs):
    df = spark.createDataFrame([(i, t, "g", 3) for i, t in docs], "doc_id long, text string, node string, n int")
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_components(df).collect()], key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = " ".join(rng.choice(vocabulary) for _ in range(30))
    docs = []
    for _ in range(12):  # families: copies with from none to many words changed, some with a common line
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 40, 90]))]
        for _ in range(rng.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(w) + (" " + line if rng.random() < 0.4 else "")))
    w = [f"c{i}" for i in range(80)]  # a chain: neighbours link, ends don't
    for i in range(0, 24, 3):
        docs.append((len(docs), " ".join(w[:80 - i] if i % 2 else [*w[i:], "end"])))
    docs += [(500 + i, " ".join(w[i : i + 60])) for i in range(0, 20, 4)]
    docs += [(900, None), (901, ""), (902, " \n\t "), (903, "One two"), (904, "one\x0bTWO"), (905, "ONE  two three"), (None, docs[0][1]), (906, docs[3][1].upper())]
    docs += [(907, "same row text of seven words here"), (907, "same row text of seven words here"), (None, "alone " * 9), (908, "tic tac " * 20_000)]
    rng.shuffle(docs)
    return docs


def test_against_brute_force(spark):
    docs = corpus(3)
    assert run(spark, docs) == brute(docs)


def test_common_shingles_come_last_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "OFTEN", 3)
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", 500)
    docs = corpus(4)
    assert run(spark, docs) == brute(docs)


def test_full_bitmaps_lose_nothing(spark):
    docs = corpus(5)[:40]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_components(df, max_bits=11).collect()], key=str)
    assert got == brute(docs)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(2, text, "a"), (1, text + " x", "b"), (3, "other text", "c"), (3, "other text", "c"), (None, None, "d"), (4, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    assert sorted([(r[0], r[2]) for r in jaccard.one_of_each(df).collect()], key=str) == sorted([(1, "b"), (3, "c"), (None, "d"), (4, "e")], key=str)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(300, 301), (301, 301)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 301: 300}
    assert components(edges.limit(0)).count() == 0


@given(st.lists(st.sampled_from("a b c d".split()), max_size=14), st.lists(st.sampled_from("a b c d".split()), max_size=14))
def test_similar_is_exact(x, y):
    a, b = sets(" ".join(x)), sets(" ".join(y))
    p, q = shingle_set(" ".join(x)), shingle_set(" ".join(y))
    assert (len(p), len(q)) == (len(a), len(b))
    assert len(np.intersect1d(p, q)) == len(a & b)
    assert similar(p, q, 75) == bool(a and b and 100 * len(a & b) >= 75 * len(a | b))


def test_one_of_each_with_a_full_bitmap_and_repeated_ids(spark):
    docs = corpus(6)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, marked_id string")
    want = {c for i, _, c in brute(docs) if i == c}
    for bits in (11, 29):
        got = [r["doc_id"] for r in jaccard.one_of_each(df, max_bits=bits).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_bitmap_knows_every_id(spark):
    ids = spark.range(0, 5000, 3).withColumnRenamed("id", "marked")
    bits, bitmap = jaccard._ids_bitmap(ids, 29)
    shared = spark.sparkContext.broadcast(bitmap)
    maybe = {r[0] for r in spark.range(5000).where(jaccard._maybe_in(F.col("id"), bits, shared)).collect()}
    assert set(range(0, 5000, 3)) <= maybe and len(maybe) < 2200
