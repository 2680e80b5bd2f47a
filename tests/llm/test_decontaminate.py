from __future__ import annotations

import random
import re

from zoneflow.llm import decontaminate as dc

DOCS = "doc_id long, text string, item_id string, win string, h long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for s in range(max(0, len(w) - window) + 1 if w else 0):
            wins.setdefault(tuple(w[s : s + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in wins}:
            for s in range(len(w) - size + 1):
                key = tuple(w[s : s + size])
                if key in wins:
                    hit.update(range(s, s + size))
                    found |= wins[key]
        out.append((doc, len(w), len(hit), sorted(str(i) for i in found if i is not None), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id long")
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in dc.contamination(d, b).collect()]
    return sorted(got, key=str)


def test_against_brute_force(spark):
    rng = random.Random(1)
    # few words, so that windows and parts of them repeat within and across texts
    text = lambda n, k: " ".join(rng.choice("ab cd Éé e1 ÉÉ x_y Q".split()[:k]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 4, 6, 9, 10, 11, 15, 25]), 7)) for i in range(12)]
    items += [(90, None), (91, ""), (92, " .,- "), (None, text(12, 3)), (3, text(12, 2)), (3, items[3][1])]
    docs = [(i, text(rng.randint(0, 60), 7)) for i in range(30)]
    docs += [(40 + i, f"{text(5, 7)}, {t}! {text(3, 7)}") for i, (_, t) in enumerate(items)]
    docs += [(100, None), (101, ""), (None, items[8][1]), (102, items[5][1]), (102, items[5][1]), (102, "other"), (103, text(8000, 2))]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [(1, "a b c")], []) == [(1, 3, 0, [], False)]
    assert run(spark, [], [(1, "a b c")]) == []


def test_clean_documents_keep_all_columns(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"x {item} y", "k"), (2, "clean", "l"), (None, None, "m"), (2, "clean", "l")], "doc_id long, text string, content string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert sorted(map(tuple, dc.clean_documents(docs, items).collect()), key=str) == sorted([(2, "clean", "l"), (2, "clean", "l"), (None, None, "m")], key=str)


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = dc.contamination(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
