from __future__ import annotations

import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from zoneflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a b  c\t d\x1ce <|endoftext|>x <|startoftext|> É́ Σας ΣΑΣ İstanbul don't I'LL 12a ̈b",
    "",
    "  \n ",
    "İstanbul, Ab. ,. a.. İİ TAKSİ. TAKSİ, ढ़, שׁ.",
    "ein Satz. Noch einer!",
    "x" * 5000,
]


def cost(at, penalty, cuts, capacity):
    return sum(penalty[j] + capacity - (at[j] - at[i]) for i, j in zip(cuts, cuts[1:]))


def test_cuts_are_the_cheapest():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.randint(5, 12)
        at = [0]
        for _ in range(rng.randint(0, 9)):
            at.append(at[-1] + rng.randint(1, capacity))
        penalty = [rng.choice([0, 0, 2, 7]) for _ in at]
        best = [0] + [10**9] * (len(at) - 1)
        for i in range(1, len(at)):
            best[i] = min(best[j] + penalty[i] + capacity - at[i] + at[j] for j in range(i) if at[i] - at[j] <= capacity)
        cuts = packing.best_cuts(at, penalty, capacity, whole=True)
        assert cuts[0] == 0 and cuts[-1] == len(at) - 1
        assert all(at[j] - at[i] <= capacity for i, j in zip(cuts, cuts[1:]))
        assert cost(at, penalty, cuts, capacity) == best[-1]


def test_tail_cuts_are_the_cheapest():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.choice([4, 8, 13])
        at = [0]
        for _ in range(rng.randint(0, 6)):
            at.append(at[-1] + rng.randint(1, capacity))
        penalty = dict(zip(at, [rng.choice([0, 0, 2, 7]) for _ in at]))
        places = sorted({p for a in at for p in (a, *(a + 2**k for k in range(capacity.bit_length()))) if p <= at[-1]})
        window = lambda n: 0 if n & (n - 1) == 0 else capacity - n
        best = {0: 0}
        for b in places[1:]:
            best[b] = min(best[a] + window(b - a) for a in places if 0 < b - a <= capacity) + penalty.get(b, packing.MIDDLE_PENALTY)
        cuts = packing.tail_cuts(at, [penalty[a] for a in at], capacity)
        assert cuts[0] == 0 and cuts[-1] == at[-1]
        assert sum(window(b - a) + penalty.get(b, packing.MIDDLE_PENALTY) for a, b in zip(cuts, cuts[1:])) == best[at[-1]]


def checked(rows, docs, capacity):
    """Every id of every document in one piece, sequences without gaps; returns the sequences' lengths."""
    plain = Tokenizer.from_file(PATH)
    whole = {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in docs}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(whole)
    for i, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(whole[i]))
            ids = whole[i][at : at + p.length]
            assert p.ids_crc32 == zlib.crc32(ids.tobytes()) and p.ids == ids.tolist()
            at += p.length
        assert at == len(whole[i])
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        lengths.append(at)
    assert max(lengths) <= capacity
    return lengths


def test_round_trip_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack_documents(docs, PATH, with_ids=True).collect()
    lengths = checked(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096)
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in lengths)
    assert padding < 0.02 * sum(lengths)


def rows_in_process(docs, capacity):
    """Blocks far smaller than a document."""
    encoder = packing.text_encoder(PATH)
    stream = packing._Stream(0, capacity, packing.ends_sentence(encoder))
    out = []
    for (i, _), ids in zip(docs, encoder.encode([t or "" for _, t in docs])):
        out.extend(stream.add(i, np.append(ids, 2).astype("<u4")))
        assert stream.held < packing.BLOCK_TOKENS + capacity
    out.extend(stream.flush(final=True))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return [SimpleNamespace(**dict(zip(names, row)), ids=row[-1].tolist()) for row in out]


def test_odd_rows(spark, monkeypatch):
    docs = [*enumerate(ODD), (7, None), (None, "no id"), (2**60 + 1, "word. " * 9000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, start int").coalesce(1)
    checked(packing.pack_documents(df, PATH, with_ids=True).collect(), docs, 4096)
    checked(packing.pack_documents(df, PATH, capacity=64, with_ids=True).collect(), docs, 64)
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 200)
    checked([r for r in rows_in_process(docs, 64)], docs, 64)
    twice = packing.pack_documents(df.unionByName(df), PATH)
    assert twice.agg({"length": "sum"}).first()[0] == 2 * packing.pack_documents(df, PATH).agg({"length": "sum"}).first()[0]
    assert packing.pack_documents(df.limit(0), PATH).count() == 0
