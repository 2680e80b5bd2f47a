from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from zoneflow.llm import bestfit

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(lengths, capacity):
    """Least number of sequences, by trying everything."""
    best = len(lengths)

    def put(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(lengths):
            best = len(gaps)
            return
        for k in {g: k for k, g in enumerate(gaps) if g >= lengths[i]}.values():
            put(i + 1, [*gaps[:k], gaps[k] - lengths[i], *gaps[k + 1 :]])
        put(i + 1, [*gaps, capacity - lengths[i]])

    put(0, [])
    return best


def test_plan_uses_every_length_and_is_near_the_best():
    rng = random.Random(3)
    over = 0
    for _ in range(200):
        capacity = rng.randint(3, 20)
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 9))), reverse=True)
        patterns = bestfit.plan(Counter(lengths), capacity)
        used = Counter(x for p, n in patterns for x in p for _ in range(n))
        assert used == Counter(lengths) and all(sum(p) <= capacity for p, _ in patterns)
        over += sum(n for _, n in patterns) - fewest(lengths, capacity)
    assert over <= 2


def test_exact_patterns_have_no_gap_and_leave_no_complement():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.randint(4, 40)
        stock = np.zeros(capacity + 1, np.int64)
        for _ in range(30):
            stock[rng.randint(1, capacity)] += 1
        before = stock.copy()
        used = Counter()
        for p, n in bestfit.exact_patterns(stock, capacity, 3):
            assert sum(p) == capacity and len(p) <= 4 and n > 0
            for x in p:
                used[x] += n
        assert all(before[x] - stock[x] == used[x] for x in range(capacity + 1)) and (stock >= 0).all()
        left = [x for x in range(capacity + 1) for _ in range(stock[x])]
        for i, a in enumerate(left):
            for j, b in enumerate(left[i + 1 :], i + 1):
                assert a + b != capacity and all(a + b + c != capacity for c in left[j + 1 :])


def test_best_fit_runs_equal_best_fit_one_by_one():
    rng = random.Random(5)
    for _ in range(100):
        capacity = rng.randint(3, 30)
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 60)))
        gaps = []
        for x in sorted(counts.elements(), reverse=True):
            k = min((k for k, g in enumerate(gaps) if g >= x), key=lambda k: gaps[k], default=None)
            if k is None:
                gaps.append(capacity - x)
            else:
                gaps[k] -= x
        stock = np.zeros(capacity + 1, np.int64)
        stock[list(counts)] = list(counts.values())
        made = [capacity - sum(p) for p, n in bestfit.best_fit_patterns(stock, capacity) for _ in range(n)]
        assert sorted(made) == sorted(gaps)


def test_a_huge_corpus_has_a_small_plan():
    counts = {n: 10**9 + n * 977 for n in range(1, 2049)}
    patterns = bestfit.plan(counts, 2048)
    total = sum(n * c for n, c in counts.items())
    assert len(patterns) < 10_000 and sum(n for _, n in patterns) <= -(-total // 2048) * 1.001


def checked(rows, docs, capacity):
    plain = Tokenizer.from_file(PATH)
    whole = [(i, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")) for i, t in docs]
    want, got, sequences = Counter(), Counter(), {}
    for i, ids in whole:
        first = (len(ids) - 1) % capacity + 1
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), tuple(ids[a:b].tolist())] += 1
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(len(ids) for _, ids in whole)


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    n, tokens = checked(bestfit.pack_best_fit(docs, PATH, with_ids=True).collect(), [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert n <= -(-tokens // 2048) * 1.02 + 1


def test_odd_rows(spark):
    docs = [(1, None), (1, ""), (2, "a  b   c <|endoftext|>"), (None, "no id"), (2**60 + 1, "word, " * 9000), (3, "same"), (3, "same"), (4, "x" * 9000)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, place int, before int").repartition(3)
    for capacity in (2048, 7):
        checked(bestfit.pack_best_fit(df, PATH, capacity, with_ids=True).collect(), docs, capacity)
    assert bestfit.pack_best_fit(df, PATH).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert bestfit.pack_best_fit(df.limit(0), PATH).count() == 0
