"""Best-fit packing of tokenized documents by exact-complement hashing.

A document longer than ``capacity`` is cut into full pieces; its first piece holds the rest. What is packed is a count of
pieces by length, at most ``capacity`` numbers whatever the corpus. From the longest length down, an index from sums to
single lengths, pairs and triples in stock finds what fills the gap exactly; a found combination is used as often as its scarcest
length allows. What has no complement is packed best-fit, longest first, in runs of equal sequences.

Only that count and the plan made from it pass through the driver. A piece knows its place among the pieces
of its length in its task; the counts of the tasks before make it a place in the corpus, and the plan says for each range of places
which sequences and which offset it has. Tokens stay where they were made; no key is gathered, so copies and hot sources
need no care.

Defined results: null text is the empty text and gives the end id alone; rows with equal ids are documents of their own; a null
``doc_id`` stays null; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import written
from zoneflow.llm.words import text_encoder

END_ID = 0
CAPACITY = 2048

PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long, part long, spot long"


class SumIndex:
    """Combinations of up to three lengths in stock by their sum.

    An entry lists its pairs or triples by their longest member and is made when its sum is first asked for. Stock only falls, so
    a combination that has run out never comes back and is dropped when it is met.
    """

    def __init__(self, stock: np.ndarray):
        self.stock = stock
        here = (stock > 0).astype(np.int64)
        self.lengths = np.flatnonzero(here)
        size = 1 << (2 * len(stock)).bit_length()
        spectrum = np.fft.rfft(here, size)
        self.pair_sums = np.rint(np.fft.irfft(spectrum * spectrum, size))[: len(stock)] > 0
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        self.triples: dict[int, list[int]] = {}

    def enough(self, *lengths: int) -> bool:
        return all(self.stock[x] >= lengths.count(x) for x in lengths)

    def _pairs(self, total: int) -> list[tuple[int, int]]:
        if total not in self.pairs:
            longer = self.lengths[(2 * self.lengths >= total) & (self.lengths < total)]
            longer = longer[self.stock[total - longer] > 0]
            self.pairs[total] = [(x, total - x) for x in longer.tolist()]
        return self.pairs[total]

    def _triples(self, total: int) -> list[int]:
        if total not in self.triples:
            longest = self.lengths[(3 * self.lengths >= total) & (self.lengths < total)]
            self.triples[total] = longest[self.pair_sums[total - longest]].tolist()
        return self.triples[total]

    def _pair(self, total: int, *others: int) -> tuple[int, int] | None:
        """The pair with the longest member that is in stock beside ``others``."""
        pairs = self._pairs(total)
        while pairs and not self.enough(*pairs[-1]):
            pairs.pop()
        return next((p for p in reversed(pairs) if self.enough(*others, *p)), None)

    def filling(self, gap: int, beside: int, most: int) -> tuple[int, ...] | None:
        """Up to ``most`` lengths in stock beside one ``beside`` whose sum is ``gap``, the longest first."""
        if most >= 1 and self.enough(beside, gap):
            return (gap,)
        if most >= 2 and (pair := self._pair(gap, beside)):
            return pair
        if most < 3:
            return None
        triples = self._triples(gap)
        while triples and (not self.stock[triples[-1]] or not self._pair(gap - triples[-1])):
            triples.pop()
        for longest in reversed(triples):
            if self.enough(beside, longest) and (pair := self._pair(gap - longest, beside, longest)):
                return (longest, *pair)
        return None


def exact_patterns(stock: np.ndarray, capacity: int, most: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """(lengths, how often) of sequences without padding; takes what they use from ``stock``."""
    index = SumIndex(stock)
    for length in index.lengths[::-1].tolist():
        while stock[length]:
            rest = () if length == capacity else index.filling(capacity - length, length, most)
            if rest is None:
                break
            pattern = (length, *rest)
            times = int(min(stock[x] // n for x, n in Counter(pattern).items()))
            for x in pattern:
                stock[x] -= times
            yield pattern, times


def best_fit_patterns(stock: np.ndarray, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Best fit, longest length first, of all that is in ``stock``: each run of equal open sequences is filled at once."""
    open_runs: dict[int, list[list]] = defaultdict(list)  # gap -> [lengths, how often]
    for length in np.flatnonzero(stock)[::-1].tolist():
        left = int(stock[length])
        while left:
            gap = min((g for g, runs in open_runs.items() if g >= length and runs), default=None)
            pattern, times = open_runs[gap].pop() if gap is not None else [(), -(-left // (capacity // length))]
            gap = capacity if gap is None else gap
            each = gap // length
            full = min(times, left // each)
            some = left - full * each if full < times and left - full * each < each else 0
            if full:
                open_runs[gap - each * length].append([pattern + (length,) * each, full])
            if some:
                open_runs[gap - some * length].append([pattern + (length,) * some, 1])
            untouched = times - full - bool(some)
            if untouched and pattern:
                open_runs[gap].append([pattern, untouched])
            left -= full * each + some
    for runs in open_runs.values():
        yield from ((pattern, times) for pattern, times in runs)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used. Indexing triples, pairs or single lengths is tried: fewest sequences win."""
    plans = []
    for most in (3, 2, 1):
        stock = np.zeros(capacity + 1, np.int64)
        stock[list(counts)] = list(counts.values())
        plans.append([*exact_patterns(stock, capacity, most), *best_fit_patterns(stock, capacity)])
    return min(plans, key=lambda p: sum(times for _, times in p))


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: where ranges of places begin, the sequence of each range's first place, and the offset in its sequences."""
    used: Counter = Counter()
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows[length].append((used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return {length: tuple(np.array(r, np.int64).T) for length, r in rows.items()}


def _pieces(path: str, capacity: int, with_ids: bool):
    names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId(), Counter()
        encoder = text_encoder(path, " ")
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"], encoder.encode([x or "" for x in batch["text"]]), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                start = 0
                for number in range(-(-len(ids) // capacity)):
                    length = (len(ids) - 1) % capacity + 1 if number == 0 else capacity
                    piece = ids[start : start + length]
                    rows.append((doc_id, number, start, length, zlib.crc32(piece.tobytes()), part, seen[length], piece))
                    seen[length] += 1
                    start += length
            out = pd.DataFrame(rows, columns=names)
            yield out.assign(ids=[x.astype("i4") for x in out["ids"]]) if with_ids else out.drop(columns="ids")

    return run


def _placed(table: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place, length = batch["place"].to_numpy(), batch["length"].to_numpy()
            sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            order = np.argsort(length, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                begins, sequences, offsets = table[int(length[at[0]])]
                i = np.searchsorted(begins, place[at], "right") - 1
                sequence[at], offset[at] = sequences[i] + place[at] - begins[i], offsets[i]
            yield batch.drop(columns="place").assign(sequence_id=sequence, offset=offset)

    return run


def pack_best_fit(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset; ``with_ids`` adds the ids.

    ``docs`` has doc_id and text. ``tokenizer_path``: a tokenizers file that is at this path on every executor.
    The counts by task and length that place the pieces grow with the number of tasks and are joined, by the planner's choice.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    # ids go through Python as text: beside a null, pandas would hold numbers as floats
    made = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(_pieces(tokenizer_path, capacity, with_ids), schema)
    pieces = written(made, "bestfit-pieces")
    counts = pieces.groupBy("length", "part").agg((F.max("spot") + 1).alias("held"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0))), "bestfit-counts")
    stock = {r["length"]: r["held"] for r in counts.groupBy("length").agg(F.sum("held").alias("held")).collect()}
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = pieces.join(counts.drop("held"), ["length", "part"]).select(*kept, (F.col("before") + F.col("spot")).alias("place"))
    out = ranked.drop("place").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    rows = ranked.mapInPandas(_placed(places(plan(stock, capacity))), out)
    return rows.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
