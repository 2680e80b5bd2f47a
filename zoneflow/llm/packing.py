"""Packing of tokenized documents into sequences by order-preserving dynamic programming.

The documents of a task's partition form one stream, in the order of the input. Windows of at most ``capacity`` tokens cut it at
document ends, sentence ends or, inside very long sentences, at evenly spaced places. The cost of a cutting is
the padding of its windows plus a penalty for every cut inside a document; the cheapest one is found from left to
right, with the candidates for the last cut in a monotone queue:

    best[i] = penalty[i] + capacity - at[i] + min(best[j] + at[j])    over cuts j with at[i] - at[j] <= capacity

The stream is cut in blocks of some dozens of windows; what follows the last cut of a block begins the next one,
so a task holds one block; a longer document enters it part by part. At a partition's end the rest is cut by the same costs,
where sequences whose length is a power of two count as unpadded.

Sequences never span partitions, so nothing is shuffled, and a task that runs again makes the same rows.
``sequence_id`` is the partition's number times 2**32 plus the sequence's number there.

Defined results: null text is the empty text and gives the end id alone; rows with equal ids are documents of
their own; a null ``doc_id`` stays null; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.words import TextEncoder, text_encoder

END_ID = 2
CAPACITY = 4096
SENTENCE_PENALTY = 16
MIDDLE_PENALTY = 256
#: A sentence longer than this may be cut at every MIDDLE_STEP tokens.
LONG_SENTENCE = 512
MIDDLE_STEP = 256
BLOCK_TOKENS = 64 * CAPACITY
#: Pieces handed on together.
FRAME_ROWS = 2000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def ends_sentence(encoder: TextEncoder) -> np.ndarray:
    """Which ids end a sentence."""
    vocabulary = encoder.encoder.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.removesuffix("</w>").endswith((".", "!", "?"))]] = True
    return out


def best_cuts(at: list[int], penalty: list[int], capacity: int, whole: bool = False) -> list[int]:
    """Indices into ``at`` (``at[0]`` = 0, gaps up to ``capacity``) of the cheapest cuts, 0 first.

    ``whole``: the last place must be a cut. Otherwise the best cut within ``capacity`` of it ends the block.
    """
    best, back = [0], [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + at, index), increasing
    for i in range(1, len(at)):
        here = at[i]
        while at[queue[0][1]] < here - capacity:
            queue.popleft()
        key, j = queue[0]
        cost = penalty[i] + capacity - here + key
        best.append(cost)
        back.append(j)
        key = cost + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, i))
    if whole:
        i = len(at) - 1
    else:  # what a candidate leaves over is not yet padding: the least cost by token
        i = min((k for k in range(len(at)) if at[k] > at[-1] - capacity), key=lambda k: (best[k] / max(at[k], 1), -k))
    cuts = [i]
    while i:
        i = back[i]
        cuts.append(i)
    return cuts[::-1]


def tail_cuts(at: list[int], penalty: list[int], capacity: int) -> list[int]:
    """Places of the cheapest cuts of what is left at a partition's end, 0 and ``at[-1]`` included.

    A sequence whose length is a power of two needs no padding, so each place also offers the places a power of two behind it.
    """
    natural, cost_there = np.array(at, np.int64), dict(zip(at, penalty, strict=True))
    ahead = (natural[:, None] + (1 << np.arange(capacity.bit_length()))[None, :]).ravel()
    places = np.union1d(natural, ahead[ahead < natural[-1]])
    best, back = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    for i in range(1, len(places)):
        first = int(np.searchsorted(places, places[i] - capacity))
        length = places[i] - places[first:i]
        cost = best[first:i] + np.where(length & (length - 1) == 0, 0, capacity - length)
        back[i] = first + int(np.argmin(cost))
        best[i] = cost.min() + cost_there.get(int(places[i]), MIDDLE_PENALTY)
    cuts = [len(places) - 1]
    while cuts[-1]:
        cuts.append(int(back[cuts[-1]]))
    return places[cuts[::-1]].tolist()


class _Stream:
    """Tokens not yet packed, as parts of documents, and the sequences made from them."""

    def __init__(self, first_id: int, capacity: int, ends_sentence: np.ndarray):
        self.ids = itertools.count(first_id)
        self.capacity, self.ends_sentence = capacity, ends_sentence
        self.parts: list[tuple[object, int, np.ndarray, int]] = []  # doc_id, start, ids, doc_tokens
        self.held = 0

    def add(self, doc_id: object, ids: np.ndarray) -> Iterator[tuple]:
        """Takes a document in, block by block; hands on what is packed."""
        for start in range(0, len(ids), BLOCK_TOKENS):
            part = ids[start : start + BLOCK_TOKENS]
            self.parts.append((doc_id, start, part, len(ids)))
            self.held += len(part)
            if self.held >= BLOCK_TOKENS:
                yield from self.flush(final=False)

    def _places(self, skipped: int = 0) -> tuple[list[int], list[int]]:
        """Where the tokens after the first ``skipped`` may be cut, and what a cut costs there."""
        until = np.cumsum([len(ids) for _, _, ids, _ in self.parts])
        complete = np.array([start + len(ids) == total for _, start, ids, total in self.parts])
        whole = np.concatenate([ids for _, _, ids, _ in self.parts])
        ends = until[complete]
        stops = np.union1d(np.flatnonzero(self.ends_sentence[whole]) + 1, np.append(ends, until[-1]))
        gaps = np.diff(stops, prepend=0)
        step = min(MIDDLE_STEP, self.capacity)
        between = [
            np.arange(stop - gap + step, stop, step) for stop, gap in zip(stops, gaps, strict=True) if gap > min(LONG_SENTENCE, self.capacity)
        ]
        places = np.unique(np.concatenate([[skipped], stops, *between])).astype(np.int64)
        places = places[places >= skipped]
        penalty = np.where(np.isin(places, ends), 0, np.where(np.isin(places, stops), SENTENCE_PENALTY, MIDDLE_PENALTY))
        return (places - skipped).tolist(), penalty.tolist()

    def flush(self, final: bool) -> Iterator[tuple]:
        if not self.held:
            return
        at, penalty = self._places()
        cuts = [at[i] for i in best_cuts(at, penalty, self.capacity)]
        if final and cuts[-1] < self.held:
            cuts += [cuts[-1] + c for c in tail_cuts(*self._places(cuts[-1]), self.capacity)[1:]]
        for a, b in itertools.pairwise(cuts):
            yield from self._take(b - a)

    def _take(self, n: int) -> Iterator[tuple]:
        """The next ``n`` tokens as one sequence."""
        sequence, offset = next(self.ids), 0
        taken = 0
        while offset < n:
            doc_id, start, ids, total = self.parts[taken]
            piece = ids[: n - offset]
            yield doc_id, start, len(piece), zlib.crc32(piece.tobytes()), total, sequence, offset, piece
            offset += len(piece)
            if len(piece) == len(ids):
                taken += 1
            else:
                self.parts[taken] = (doc_id, start + len(piece), ids[len(piece) :], total)
        del self.parts[:taken]
        self.held -= n


def _pack(path: str, capacity: int, with_ids: bool):
    names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.assign(ids=[x.astype("i4") for x in out["ids"]]) if with_ids else out.drop(columns="ids")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(path)
        stream = _Stream(TaskContext.get().partitionId() << 32, capacity, ends_sentence(encoder))
        end = np.array([END_ID], "<u4")
        rows: list[tuple] = []
        for batch in batches:
            texts = [x or "" for x in batch["text"]]
            for doc_id, ids in zip(batch["doc_id"], encoder.encode(texts), strict=True):
                rows.extend(stream.add(doc_id, np.concatenate([ids, end])))
                if len(rows) >= FRAME_ROWS:
                    yield frame(rows)
                    rows = []
        rows.extend(stream.flush(final=True))
        yield frame(rows)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence, as in PIECES; ``with_ids`` adds the piece's ids.

    ``docs`` has doc_id and text. ``tokenizer_path``: a tokenizers file that is at this path on every executor.
    """
    schema = PIECES.replace("doc_id long", "doc_id string") + (", ids array<int>" if with_ids else "")
    # ids go through Python as text: beside a null, pandas would hold numbers as floats
    pieces = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        _pack(tokenizer_path, capacity, with_ids), schema
    )
    return pieces.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
