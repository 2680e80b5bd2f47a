"""Language identification by a byte convolutional network in numpy.

A text's bytes are embedded, filters of several widths slide over them, and the largest answer of each filter
within a window of ``WINDOW`` bytes goes through a softmax layer. The windows tile the whole text; a text's
probabilities are those of its windows, weighted by their bytes. The layer sizes are fixed, so is the model's size.

The fit uses windows of at most ``sample_docs`` documents in all, as many of each language, chosen by a
hash of id and text, ``WINDOWS_A_DOC`` windows of each at most; nothing but text and language enters.

Defined results: null texts and texts without a letter are ``und`` with score 0; identical rows are predicted one
by one; without a labelled row every other text is ``und`` with score 0 too; rows with a null language or a null ``doc_id`` are
predicted but never learned from; ids may be of any type. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import fresh_name

UNDETERMINED = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
WINDOWS_A_DOC = 8
#: Windows in one pass of the network: what they need stays in the processor's cache.
BATCH = 48
_REACH = max(WIDTHS) - 1
#: Every letter, and numerals such as a superscript two.
_MAY_BE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _MAY_BE_LETTER.finditer(text))


def tiles(text: str) -> np.ndarray:
    """The text's bytes, small ASCII letters, with zeros up to whole windows and the filters' reach."""
    raw = np.frombuffer(text.encode().lower(), np.uint8)
    whole = -(-len(raw) // WINDOW) * WINDOW
    out = np.zeros(whole + _REACH, np.uint8)
    out[: len(raw)] = raw
    return out


@dataclass
class ByteNetwork:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: np.ndarray  # (longest width * EMBEDDING) x all filters, zero beyond a filter's width
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def _answers(self, stream: np.ndarray) -> np.ndarray:
        """Filter answers at each place of a byte stream that is _REACH longer than its places."""
        embedded = self.embedding[stream]
        n, step = len(stream) - _REACH, embedded.strides[0]
        seen = np.lib.stride_tricks.as_strided(embedded, (n, self.filters.shape[0]), (step, embedded.strides[1]))
        return seen @ self.filters

    def window_probabilities(self, stream: np.ndarray) -> np.ndarray:
        windows = (len(stream) - _REACH) // WINDOW
        pooled = np.empty((windows, self.filters.shape[1]), np.float32)
        for s in range(0, windows, BATCH):
            e = min(windows, s + BATCH)
            part = self._answers(stream[s * WINDOW : e * WINDOW + _REACH])
            pooled[s:e] = part.reshape(e - s, WINDOW, -1).max(1)
        return softmax(np.maximum(pooled + self.bias, 0) @ self.dense + self.dense_bias)

    def predict(self, texts: list[str]) -> np.ndarray:
        """Probabilities by text; the windows of all texts go through together."""
        tiled = [tiles(t)[:-_REACH] for t in texts]
        counts = np.array([len(t) // WINDOW for t in tiled])
        gap = np.zeros(WINDOW, np.uint8)  # a text's last filters reach into zeros, not into the next text
        stream = np.concatenate([x for t in tiled for x in (t, gap)] + [gap[:_REACH]])
        probabilities = self.window_probabilities(stream)
        starts = np.concatenate([[0], np.cumsum(counts + 1)[:-1]]).astype(int)
        used = np.concatenate([np.arange(s, s + c) for s, c in zip(starts, counts, strict=True)])
        weight = (stream[: len(probabilities) * WINDOW].reshape(-1, WINDOW) != 0).sum(1)[used].astype(np.float64) + 1e-9
        firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(int)
        total = np.add.reduceat(probabilities[used] * weight[:, None], firsts, axis=0)
        return total / np.add.reduceat(weight, firsts)[:, None]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6, seed: int = 0) -> ByteNetwork:
    """``windows``: n x (WINDOW + reach) bytes. Adam on the cross entropy, languages weighted equally."""
    rng = np.random.default_rng(seed)
    wide, kinds = max(WIDTHS), len(languages)
    mask = np.concatenate([np.repeat(np.arange(wide * EMBEDDING)[:, None] < w * EMBEDDING, FILTERS, 1) for w in WIDTHS], 1)
    p = {
        "embedding": rng.normal(0, 0.5, (256, EMBEDDING)),
        "filters": rng.normal(0, 0.3, mask.shape) * mask,
        "bias": np.zeros(mask.shape[1]),
        "dense": rng.normal(0, 0.3, (mask.shape[1], kinds)),
        "dense_bias": np.zeros(kinds),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    share = np.bincount(labels, minlength=kinds)
    weight = (len(labels) / (kinds * np.maximum(share, 1)))[labels].astype(np.float32)
    size = 128
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for s in range(0, len(order), size):
            at = order[s : s + size]
            x, y, wt, n = windows[at], labels[at], weight[at], len(at)
            emb = p["embedding"][x]  # n x (WINDOW + reach) x d
            places = np.lib.stride_tricks.sliding_window_view(emb, wide, 1).transpose(0, 1, 3, 2).reshape(n, WINDOW, -1)
            answers = places @ p["filters"]
            best = answers.argmax(1)  # n x filters
            top = np.take_along_axis(answers, best[:, None, :], 1)[:, 0] + p["bias"]
            hidden = np.maximum(top, 0)
            prob = softmax(hidden @ p["dense"] + p["dense_bias"])
            err = prob.copy()
            err[np.arange(n), y] -= 1
            err *= wt[:, None] / n
            back = (err @ p["dense"].T) * (top > 0)
            chosen = places[np.arange(n)[:, None], best]  # n x filters x inputs
            g = {
                "dense": hidden.T @ err,
                "dense_bias": err.sum(0),
                "bias": back.sum(0),
                "filters": np.einsum("nfi,nf->if", chosen, back) * mask,
                "embedding": np.zeros_like(p["embedding"]),
            }
            to_inputs = (back[:, :, None] * p["filters"].T[None]).reshape(n, -1, wide, EMBEDDING)
            where = best[:, :, None] + np.arange(wide)[None, None]
            np.add.at(g["embedding"], x[np.arange(n)[:, None, None], where], to_inputs)
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] -= (0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return ByteNetwork(languages, **p)


def is_held_out(doc_id: Column) -> Column:
    """A row without an id is not held out."""
    return F.coalesce(_remainder(doc_id) == 0, F.lit(False))


def may_be_learned(doc_id: Column) -> Column:
    """Only rows that are known not to be held out: a row without an id is neither held out nor learned from."""
    return F.coalesce(_remainder(doc_id) != 0, F.lit(False))


def _remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def _sampled_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows spread evenly over the whole text."""
    for batch in batches:
        rows = []
        for doc_id, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"], strict=True):
            stream = tiles(text)
            n = len(stream) // WINDOW
            for w in sorted({int(x) for x in np.linspace(0, n - 1, min(n, WINDOWS_A_DOC))}):
                rows.append((doc_id, lang, w, stream[w * WINDOW : (w + 1) * WINDOW + _REACH].tobytes()))
        yield pd.DataFrame(rows, columns=["doc_id", "lang", "at", "bytes"])


def train(labelled: DataFrame, sample_docs: int = 3000) -> ByteNetwork | None:
    """``labelled``: doc_id, text, lang of the rows to learn from. What comes to the driver: windows of at most
    ``sample_docs`` documents and one more for each language, those of the least hashes in each language."""
    usable = labelled.where("lang IS NOT NULL AND length(text) > 0").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    totals = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return None
    each = max(1, sample_docs // len(totals))
    # rows that surely are not among the least are left out before they are ordered
    share = F.create_map(*(F.lit(x) for lang, n in totals.items() for x in (lang, min(1.0, (each + 6 * each**0.5 + 20) / n))))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1_000_003)) / 1_000_003
    likely = usable.withColumn("drawn", drawn).where(F.col("drawn") < share[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("drawn", "doc_id", "text")
    sample = likely.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    rows = sample.select("doc_id", "lang", "text").mapInPandas(_sampled_windows, "doc_id string, lang string, at int, bytes binary").toPandas()
    rows = rows.sort_values(["doc_id", "at", "bytes"])
    languages = sorted(rows["lang"].unique())
    if not languages:
        return None
    windows = np.frombuffer(b"".join(rows["bytes"]), np.uint8).reshape(len(rows), -1)
    labels = rows["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(int)
    return fit(windows, labels, languages)


def _predictor(docs: DataFrame, network: ByteNetwork | None):
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(column: pd.Series) -> pd.DataFrame:
        network, texts = shared.value, column.tolist()
        known = [i for i, t in enumerate(texts) if network is not None and t is not None and has_letter(t)]
        lang, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
        for s in range(0, len(known), 64):
            part = known[s : s + 64]
            prob = network.predict([texts[i] for i in part])
            lang[part] = np.array(network.languages, object)[prob.argmax(1)]
            score[part] = np.minimum(prob.max(1), 1)
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return predicted


def predict(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    rows = docs.select("doc_id", _predictor(docs, network)("text").alias("p"))
    return rows.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score")


def identified(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """The rows of ``docs`` whose language was determined, all columns; ``lang`` (if there) becomes what was predicted.

    Without a network, as in a corpus without labels, nothing can be told: every row that has a letter stays, unchanged.
    """
    if network is None:
        return docs.where(F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)))
    name = fresh_name(docs, "language")
    # as it is not called deterministic, the filter on its answer does not make it run twice
    told = docs.withColumn(name, _predictor(docs, network).asNondeterministic()("text")["lang_pred"]).where(F.col(name) != UNDETERMINED)
    if "lang" in docs.columns:
        told = told.withColumn("lang", F.col(name).cast(docs.schema["lang"].dataType))
    return told.select(*docs.columns)
