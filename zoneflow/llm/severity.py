"""Toxicity by cumulative-link ordinal regression on sparse text features.

A text's features are its words and their first letters, in windows of ``PER_WORDS`` words that overlap by half and cover all of
it; the window with the highest score counts, so a toxic passage weighs the same however long the text around it is. Grades are ordered: 0 is not toxic; toxic texts get grades 1 to
``GRADES`` - 1 by how much it has of the features that mark toxic texts in the sample. One weight vector serves all
thresholds, P(grade > k) = sigmoid(w x - t_k) with t_0 < t_1 < ..., so the predicted grades are ordered too; the
expected severity is the sum of these probabilities.

The fit uses a bounded sample of labelled rows (``sample_rows`` of each label, chosen by a hash of the id). What marks toxic texts is
counted over whole texts in the cluster, at most ``max_features`` features stay, and of every text, short or
long, the FIT_WINDOWS windows with the most of them enter the fit. Every document is scored on its whole text.

Defined results: null, empty and word-free texts have severity 0, grade 0 and are not toxic; labels that are null or without a
document are left out, an id with both labels is toxic, and of documents with equal ids one is learned from; documents with equal ids are scored one by one; without both labels in the sample nothing is
toxic. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable, Container, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import written

GRADES = 4
#: Probability of a grade above 0 from which a text is called toxic.
TOXIC_FROM = 0.4
KEPT_WORDS = 300_000
#: Counts are taken in windows of so many words.
PER_WORDS = 200
#: Windows of a text that the fit chooses from.
FIT_WINDOWS = 16
#: Lengths of word beginnings that are features beside the word itself.
BEGINNINGS = (4, 5, 6)
#: A feature is of so many toxic texts of the sample at least.
LEAST_TEXTS = 3
#: A feature is kept if its log odds are this many standard errors above 0.
LEAST_Z = 3.0
_SPACES = str.maketrans({c: " " for c in string.punctuation + "\n\t\r"})


def _words(text: str) -> list[str]:
    return text.lower().translate(_SPACES).split()


def _features_of(word: str) -> list[str]:
    """The word and its beginnings, these marked by a trailing "*"."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def _windows(words: list[str], known: Callable[[str], tuple[str, ...]]) -> list[tuple[int, dict[str, float]]]:
    """Start and values of the known features for every window with some. A window is two halves; one whose first half has
    none has nothing that the next window lacks."""
    half = PER_WORDS // 2
    halves: dict[int, Counter] = {}
    for i, word in enumerate(words):
        if found := known(word):
            halves.setdefault(i // half, Counter()).update(found)
    out = []
    for k, counts in halves.items():
        both = counts + halves[k + 1] if k + 1 in halves else counts
        out.append((k * half, {f: float(np.log1p(n)) for f, n in both.items()}))
    return out


def _knower(features: Container[str], seen: dict[str, tuple[str, ...]]) -> Callable[[str], tuple[str, ...]]:
    """The known features of a word; ``seen`` keeps those of words met so far."""

    def known(word: str) -> tuple[str, ...]:
        found = seen.get(word)
        if found is None:
            if len(seen) >= KEPT_WORDS:
                seen.clear()
            found = seen[word] = tuple(f for f in _features_of(word) if f in features)
        return found

    return known


def _features(text: str | None) -> set[str]:
    return {f for word in set(_words(text or "")) for f in _features_of(word)}


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, np.inf))

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k), one column for each threshold."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))

    def strongest(self, words: list[str], seen: dict[str, tuple[str, ...]]) -> tuple[float, int]:
        """Score and start of the window with the highest score; weights are never below 0."""
        scored = ((sum(self.weights[f] * x for f, x in w.items()), -at) for at, w in _windows(words, _knower(self.weights, seen)))
        score, at = max(scored, default=(0.0, 0))
        return score, -at

    def score(self, text: str | None, seen: dict[str, tuple[str, ...]]) -> float:
        """``seen``: the known features of words met so far, which the caller keeps."""
        return self.strongest(_words(text or ""), seen)[0]


def _graded(amount: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for texts that aren't toxic, else 1 to GRADES - 1 by the amount of what marks toxic texts, in equal parts."""
    cuts = np.quantile(amount[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
    return np.where(toxic, 1 + np.searchsorted(cuts, amount), 0)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(feature, toxic texts with it, other texts with it) of each batch."""
    for batch in batches:
        inside, outside = Counter(), Counter()
        for text, toxic in zip(batch["text"], batch["is_toxic"], strict=True):
            (inside if toxic else outside).update(_features(text))
        names = sorted(inside.keys() | outside.keys())
        yield pd.DataFrame({"feature": names, "a": [inside[f] for f in names], "b": [outside[f] for f in names]})


def evidence(labelled: DataFrame, n_in: int, n_out: int, max_features: int) -> dict[str, float]:
    """Log odds of the features that mark toxic texts, the surest first; counted over whole texts in the cluster."""
    counts = labelled.select("text", "is_toxic").mapInPandas(_counted, "feature string, a long, b long")
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n_in + 1)) - F.log(b / (n_out + 1))
    known = counts.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("a") >= LEAST_TEXTS)
    known = known.select("feature", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("sure"))
    # evidence is for toxicity only: what marks other texts is their subject, not their tone
    best = known.where("odds >= 1").orderBy(F.desc("sure"), "feature").limit(max_features).toPandas()
    least = min(LEAST_Z, best["sure"].max() / 2) if len(best) else 0  # a very small sample is never sure
    return {f: o for f, o, s in best.itertuples(index=False) if s >= least}


def _strong_windows(odds: dict[str, float]):
    """Of every text, whatever its length, the FIT_WINDOWS windows with the most evidence, as numbers and values of features."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = {f: i for i, f in enumerate(odds)}
        known = _knower(number, {})
        for batch in batches:
            rows = []
            for doc_id, toxic, text in zip(batch["doc_id"], batch["is_toxic"], batch["text"], strict=True):
                windows = _windows(_words(text), known)
                windows.sort(key=lambda w: (-sum(odds[f] * x for f, x in w[1].items()), w[0]))
                for k, (_, values) in enumerate(windows[:FIT_WINDOWS] or [(0, {})]):
                    rows.append((doc_id, toxic, k, [number[f] for f in values], list(values.values())))
            yield pd.DataFrame(rows, columns=["doc_id", "is_toxic", "k", "features", "amounts"])

    return run


def fit(bags: list[list[dict[int, float]]], toxic: np.ndarray, odds: np.ndarray, prior: float, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for texts given as the values of the features in their windows.

    ``odds``: the evidence of each feature; ``prior``: the share of toxic rows among all labelled ones, to which the sample is weighted
    back. The window of a text that counts is first chosen by the evidence of its features, then by their weights, which stay at 0 or above.
    """
    strength = odds
    for _ in range(2):
        entries = [
            (i, c, x) for i, bag in enumerate(bags) if bag for c, x in max(bag, key=lambda w: sum(strength[c] * x for c, x in w.items())).items()
        ]
        row, col, val = (np.array(x, kind) for x, kind in zip(zip(*entries, strict=True) if entries else ([], [], []), (int, int, float), strict=True))
        strength, thresholds = _solved(row, col, val, toxic, len(odds), prior, steps)
    return strength, thresholds


def _solved(
    row: np.ndarray, col: np.ndarray, val: np.ndarray, toxic: np.ndarray, features: int, prior: float, steps: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for the values ``val`` of the features ``col`` in the texts ``row``."""
    texts, n_in, n_out = len(toxic), toxic.sum(), (~toxic).sum()
    grades = _graded(np.bincount(row, val, texts), toxic)
    weight = np.where(toxic, prior / n_in, (1 - prior) / n_out)
    above = grades[:, None] > np.arange(GRADES - 1)[None, :]

    # without evidence a text is rarely toxic, even where half of the labelled ones are
    w, first = np.zeros(features), 2 + max(0.0, np.log((1 - prior) / prior))
    gaps = np.full(GRADES - 2, 0.0)  # exponents: thresholds stay ordered
    moment = [np.zeros(features + GRADES - 1) for _ in range(2)]
    for step in range(1, steps + 1):
        t = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, w[col] * val, texts)
        p = 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -50, 50)))
        err = (p - above) * weight[:, None]
        gw = np.bincount(col, err.sum(1)[row] * val, features) + 1e-5 * w
        gt = -err.sum(0)
        gradient = np.concatenate([gw, [gt.sum()], [gt[k + 1 :].sum() * np.exp(gaps[k]) for k in range(GRADES - 2)]])
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.999 * moment[1] + 0.001 * gradient**2
        move = 0.05 * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-9)
        w, first, gaps = np.maximum(w - move[: len(w)], 0), first - move[len(w)], np.clip(gaps - move[len(w) + 1 :], -5, 5)
    thresholds = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
    return w, thresholds


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, max_features: int = 50_000) -> OrdinalModel:
    """Fits on at most ``sample_rows`` ids of each label, those with the least hashes, and one text of each id.

    What comes to the driver: at most ``max_features`` features, and of each of those texts FIT_WINDOWS windows of numbers.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", (F.col("toxic") > 0).alias("is_toxic"))
    totals = dict(marked.groupBy("is_toxic").count().collect())
    picked = [
        marked.where(F.col("is_toxic") == flag).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for flag in (False, True)
    ]
    # an id with both labels is toxic
    ids = picked[0].unionByName(picked[1]).groupBy("doc_id").agg(F.max("is_toxic").alias("is_toxic"))
    share = totals.get(True, 0) / max(1, sum(totals.values()))
    found = docs.where(F.length("text") > 0).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "is_toxic")
    one_text = F.min_by("text", F.struct(F.xxhash64("text"), "text"))
    labelled = written(found.groupBy("doc_id").agg(F.max("is_toxic").alias("is_toxic"), one_text.alias("text")), "labelled")
    held = dict(labelled.groupBy("is_toxic").count().collect())
    n_in, n_out = held.get(True, 0), held.get(False, 0)
    if not n_in or not n_out:
        return OrdinalModel()
    odds = evidence(labelled, n_in, n_out, max_features)
    schema = "doc_id string, is_toxic boolean, k int, features array<int>, amounts array<double>"
    texts = labelled.select(F.col("doc_id").cast("string").alias("doc_id"), "is_toxic", "text")
    rows = texts.mapInPandas(_strong_windows(odds), schema).toPandas().sort_values(["doc_id", "k"])
    bags, toxic = [], []
    for _, text in rows.groupby("doc_id", sort=True):
        bags.append([dict(zip(f, x, strict=True)) for f, x in zip(text["features"], text["amounts"], strict=True)])
        toxic.append(bool(text["is_toxic"].iloc[0]))
    weights, thresholds = fit(bags, np.array(toxic), np.array(list(odds.values()), float), share)
    return OrdinalModel({f: float(x) for f, x in zip(odds, weights, strict=True)}, thresholds)


def predict(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """(doc_id, severity, grade, toxic) of every row: the expected grade, the likeliest one, P(grade > 0) >= TOXIC_FROM."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, grade int, toxic boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        model, seen = shared.value, {}
        above = model.probabilities(np.array([model.score(t, seen) for t in texts], float))
        blank = np.array([t is None or not t.translate(_SPACES).strip() for t in texts], bool)
        above[blank] = 0
        exact = np.hstack([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]])
        return pd.DataFrame({"severity": above.sum(1), "grade": exact.argmax(1), "toxic": above[:, 0] >= TOXIC_FROM})

    return docs.select("doc_id", predicted("text").alias("p")).select("doc_id", "p.severity", "p.grade", "p.toxic")
