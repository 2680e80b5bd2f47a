"""Exact top-k search by inner product with a three-phase uniform threshold.

A vector is cut into ``PARTS`` ranges of components. For a query, each range is a list of local scores over all
candidates, and a candidate's score is the sum of its local scores.

1. Every list gives the candidates with its k highest local scores, and its least local score. The k-th highest whole score of the
   candidates given is one that k candidates reach: the cutoff. What it is above the sum of the least scores
   is dealt evenly over the lists: a candidate below its share in every list cannot reach the cutoff.
2. The shares go to all lists, which give every local score at or above them. A candidate's given scores, plus
   the shares for those not given, bound its score from above; who stays below the k-th highest lower bound drops out.
3. The scores still missing are computed from the vectors, exactly.

Equal vectors are one candidate and one query, represented by their smallest id; their members are put in at the
end, k + 1 of each at most, as no query can need more. Vectors and queries are worked on in blocks of rows, so that
each pair of blocks is two matrix products.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part, nor do rows without an
id; of rows with one id and different vectors the least vector counts, so identical rows count once; missing components
of a shorter vector are 0; an empty table gives no rows. Scores are exact as long as they fit 63 bits. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.llm.common import written

PARTS = 2
VECTOR_BLOCK = 4096
QUERY_BLOCK = 1024
SCALE = 1024


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v: array of whole numbers), one row per id."""
    usable = F.col("vec_id").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return (
        vectors.where(usable)
        .select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )


def _matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _packed(ids: list, rows: list, width: int, block: int) -> pd.DataFrame:
    made = np.array(ids, "<i8").tobytes(), _matrix(rows, width).astype("<i8").tobytes()
    return pd.DataFrame({"block": [block], "ids": [made[0]], "data": [made[1]]})


BLOCK = "block long, ids binary, data binary"


def vector_blocks(vectors: DataFrame, width: int) -> DataFrame:
    """Rows (id, v) of a partition as blocks of at most VECTOR_BLOCK rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, rows = [], []
        for batch in batches:
            for i, v in zip(batch["id"], batch["v"], strict=True):
                ids.append(i), rows.append(v)
                if len(ids) == VECTOR_BLOCK:
                    yield _packed(ids, rows, width, 0)
                    ids, rows = [], []
        if ids:
            yield _packed(ids, rows, width, 0)

    return vectors.select("id", "v").mapInPandas(run, BLOCK).select("ids", "data")


def query_blocks(vectors: DataFrame, count: int, width: int) -> DataFrame:
    """Rows (id, v) dealt by hash to ``count`` blocks, numbered from 0."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        return _packed(pdf["id"].tolist(), pdf["v"].tolist(), width, key[0])

    dealt = vectors.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(count)).alias("b"))
    return dealt.groupBy("b").applyInPandas(run, BLOCK).select(
        F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")
    )


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; through floats where these are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _read(row, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    q_ids, ids = np.frombuffer(row.q_ids, "<i8"), np.frombuffer(row.ids, "<i8")
    return q_ids, np.frombuffer(row.q_data, "<i8").reshape(len(q_ids), width), ids, np.frombuffer(row.data, "<i8").reshape(len(ids), width)


def _local_tops(width: int, parts: list[slice], k: int):
    """Phase 1: per task, query and part the candidates with the k highest local scores, with their whole scores, and
    the least local score."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}  # per block of queries: ids, and by part local scores, candidates, whole scores, least
        for batch in batches:
            for row in batch.itertuples():
                q_ids, q, ids, x = _read(row, width)
                local = [_product(q[:, part], x[:, part]) for part in parts]
                whole, who = sum(local), np.broadcast_to(ids, (len(q_ids), len(ids)))
                _, before = held.get(row.q_block, (None, [None] * len(parts)))
                after = []
                for scores, earlier in zip(local, before, strict=True):
                    top, least = [scores, who, whole], scores.min(1)
                    if earlier is not None:
                        top = [np.hstack(pair) for pair in zip(earlier[0], top, strict=True)]
                        least = np.minimum(least, earlier[1])
                    if top[0].shape[1] > k:
                        at = np.argpartition(-top[0], k - 1, 1)[:, :k]
                        top = [np.take_along_axis(t, at, 1) for t in top]
                    after.append((top, least))
                held[row.q_block] = (q_ids, after)
        for q_ids, found in held.values():
            for p, ((_, who, whole), least) in enumerate(found):
                yield pd.DataFrame({"query": q_ids, "part": p, "least": least, "ids": list(who), "scores": list(whole)})

    return run


def _above(width: int, parts: list[slice]):
    """Phase 2: local scores at or above the query's share for the part, null below."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                q_ids, q, ids, x = _read(row, width)
                shares = np.frombuffer(row.shares, "<i8").reshape(len(q_ids), len(parts))
                local = [_product(q[:, part], x[:, part]) for part in parts]
                given = [s >= shares[:, p : p + 1] for p, s in enumerate(local)]
                at, who = np.nonzero(np.logical_or.reduce(given))
                out = {"query": q_ids[at], "id": ids[who]}
                for p in range(len(parts)):
                    out[f"s{p}"] = pd.array(local[p][at, who], "Int64")
                    out[f"s{p}"][~given[p][at, who]] = pd.NA
                yield pd.DataFrame(out)

    return run


def _paired(vectors: DataFrame, queries: DataFrame, count: int) -> DataFrame:
    """Each block of vectors beside each block of queries: repeated once for every number, joined on it."""
    spread = vectors.withColumn("of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    return spread.join(queries, F.col("of") == F.col("q_block")).drop("of")


def _with_shares(queries: DataFrame, shares: DataFrame, count: int) -> DataFrame:
    """Blocks of queries with the shares (query, shares: array) of their queries, in the order of their ids."""

    def run(key: tuple, block: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        by_query = dict(zip(mine["query"], mine["shares"], strict=True))
        return block.assign(shares=[np.array([by_query[i] for i in np.frombuffer(x, "<i8")], "<i8").tobytes() for x in block["q_ids"]])

    dealt = shares.withColumn("q_block", F.pmod(F.xxhash64("query"), F.lit(count)))
    return queries.groupBy("q_block").cogroup(dealt.groupBy("q_block")).applyInPandas(
        run, "q_block long, q_ids binary, q_data binary, shares binary"
    )


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id in ``queries`` (query_id) its k best other rows of ``vectors``
    (vec_id, embedding), ties to the smaller id."""
    rows = written(whole_vectors(vectors.select("vec_id", "embedding")), "whole-vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    classes = written(rows.groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")), "classes")
    of_class = written(
        rows.join(classes.withColumnRenamed("v", "w"), F.col("v") == F.col("w")).select("vec_id", "id"), "members"
    )
    asked = written(queries.select("query_id").distinct().join(of_class, F.col("query_id") == F.col("vec_id")).select("query_id", "id"), "asked")
    step = -(-max(width, 1) // PARTS)
    parts = [slice(s, min(s + step, width)) for s in range(0, width, step)] or [slice(0, 0)]
    want = k + 1  # a query's own row is among its best ones at most once

    queried = classes.join(asked.select(F.col("id").alias("a")).distinct(), F.col("id") == F.col("a"), "left_semi")
    count = max(1, -(-queried.count() // QUERY_BLOCK))
    all_blocks = written(vector_blocks(classes, width), "vector-blocks")
    asked_blocks = written(query_blocks(queried, count, width), "query-blocks")
    pairs = _paired(all_blocks, asked_blocks, count)

    # phase 1
    tops = written(
        pairs.mapInPandas(_local_tops(width, parts, want), "query long, part int, least long, ids array<long>, scores array<long>"),
        "local-tops",
    )
    least = tops.groupBy("query", "part").agg(F.min("least").alias("least"))
    given = tops.select("query", F.explode(F.arrays_zip("ids", "scores")).alias("e")).select(
        "query", F.col("e.ids").alias("id"), F.col("e.scores").alias("score")
    )
    highest = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    reached = given.distinct().withColumn("place", F.row_number().over(highest)).where(F.col("place") <= want)
    floor = least.groupBy("query").agg(F.sum("least").alias("floor"))
    # with fewer candidates than wanted there is no cutoff and all are given
    cutoff = reached.join(floor, "query").groupBy("query").agg(
        F.when(F.count(F.lit(1)) >= want, F.min(F.col("score") - F.col("floor"))).otherwise(0).alias("over")
    )
    shares = least.join(cutoff, "query").select(
        "query", "part", (F.col("least") + F.ceil(F.col("over") / len(parts)).cast("long")).alias("share"), "least"
    )
    shares = written(shares, "shares")
    wide = shares.groupBy("query").pivot("part", list(range(len(parts)))).agg(F.first("share"))
    wide = written(wide.select("query", F.array(*(F.col(str(p)) for p in range(len(parts)))).alias("shares")), "shares-by-query")
    with_shares = written(_with_shares(asked_blocks, wide, count), "query-blocks-2")

    # phase 2
    columns = [f"s{p}" for p in range(len(parts))]
    entries = written(
        _paired(all_blocks, with_shares, count).mapInPandas(_above(width, parts), "query long, id long, " + ", ".join(f"{c} long" for c in columns)),
        "entries",
    )
    bounds = entries.join(wide, "query").select(
        "query",
        "id",
        *columns,
        sum(F.coalesce(c, F.col("shares")[p] - 1) for p, c in enumerate(columns)).alias("most"),
    )
    known = entries.join(shares.groupBy("query").pivot("part", list(range(len(parts)))).agg(F.first("least")), "query").select(
        "query", "id", sum(F.coalesce(F.col(c), F.col(str(p))) for p, c in enumerate(columns)).alias("lower")
    )
    best = Window.partitionBy("query").orderBy(F.desc("lower"), "id")
    second = (
        known.withColumn("place", F.row_number().over(best)).where(F.col("place") <= want)
        .groupBy("query").agg(F.when(F.count(F.lit(1)) >= want, F.min("lower")).alias("cutoff"))
    )
    alive = bounds.join(second, "query").where(F.col("cutoff").isNull() | (F.col("most") >= F.col("cutoff")))

    # phase 3
    complete = [F.col(c).isNotNull() for c in columns]
    done = complete[0]
    for c in complete[1:]:
        done = done & c
    alive = written(alive.select("query", "id", F.when(done, sum(F.col(c) for c in columns)).alias("score")), "alive")
    x = classes.select(F.col("id").alias("xi"), F.col("v").alias("x"))
    y = classes.select(F.col("id").alias("yi"), F.col("v").alias("y"))
    product = F.aggregate(
        F.zip_with("x", "y", lambda a, b: F.coalesce(a * b, F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda acc, z: acc + z
    )
    missing = (
        alive.where("score IS NULL").join(x, F.col("query") == F.col("xi")).join(y, F.col("id") == F.col("yi"))
        .select("query", "id", product.alias("score"))
    )
    scored = alive.where("score IS NOT NULL").unionByName(missing)
    class_best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = written(
        scored.withColumn("place", F.row_number().over(class_best)).where(F.col("place") <= want).select("query", "id", "score"), "top-classes"
    )

    # members
    member = (
        of_class.withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("vec_id"))).where(F.col("nth") <= want).drop("nth")
    )
    listed = top.join(member, "id").select("query", "vec_id", "score")
    own_best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("place", F.row_number().over(own_best)).where(F.col("place") <= want).select("query", "vec_id", "score")
    ranked = asked.join(listed, asked["id"] == listed["query"]).where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return ranked.select("query_id", "vec_id", "score", rank.alias("rank")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
