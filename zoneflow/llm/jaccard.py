"""N-gram Jaccard join by grouped prefixes.

Two texts link when their sets of word shingles have a Jaccard similarity of ``percent`` or more. With the shingles
of every set in one global order, similar sets share a shingle among the first n - ceil(percent n) + 1 (their
prefix), whatever the order is; an order by rarity leaves few candidates.

1. Counts. Every shingle of every document is counted (per task first, as sorted arrays; the shuffle moves some
   five bytes a shingle). What comes back is two bitmaps over shingle hashes, of a size bounded by ``max_bits``:
   occurs twice or more; occurs often. The order is (often, twice, hash). Two shingles in one place of a bitmap
   only make the order less sharp: it stays one function of the shingle, so no link is lost.
2. Prefixes. A shingle that occurs once has no partner, so only the repeated shingles of a prefix are indexed;
   documents without any drop out. Equal sets become one node, nodes with equal prefix and size one group.
3. Group pairs. Groups meet on an indexed shingle and pass the size and position bounds.
4. Members. Group pairs are expanded to nodes and verified on whole texts. First every group meets one group per
   shingle only; later rounds take just pairs whose nodes are still in different components, the last one all of
   them. So a family of n copies costs about n comparisons, and no link between two components is left out.

Defined results: null, empty and blank texts have an empty set, link with nothing and are their own component;
rows with equal ids are rows of their own, and a component's id is its smallest ``doc_id``; a null ``doc_id``
counts only where a component has no other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import fresh_name, written
from zoneflow.llm.components import components
from zoneflow.llm.shingles import shingle_set, similar

#: A shingle of more documents than this comes late in the order (a chunk's count is kept in one byte).
OFTEN = 128
CHUNK_SHINGLES = 500_000
SHINGLES_A_BUCKET = 500_000


def _bits_for(n: int, least: int) -> int:
    return max(least, (max(1, n) - 1).bit_length())


def _count_chunks(size: int, bucket_bits: int):
    """Task side of the counts: rows (bucket, sorted 32-bit rests of hashes, counts up to 255)."""

    def rows(sets: list[np.ndarray]) -> pd.DataFrame:
        hashes, counts = np.unique(np.concatenate(sets), return_counts=True)
        bucket = (hashes >> np.uint64(64 - bucket_bits)).astype(np.int64)
        rest = ((hashes << np.uint64(bucket_bits)) >> np.uint64(32)).astype("<u4")
        few = np.minimum(counts, 255).astype("u1")
        present, starts = np.unique(bucket, return_index=True)
        ends = [*starts[1:], len(bucket)]
        return pd.DataFrame(
            {
                "bucket": present,
                "rests": [rest[s:e].tobytes() for s, e in zip(starts, ends, strict=True)],
                "counts": [few[s:e].tobytes() for s, e in zip(starts, ends, strict=True)],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets, held = [], 0
        for batch in batches:
            for text in batch["text"]:
                one = shingle_set(text, size)
                sets.append(one)
                held += len(one)
                if held >= CHUNK_SHINGLES:
                    yield rows(sets)
                    sets, held = [], 0
        if held:
            yield rows(sets)

    return run


def _bucket_bitmaps(place_bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rests = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["rests"]])
        counts = np.concatenate([np.frombuffer(x, "u1") for x in pdf["counts"]])
        distinct, at = np.unique(rests, return_inverse=True)
        total = np.bincount(at, weights=counts)
        out = []
        for least in (2, OFTEN):
            flags = np.zeros(1 << place_bits, bool)
            flags[distinct[total >= least] >> np.uint32(32 - place_bits)] = True
            out.append(np.packbits(flags, bitorder="little").tobytes())
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "twice": [out[0]], "often": [out[1]]})

    return run


def _bitmaps(texts: DataFrame, size: int, max_bits: int) -> tuple[int, bytes, bytes]:
    """(log2 of the number of places, twice, often)."""
    about = texts.agg(F.sum(F.length("text") / 6)).first()[0] or 0
    bucket_bits = _bits_for(int(about / SHINGLES_A_BUCKET), 8)
    place_bits = max(3, min(max_bits, _bits_for(int(about / 2), 20)) - bucket_bits)
    made = (
        texts.select("text")
        .mapInPandas(_count_chunks(size, bucket_bits), "bucket long, rests binary, counts binary")
        .groupBy("bucket")
        .applyInPandas(_bucket_bitmaps(place_bits), "bucket long, twice binary, often binary")
    )
    width = (1 << place_bits) // 8
    maps = [bytearray(width << bucket_bits) for _ in range(2)]
    for row in made.toLocalIterator():
        for whole, part in zip(maps, (row["twice"], row["often"]), strict=True):
            whole[row["bucket"] * width : (row["bucket"] + 1) * width] = part
    return bucket_bits + place_bits, bytes(maps[0]), bytes(maps[1])


def _prefix_of(size: int, percent: int, bits: int, shared):
    """Per text: n and, only where the prefix has a repeated shingle, node, grp and that part of the prefix."""

    def flagged(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - bits)
        return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype("u1")) & 1

    @F.pandas_udf("n long, node binary, grp binary, first int, shingles array<long>")
    def prefix(texts: pd.Series) -> pd.DataFrame:
        twice, often = (np.frombuffer(x, "u1") for x in shared.value)
        rows = []
        for text in texts:
            hashes = shingle_set(text, size)
            n = len(hashes)
            length = n - -(-percent * n // 100) + 1
            rank = flagged(twice, hashes)
            first = n - int(rank.sum(dtype=np.int64))
            if not n or first >= length:
                rows.append((n, None, None, 0, None))
                continue
            rank = rank + flagged(often, hashes)
            chosen = hashes[np.argsort(rank, kind="stable")[:length]]
            node = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            grp = hashlib.blake2b(chosen.tobytes() + n.to_bytes(8, "little"), digest_size=16).digest()
            rows.append((n, node, grp, first, chosen[first:].view(np.int64)))
        return pd.DataFrame(rows, columns=["n", "node", "grp", "first", "shingles"])

    return prefix


def _verify(size: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[bytes, np.ndarray] = {}

        def set_of(node: bytes, text: str) -> np.ndarray:
            if node not in kept:
                if len(kept) >= 256:
                    kept.clear()
                kept[node] = shingle_set(text, size)
            return kept[node]

        for batch in batches:
            good = [
                similar(set_of(a, x), set_of(b, y), percent)
                for a, b, x, y in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"], strict=True)
            ]
            yield batch.loc[good, ["a", "b"]]

    return run


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _places_fit(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes must share ``percent / (100 + percent)`` of their summed sizes, so one shared shingle at least
    stands where that many still can follow in both: in their prefixes for each other's size."""
    return (100 + percent) * F.least(a["n"] - a["pos"], b["n"] - b["pos"]) >= percent * (a["n"] + b["n"])


class _Join:
    """The written tables of one join: nodes (node, doc_id, n, grp), texts, index (shingle, entry(first, n, pos, grp)).

    The least entry of a shingle is that with the fewest shingles of its own: of a family of copies, the original or
    what is nearest to it, to which most of the others link.
    """

    def __init__(self, prefixes: DataFrame, size: int, percent: int):
        self.size, self.percent = size, percent
        members = prefixes.where("node IS NOT NULL")
        self.nodes = written(
            members.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("grp").alias("grp")), "nodes"
        )
        self.members = members
        groups = members.select("grp", "n", "first", "shingles").dropDuplicates(["grp"])
        self.index = written(
            groups.select("grp", "n", "first", F.posexplode("shingles").alias("i", "shingle")).select(
                "shingle", F.struct("first", "n", (F.col("first") + F.col("i")).alias("pos"), "grp").alias("entry")
            ),
            "index",
        )
        self.texts = written(members.select("node", "text").dropDuplicates(["node"]), "texts")

    def verified(self, pairs: DataFrame) -> DataFrame:
        a = self.texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        b = self.texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInPandas(
            _verify(self.size, self.percent), "a binary, b binary"
        )

    def _open_index(self, labels: DataFrame) -> DataFrame:
        """The index where it still joins components: low and high are the least and greatest label of a group."""
        ranges = (
            self.nodes.join(labels, "node", "left")
            .select("grp", F.coalesce("label", "node").alias("label"))
            .groupBy("grp")
            .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        )
        ranged = self.index.join(ranges.withColumnRenamed("grp", "g"), F.col("entry.grp") == F.col("g")).drop("g")
        # written, so that the join is one of two shuffles and a common shingle's rows can be split
        opened = written(
            ranged.groupBy("shingle").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l < h").select("shingle"),
            "open-shingles",
        )
        return written(ranged.join(opened, "shingle"), "open-index")

    def pairs(self, labels: DataFrame, leader) -> DataFrame:
        """Node pairs (a < b) with different labels; ``leader`` picks one group per shingle (None: all pairs)."""
        rows = self._open_index(labels)
        left = rows.select("shingle", F.col("entry").alias("x"), F.col("low").alias("xl"), F.col("high").alias("xh"))
        if leader is None:
            right = rows.select("shingle", F.col("entry").alias("y"), F.col("low").alias("yl"), F.col("high").alias("yh"))
            apart = F.col("x.grp") < F.col("y.grp")
        else:
            best = leader(F.struct("entry", "low", "high")).alias("lead")
            right = written(
                rows.groupBy("shingle").agg(best).select(
                    "shingle", F.col("lead.entry").alias("y"), F.col("lead.low").alias("yl"), F.col("lead.high").alias("yh")
                ),
                "leaders",
            )
            apart = F.col("x.grp") != F.col("y.grp")
        x, y = F.col("x"), F.col("y")
        one_label = (F.col("xl") == F.col("xh")) & (F.col("yl") == F.col("yh")) & (F.col("xl") == F.col("yl"))
        group_pairs = (
            left.join(right, (left["shingle"] == right["shingle"]) & apart & ~one_label)
            .where(_sizes_fit(x["n"], y["n"], self.percent) & _places_fit(x, y, self.percent))
            .groupBy(F.col("x.grp").alias("g"), F.col("y.grp").alias("h"))
            .agg(F.count(F.lit(1)).alias("common"))
        )
        if leader is None:
            group_pairs = group_pairs.select("g", "h")
        else:  # of its shingles' leaders, a group tries the one with which it shares most
            nearest = F.max(F.struct("common", "h"))["h"]
            group_pairs = group_pairs.groupBy("g").agg(nearest.alias("h"))
        within = self.nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("grp").alias("g"), F.col("grp").alias("h"))
        node = self.nodes.join(labels, "node", "left").select("node", "grp", F.coalesce("label", "node").alias("label"))
        xs = node.select(F.col("grp").alias("g"), F.col("node").alias("p"), F.col("label").alias("pl"))
        if leader is None:
            ys = node.select(F.col("grp").alias("h"), F.col("node").alias("q"), F.col("label").alias("ql"))
        else:  # one member stands for the leading group; written, so that a hot group's pairs can be split
            ys = written(
                node.groupBy(F.col("grp").alias("h")).agg(leader(F.struct("node", "label")).alias("m")).select(
                    "h", F.col("m.node").alias("q"), F.col("m.label").alias("ql")
                ),
                "leading-members",
            )
        return (
            written(group_pairs.unionByName(within).join(xs, "g"), "group-pairs")
            .join(ys, "h")
            .where("pl != ql")
            .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
            .distinct()
        )


def similar_components(docs: DataFrame, percent: int = 75, size: int = 5, max_bits: int = 29) -> DataFrame:
    """(doc_id, n_shingles, component_id, node) for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    bits, twice, often = _bitmaps(docs, size, max_bits)
    shared = spark.sparkContext.broadcast((twice, often))
    prefixes = written(
        docs.select("doc_id", "text", _prefix_of(size, percent, bits, shared)("text").alias("p")).select(
            "doc_id", "p.*", F.when(F.col("p.node").isNotNull(), F.col("text")).alias("text")
        ),
        "prefixes",
    )
    join = _Join(prefixes, size, percent)

    labels = spark.createDataFrame([], "node binary, label binary")
    checked = None
    for turn, leader in enumerate((F.min, F.max, None)):
        pairs = join.pairs(labels, leader)
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = written(pairs, f"pairs-{turn}")
        checked = pairs if checked is None else checked.unionByName(pairs)
        links = written(join.verified(pairs), f"links-{turn}")
        label_of = join.nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
        u = label_of.select(F.col("node").alias("a"), F.col("label").alias("u"))
        v = label_of.select(F.col("node").alias("b"), F.col("label").alias("v"))
        merged = components(links.join(u, "a").join(v, "b").select("u", "v"))
        labels = written(
            label_of.join(merged.select(F.col("node").alias("label"), "root"), "label", "left").select(
                "node", F.coalesce("root", "label").alias("label")
            ),
            "labels",
        )
    named = join.nodes.join(labels, "node")
    # written, so that the join below is one of two shuffles and the rows of a large component can be split
    least = written(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "component-ids")
    ids = named.join(least, "label").select(F.col("node").alias("of"), "component_id")
    return prefixes.join(ids, F.col("node") == F.col("of"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "node",
    )


def digest(result: DataFrame) -> DataFrame:
    """The columns of query op6."""
    return result.select("doc_id", "n_shingles", "component_id")


def _ids_bitmap(ids: DataFrame, max_bits: int) -> tuple[int, np.ndarray]:
    """(log2 of its places, words of 64 bits) of a bitmap over the hashes of the one column of ``ids``."""
    bits = min(max_bits, max(10, (16 * ids.count()).bit_length()))
    place = F.shiftrightunsigned(F.xxhash64(ids.columns[0]), 64 - bits)
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = ids.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("held")).toPandas()
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[words["word"].to_numpy(np.int64)] = words["held"].to_numpy(np.int64)
    return bits, bitmap


def _maybe_in(column: Column, bits: int, shared) -> Column:
    """False only for values that surely are not in the bitmap."""

    def look(hashes: pd.Series) -> pd.Series:
        place = hashes.to_numpy(np.int64).view(np.uint64) >> np.uint64(64 - bits)
        word = shared.value[(place >> np.uint64(6)).astype(np.int64)].view(np.uint64)
        return pd.Series((word >> (place & np.uint64(63))) & np.uint64(1) == 1)

    look.__annotations__ = {"hashes": pd.Series, "return": pd.Series}
    return F.pandas_udf(look, "boolean")(F.xxhash64(column))


def one_of_each(docs: DataFrame, percent: int = 75, size: int = 5, max_bits: int = 29) -> DataFrame:
    """The rows of ``docs``, all columns, that are the smallest id of their component. An id stands for one document:
    of rows with equal ids one stays.

    Most rows stay. A bitmap of at most ``2 ** max_bits`` bits over the ids that go or repeat is broadcast; rows it does not
    know are kept where they are, and only the others meet the list of those ids. Full, it only sends more rows there.
    """
    result = written(similar_components(docs, percent, size, max_bits).select("doc_id", "component_id"), "components")
    least = F.max(F.col("doc_id").eqNullSafe(F.col("component_id")))
    name = fresh_name(docs, "marked_id")
    marked = written(
        result.groupBy(F.col("doc_id").alias(name))
        .agg(least.alias(f"{name}_kept"), F.count(F.lit(1)).alias(f"{name}_rows"))
        .where(~F.col(f"{name}_kept") | (F.col(f"{name}_rows") > 1)),
        "marked",
    )
    bits, bitmap = _ids_bitmap(marked.select(name), max_bits)
    known = _maybe_in(docs["doc_id"], bits, docs.sparkSession.sparkContext.broadcast(bitmap))
    doubtful = docs.where(known)
    same = doubtful["doc_id"].eqNullSafe(F.col(name))
    several = doubtful.join(marked.where(F.col(f"{name}_kept")), same, "left_semi").dropDuplicates(["doc_id"])
    return docs.where(~known).unionByName(doubtful.join(marked, same, "left_anti")).unionByName(several)


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, link.b FROM r JOIN link ON link.a = r.b)
  SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, reach.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id
"""
