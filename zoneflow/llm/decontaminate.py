"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Every benchmark item is cut into windows (10 consecutive words; a shorter item is one window). A window occurs
in a document only if all of its word shingles do, so one shingle is a sufficient prefix: the rarest one, by its
count over all documents. Documents meet windows on that shingle alone; the shingle's place gives the only place
at which the window can start, which must lie inside the document (length and position). Until then only hashes and
places are moved; the words of the documents left are then fetched once and compared one by one.

Defined results: null and empty texts have no words and no hits; an item without words has no window; a null
``item_id`` marks words but is not counted or listed; identical rows and rows with equal ids give one row each;
an empty table on either side gives documents without hits. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.llm.common import ascii_lower, fresh_name, written

#: A word, once A-Z is in lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same runs in text that still has capitals.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _shingles(tokens: Column, size: int) -> Column:
    """Structs (pos, size, h) of every run of ``size`` words."""
    last = F.size(tokens) - size
    made = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("pos"),
            F.lit(size).alias("size"),
            F.xxhash64(F.lit(size), *(F.get(tokens, i + k) for k in range(size))).alias("h"),
        ),
    )
    return F.when(last >= 0, made).otherwise(F.array().cast("array<struct<pos:int,size:int,h:bigint>>"))


def _all_shingles(tokens: Column, sizes: list[int]) -> Column:
    return F.concat(*(_shingles(tokens, k) for k in sizes))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, win: array of words) for every window of every item."""
    tokens = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return tokens.select("item_id", "w", F.explode(starts).alias("s")).select(
        "item_id", F.slice("w", F.col("s") + 1, F.lit(window)).alias("win")
    )


def find_windows(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """Verified occurrences: (doc_id, content, start, length, win); ``content`` is the text's hash."""
    windows = written(item_windows(items, window), "windows")
    distinct = windows.select("win").distinct()
    # at most ``shingle`` values, whatever the number of items
    sizes = [r[0] for r in windows.select(F.least(F.size("win"), F.lit(shingle)).alias("k")).distinct().collect()]
    sizes = sorted(sizes) or [shingle]
    tokens = distinct.select(
        "win", F.explode(_all_shingles(F.col("win"), sizes)).alias("t")
    ).where(F.col("t.size") == F.least(F.size("win"), F.lit(shingle))).select("win", "t.pos", "t.h")
    wanted = written(tokens.select("h").distinct(), "window-shingles")

    cut = docs.select("doc_id", F.xxhash64("text").alias("content"), words(F.col("text")).alias("w"))
    seen = written(
        cut.select("doc_id", "content", F.explode(_all_shingles(F.col("w"), sizes)).alias("t"))
        .select("doc_id", "content", F.col("t.pos").alias("pos"), F.col("t.h").alias("h"))
        .join(wanted, "h"),
        "shingles-seen",
    )
    rarity = seen.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    # a window with a shingle that no document has cannot occur: the inner join drops that shingle, the count the window
    prefix = (
        tokens.join(rarity, "h")
        .groupBy("win")
        .agg(F.min(F.struct("n", "pos", "h")).alias("rarest"), F.count(F.lit(1)).alias("known"))
        .where(F.col("known") == F.size("win") - F.least(F.size("win"), F.lit(shingle)) + 1)
        .select("win", F.col("rarest.pos").alias("at"), F.col("rarest.h").alias("h"))
    )
    start = F.col("pos") - F.col("at")
    possible = seen.join(prefix, "h").where(start >= 0).select("doc_id", "content", F.struct(start.alias("start"), "win").alias("c"))
    # at most a document's own places, and as many windows as begin alike at each
    candidates = written(
        possible.groupBy(F.col("doc_id").alias("of_id"), F.col("content").alias("of_content")).agg(F.collect_set("c").alias("cs")), "candidates"
    )
    # the words of a document come once more, and only those of documents with a candidate
    texts = docs.select("doc_id", F.xxhash64("text").alias("content"), "text").join(
        candidates, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("content") == F.col("of_content"))
    )
    placed = texts.select("doc_id", "content", "cs", words(F.col("text")).alias("w")).select(
        "doc_id", "content", "w", F.explode("cs").alias("c")
    )
    length = F.size("c.win")
    return placed.where(
        (F.col("c.start") + length <= F.size("w")) & (F.slice("w", F.col("c.start") + 1, length) == F.col("c.win"))
    ).select("doc_id", "content", F.col("c.start").alias("start"), length.alias("length"), F.col("c.win").alias("win"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """Per document row: n_words, n_hit (words inside any occurrence), item_ids (sorted as strings), contaminated.

    ``docs`` needs doc_id and text, ``items`` item_id and text.
    """
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    found = written(find_windows(docs, items, window, shingle), "windows-found")
    key = ["doc_id", "content"]
    end = F.col("start") + F.col("length")
    before = F.max(end).over(Window.partitionBy(*key).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        found.select(*key, "start", "length")
        .distinct()
        .select(*key, F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0)))).alias("fresh"))
        .groupBy(*key)
        .agg(F.sum("fresh").alias("n_hit"))
    )
    owners = item_windows(items, window).distinct()
    listed = (
        found.select(*key, "win")
        .distinct()
        .join(owners, "win")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    hits = covered.join(listed, [covered[k].eqNullSafe(listed[k]) for k in key], "left").select(
        covered["doc_id"].alias("hit_id"), covered["content"].alias("hit_content"), "n_hit", "item_ids"
    )
    counted = docs.select(
        "doc_id",
        F.xxhash64("text").alias("content"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_ANY_CASE)), F.lit(0)).cast("long").alias("n_words"),
    )
    return counted.join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("content") == F.col("hit_content")), "left"
    ).select(
        "doc_id",
        "content",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def digest(result: DataFrame) -> DataFrame:
    """The columns of query op7."""
    return result.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, without contaminated documents."""
    found = find_windows(docs.select("doc_id", "text"), items.select("item_id", "text"), window, shingle)
    bad_id, bad_content = fresh_name(docs, "bad_id"), fresh_name(docs, "bad_content")
    bad = written(found.select(F.col("doc_id").alias(bad_id), F.col("content").alias(bad_content)).distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(F.col(bad_id)) & (F.xxhash64(docs["text"]) == F.col(bad_content))
    return docs.join(bad, same, "left_anti")


_DUCK_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH iw AS (SELECT item_id, {_DUCK_WORDS} AS w FROM benchmark),
ww AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s : s + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, {_DUCK_WORDS} AS w FROM documents),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM dw WHERE len(w) > 0),
hit AS (
  SELECT d.doc_id, d.s, x.l, x.win
  FROM (SELECT dp.doc_id, dp.s, ls.l, array_to_string(dp.w[dp.s : dp.s + ls.l - 1], ' ') AS piece
        FROM dp, (SELECT DISTINCT l FROM ww) ls WHERE dp.s + ls.l - 1 <= len(dp.w)) d
  JOIN (SELECT DISTINCT l, win FROM ww) x ON x.l = d.l AND x.win = d.piece),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM hit) GROUP BY 1),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT hit.doc_id, CAST(ww.item_id AS VARCHAR) AS i FROM hit JOIN ww ON ww.win = hit.win AND ww.l = hit.l) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
