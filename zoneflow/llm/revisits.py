"""WARC: not-modified revisits resolved against the latest earlier full response of the same canonical URL.

A revisit stands for a fetch that was answered "not modified". It is resolved by an as-of join: the latest full response of
its canonical URL that is strictly earlier. The validators both carry must agree (entity tags by weak comparison,
else the time of last change); a revisit without any validator is taken for a response without any. The resolved
headers are those of the response, renewed by what a not-modified answer may carry.

Records are dealt out by ranges of (URL, time), so the captures of a hot URL spread over as many partitions as
they need. In every partition the latest response is found by a window; what a URL's earlier partitions hand on is one row
each: the latest response and the latest one at an earlier time. Payloads are never moved, only validators, digests and headers.

Defined results: records without a URL or a time resolve to nothing and are nothing's response; of responses of one
URL and time the one with the greatest record id counts; identical records are resolved one by one; a null header
map is empty; empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.llm.common import written

# Headers that describe the stored payload or one connection; a revisit does not renew them.
KEPT_HEADERS = (
    "connection content-encoding content-length content-md5 content-range content-type keep-alive proxy-authenticate"
    " proxy-authorization te trailer transfer-encoding upgrade"
).split()
# Query parameters that do not change the content.
TRACKING = "ref utm_source utm_medium utm_campaign utm_term utm_content gclid fbclid sessionid phpsessid".split()

RECORD = ("record_id", "kind", "url", "at", "etag", "last_modified", "digest", "headers")


def canonical_url(url: Column) -> Column:
    """Without scheme, "www.", default port, fragment, tracking parameters and a closing slash; host in lower case, parameters sorted."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(TRACKING))
    )
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _opaque(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def validators_agree(revisit: Column, response: Column) -> Column:
    tags = revisit["etag"].isNotNull() & response["etag"].isNotNull()
    times = revisit["last_modified"].isNotNull() & response["last_modified"].isNotNull()
    bare = revisit["etag"].isNull() & revisit["last_modified"].isNull()
    bare_too = response["etag"].isNull() & response["last_modified"].isNull()
    return (
        F.when(tags, _opaque(revisit["etag"]) == _opaque(response["etag"]))
        .when(times, revisit["last_modified"] == response["last_modified"])
        .otherwise(bare & bare_too)
    )


def merged_headers(response: Column, revisit: Column) -> Column:
    """Names in lower case. Of names that differ only in case the first one counts."""

    def small(headers: Column) -> Column:
        entries = F.map_entries(F.coalesce(headers, F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")))
        lower = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
        names = F.transform(lower, lambda e: e["key"])
        return F.filter(lower, lambda e, i: F.array_position(names, e["key"]) == i + 1)

    new = F.filter(small(revisit), lambda e: ~e["key"].isin(KEPT_HEADERS))
    renewed = F.transform(new, lambda e: e["key"])
    old = F.filter(small(response), lambda e: ~F.array_contains(renewed, e["key"]))
    return F.map_from_entries(F.array_sort(F.concat(old, new)))


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, url_key, state, response_id, digest, headers) of every revisit in ``records`` (RECORD; kind is
    "response" or "revisit", at and last_modified ordered values). state: resolved, mismatch or none; response_id is the
    response looked at, digest and headers are those of resolved revisits."""
    keyed = records.select(*RECORD, F.when(F.col("at").isNotNull(), canonical_url(F.col("url"))).alias("url_key"))
    dealt = keyed.select("record_id", "kind", "at", "url_key").repartitionByRange("url_key", "at", "record_id")
    placed = written(dealt.withColumn("part", F.spark_partition_id()), "captures")
    is_response = F.col("kind") == "response"
    # of the two greatest times of a part's responses the best one each: a revisit at the greatest time needs the one before
    by_time = placed.where(is_response & F.col("url_key").isNotNull()).groupBy("url_key", "part", "at").agg(F.max("record_id").alias("id"))
    newest_first = F.row_number().over(Window.partitionBy("url_key", "part").orderBy(F.desc("at")))
    two = by_time.withColumn("n", newest_first).where("n <= 2").withColumn("r", F.struct("at", "id"))
    handed = two.groupBy("url_key", "part").agg(F.max(F.when(F.col("n") == 1, F.col("r"))).alias("l"), F.max(F.when(F.col("n") == 2, F.col("r"))).alias("p"))
    # where equal times go on over several parts, the response before them is that of the part they begin in
    by_part = Window.partitionBy("url_key").orderBy("part")
    left = F.lag("l").over(by_part)
    begins = left.isNull() | (left["at"] < F.col("l.at"))
    handed = handed.withColumn("p", F.when(begins, F.coalesce("p", left))).select(
        "url_key", "part", F.struct(F.col("l.at").alias("at"), F.col("l.id").alias("id"), F.last("p.id", ignorenulls=True).over(by_part).alias("prior")).alias("h")
    )
    parts = placed.where("url_key IS NOT NULL").select("url_key", "part").distinct().join(handed, ["url_key", "part"], "left")
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("url_key", "part", F.last("h", ignorenulls=True).over(earlier).alias("b"))
    # of equal times the revisit stands first: only strictly earlier responses count
    within = Window.partitionBy("url_key", "part").orderBy("at", F.desc("kind"), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    asof = (
        placed.where("url_key IS NOT NULL")
        .withColumn("w", F.last(F.when(is_response, F.struct("at", "record_id")), ignorenulls=True).over(within))
        .where("kind = 'revisit'")
        .join(before, ["url_key", "part"], "left")
        # a partition may end between a response and a revisit of the same time
        .select("record_id", "at", F.coalesce("w.record_id", F.when(F.col("b.at") < F.col("at"), F.col("b.id")).otherwise(F.col("b.prior"))).alias("response_id"))
        .distinct()
    )
    revisit = keyed.where("kind = 'revisit'").select(
        "record_id", "url_key", F.struct("etag", "last_modified", "headers", "at").alias("r")
    )
    # written, so that the join is one of two shuffles and the revisits of a hot response can be split
    response = written(
        keyed.where("kind = 'response'")
        .select(F.col("record_id").alias("found_id"), F.struct("etag", "last_modified", "digest", "headers").alias("s"))
        .dropDuplicates(["found_id"]),
        "responses",
    )
    asof = asof.select(F.col("record_id").alias("of"), F.col("at").alias("of_at"), "response_id")
    # what has no response is spread by itself, else all of it would meet under the null key
    alone = F.when(F.col("response_id").isNull(), F.xxhash64("record_id")).otherwise(0)
    joined = (
        revisit.join(asof, (F.col("record_id") == F.col("of")) & (F.col("r.at") == F.col("of_at")), "left")
        .withColumn("alone", alone)
        .join(response.withColumn("never", F.lit(0).cast("long")), (F.col("response_id") == F.col("found_id")) & (F.col("alone") == F.col("never")), "left")
    )
    good = F.col("s").isNotNull() & validators_agree(F.col("r"), F.col("s"))
    return joined.select(
        "record_id",
        "url_key",
        F.when(F.col("s").isNull(), "none").when(good, "resolved").otherwise("mismatch").alias("state"),
        "response_id",
        F.when(good, F.col("s.digest")).alias("digest"),
        F.when(good, merged_headers(F.col("s.headers"), F.col("r.headers"))).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Capture records of ``pages``: a full response each, an earlier revisit, two later ones by other spellings of the
    URL (one with a weak tag, one with only the time of last change), and for every third page one whose tag has changed."""
    hash_ = F.md5(F.col("html").cast("binary"))
    base = F.col("page_id") * 7919 % 1_000_003 + 1_700_000_000
    tag = F.concat(F.lit('"'), F.substr(hash_, F.lit(1), F.lit(16)), F.lit('"'))

    def record(n: int, kind: str, after: int, url: Column, etag: Column, modified: Column, headers: dict[str, Column]) -> Column:
        return F.struct(
            (F.col("page_id") * 8 + n).alias("record_id"),
            F.lit(kind).alias("kind"),
            url.alias("url"),
            (base + after).alias("at"),
            etag.alias("etag"),
            modified.alias("last_modified"),
            F.when(F.lit(kind == "response"), F.sha2(F.col("html").cast("binary"), 256)).alias("digest"),
            F.create_map(*(x for k, v in headers.items() for x in (F.lit(k), v))).alias("headers"),
        )

    none, url = F.lit(None).cast("string"), F.col("url")
    modified = base - 86_400
    when = lambda after: (base + after).cast("string")
    length = F.length(F.col("html").cast("binary")).cast("string")
    made = [
        record(0, "response", 0, url, tag, modified, {"Date": when(0), "Content-Type": F.lit("text/html"), "Content-Length": length, "Cache-Control": F.lit("max-age=60")}),
        record(1, "revisit", -1800, url, tag, modified, {"Date": when(-1800)}),
        record(2, "revisit", 3600, F.concat(url, F.lit("#again")), F.concat(F.lit("W/"), tag), F.lit(None).cast("long"), {"Date": when(3600), "Content-Length": F.lit("0")}),
        record(3, "revisit", 7200, F.regexp_replace(url, "^https?://", "HTTP://WWW."), none, modified, {"date": when(7200), "Cache-Control": F.lit("max-age=90")}),
        record(4, "revisit", 9000, url, F.lit('"other"'), modified, {"Date": when(9000)}),
    ]
    rows = pages.select(F.explode(F.array(*made)).alias("r")).select("r.*")
    return rows.where((F.col("record_id") % 8 != 4) | (F.floor(F.col("record_id") / 8) % 3 == 0))


def digest(resolved: DataFrame) -> DataFrame:
    """The columns of query op1: headers as sorted "name=value" lines."""
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return resolved.select("record_id", "url_key", "state", "response_id", "digest", F.array_join(F.array_sort(lines), "\n").alias("headers"))


SQL = r"""
WITH b AS (SELECT page_id, url, html, (page_id * 7919) % 1000003 + 1700000000 AS t, '"' || substr(md5(html), 1, 16) || '"' AS tag FROM pages),
rec AS (
  SELECT page_id * 8 AS record_id, 'response' AS kind, url, t AS at, tag AS etag, t - 86400 AS lm, sha256(html) AS digest,
    [('date', t::VARCHAR), ('content-type', 'text/html'), ('content-length', strlen(html)::VARCHAR), ('cache-control', 'max-age=60')] AS h FROM b
  UNION ALL SELECT page_id * 8 + 1, 'revisit', url, t - 1800, tag, t - 86400, NULL, [('date', (t - 1800)::VARCHAR)] FROM b
  UNION ALL SELECT page_id * 8 + 2, 'revisit', url || '#again', t + 3600, 'W/' || tag, NULL, NULL, [('date', (t + 3600)::VARCHAR)] FROM b
  UNION ALL SELECT page_id * 8 + 3, 'revisit', regexp_replace(url, '^https?://', 'HTTP://WWW.'), t + 7200, NULL, t - 86400, NULL, [('date', (t + 7200)::VARCHAR), ('cache-control', 'max-age=90')] FROM b
  UNION ALL SELECT page_id * 8 + 4, 'revisit', url, t + 9000, '"other"', t - 86400, NULL, [('date', (t + 9000)::VARCHAR)] FROM b WHERE page_id % 3 = 0),
u AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM rec),
k AS (
  SELECT * EXCLUDE (rest), regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
         lambda p: p <> '' AND lower(string_split(p, '=')[1]) NOT IN ('ref', 'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'gclid', 'fbclid', 'sessionid', 'phpsessid'))), '&'), ''), '') AS url_key
  FROM u),
s AS (SELECT * FROM k WHERE kind = 'response'),
m AS (
  SELECT v.record_id, v.url_key, v.etag, v.lm, v.h, s.record_id AS response_id, s.etag AS s_etag, s.lm AS s_lm, s.digest, s.h AS s_h,
    row_number() OVER (PARTITION BY v.record_id ORDER BY s.at DESC, s.record_id DESC) AS n
  FROM (SELECT * FROM k WHERE kind = 'revisit') v LEFT JOIN s ON s.url_key = v.url_key AND s.at < v.at),
o AS (
  SELECT *, response_id IS NOT NULL AND CASE WHEN etag IS NOT NULL AND s_etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = regexp_replace(s_etag, '^W/', '')
      WHEN lm IS NOT NULL AND s_lm IS NOT NULL THEN lm = s_lm ELSE etag IS NULL AND lm IS NULL AND s_etag IS NULL AND s_lm IS NULL END AS good
  FROM m WHERE n = 1),
l AS (
  SELECT record_id, string_agg(x[1] || '=' || x[2], chr(10) ORDER BY x[1] || '=' || x[2]) AS headers
  FROM (SELECT record_id, unnest(list_concat(h, list_filter(s_h, lambda y: NOT list_contains(list_transform(h, lambda z: z[1]), y[1])))) AS x FROM o WHERE good) GROUP BY 1)
SELECT o.record_id, url_key, CASE WHEN response_id IS NULL THEN 'none' WHEN good THEN 'resolved' ELSE 'mismatch' END AS state,
  response_id, CASE WHEN good THEN digest END AS digest, l.headers
FROM o LEFT JOIN l USING (record_id)
"""
