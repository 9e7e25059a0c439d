"""Not-modified revisits of web captures, resolved to the full responses that they refer to.

A 304 answer has no body: it says that the latest full response still holds. For each one, the latest earlier full
response of the same canonical URL is found by an as-of join, the validators of both are compared, and
the headers that a 304 may carry replace those of the response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom.operators.skew import spread_join

# Header fields that a 304 answer carries for the stored response (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that track visitors and do not name a page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
#: Stretches that the time of captures is cut into, so that one URL's captures spread over tasks.
STRETCHES = 512
#: The share of captures before the first and after the last stretch that is cut at equal widths.
EDGE = 0.001


def canonical_url(url: Column) -> Column:
    """A URL without scheme, user, ``www.``, default port, fragment, trailing slashes and tracking parameters, with the
    host in lower case and the parameters sorted. Null stays null."""
    rest = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    head = F.regexp_extract(rest, "^([^/?]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(head), "^[^@]*@", ""), ":(80|443)$", "")
    tail = F.substr(rest, F.char_length(head) + 1)
    path = F.regexp_replace(F.regexp_extract(tail, "^([^?]*)", 1), "/+$", "")
    parameters = F.filter(
        F.split(F.regexp_extract(tail, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING))
    )
    query = F.array_join(F.array_sort(parameters), "&")
    return F.concat(
        F.regexp_replace(host, "^www[0-9]*\\.", ""), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    )


def _tag(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(etag), "^[Ww]/", "")


def _named(record: Column, mark: Column) -> Column:
    return F.concat(F.coalesce(record.cast("string"), F.lit("")), F.lit("/"), mark.cast("string"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row for each 304 record of ``records`` (columns ``record_id`` long, ``url``, ``captured_at`` timestamp, ``status`` int,
    ``headers`` map<string,string> with lower-case names, and ``payload``): ``record_id``, ``canonical``, ``captured_at``,
    ``outcome``, ``refers_to`` (the response's record), ``age_seconds``, ``payload_digest`` and merged ``headers``.

    Outcomes: ``matched`` (entity tags, or else modification dates, agree), ``unchecked`` (the 304 has no validator
    that the response has too), ``mismatch`` (they differ: not resolved, no headers) and ``no_response`` (none is
    earlier). A response of the same instant is not earlier; of several at one instant the one with the
    largest record id counts (of repeated ids, that of the greatest validators, payload and headers). Records without URL or time
    match nothing. Missing headers are an empty map. Repeated 304 rows give a row each, with the headers of that row. An
    empty table gives no rows; other columns are not read.
    """
    headers = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    base = records.select("record_id", canonical_url(F.col("url")).alias("canonical"), "captured_at", "status", headers.alias("headers"), "payload")
    base = base.withColumn("mark", F.xxhash64(F.array_sort(F.map_entries("headers"))))  # tells rows of one record id apart
    low, high = records.agg(
        F.percentile_approx(F.unix_micros("captured_at"), F.lit(EDGE)), F.percentile_approx(F.unix_micros("captured_at"), F.lit(1 - EDGE))
    ).first()
    width = (max(1, high - low + 1) if low is not None else 1) / STRETCHES
    # captures before and after the bulk of them, a few in a thousand, are in the first and the last stretch
    stretch = F.greatest(F.lit(0), F.least(F.lit(STRETCHES - 1), F.floor((F.unix_micros("captured_at") - (low or 0)) / width))).cast("int")
    new = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    every = base.where("status in (200, 304)").select(
        "record_id",
        F.col("canonical").alias("_url"),
        "captured_at",
        stretch.alias("_stretch"),
        F.when(F.col("status") == 304, new).alias("_new"),
        "mark",
        F.col("headers")["etag"].alias("_etag"),
        F.col("headers")["last-modified"].alias("_modified"),
        (F.col("status") == 200).alias("_full"),
        F.when(F.col("status") == 200, F.sha1(F.coalesce("payload", F.lit("")))).alias("_digest"),
    )
    known = F.col("_url").isNotNull() & F.col("captured_at").isNotNull()
    response = F.struct("captured_at", "record_id", "_etag", "_modified", "_digest", "mark")
    thin = every.where(known).withColumn("_response", F.when(F.col("_full"), response))
    # the last response of each stretch, carried on to the stretches after it
    ends = thin.groupBy("_url", "_stretch").agg(F.max("_response").alias("_last"))
    before = W.partitionBy("_url").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(F.col("_url").alias("_u"), F.col("_stretch").alias("_s"), F.max("_last").over(before).alias("_carried"))
    # within a stretch the 304s of an instant stand before its responses
    inside = W.partitionBy("_url", "_stretch").orderBy("captured_at", "_full", "record_id").rowsBetween(W.unboundedPreceding, -1)
    found = thin.withColumn("_in", F.max("_response").over(inside)).where("not _full")
    found = found.join(carried, (F.col("_url") == F.col("_u")) & (F.col("_stretch") == F.col("_s")), "left")
    found = found.withColumn("_r", F.coalesce("_in", "_carried"))
    # records without URL or time meet nothing, so they do not go through the windows
    nowhere = every.where(~known & ~F.col("_full")).withColumn("_r", F.lit(None).cast(found.schema["_r"].dataType))
    found = found.select(*nowhere.columns).unionByName(nowhere)
    tags = _tag(F.col("_etag")) == _tag(F.col("_r._etag"))
    outcome = (
        F.when(F.col("_r").isNull(), "no_response")
        .when(tags.isNotNull(), F.when(tags, "matched").otherwise("mismatch"))
        .when((F.col("_modified") == F.col("_r._modified")), "matched")
        .when((F.col("_modified") != F.col("_r._modified")), "mismatch")
        .otherwise("unchecked")
    )
    judged = found.select(
        "record_id", F.col("_url").alias("canonical"), "captured_at", outcome.alias("outcome"), F.col("_r.record_id").alias("refers_to"),
        ((F.unix_micros("captured_at") - F.unix_micros("_r.captured_at")) / 1_000_000).alias("age_seconds"),
        F.col("_r._digest").alias("payload_digest"), "_new", _named(F.col("_r.record_id"), F.col("_r.mark")).alias("_to"),
    )
    # the response's headers are fetched by record for resolved rows only; one response may be referred to by very many
    resolved = F.col("outcome").isin("matched", "unchecked")
    open_ = judged.where(~resolved)
    stored = base.where("status = 200").groupBy(_named(F.col("record_id"), F.col("mark")).alias("_to")).agg(F.first("headers").alias("_stored"))
    full = spread_join(judged.where(resolved), stored, ["_to"], [F.col("record_id"), F.col("captured_at")], "inner")
    kept = F.map_filter("_stored", lambda k, v: ~F.coalesce(F.map_contains_key("_new", k), F.lit(False)))
    names = [c for c in judged.columns if c not in ("_new", "_to")]
    full = full.select(*names, F.map_concat(kept, "_new").alias("headers"))
    return full.unionByName(open_.select(*names, F.lit(None).cast("map<string,string>").alias("headers")))


def crawl(pages: DataFrame) -> DataFrame:
    """Capture records made of the pages, all of them: a full response of each page, and two later 304 answers of
    differently written URLs, some of them with another entity tag, with dates only, or without validators; one page in
    eleven is asked before it was ever answered."""
    n = F.col("page_id")
    at = lambda shift: F.timestamp_seconds(F.lit(1_700_000_000) + n + shift)
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    day = F.concat(F.lit("day "), (n % 1000).cast("string"))
    full = pages.select(
        (n * 4).alias("record_id"), "url", at(0).alias("captured_at"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("etag"), tag, F.lit("last-modified"), day, F.lit("content-type"), F.lit("text/html"),
            F.lit("content-length"), F.octet_length("html").cast("string"), F.lit("cache-control"), F.lit("max-age=60"),
        ).alias("headers"),
        F.col("html").alias("payload"),
    )
    again = pages.select(
        (n * 4 + 1).alias("record_id"), F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")).alias("url"),
        at(F.when(n % 11 == 0, -5_000_000).otherwise(86_400)).alias("captured_at"), F.lit(304).alias("status"),
        F.create_map(
            F.lit("etag"), F.when(n % 7 == 3, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag)),
            F.lit("cache-control"), F.lit("max-age=600"), F.lit("content-length"), F.lit("0"), F.lit("date"), day,
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    later = pages.select(
        (n * 4 + 2).alias("record_id"), F.concat(F.lit("HTTP://"), F.regexp_replace("url", "^https?://", "")).alias("url"),
        at(172_800).alias("captured_at"), F.lit(304).alias("status"),
        F.create_map(
            F.lit("last-modified"), F.when(n % 5 == 1, F.lit(None).cast("string")).when(n % 5 == 2, F.lit("never")).otherwise(day),
            F.lit("vary"), F.lit("accept"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return full.unionByName(again).unionByName(later)


def op10_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(crawl(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    spelled = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return resolved.withColumn("headers", spelled).withColumn("captured_at", F.unix_seconds("captured_at"))


OP10_SQL = r"""
WITH urls AS (
  SELECT page_id, html, url, md5(html) AS h, octet_length(encode(html)) AS n FROM pages
), records AS (
  SELECT page_id * 4 AS record_id, url, 1700000000 + page_id AS captured_at, 200 AS status, '"' || h || '"' AS etag,
         'day ' || (page_id % 1000) AS modified, n, page_id FROM urls
  UNION ALL
  SELECT page_id * 4 + 1, url, 1700000000 + page_id + CASE WHEN page_id % 11 = 0 THEN -5000000 ELSE 86400 END, 304,
         CASE WHEN page_id % 7 = 3 THEN '"other"' ELSE '"' || h || '"' END, NULL, n, page_id FROM urls
  UNION ALL
  SELECT page_id * 4 + 2, url, 1700000000 + page_id + 172800, 304, NULL,
         CASE page_id % 5 WHEN 1 THEN NULL WHEN 2 THEN 'never' ELSE 'day ' || (page_id % 1000) END, n, page_id FROM urls
), split AS (
  SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^https?://', '') AS rest FROM records
), cut AS (
  SELECT *, lower(split_part(split_part(rest, '/', 1), '?', 1)) AS host, split_part(rest, '?', 1) AS front,
         CASE WHEN strpos(rest, '?') > 0 THEN substr(rest, strpos(rest, '?') + 1) ELSE '' END AS query FROM split
), named AS (
  SELECT *, [x FOR x IN string_split(query, '&') IF x <> '' AND NOT x LIKE 'utm%' AND NOT x LIKE 'ref=%'] AS kept FROM cut
), spelled AS (
  SELECT *, regexp_replace(host, '^www\.', '') || rtrim(substr(front, length(host) + 1), '/') ||
    CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_sort(kept), '&') ELSE '' END AS canonical FROM named
), last_full AS (
  SELECT * FROM spelled WHERE status = 200
  QUALIFY row_number() OVER (PARTITION BY canonical, captured_at ORDER BY record_id DESC) = 1
), paired AS (
  SELECT a.*, b.record_id AS b_id, b.captured_at AS b_at, b.etag AS b_etag, b.modified AS b_modified, b.page_id AS b_page, b.n AS b_n
  FROM (SELECT * FROM spelled WHERE status = 304) a
  ASOF LEFT JOIN last_full b ON a.canonical = b.canonical AND a.captured_at > b.captured_at
), judged AS (
  SELECT *, CASE WHEN b_id IS NULL THEN 'no_response'
    WHEN etag IS NOT NULL THEN CASE WHEN etag = b_etag THEN 'matched' ELSE 'mismatch' END
    WHEN modified IS NULL THEN 'unchecked' WHEN modified = b_modified THEN 'matched' ELSE 'mismatch' END AS outcome FROM paired
)
SELECT j.record_id, j.canonical, j.captured_at, j.outcome, j.b_id AS refers_to,
  CAST(j.captured_at - j.b_at AS DOUBLE) AS age_seconds, sha1(p.html) AS payload_digest,
  CASE WHEN outcome IN ('matched', 'unchecked') THEN
    CASE WHEN record_id % 4 = 1
      THEN 'cache-control=max-age=600;content-length=' || b_n || ';content-type=text/html;date=day ' || (j.page_id % 1000) || ';etag=W/' || j.etag || ';last-modified=' || b_modified
      ELSE 'cache-control=max-age=60;content-length=' || b_n || ';content-type=text/html;etag=' || b_etag || ';last-modified=' || b_modified || ';vary=accept' END END AS headers
FROM judged j LEFT JOIN pages p ON p.page_id = j.b_page
"""
