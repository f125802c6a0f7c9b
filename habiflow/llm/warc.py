"""Operator 10: resolving WARC not-modified revisits.

A revisit record (a 304 answer) has no body: an as-of join by canonical URL
finds the latest earlier full response, whose body it stands for if the
validators agree (equal ETag, weak marks aside; without one on either side,
equal Last-Modified).  The headers a 304 may update replace the response's.
Only identifiers and times go through windows; headers and bodies join by
record id.

Defined cases: a null URL is one URL, the empty one; earlier means a smaller
time, and of responses at one time the largest record id counts; a response
without an id or a time is not used; of responses that share an id the one
with the largest body counts; a revisit without a time, without an earlier
response or whose validators differ stays unresolved (null headers and body);
repeated revisits each keep their row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habiflow.llm.common import stored

SLICES = 128
# fixed values: the headers of a 304 answer that update the stored response
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified")


def canonical_url(url: Column) -> Column:
    """Without scheme, leading www., default port, fragment and slash at the end; host in lower case."""
    u = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[wW]{3}\.)?", "")
    host, rest = F.regexp_extract(u, r"^([^/?]*)", 1), F.regexp_replace(u, r"^[^/?]*", "")
    return F.concat(F.regexp_replace(F.lower(host), ":(80|443)$", ""), F.regexp_replace(rest, "/$", ""))


def as_of(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """``url, at, response_id``: for each URL and time of a revisit the latest earlier response.

    Records shrink to one row a URL and time first, so copies of a record or
    many records at one time are one row.  Quantiles of the times cut every
    URL into ``slices``; a slice looks back in a window of its own, and what
    precedes a slice comes from one row a URL and slice.  So no task meets a
    URL as a whole, however many records it has.
    """
    usable = F.when((F.col("kind") == "response") & F.col("at").isNotNull(), F.col("record_id"))
    keys = stored(records.filter("at is not null").groupBy("url", "at").agg(
        F.max(usable).alias("own"), F.max(F.col("kind") == "revisit").alias("asked")).filter("own is not null or asked"), "times")
    at = F.col("at").cast("double")
    bounds = keys.agg(F.percentile_approx(at, [i / slices for i in range(1, slices)], 10_000).alias("b")).first()["b"]
    cut = F.array(*[F.lit(float(b)) for b in sorted(set(bounds or []))]).cast("array<double>")
    keys = keys.withColumn("slice", F.size(F.filter(cut, lambda b: b < at)))
    last = (keys.filter("own is not null").groupBy("url", "slice").agg(F.max_by("own", "at").alias("last")))
    # a slice that has only revisits needs a row as well
    carry = keys.select("url", "slice").distinct().join(last, ["url", "slice"], "left").withColumn(
        "before", F.last("last", ignorenulls=True).over(
            Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy("url", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    found = keys.withColumn("within", F.last("own", ignorenulls=True).over(inside)).filter("asked")
    return found.join(carry.select("url", "slice", "before"), ["url", "slice"]).select(
        "url", "at", F.coalesce("within", "before").alias("of"))


def resolve_revisits(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """``records(record_id, kind, url, at, headers map, body)`` -> each revisit with ``response_id, headers, body``."""
    none = F.create_map().cast("map<string,string>")
    r = records.select("record_id", "kind", canonical_url(F.col("url")).alias("url"), "at",
                       F.coalesce("headers", none).alias("headers"))
    v = r.filter(F.col("kind") == "revisit").join(as_of(r, slices), ["url", "at"], "left")
    full = (records.filter((F.col("kind") == "response") & F.col("record_id").isNotNull())
            .groupBy(F.col("record_id").alias("of"))
            .agg(F.max_by(F.struct(F.coalesce("headers", none).alias("headers"), "body"), F.coalesce("body", F.lit(""))).alias("full")))
    v = v.join(full, "of", "left")
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    mine, theirs = F.col("headers"), F.col("full.headers")
    both_tags = tag(mine).isNotNull() & tag(theirs).isNotNull()
    same = F.coalesce(F.when(both_tags, tag(mine) == tag(theirs)).otherwise(mine["last-modified"] == theirs["last-modified"]), F.lit(False))
    fresh = F.map_filter(mine, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(F.coalesce(theirs, none), lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    return v.select("record_id", "url", F.when(same, F.col("of")).alias("response_id"),
                    F.when(same, F.map_concat(kept, fresh)).alias("headers"), F.when(same, F.col("full.body")).alias("body"))


def page_records(pages: DataFrame) -> DataFrame:
    """Every page as a full response, and a later revisit of its URL; of every seventh the ETag has changed."""
    etag = F.md5(F.coalesce("html", F.lit("")))
    full = pages.select((2 * F.col("page_id")).alias("record_id"), F.lit("response").alias("kind"), "url", (2 * F.col("page_id")).alias("at"),
                        F.create_map(F.lit("etag"), etag, F.lit("content-type"), F.lit("text/html"), F.lit("date"), F.lit("first")).alias("headers"),
                        F.coalesce("html", F.lit("")).alias("body"))
    tag = F.when(F.col("page_id") % 7 == 0, F.lit("changed")).otherwise(F.concat(F.lit("W/"), etag))
    again = pages.select(2 * F.col("page_id") + 1, F.lit("revisit"), F.concat("url", F.lit("#top")), 2 * F.col("page_id") + 1,
                         F.create_map(F.lit("etag"), tag, F.lit("date"), F.lit("later"), F.lit("content-type"), F.lit("none")),
                         F.lit(None).cast("string"))
    return full.union(again)


def op10_warc_revisits(pages: DataFrame) -> DataFrame:
    r = resolve_revisits(page_records(pages))
    return r.select("record_id", "url", "response_id", F.col("headers")["date"].alias("date"),
                    F.col("headers")["content-type"].alias("content_type"), F.sha2("body", 256).alias("body_sha256"))


# the record of a page is its response, 2 * page_id + 1 its revisit; URLs are made canonical as in canonical_url
OP10_SQL = r"""
WITH bare AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(coalesce(url, '')), '#.*$', ''),
                                       '^[A-Za-z][A-Za-z0-9+.-]*://(?:[wW]{3}\.)?', '') AS u FROM pages),
canon AS (
  SELECT page_id, html, regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), ':(80|443)$', '')
                        || regexp_replace(regexp_replace(u, '^[^/?]*', ''), '/$', '') AS url FROM bare),
full_answers AS (SELECT url, 2 * page_id AS at, max(2 * page_id) AS rid FROM canon WHERE page_id IS NOT NULL GROUP BY ALL),
bodies AS (SELECT 2 * page_id AS rid, max(coalesce(html, '')) AS body FROM canon WHERE page_id IS NOT NULL GROUP BY ALL),
again AS (SELECT 2 * page_id + 1 AS record_id, url,
                 CASE WHEN page_id % 7 = 0 THEN 'changed' ELSE md5(coalesce(html, '')) END AS etag FROM canon),
matched AS (SELECT a.record_id, a.url, a.etag, f.rid FROM again a
            ASOF LEFT JOIN full_answers f ON a.url = f.url AND a.record_id > f.at)
SELECT m.record_id, m.url,
       CASE WHEN m.etag = md5(b.body) THEN m.rid END AS response_id,
       CASE WHEN m.etag = md5(b.body) THEN 'later' END AS date,
       CASE WHEN m.etag = md5(b.body) THEN 'text/html' END AS content_type,
       CASE WHEN m.etag = md5(b.body) THEN sha256(b.body) END AS body_sha256
FROM matched m LEFT JOIN bodies b ON m.rid = b.rid
"""
