"""Not-modified revisit resolution for web archives.

A revisit record of the server-not-modified profile (a 304) has no payload: it
belongs to the latest earlier full response of the same canonical URL, provided
the validators agree. The resolved record has that response's payload, and its
headers merged with those of the 304.

As-of join: records are keyed by canonical URL and cut into spans of time. Within
a span the latest earlier response is a running maximum; for the first revisits
of a span it comes from a table with one row per URL and span that had a
response. So a URL with any share of all records is split by time, and only ids,
validators and digests are sorted; headers and payloads join the resolved rows by
record id and digest. Revisits that stay unresolved take no part in that join.

Validators: if the 304 has an ETag, it must equal the response's (weakly: without
W/); else if it has a Last-Modified, that must equal; else there is nothing to
check and the revisit stays unresolved. Headers: those of the 304 replace the
response's, but for names that describe the stored payload or the connection.

Edge cases: records at the very time of the revisit are not earlier; of several
responses at one time the largest record id counts, and of rows that repeat an id
the one with the largest validators, then digest; a null URL or time matches
nothing; null headers are empty; rows that repeat a record id, with equal contents
or others, are resolved each with its own headers, and a stored response gives
headers and payload of one row; rows of a null id are left out; other columns are
ignored.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import written

SPAN = 86_400  # seconds

# header names that a 304 may not replace (fixed values of the HTTP caching rules)
NOT_MERGED = ["connection", "content-encoding", "content-length", "content-range", "content-type",
              "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer",
              "transfer-encoding", "upgrade"]

RESOLVED, MISMATCH, NO_VALIDATOR, NOT_FOUND = "resolved", "mismatch", "no_validator", "not_found"

_PARTS = r"^[ ]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^?#]*)(\?[^#]*)?.*$"
_TRACKING = r"^(utm_[^=]*|gclid|fbclid|ref)(=.*)?$"


def canonical_url(url: Column) -> Column:
    """Scheme, user, default port, www, fragment and tracking parameters dropped, parameters sorted."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _PARTS, 1)), r"^www\.", "")
    port = F.regexp_replace(F.regexp_extract(url, _PARTS, 2), r"^:(80|443)?$", "")
    path = F.regexp_replace(F.regexp_extract(url, _PARTS, 3), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(url, _PARTS, 4), r"^\?", "")
    kept = F.array_sort(F.filter(F.split(query, "&", -1),
                                 lambda p: (p != "") & ~F.regexp_like(p, F.lit(_TRACKING))))
    return F.when(F.regexp_like(url, F.lit(_PARTS)),
                  F.concat(host, port, path, F.when(F.size(kept) > 0, F.lit("?")).otherwise(""),
                           F.array_join(kept, "&")))


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def _header(name: str) -> Column:
    return F.element_at("headers", F.lit(name))


def _content() -> Column:
    """Digest of a row's headers and payload: rows of one id and digest are interchangeable."""
    lines = F.to_json(F.array_sort(F.map_entries("headers")))
    return F.md5(F.concat_ws("\n", lines, F.md5("payload")))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Headers of a stored response updated by those of a 304 (names in lower case)."""
    allowed = F.map_filter(fresh, lambda k, _: ~k.isin(*NOT_MERGED))
    rest = F.map_filter(stored, lambda k, _: ~F.map_contains_key(allowed, k))
    return F.map_concat(rest, allowed)


def resolve(records: DataFrame, span: int = SPAN) -> DataFrame:
    """Per revisit: record_id, canonical_url, ts, status, source_id, headers, payload.

    ``records``: record_id (long), url, ts (long, seconds), kind ('response' or
    'revisit'), headers (map, lower-case names), payload (null for revisits).
    source_id is the latest earlier response, resolved or not; headers and
    payload are null unless resolved.
    """
    no_headers = F.create_map().cast("map<string,string>")
    keyed = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "ts", "kind",
        F.coalesce("headers", no_headers).alias("headers"), "payload").where("record_id is not null")
    keyed = keyed.withColumn("content", _content())
    light = keyed.select("record_id", "canonical_url", "ts", "kind", "content",
                         _strong(_header("etag")).alias("etag"), _header("last-modified").alias("modified"),
                         F.floor(F.col("ts") / span).alias("span"))
    able = light.where("canonical_url is not null and ts is not null")
    full = F.struct("ts", "record_id", "etag", "modified", "content")
    response = F.when(F.col("kind") == "response", full)
    earlier = (Window.partitionBy("canonical_url", "span").orderBy("ts")
               .rangeBetween(Window.unboundedPreceding, -1))
    inside = (able.withColumn("hit", F.max(response).over(earlier)).where("kind = 'revisit'"))
    spans = able.groupBy("canonical_url", "span").agg(F.max(response).alias("last"))
    before = (Window.partitionBy("canonical_url").orderBy("span")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = spans.select("canonical_url", "span", F.max("last").over(before).alias("carried"))
    hits = (inside.join(carried, ["canonical_url", "span"], "left")
            .withColumn("hit", F.coalesce("hit", "carried")))
    lost = light.where("kind = 'revisit' and (canonical_url is null or ts is null)")
    same = (F.when(F.col("etag").isNotNull(), F.coalesce(F.col("etag") == F.col("hit.etag"), F.lit(False)))
            .when(F.col("modified").isNotNull(),
                  F.coalesce(F.col("modified") == F.col("hit.modified"), F.lit(False))))
    status = (F.when(F.col("hit").isNull(), NOT_FOUND).when(same.isNull(), NO_VALIDATOR)
              .when(same, RESOLVED).otherwise(MISMATCH))
    columns = ["record_id", "canonical_url", "ts"]
    none = F.lit(None).cast("long"), F.lit(None).cast("string")
    # written: the resolved and the other rows come from one pass
    judged = written(hits.select(*columns, "content", status.alias("status"), F.col("hit.record_id").alias("source_id"),
                                 F.col("hit.content").alias("source_content"))
                     .unionByName(lost.select(*columns, "content", F.lit(NOT_FOUND).alias("status"),
                                              none[0].alias("source_id"), none[1].alias("source_content"))),
                     "revisits-judged")
    fresh = (keyed.where("kind = 'revisit'").select("record_id", "content", F.col("headers").alias("fresh"))
             .dropDuplicates(["record_id", "content"]))
    stored = (keyed.where("kind = 'response'")
              .select(F.col("record_id").alias("source_id"), F.col("content").alias("source_content"),
                      F.col("headers").alias("stored"), F.col("payload").alias("body"))
              .dropDuplicates(["source_id", "source_content"]))
    resolved = (judged.where(F.col("status") == RESOLVED).join(fresh, ["record_id", "content"])
                .join(stored, ["source_id", "source_content"])
                .select(*columns, "status", "source_id",
                        merged_headers(F.col("stored"), F.col("fresh")).alias("headers"),
                        F.col("body").alias("payload")))
    others = judged.where(F.col("status") != RESOLVED).select(
        *columns, "status", "source_id", F.lit(None).cast("map<string,string>").alias("headers"),
        F.lit(None).cast(keyed.schema["payload"].dataType).alias("payload"))
    return resolved.unionByName(others)


# --- records derived from the pages table ------------------------------------

HOUR = 3600


def crawl(pages: DataFrame) -> DataFrame:
    """Records of a crawl of ``pages``: each is fetched once and asked for again later.

    The first digits of the page's hash set the delay of the second visit (1 to
    256 hours) and its validators: the ETag, a weak one, only Last-Modified, an
    outdated ETag, or none.
    """
    base = pages.select(
        "page_id", "url", "html", F.md5(F.coalesce("html", F.lit(""))).alias("h"))
    number = F.conv(F.substring("h", 1, 2), 16, 10).cast("long")
    choice = F.conv(F.substring("h", 3, 1), 16, 10).cast("int")
    ts = F.col("page_id") * 60
    later = ts + (number + 1) * HOUR
    etag = F.concat(F.lit('"'), F.col("h"), F.lit('"'))
    modified = F.concat(F.lit("t"), ts.cast("string"))
    first = base.select(
        (F.col("page_id") * 2).alias("record_id"), "url", ts.alias("ts"), F.lit("response").alias("kind"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), ts.cast("string"),
                     F.lit("content-length"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string"),
                     F.lit("etag"), etag, F.lit("last-modified"), modified).alias("headers"),
        F.col("html").alias("payload"))
    validators = (F.when(choice < 10, F.create_map(F.lit("etag"), etag))
                  .when(choice < 12, F.create_map(F.lit("etag"), F.concat(F.lit("W/"), etag)))
                  .when(choice < 14, F.create_map(F.lit("last-modified"), modified))
                  .when(choice < 15, F.create_map(F.lit("etag"), F.lit('"old"')))
                  .otherwise(F.create_map().cast("map<string,string>")))
    again = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", later.alias("ts"),
        F.lit("revisit").alias("kind"),
        F.map_concat(F.create_map(F.lit("date"), later.cast("string"), F.lit("content-length"), F.lit("0"),
                                  F.lit("x-cache"), F.lit("hit")), validators).alias("headers"),
        F.lit(None).cast("string").alias("payload"))
    return first.unionByName(again)


def report(resolved: DataFrame) -> DataFrame:
    """Headers as sorted lines, the payload as digest and size."""
    lines = F.transform(F.array_sort(F.map_entries("headers")),
                        lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return resolved.select("record_id", "canonical_url", "ts", "status", "source_id",
                           F.when(F.col("headers").isNotNull(), F.array_join(lines, "\n")).alias("headers"),
                           F.md5("payload").alias("payload_md5"),
                           F.octet_length("payload").cast("long").alias("payload_bytes"))


def _sql_url() -> str:
    part = lambda i: f"regexp_extract(url, '{_PARTS}', {i})"
    kept = (f"list_sort(list_filter(string_split(regexp_replace({part(4)}, '^\\?', ''), '&'), "
            f"lambda p: p <> '' AND NOT regexp_matches(p, '{_TRACKING}')))")
    return (f"CASE WHEN regexp_matches(url, '{_PARTS}') THEN "
            f"regexp_replace(lower({part(1)}), '^www\\.', '') "
            f"|| regexp_replace({part(2)}, '^:(80|443)?$', '') "
            f"|| regexp_replace({part(3)}, '/+$', '') "
            f"|| CASE WHEN len({kept}) > 0 THEN '?' ELSE '' END || array_to_string({kept}, '&') END")


SQL = f"""
WITH base AS (
  SELECT page_id, html, {_sql_url()} AS u, md5(coalesce(html, '')) AS h FROM pages
  WHERE page_id IS NOT NULL),
numbered AS (
  SELECT *, ('0x' || substr(h, 1, 2))::BIGINT AS delay, ('0x' || substr(h, 3, 1))::BIGINT AS choice,
         page_id * 60 AS t0, '"' || h || '"' AS tag
  FROM base),
responses AS (
  SELECT max_by(page_id, page_id) AS page_id, u, t0,
         max_by(tag, page_id) AS tag, max_by(html, page_id) AS html
  FROM numbered WHERE u IS NOT NULL AND t0 IS NOT NULL GROUP BY u, t0),
revisits AS (
  SELECT page_id * 2 + 1 AS record_id, u, t0 + (delay + 1) * 3600 AS ts,
         CASE WHEN choice < 12 THEN tag WHEN choice = 14 THEN '"old"' END AS etag,
         CASE WHEN choice < 12 AND choice >= 10 THEN 'W/' || tag WHEN choice < 10 THEN tag END AS sent,
         CASE WHEN choice IN (12, 13) THEN 't' || t0 END AS modified
  FROM numbered),
hits AS (
  SELECT v.*, r.page_id AS source, r.tag, r.t0, r.html
  FROM revisits v ASOF LEFT JOIN responses r ON v.u = r.u AND v.ts > r.t0),
judged AS (
  SELECT *, CASE WHEN source IS NULL THEN '{NOT_FOUND}'
                 WHEN etag IS NOT NULL THEN CASE WHEN etag = tag THEN '{RESOLVED}' ELSE '{MISMATCH}' END
                 WHEN modified IS NOT NULL
                   THEN CASE WHEN modified = 't' || t0 THEN '{RESOLVED}' ELSE '{MISMATCH}' END
                 ELSE '{NO_VALIDATOR}' END AS status
  FROM hits)
SELECT record_id, u AS canonical_url, ts, status, source * 2 AS source_id,
       CASE WHEN status = '{RESOLVED}' THEN
         'content-length: ' || coalesce(octet_length(encode(html)), 0) || chr(10) || 'content-type: text/html' || chr(10)
         || 'date: ' || ts || chr(10) || 'etag: ' || coalesce(sent, tag) || chr(10)
         || 'last-modified: ' || coalesce(modified, 't' || t0) || chr(10) || 'x-cache: hit' END AS headers,
       CASE WHEN status = '{RESOLVED}' THEN md5(html) END AS payload_md5,
       CASE WHEN status = '{RESOLVED}' THEN octet_length(encode(html))::BIGINT END AS payload_bytes
FROM judged
"""
