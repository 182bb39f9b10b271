"""Not-modified revisit resolution for web captures. DataFrame functions only.

A capture table has record_id, url, ts, kind (``response`` or ``revisit``), status, etag, last_modified, headers (map of
lower-case names) and payload_digest. Each revisit is joined as of its time with the latest earlier full response (status
200) of the same canonical URL; its validators are checked against that response's and the permitted headers are merged.

The as-of join runs in two steps, so that one URL with a third of all captures is not one task: captures are dealt by ranges of (url, time, record), whose ends Spark takes
from a sample, so that ranges are even however times are spread; inside a range a window finds the response, and between the ranges of a URL the last one of each is carried forward.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table, written

#: Fixed values (RFC 9110, 15.4.5, and RFC 9111, 3.2): header fields of a 304 that replace the stored ones.
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Query parameters that do not select a page.
TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid|phpsessid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Scheme and ``www.`` dropped, host lower-cased, default port, fragment, tracking parameters and a final slash dropped, other parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"(?i)^https?://(www\.)?", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def strong(etag: Column) -> Column:
    """Weak comparison: ``W/`` is dropped."""
    return F.regexp_replace(etag, r"^W/", "")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url_key, ts, outcome, response_id, response_ts, payload_digest, merged (map).

    outcome: ``resolved`` (a validator agrees and none differs), ``mismatch`` (one differs), ``unchecked`` (neither side has a
    common validator: joined, not merged), ``orphan`` (no earlier response). Earlier means a smaller ts, or the same ts and a
    smaller record_id; of rows equal in both, any. A revisit with a null url or ts is an orphan; a null headers map is empty.
    Only ``resolved`` rows have merged headers: the response's, with the revisit's permitted ones over them. Repeated revisits
    give repeated rows; extra columns are ignored. A null record_id is smaller than any; an empty url is a key like others. An empty table gives no rows.
    """
    rows = captures.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "kind", "status", "etag", "last_modified", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "payload_digest")
    usable = (F.col("kind") == "response") & (F.col("status") == 200)
    full = F.when(usable, F.struct("ts", F.col("record_id").alias("id"), "etag", "last_modified", "headers", "payload_digest"))
    rows = rows.where("kind = 'revisit' or status = 200").withColumn("full", full)
    ranged = rows.where("url_key is not null and ts is not null").repartitionByRange("url_key", "ts", "record_id")
    placed = written(ranged.withColumn("cell", F.spark_partition_id()))
    order = F.struct("ts", "record_id")
    last = placed.where(usable).groupBy("url_key", "cell").agg(F.max_by("full", order).alias("full"))
    revisits_at = placed.where("kind = 'revisit'").groupBy("url_key", "cell").agg(F.lit(1).alias("x")).select("url_key", "cell", F.lit(None).cast(last.schema["full"].dataType).alias("full"))
    cells = last.unionByName(revisits_at).groupBy("url_key", "cell").agg(F.max_by("full", F.col("full").isNotNull()).alias("full"))
    earlier = Window.partitionBy("url_key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a URL has a row for each range it reaches into
    carried = cells.select("url_key", "cell", F.last("full", ignorenulls=True).over(earlier).alias("carried"))
    in_cell = Window.partitionBy("url_key", "cell").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    found = placed.withColumn("near", F.last("full", ignorenulls=True).over(in_cell)).where("kind = 'revisit'")
    joined = found.join(carried, ["url_key", "cell"], "left").withColumn("r", F.coalesce("near", "carried"))
    lost = rows.where("kind = 'revisit' and (url_key is null or ts is null)")
    joined = joined.unionByName(lost.withColumn("r", F.lit(None).cast(joined.schema["r"].dataType)), allowMissingColumns=True)
    tags = F.col("etag").isNotNull() & F.col("r.etag").isNotNull()
    dates = F.col("last_modified").isNotNull() & F.col("r.last_modified").isNotNull()
    differs = (tags & (strong(F.col("etag")) != strong(F.col("r.etag")))) | (dates & (F.col("last_modified") != F.col("r.last_modified")))
    outcome = F.when(F.col("r").isNull(), "orphan").when(~tags & ~dates, "unchecked").when(F.coalesce(differs, F.lit(False)), "mismatch").otherwise("resolved")
    permitted = F.map_filter("headers", lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    kept = F.map_filter("r.headers", lambda k, v: ~F.array_contains(F.map_keys(permitted), k))
    merged = F.when(outcome == "resolved", F.map_concat(kept, permitted))
    return joined.select("record_id", "url_key", "ts", outcome.alias("outcome"), F.col("r.id").alias("response_id"), F.col("r.ts").alias("response_ts"), F.when(outcome == "resolved", F.col("r.payload_digest")).alias("payload_digest"), merged.alias("merged"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures that follow from ``pages``: each page is a response at 60 s x page_id and is asked for again 45 s later with the validators
    of its text; where page_id is divisible by 5 the ETag has changed, by 7 none is sent, by 11 the first answer was a 503."""
    page = pages.select("page_id", "url", F.md5(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest"))
    etag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    day = F.format_string("2024-01-%02d", (F.pmod("page_id", F.lit(28)) + 1).cast("int"))
    first = page.select(
        (F.col("page_id") * 2).alias("record_id"), "url", (F.col("page_id") * 60).alias("ts"), F.lit("response").alias("kind"), F.when(F.col("page_id") % 11 == 0, 503).otherwise(200).alias("status"), etag.alias("etag"), day.alias("last_modified"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), etag, F.lit("date"), (F.col("page_id") * 60).cast("string"), F.lit("cache-control"), F.lit("max-age=60")).alias("headers"), "digest",
    )
    changed = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit('"x'), F.substring("digest", 2, 15), F.lit('"'))).otherwise(F.concat(F.lit("W/"), etag))
    sent = F.when(F.col("page_id") % 7 != 0, changed)
    again = page.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (F.col("page_id") * 60 + 45).alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), sent.alias("etag"), F.when(F.col("page_id") % 3 == 0, day).alias("last_modified"),
        F.create_map(F.lit("date"), (F.col("page_id") * 60 + 45).cast("string"), F.lit("content-length"), F.lit("0"), F.lit("expires"), (F.col("page_id") * 60 + 3645).cast("string")).alias("headers"), F.lit(None).cast("string").alias("digest"),
    )
    return first.unionByName(again).withColumnRenamed("digest", "payload_digest")


def op1_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """Every revisit of ``pages``; merged headers as sorted ``name: value`` lines."""
    out = resolve_revisits(captures_of_pages(table(spark, sf_dir, "pages")))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("merged"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return out.select("record_id", "url_key", "ts", "outcome", "response_id", "response_ts", "payload_digest", lines.alias("merged_headers"))


OP1_SQL = r"""
with page as (select page_id, url, md5(coalesce(html, '')) as digest, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' as tag,
    printf('2024-01-%02d', page_id % 28 + 1) as day, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i)https?://(www\.)?', '') as bare from pages),
parts as (select *, regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), ':(80|443)$', '') as host, regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') as path,
    list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda p: p <> '' and not regexp_matches(p, '(?i)^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid|phpsessid)(=|$)'))) as query from page),
keyed as (select *, host || path || case when len(query) > 0 then '?' || array_to_string(query, '&') else '' end as url_key from parts),
response as (select url_key, page_id * 60 as ts, page_id * 2 as id, tag, day, digest from keyed where page_id % 11 <> 0),
revisit as (select page_id * 2 + 1 as record_id, url_key, page_id * 60 + 45 as ts, case when page_id % 7 = 0 then null when page_id % 5 = 0 then '"x' || substr(digest, 2, 15) || '"' else 'W/' || tag end as etag,
    case when page_id % 3 = 0 then day end as day from keyed),
joined as (select v.*, r.id, r.ts as rts, r.tag as rtag, r.day as rday, r.digest as rdigest from revisit v asof left join response r on v.url_key = r.url_key and v.ts >= r.ts),
judged as (select *, case when id is null then 'orphan' when etag is null and day is null then 'unchecked'
    when coalesce(regexp_replace(etag, '^W/', '') <> rtag, false) or coalesce(day <> rday, false) then 'mismatch' else 'resolved' end as outcome from joined)
select record_id, url_key, ts, outcome, id as response_id, rts as response_ts, case when outcome = 'resolved' then rdigest end as payload_digest,
  case when outcome = 'resolved' then 'cache-control: max-age=60' || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10) || 'etag: ' || rtag || chr(10) || 'expires: ' || (ts + 3600) end as merged_headers
from judged
"""
