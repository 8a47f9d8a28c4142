"""Resolution of not-modified revisits in web archives.

A ``revisit`` record says that the server answered 304: the body is that of an earlier full
response. Each revisit is matched, as of its date, with the latest strictly earlier response of
the same canonical URL; the validators must agree; then the stored headers are updated with the
revisit's permitted ones.

The as-of join is a forward fill without a per-URL group: records are range-partitioned by
(canonical URL, date), so a URL with a third of all captures spreads over many partitions; inside a
partition the last response is carried forward, and one record per partition and URL carries it
over the partition's edge. Bodies are not moved: the result names the response, and
:func:`with_payload` joins bodies to resolved records on demand.

Canonical URL: scheme, ``www`` prefix, default port, fragment, trailing slashes and ``utm_``
parameters are dropped, the host is lower-cased, the other parameters are sorted. What does not
look like a URL stands for itself.

Status of a record: ``response``; ``resolved``; ``validator_mismatch``; ``no_validator`` (the
revisit has neither ETag nor Last-Modified); ``no_earlier_response``. An ETag decides if the
revisit has one (weak comparison), else Last-Modified (equal text). Only resolved revisits have a
source and merged headers; responses are their own source; others keep their own headers.

Definitions: records with null URL or null date never match (``no_earlier_response``), other types
than ``response`` and ``revisit`` get their own type as status. Among responses of equal date the
one with the largest id is the later. Null headers are an empty map; header names are compared in
lower case, the values of names that differ in case only are joined. Rows repeated exactly are reported each. An empty table gives an empty result; columns
beyond the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from planscore.session import materialize

# The header fields a 304 response updates.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires",
             "last-modified", "vary")

URL = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$"
COLUMNS = ("record_id", "record_type", "url", "date", "headers")


def canonical_url(url: Column) -> Column:
    def part(i: int) -> Column:
        return F.regexp_extract(url, URL, i)
    host = F.regexp_replace(F.lower(part(1)), r":(80|443)$", "")
    host = F.regexp_replace(host, r"^www[0-9]*[.]", "")
    params = F.sort_array(F.filter(F.split(F.regexp_replace(part(3), r"^[?]", ""), "&"),
                                   lambda p: (p != "") & ~p.startswith("utm_")))
    query = F.array_join(params, "&")
    return F.when(F.rlike(url, F.lit(URL)), F.concat(
        host, F.regexp_replace(part(2), "/+$", ""),
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))).otherwise(url)


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^\s*W/", "")


def lower_names(headers: Column) -> Column:
    """Headers by lower-case name. Names that differ in case only are one header: their values, by
    the names as written and without nulls, are joined by a comma and a blank, as repeated header lines
    are; null if all are null."""
    lines = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(
        F.lower(e.getField("key")).alias("name"), e.getField("value").alias("value")))
    names = F.array_distinct(F.transform(lines, lambda e: e.getField("name")))

    def joined(name: Column) -> Column:
        values = F.transform(F.filter(lines, lambda e: (e.getField("name") == name)
                                      & e.getField("value").isNotNull()),
                             lambda e: e.getField("value"))
        return F.when(F.size(values) > 0, F.array_join(values, ", "))
    return F.map_from_arrays(names, F.transform(names, joined))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records``: record_id, record_type, url, date, headers (map). Returns ``record_id,
    record_type, canonical, status, source_id, headers`` (merged)."""
    headers = F.coalesce(lower_names(F.col("headers")),
                         F.expr("cast(map() as map<string,string>)"))
    own = records.select(*COLUMNS).select(
        "record_id", "record_type", "date", headers.alias("headers"),
        canonical_url(F.col("url")).alias("canonical"),
        # at equal dates a revisit sorts before a response: only earlier ones count
        (F.col("record_type") == "response").cast("int").alias("later"))
    order = ["date", "later", "record_id"]
    rows = materialize(own.repartitionByRange("canonical", *order)
                       .withColumn("pid", F.spark_partition_id()), "captures")
    held = F.when((F.col("later") == 1) & F.col("date").isNotNull()
                  & F.col("canonical").isNotNull(),
                  F.struct("record_id", "headers"))
    upto = (W.partitionBy("pid", "canonical").orderBy(*order)
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    filled = rows.withColumn("here", F.last(held, ignorenulls=True).over(upto))
    # the last response of each part, carried to the later parts of the same URL
    tails = rows.groupBy("pid", "canonical").agg(F.max_by(
        held, F.when(held.isNotNull(), F.struct("date", "record_id"))).alias("tail"))
    before = (W.partitionBy("canonical").orderBy("pid")
              .rowsBetween(W.unboundedPreceding, -1))
    tails = tails.select("pid", "canonical", F.last("tail", ignorenulls=True).over(before)
                         .alias("carried")).filter("carried is not null")
    # the edge rows are one per partition boundary inside a URL
    filled = filled.join(tails, ["pid", "canonical"], "left")
    found = F.when(F.col("date").isNotNull(), F.coalesce("here", "carried"))
    etag, modified = F.col("headers")["etag"], F.col("headers")["last-modified"]
    base = F.col("found.headers")
    agrees = F.when(etag.isNotNull(), _strong(etag).eqNullSafe(_strong(base["etag"]))).otherwise(
        modified.eqNullSafe(base["last-modified"]))
    status = (F.when(F.col("record_type") == "response", "response")
              .when(~F.col("record_type").eqNullSafe("revisit"), F.col("record_type"))
              .when(F.col("found").isNull(), "no_earlier_response")
              .when(etag.isNull() & modified.isNull(), "no_validator")
              .when(agrees, "resolved").otherwise("validator_mismatch"))
    fresh = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(
        F.map_filter(base, lambda k, v: ~F.map_contains_key(fresh, k)), fresh)
    return (filled.withColumn("found", found).withColumn("status", status).select(
        "record_id", "record_type", "canonical", "status",
        F.when(F.col("status") == "resolved", F.col("found.record_id"))
        .when(F.col("status") == "response", F.col("record_id")).alias("source_id"),
        F.when(F.col("status") == "resolved", merged).otherwise(F.col("headers"))
        .alias("headers")))


def with_payload(resolved: DataFrame, records: DataFrame, payload_col: str) -> DataFrame:
    """Adds the body of each record's source (null without one). A response that many revisits
    share is one row of the join, which AQE can split."""
    bodies = (records.filter(F.col("record_type") == "response")
              .select(F.col("record_id").alias("source_id"), payload_col))
    return resolved.join(bodies, "source_id", "left")


def header_lines(headers: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(
        e.getField("key"), F.lit(": "), e.getField("value"))), "\n")


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Crawl records from ``pages``: each page is a response, later re-crawled with 304 under
    another spelling of its URL (validators by page number), every fifth also just before."""
    p = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16),
                   F.lit('"'))
    day = F.concat(F.lit("day "), (p % 365).cast("string"))
    respelt = F.concat(F.regexp_replace("url", r"^https?://(www[.])?", "https://WWW."),
                       F.lit("#again"))

    def headers(*pairs) -> Column:
        m = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]),
                              F.array(*[v for _, v in pairs]))
        return F.map_filter(m, lambda k, v: v.isNotNull())

    def record(i: int, kind: str, at: Column, url: Column, h: Column) -> Column:
        return F.struct((p * 3 + i).alias("record_id"), F.lit(kind).alias("record_type"),
                        url.alias("url"), at.alias("date"), h.alias("headers"))

    first = record(0, "response", p * 60, F.col("url"), headers(
        ("Content-Type", F.lit("text/html")),
        ("Content-Length", F.octet_length(F.coalesce("html", F.lit(""))).cast("string")),
        ("ETag", tag), ("Last-Modified", day), ("Cache-Control", F.lit("max-age=600")),
        ("Date", (p * 60).cast("string"))))

    def again(i: int, at: Column) -> Column:
        return record(i, "revisit", at, respelt, headers(
            ("Content-Length", F.lit("0")), ("Connection", F.lit("close")),
            ("ETag", F.when(p % 7 == 0, '"changed"').when((p % 11 != 0) & (p % 13 != 0),
                                                          F.concat(F.lit("W/"), tag))),
            ("Last-Modified", F.when((p % 7 != 0) & (p % 11 == 0), day)),
            ("Cache-Control", F.lit("max-age=60")), ("Date", at.cast("string"))))

    late, early = again(1, p * 60 + 3600 * (1 + p % 5)), again(2, p * 60 - 30)
    records = F.when(p % 5 == 0, F.array(first, late, early)).otherwise(F.array(first, late))
    return pages.select(F.explode(records).alias("r")).select("r.*")


def op2(spark, sf_dir: str) -> DataFrame:
    """The crawl records of ``pages`` with their revisits resolved."""
    out = resolve_revisits(records_of_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return out.select("record_id", "record_type", "canonical", "status", "source_id",
                      header_lines(F.col("headers")).alias("headers"))


OP2_SQL = r"""
with p as (
  select page_id as p, url, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' as tag,
         'day ' || (page_id % 365) as day, strlen(coalesce(html, '')) as len,
         regexp_replace(url, '^https?://(www[.])?', 'https://WWW.') || '#again' as respelt
  from pages),
v as (
  select *, case when p % 7 = 0 then '"changed"'
                 when p % 11 <> 0 and p % 13 <> 0 then 'W/' || tag end as etag,
         case when p % 7 <> 0 and p % 11 = 0 then day end as modified from p),
r as (
  select p * 3 as record_id, 'response' as record_type, url, p * 60 as date, 1 as later,
         tag as etag, day as modified, len from v
  union all
  select p * 3 + 1, 'revisit', respelt, p * 60 + 3600 * (1 + p % 5), 0, etag, modified, len from v
  union all
  select p * 3 + 2, 'revisit', respelt, p * 60 - 30, 0, etag, modified, len from v
  where p % 5 = 0),
u as (
  select *, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$' as re from r),
k as (
  select *, regexp_replace(regexp_replace(lower(regexp_extract(url, re, 1)), ':(80|443)$', ''),
                           '^www[0-9]*[.]', '')
            || regexp_replace(regexp_extract(url, re, 2), '/+$', '') as place,
         array_to_string(list_sort(list_filter(
           string_split(regexp_replace(regexp_extract(url, re, 3), '^[?]', ''), '&'),
           lambda x: x <> '' and not starts_with(x, 'utm_'))), '&') as query
  from u),
c as (
  select *, case when regexp_matches(url, re)
                 then place || case when query = '' then '' else '?' || query end
                 else url end as canonical from k),
f as (
  select *, last_value(case when later = 1 then {'id': record_id, 'etag': etag, 'day': modified,
                                                  'len': len} end ignore nulls) over (
      partition by canonical order by date, later, record_id
      rows between unbounded preceding and current row) as found
  from c),
s as (
  select *, case when later = 1 then 'response'
                 when found is null then 'no_earlier_response'
                 when etag is null and modified is null then 'no_validator'
                 when (etag is not null and regexp_replace(etag, '^\s*W/', '') = found.etag)
                   or (etag is null and modified = found.day) then 'resolved'
                 else 'validator_mismatch' end as status
  from f)
select record_id, record_type, canonical, status,
       case when status = 'resolved' then found.id when later = 1 then record_id end as source_id,
       case when later = 1 then
              'cache-control: max-age=600' || chr(10) || 'content-length: ' || len || chr(10)
              || 'content-type: text/html' || chr(10) || 'date: ' || date || chr(10)
              || 'etag: ' || etag || chr(10) || 'last-modified: ' || modified
            when status = 'resolved' then
              'cache-control: max-age=60' || chr(10) || 'content-length: ' || found.len || chr(10)
              || 'content-type: text/html' || chr(10) || 'date: ' || date || chr(10)
              || 'etag: ' || coalesce(etag, found.etag) || chr(10)
              || 'last-modified: ' || coalesce(modified, found.day)
            else
              'cache-control: max-age=60' || chr(10) || 'connection: close' || chr(10)
              || 'content-length: 0' || chr(10) || 'date: ' || date
              || coalesce(chr(10) || 'etag: ' || etag, '')
              || coalesce(chr(10) || 'last-modified: ' || modified, '') end as headers
from s
"""
