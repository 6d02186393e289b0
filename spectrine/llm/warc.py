"""WARC records and the resolution of not-modified revisits.

A ``revisit`` record says that the server answered 304 and holds no body. It is
resolved by an as-of join on the canonical URL: the latest ``response`` of that URL
captured before it. The revisit's validators must agree with that response's (an
ETag by the weak comparison, else Last-Modified), and its permitted headers replace
the stored ones, as a cache would update them.

The as-of join holds no URL's captures in one place: time is cut into slices, each
(URL, slice) is searched by itself, and what earlier slices hand on is one row per
(URL, slice). Bodies are joined last, by record id, to the rows that need them.
"""

from __future__ import annotations

import gzip
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Headers that a 304 answer may update (RFC 9111, section 3.2, and RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified", "age")
#: Query parameters that do not change a resource.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)"
SLICE_SECONDS = 86_400

SCHEMA = (
    "record_id string, warc_type string, target_uri string, warc_date timestamp, "
    "status int, headers map<string,string>, body binary"
)


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host without ``www.`` or default port; no fragment, tracking
    parameters, trailing slash or index page; http and https alike; remaining parameters sorted.
    Null for null or text without a host."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^(?i:https?)://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_extract(bare, r"^[A-Za-z]+://[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", "/"), r"/+$", "")
    parts = F.filter(
        F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike(rf"^{TRACKING}(=|$)")
    )
    query = F.array_join(F.array_sort(parts), "&")
    return F.when(
        host != "", F.concat(F.lit("http://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    )


def _lowered(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case alone the last in name order counts."""
    entries = F.array_sort(F.filter(F.map_entries(headers), lambda e: e["value"].isNotNull()))
    return F.coalesce(
        F.aggregate(
            entries,
            F.create_map().cast("map<string,string>"),
            lambda m, e: F.map_concat(
                F.map_filter(m, lambda k, v: k != F.lower(e["key"])), F.create_map(F.lower(e["key"]), e["value"])
            ),
        ),
        F.create_map().cast("map<string,string>"),
    )


def _weak(etag: Column) -> Column:
    return F.regexp_replace(F.trim(etag), r"^W/", "")


def resolve_revisits(records: DataFrame, *, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every record with what it stands for: the columns of ``records`` plus ``canonical_url``,
    ``refers_to``, ``outcome``, ``merged_headers`` and ``merged_body``.

    ``records`` has the columns of ``SCHEMA``. ``outcome`` is ``response`` or
    ``other`` for records that are no revisit (their headers and body pass through),
    and for revisits ``resolved``, ``mismatch`` (the latest earlier response has
    another validator), ``unvalidated`` (neither ETag nor Last-Modified can be
    compared; resolved nevertheless, since 304 answers a conditional request) or
    ``unresolved`` (no earlier full response; also null URLs and dates). A full
    response has status 200 and a body. "Earlier" is strictly by date; among
    responses of one date the larger record id is the later.

    Null header maps count as empty, null ids as ids that sort first; repeated rows
    are resolved alike. Other columns pass through; clashing ones are replaced. An
    empty table gives an empty table.
    """
    added = ("canonical_url", "refers_to", "outcome", "merged_headers", "merged_body")
    keep = [c for c in records.columns if c not in added]
    # a record is one struct from here on, so that no column of it meets a name used below
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = records.select(row.alias("row"), canonical_url(F.col("target_uri")).alias("canonical_url"), _lowered(F.col("headers")).alias("headers"))
    rid = F.coalesce("row.record_id", F.lit(""))
    known = F.col("canonical_url").isNotNull() & F.col("row.warc_date").isNotNull()
    time = F.unix_micros("row.warc_date")
    asked = F.coalesce(F.col("row.warc_type") == "revisit", F.lit(False))
    full = F.coalesce((F.col("row.warc_type") == "response") & (F.col("row.status") == 200) & F.col("row.body").isNotNull(), F.lit(False))

    events = rows.where(known & (asked | full)).select(
        F.xxhash64("canonical_url").alias("u"), "canonical_url", time.alias("t"),
        F.floor(time / (slice_seconds * 1_000_000)).alias("slice"), full.alias("full"),
        rid.alias("rid"),
    ).distinct()
    # the last response of each slice, handed on to later slices of the URL
    last = events.where("full").groupBy("canonical_url", "slice").agg(F.max(F.struct("t", "rid")).alias("own"))
    slices = events.select("canonical_url", "slice").distinct().join(last, ["canonical_url", "slice"], "left")
    before = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("canonical_url", "slice", F.last("own", True).over(before).alias("earlier"))
    within = Window.partitionBy("canonical_url", "slice").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    found = (
        events.withColumn("here", F.max(F.when(F.col("full"), F.struct("t", "rid"))).over(within))
        .where("not full")
        .join(slices, ["canonical_url", "slice"])
        .select("canonical_url", "t", "rid", F.coalesce("here", "earlier").alias("ref"))
        .where("ref is not null")
        .select("canonical_url", "t", "rid", F.col("ref.t").alias("ref_t"), F.col("ref.rid").alias("ref_rid"))
        .distinct()
    )
    # only responses that something refers to are moved, and each once; records that are no revisit stay where they are
    spot = ["canonical_url", "ref_t", "ref_rid"]
    stored = rows.where(known & full).select(
        "canonical_url", time.alias("ref_t"), rid.alias("ref_rid"),
        F.col("headers").alias("stored"), F.col("row.body").alias("body"),
    ).join(found.select(*spot).distinct(), spot, "left_semi").dropDuplicates(spot)
    named = found.select(F.col("canonical_url").alias("u"), "t", "rid", "ref_t", "ref_rid")
    revisits = rows.where(asked).join(
        named,
        (F.col("canonical_url") == F.col("u")) & (time == F.col("t")) & (rid == F.col("rid")),
        "left",
    )
    joined = revisits.join(stored, spot, "left")
    tags = (_weak(F.element_at("headers", F.lit("etag"))), _weak(F.element_at("stored", F.lit("etag"))))
    dates = (F.element_at("headers", F.lit("last-modified")), F.element_at("stored", F.lit("last-modified")))
    agree = F.coalesce(tags[0] == tags[1], F.trim(dates[0]) == F.trim(dates[1]))
    outcome = (
        F.when(F.col("ref_rid").isNull(), "unresolved").when(agree.isNull(), "unvalidated").when(agree, "resolved").otherwise("mismatch")
    )
    news = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("stored", lambda k, v: ~F.map_contains_key(news, k)), news)
    whole = F.col("outcome").isin("resolved", "unvalidated")
    answered = (
        joined.withColumn("outcome", outcome)
        .withColumn("refers_to", F.when(whole, F.col("ref_rid")))
        .withColumn("merged_headers", F.when(whole, merged).otherwise(F.col("headers")))
        .withColumn("merged_body", F.when(whole, F.col("body")).otherwise(F.col("row.body")))
        .select("row.*", *added)
    )
    rest = rows.where(~asked).select(
        "row.*", "canonical_url", F.lit(None).cast("string").alias("refers_to"),
        F.when(F.col("row.warc_type") == "response", "response").otherwise("other").alias("outcome"),
        F.col("headers").alias("merged_headers"), F.col("row.body").alias("merged_body"),
    )
    return rest.unionByName(answered)


def _member(row) -> bytes:
    """One gzip member with the WARC record of a row."""
    headers = dict(row.headers or {})
    status = 304 if row.warc_type == "revisit" else (row.status or 200)
    http = f"HTTP/1.1 {status} {'Not Modified' if status == 304 else 'OK'}\r\n"
    http += "".join(f"{k}: {v}\r\n" for k, v in sorted(headers.items()) if v is not None) + "\r\n"
    block = http.encode() + (b"" if row.warc_type == "revisit" else bytes(row.body or b""))
    date = "" if pd.isna(row.warc_date) else pd.Timestamp(row.warc_date).strftime("WARC-Date: %Y-%m-%dT%H:%M:%S.%fZ\r\n")
    ident = row.record_id or f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row.target_uri} {date}')}"
    uri = f"WARC-Target-URI: {row.target_uri}\r\n" if row.target_uri else ""
    head = f"WARC/1.1\r\nWARC-Type: {row.warc_type or 'response'}\r\nWARC-Record-ID: <{ident}>\r\n{date}{uri}"
    head += f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", mtime=0)


def to_members(records: DataFrame) -> DataFrame:
    """(record_id, member): each record as a gzip member; concatenated members are a .warc.gz file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"record_id": pdf["record_id"], "member": [_member(r) for r in pdf.itertuples(index=False)]})

    headers = F.map_entries("headers")
    narrow = records.select("record_id", "warc_type", "target_uri", "warc_date", "status", headers.alias("headers"), "body")
    return narrow.mapInPandas(lambda it: run(_as_maps(it)), "record_id string, member binary")


def _as_maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf["headers"] = [dict((e["key"], e["value"]) for e in h) if h is not None else {} for h in pdf["headers"]]
        pdf["status"] = [None if pd.isna(s) else int(s) for s in pdf["status"]]
        yield pdf


def parse(data: bytes) -> Iterator[dict]:
    """The records of a WARC file's bytes, gzipped by member or plain; a damaged tail ends the file.

    Records without a usable length are passed over. Of the lines of a header that cannot be read
    as text the readable part counts.
    """
    stream = io.BytesIO(data)
    if data[:2] == b"\x1f\x8b":
        try:
            stream = io.BytesIO(gzip.decompress(data))
        except (EOFError, zlib.error, gzip.BadGzipFile):
            unpack, out = zlib.decompressobj(31), bytearray()
            while data:
                try:
                    out += unpack.decompress(data)
                except zlib.error:
                    break
                if not unpack.eof:
                    break
                data, unpack = unpack.unused_data, zlib.decompressobj(31)
            stream = io.BytesIO(out)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head = dict(_fields(stream))
        length = head.get("content-length", "0")
        if not re.fullmatch(r"[0-9]{1,18}", length):
            continue  # a record of unknown length: go on at the next one that begins a line
        block = stream.read(int(length))
        status, headers, body = None, {}, block
        if m := re.match(rb"HTTP/\S+ (\d+)[^\n]*\n", block):
            rest = io.BytesIO(block[m.end() :])
            status, headers = int(m[1]), dict(_fields(rest))
            body = rest.read()
        kind = head.get("warc-type")
        date = pd.to_datetime(head.get("warc-date"), utc=True, errors="coerce")
        yield {
            "record_id": head.get("warc-record-id", "").strip("<>") or None, "warc_type": kind,
            "target_uri": head.get("warc-target-uri", "").strip("<>") or None,
            "warc_date": None if pd.isna(date) else date.tz_localize(None), "status": status,
            "headers": headers, "body": None if kind == "revisit" else body,
        }


def _fields(stream: io.BytesIO) -> Iterator[tuple[str, str]]:
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        yield name.strip().lower(), value.strip()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records (``SCHEMA``) of the .warc and .warc.gz files under ``path``, one task or more a file."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                for record in parse(content):
                    rows.append(record)
                    if len(rows) == 200:
                        yield pd.DataFrame(rows, columns=names).astype({"status": "Int32"})
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"status": "Int32"})

    return files.mapInPandas(run, SCHEMA)


def captures(pages: DataFrame) -> DataFrame:
    """A crawl made of ``pages`` (page_id, url, html): a full response of every page and, an hour
    to some days later, a not-modified revisit of it. Every fifth revisit brings another ETag."""
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 61)
    later = F.timestamp_seconds(F.lit(1_700_003_600) + F.col("page_id") * 61 + F.pmod("page_id", F.lit(7)) * 90_000)
    first = F.struct(
        F.format_string("urn:page:%d:0", "page_id").alias("record_id"), F.lit("response").alias("warc_type"),
        F.col("url").alias("target_uri"), at.alias("warc_date"), F.lit(200).alias("status"),
        F.create_map(F.lit("ETag"), etag, F.lit("Content-Type"), F.lit("text/html"), F.lit("Age"), F.lit("0")).alias("headers"),
        F.encode("html", "utf-8").alias("body"),
    )
    tag = F.when(F.pmod("page_id", F.lit(5)) == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), etag))
    again = F.struct(
        F.format_string("urn:page:%d:1", "page_id").alias("record_id"), F.lit("revisit").alias("warc_type"),
        F.col("url").alias("target_uri"), later.alias("warc_date"), F.lit(304).alias("status"),
        F.create_map(F.lit("ETag"), tag, F.lit("Age"), F.lit("7"), F.lit("Content-Length"), F.lit("0")).alias("headers"),
        F.lit(None).cast("binary").alias("body"),
    )
    return pages.select("page_id", F.inline(F.array(first, again)))


def query(spark, sf_dir: str) -> DataFrame:
    """Every record of the crawl over the whole ``pages`` table, resolved."""
    out = resolve_revisits(captures(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return out.select(
        "page_id", "record_id", "canonical_url", "outcome", "refers_to",
        F.element_at("merged_headers", F.lit("age")).alias("age"),
        F.element_at("merged_headers", F.lit("content-type")).alias("content_type"),
        F.coalesce(F.octet_length("merged_body"), F.lit(0)).cast("long").alias("n_bytes"), F.md5("merged_body").alias("body_md5"),
    )


SQL = """
WITH cut AS (
  SELECT page_id, html, regexp_replace(trim(url), '#.*$', '') AS b FROM pages
), parts AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^(?i:https?)://(?:[^/?@]*@)?([^/?]*)', 1)), ':(80|443)?$', ''), '^www[.]', '') AS host,
    regexp_replace(regexp_replace(regexp_extract(b, '^[A-Za-z]+://[^/?]*([^?]*)', 1), '/index[.]html?$', '/'), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '[?](.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))), '&') AS q
  FROM cut
), p AS (
  SELECT page_id, html, CASE WHEN host <> '' THEN 'http://' || host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS u,
         page_id * 61 AS t0, 3600 + page_id * 61 + (page_id % 7) * 90000 AS t1, substr(md5(coalesce(html, '')), 1, 16) AS tag FROM parts
), r AS (
  SELECT a.page_id, a.u, CASE WHEN a.page_id % 5 = 0 THEN 'other' ELSE a.tag END AS asked,
         f.page_id AS ref, f.tag AS stored, f.html AS body
  FROM p a LEFT JOIN p f ON f.u = a.u AND f.t0 < a.t1 AND f.html IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a.page_id ORDER BY f.t0 DESC NULLS LAST, 'urn:page:' || f.page_id || ':0' DESC) = 1
), v AS (
  SELECT *, CASE WHEN ref IS NULL THEN 'unresolved' WHEN asked = stored THEN 'resolved' ELSE 'mismatch' END AS outcome FROM r
)
SELECT page_id, 'urn:page:' || page_id || ':0' AS record_id, u AS canonical_url, 'response' AS outcome, CAST(NULL AS VARCHAR) AS refers_to,
       '0' AS age, 'text/html' AS content_type, CAST(coalesce(strlen(html), 0) AS BIGINT) AS n_bytes, md5(html) AS body_md5 FROM p
UNION ALL
SELECT page_id, 'urn:page:' || page_id || ':1', u, outcome, CASE WHEN outcome = 'resolved' THEN 'urn:page:' || ref || ':0' END,
       '7', CASE WHEN outcome = 'resolved' THEN 'text/html' END,
       CAST(CASE WHEN outcome = 'resolved' THEN strlen(body) ELSE 0 END AS BIGINT), CASE WHEN outcome = 'resolved' THEN md5(body) END FROM v
"""
