"""WARC: resolution of not-modified revisits.

A revisit of the server-not-modified profile has a 304 response's headers and no body. Its content is that
of the latest full response (status 200) of the same canonical URL captured before it, provided that the
validators agree: the ETag by weak comparison where both sides have one, else Last-Modified. The merged
record takes the response's headers, those that a 304 may update replaced by the revisit's.

The as-of join never gathers a URL: records are range-partitioned by (URL, time), each slice fills its
revisits forward from its own responses, and the last response of each slice of a URL is carried to the
slices after it in a second, small step. A URL with a third of all records is spread over many slices.

Defined cases: records without URL or date, and revisits before any response, stay unresolved, with a
reason; records at the very same time are ordered by record_id, so a response of that time with a smaller
record_id counts as earlier; null headers count as none; repeated rows each return a row; an empty table
returns no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

#: Headers that a 304 response updates in the stored one (fixed values); all others stay the response's.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "set-cookie", "vary", "warning")
#: Query parameters that don't change what is fetched (fixed values).
TRACKING = "utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid|jsessionid"


def canonical_url(url: str) -> Column:
    """Scheme, user and fragment dropped; host lower-cased without www., default port and trailing dot;
    tracking parameters dropped and the others sorted; a trailing slash and an empty path dropped."""
    text = F.trim(F.col(url))
    bare = F.regexp_replace(F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), "#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"\.$", ""), r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(bare, r"[?](.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda x: (x != "") & ~F.lower(x).rlike(rf"^({TRACKING})(=|$)"))), "&")
    return F.when(text.isNotNull() & (host != ""), F.concat(host, path, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def parse_headers(block: str) -> Column:
    """Header lines to a map of lower-cased names; of repeated names the values are joined by a comma."""
    lines = F.filter(F.split(F.coalesce(F.col(block), F.lit("")), "\r?\n"), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    values = F.transform(names, lambda n: F.array_join(F.transform(F.filter(pairs, lambda p: p["k"] == n), lambda p: p["v"]), ", "))
    return F.map_from_arrays(names, values)


def _etag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve(spark: SparkSession, records: DataFrame, slices: int | None = None) -> DataFrame:
    """Revisits with what they stand for.

    ``records``: record_id bigint, url string, warc_date timestamp, status int, kind ('response' or
    'revisit'), headers map<string,string>, payload_digest string. Returns for each revisit (record_id,
    url_key, source_id, outcome, headers, payload_digest); outcome is 'resolved', 'etag differs',
    'last-modified differs', 'no validator', 'no earlier response' or 'no url or date'.
    """
    rows = records.select("record_id", canonical_url("url").alias("url_key"), "warc_date", "status", "kind", "headers", "payload_digest")
    rows = rows.where("kind = 'revisit' or kind = 'response' and status = 200 and url_key is not null and warc_date is not null")
    rows = materialize(spark, rows, "parsed")  # ranges are sampled, and headers should be parsed but once
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "url_key", "warc_date", "record_id").withColumn("slice", F.spark_partition_id())
    dealt = materialize(spark, dealt, "records")  # its slices are fixed from here on
    response = F.when(F.col("kind") == "response", F.struct("record_id", "headers", "payload_digest"))
    in_slice = Window.partitionBy("url_key", "slice").orderBy("warc_date", "record_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = dealt.withColumn("own", F.last(response, ignorenulls=True).over(in_slice)).where("kind = 'revisit'")
    ends = dealt.where("kind = 'response'").groupBy("url_key", "slice").agg(F.max_by(F.struct("record_id", "headers", "payload_digest"), F.struct("warc_date", "record_id")).alias("last"))
    # a slice of a URL takes the last response of the nearest slice before it that has one
    heads = dealt.select("url_key", "slice").distinct().join(ends, ["url_key", "slice"], "left")
    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.withColumn("carried", F.last("last", ignorenulls=True).over(before)).where("carried is not null").select("url_key", "slice", "carried")
    joined = filled.join(carried, ["url_key", "slice"], "left").withColumn("source", F.coalesce("own", "carried"))
    mine, theirs = F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>")), F.coalesce(F.col("source.headers"), F.create_map().cast("map<string,string>"))
    tagged = _etag(mine).isNotNull() & _etag(theirs).isNotNull()
    dated = mine["last-modified"].isNotNull() & theirs["last-modified"].isNotNull()
    outcome = (
        F.when(F.col("url_key").isNull() | F.col("warc_date").isNull(), "no url or date")
        .when(F.col("source").isNull(), "no earlier response")
        .when(tagged & (_etag(mine) != _etag(theirs)), "etag differs")
        .when(tagged, "resolved")
        .when(dated & (mine["last-modified"] != theirs["last-modified"]), "last-modified differs")
        .when(dated, "resolved")
        .otherwise("no validator")
    )
    fresh = F.map_filter(mine, lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    good = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "record_id", "url_key", F.when(good, F.col("source.record_id")).alias("source_id"), "outcome",
        F.when(good, merged).alias("headers"), F.when(good, F.col("source.payload_digest")).alias("payload_digest"),
    )


def parse_warc(data: bytes) -> list[dict]:
    """Records of an uncompressed WARC file: their WARC headers, status, HTTP header block and body.

    Stops at a record that is cut short; anything before it is returned.
    """
    out, at = [], 0
    while data.startswith(b"WARC/", at):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            break
        head = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        length = head.get("content-length", "0")
        size = int(length) if length.isdigit() else 0
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            break
        http, _, body = block.partition(b"\r\n\r\n")
        first = http.split(b"\r\n", 1)[0].split(b" ")
        status = int(first[1]) if first[0].startswith(b"HTTP/") and len(first) > 1 and first[1].isdigit() else None
        out.append({"warc": head, "status": status, "http": http.decode("latin-1"), "body": body})
        at = end + 4 + size
        while data.startswith(b"\r\n", at):
            at += 2
    return out
