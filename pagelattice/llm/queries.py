"""One registered query for each operator of the training-data pipeline, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html_extract, jpeg_media, lpt_shards, pii, simhash, sp_wfst, toxicity, url_rules, warc_revisit
from .common import table

#: Name of the tokenizer model that the SentencePiece query and stage read.
TOKENIZER = "piece_bpe_32k.model"


def tokenizer_bytes(path: str | None = None) -> bytes:
    """A tokenizer model's bytes; ``path`` None: the public one that the environment offers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, "rb") as f:
        return f.read()


def op1_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_jpeg_thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = jpeg_media.store_and_read(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(spark, table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def url_rules_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 with labels that depend on the URLs, as those of the sample tables don't: pages of one kind of host are
    bad, pages of another with a query key, and one in twelve of all pages by chance."""
    pages = table(spark, sf_dir, "pages")
    planted = F.expr("url like '%://blog.%' or url like '%.net/%' and url like '%?%'")
    chance = F.expr("pmod(xxhash64(page_id), 12) = 0")
    labels = pages.select(F.col("page_id").alias("doc_id"), F.when(planted | chance, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
    return url_rules.judge(spark, pages, labels)


def op4_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = lpt_shards.shard(spark, table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(spark, docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pii.pseudonymise(docs, kinds_col="kinds")
    return done.select("doc_id", "text", F.size("kinds").alias("n_replaced"), F.array_join("kinds", ",").alias("kinds"))


def op7_sentencepiece_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_wfst.encode_documents(table(spark, sf_dir, "documents"), tokenizer_bytes())


def sentencepiece_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 with a model whose weights decide: a unigram model over the same pieces."""
    return sp_wfst.encode_documents(table(spark, sf_dir, "documents"), sp_wfst.zipf_unigram(tokenizer_bytes()), with_ids=False)


def op8_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def warc_records(pages: DataFrame) -> DataFrame:
    """A crawl's records made from ``pages`` by rule, for want of a WARC table: one or two full responses of each
    page and revisits of them, some before the first response, with a changed ETag, or without validators."""
    tag = "md5(coalesce(html, ''))"
    base = "timestamp'2024-01-01 00:00:00'"
    day = "'Mon, 01 Jan 2024 00:00:' || lpad(cast(page_id % 60 as string), 2, '0') || ' GMT'"
    page = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.expr(tag).alias("tag"), F.expr(day).alias("day"))
    line = lambda name, value, when="true": f"if({when}, '{name}: ' || {value} || '\r\n', '')"
    full = "'HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nCache-Control: max-age=60\r\n' || "
    same = "'HTTP/1.1 304 Not Modified\r\nCache-Control: max-age=3600\r\nContent-Type: text/none\r\n' || "
    first = full + line("ETag", "'\"' || tag || '\"'", "page_id % 7 <> 3") + " || " + line("Last-Modified", "day", "page_id % 2 = 0")
    second = full + line("ETag", "'\"v2-' || tag || '\"'")
    etag = "if(page_id % 5 = 0, 'W/', '') || if(page_id % 13 = 0, '\"x\"', if(page_id % 3 = 0, '\"v2-', '\"') || tag || '\"')"
    revisit = same + line("etag", etag, "page_id % 7 <> 3") + " || " + line("Last-Modified", "day", "page_id % 2 = 0")
    kinds = [
        ("response", 0, "200", "url", "page_id * 97", first, "tag", "true"),
        ("response", 1, "200", "replace(url, 'http://', 'https://')", "page_id * 97 + 1800", second, "md5(tag)", "page_id % 3 = 0"),
        ("revisit", 2, "304", "url || '#later'", "page_id * 97 + 3600 * (page_id % 11 + 1)", revisit, "cast(null as string)", "true"),
        ("revisit", 3, "304", "url", "page_id * 97 - 1", revisit, "cast(null as string)", "page_id % 4 = 0"),
    ]
    made = [
        f"struct(page_id * 4 + {k} as record_id, {url} as url, {base} + make_dt_interval(0, 0, 0, {at}) as warc_date, {status} as status, '{kind}' as kind, {head} as head, {digest} as payload_digest, {when} as made)"
        for kind, k, status, url, at, head, digest, when in kinds
    ]
    rows = page.select(F.explode(F.expr(f"array({', '.join(made)})")).alias("r")).select("r.*").where("made").drop("made")
    return rows.withColumn("headers", warc_revisit.parse_headers("head")).drop("head")


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisit.resolve(spark, warc_records(table(spark, sf_dir, "pages")))
    return found.select("record_id", F.expr("record_id div 4").alias("page_id"), "url_key", "source_id", "outcome", F.to_json("headers").alias("headers"), "payload_digest")


def op10_decontamination_lsa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_html_layout,
        op2_jpeg_thumbnails,
        op3_url_rules,
        op4_lpt_shards,
        op5_toxicity_cnn,
        op6_pii_feistel,
        op7_sentencepiece_wfst,
        op8_simhash_gray,
        op9_warc_revisits,
        op10_decontamination_lsa,
        sentencepiece_unigram,
        url_rules_planted,
        media_digests,
        url_listed,
        shard_loads,
    ]
    return {f.__name__: f for f in own}


def media_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of operator 2's columns is told by the text alone, read back from the stored images."""
    return op2_jpeg_thumbnails(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", (F.col("width") * F.col("height") / 64).cast("bigint").alias("pixels"))


def url_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3's hosts, paths and listed rules, with nothing mined."""
    labels = table(spark, sf_dir, "labels").limit(0)
    return url_rules.judge(spark, table(spark, sf_dir, "pages"), labels).select("page_id", "host", "path", "rule", "verdict")


def shard_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4's shards: bytes, whether slots run from 0 without gaps, and how many texts are torn apart."""
    placed = op4_lpt_shards(spark, sf_dir)
    torn = placed.groupBy("size", "text_crc32").agg(F.count_distinct("shard").alias("n")).where("n > 1").agg(F.count("*").alias("torn"))
    dense = (F.min("slot") == 0) & (F.max("slot") == F.count("*") - 1) & (F.count_distinct("slot") == F.count("*"))
    return placed.groupBy("shard").agg(F.sum("size").alias("bytes"), dense.alias("dense")).withColumn("torn", torn.scalar())


#: The last 16 bytes of a payload and their CRC-32, bit by bit; the payload's padding is plain spaces.
_MEDIA_SQL = """
WITH p AS (SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) AS n FROM documents),
q AS (SELECT *, CASE WHEN n = 0 THEN 192 ELSE n + (192 - n % 192) % 192 END AS size FROM p),
r AS (SELECT doc_id, n, size, t || repeat(' ', CAST(size - n AS BIGINT)) AS pay FROM q),
b AS (SELECT *, right(hex(encode(right(pay, 16))), 32) AS tail FROM r),
c AS (SELECT *, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(16), lambda i: CAST(('0x' || substring(tail, CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT))),
  lambda c, x: list_reduce(list_prepend(xor(c, x), CAST(range(8) AS BIGINT[])), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))) AS crc FROM b)
SELECT doc_id, n AS n_bytes, size AS payload_bytes, sha256(pay) AS payload_sha256, xor(crc, 4294967295) AS tail_crc32, size AS pixels FROM c"""

_URL_SQL = """
WITH p AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS h, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
q AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p),
r AS (SELECT *, CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM q)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r"""

_SHARD_SQL = """
WITH RECURSIVE g AS (SELECT sum(strlen(coalesce(text, '')) + 8) AS total FROM documents GROUP BY coalesce(text, '')),
o AS (SELECT CAST(total AS BIGINT) AS total, row_number() OVER (ORDER BY total DESC) AS k FROM g),
-- one group after the other goes to the first of the least-loaded shards
s AS (SELECT CAST(0 AS BIGINT) AS k, list_transform(range(24), lambda i: CAST(0 AS BIGINT)) AS loads
  UNION ALL SELECT o.k, list_transform(range(24), lambda i: loads[i + 1] + CASE WHEN i + 1 = list_position(loads, list_min(loads)) THEN o.total ELSE 0 END) FROM s JOIN o ON o.k = s.k + 1),
e AS (SELECT loads FROM s ORDER BY k DESC LIMIT 1)
SELECT CAST(i AS INTEGER) AS shard, loads[i + 1] AS bytes, true AS dense, CAST(0 AS BIGINT) AS torn FROM (SELECT unnest(range(24)) AS i, loads FROM e) WHERE loads[i + 1] > 0"""

_WARC_SQL = """
WITH t AS (SELECT page_id, url, md5(coalesce(html, '')) AS tag, 'Mon, 01 Jan 2024 00:00:' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') || ' GMT' AS day FROM pages),
r AS (
  SELECT page_id, page_id * 4 AS record_id, url, page_id * 97 AS sec, true AS full_, CASE WHEN page_id % 7 <> 3 THEN '"' || tag || '"' END AS etag, CASE WHEN page_id % 2 = 0 THEN day END AS modified, tag AS digest FROM t
  UNION ALL SELECT page_id, page_id * 4 + 1, replace(url, 'http://', 'https://'), page_id * 97 + 1800, true, '"v2-' || tag || '"', NULL, md5(tag) FROM t WHERE page_id % 3 = 0
  UNION ALL SELECT page_id, page_id * 4 + k, CASE k WHEN 2 THEN url || '#later' ELSE url END, CASE k WHEN 2 THEN page_id * 97 + 3600 * (page_id % 11 + 1) ELSE page_id * 97 - 1 END, false,
    CASE WHEN page_id % 7 <> 3 THEN CASE WHEN page_id % 5 = 0 THEN 'W/' ELSE '' END || CASE WHEN page_id % 13 = 0 THEN '"x"' ELSE CASE WHEN page_id % 3 = 0 THEN '"v2-' ELSE '"' END || tag || '"' END END,
    CASE WHEN page_id % 2 = 0 THEN day END, NULL FROM t, (SELECT unnest([2, 3]) AS k) WHERE k = 2 OR page_id % 4 = 0),
b AS (SELECT *, regexp_replace(regexp_replace(trim(url, ' '), '^[A-Za-z][A-Za-z0-9+.\\-]*://', ''), '#.*$', '') AS bare FROM r),
h AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^(?:[^/?@]*@)?([^/?]*)', 1)), ':(80|443)?$', ''), '\\.$', ''), '^www[0-9]*\\.', '') AS host,
  regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '[?](.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid|jsessionid)(=|$)'))), '&') AS query FROM b),
k AS (SELECT *, CASE WHEN url IS NOT NULL AND host <> '' THEN host || path || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS url_key FROM h),
f AS (SELECT *, last_value(CASE WHEN full_ AND url_key IS NOT NULL THEN struct_pack(id := record_id, etag := etag, modified := modified, digest := digest) END IGNORE NULLS)
  OVER (PARTITION BY url_key ORDER BY sec, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS src FROM k),
o AS (SELECT *, CASE WHEN url_key IS NULL THEN 'no url or date' WHEN src IS NULL THEN 'no earlier response'
  WHEN etag IS NOT NULL AND src.etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') <> regexp_replace(src.etag, '^W/', '') THEN 'etag differs' ELSE 'resolved' END
  WHEN modified IS NOT NULL AND src.modified IS NOT NULL THEN CASE WHEN modified <> src.modified THEN 'last-modified differs' ELSE 'resolved' END ELSE 'no validator' END AS outcome FROM f WHERE NOT full_)
SELECT record_id, page_id, url_key, CASE WHEN outcome = 'resolved' THEN src.id END AS source_id, outcome,
  CASE WHEN outcome = 'resolved' THEN '{"content-type":"text/html"' || CASE WHEN etag IS NULL AND src.etag IS NOT NULL THEN ',"etag":"' || replace(src.etag, '"', '\\"') || '"' ELSE '' END
    || CASE WHEN modified IS NULL AND src.modified IS NOT NULL THEN ',"last-modified":"' || src.modified || '"' ELSE '' END || ',"cache-control":"max-age=3600"'
    || CASE WHEN etag IS NOT NULL THEN ',"etag":"' || replace(etag, '"', '\\"') || '"' ELSE '' END || CASE WHEN modified IS NOT NULL THEN ',"last-modified":"' || modified || '"' ELSE '' END || '}' END AS headers,
  CASE WHEN outcome = 'resolved' THEN src.digest END AS payload_digest FROM o"""


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can express; tests hold the other queries against brute force."""
    return {"media_digests": _MEDIA_SQL, "url_listed": _URL_SQL, "shard_loads": _SHARD_SQL, "op9_warc_revisits": _WARC_SQL}
