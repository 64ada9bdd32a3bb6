"""URL filter: association rules mined by FP-growth, matched by inverted index.

URLs become sets of tokens (scheme, domain suffixes, host labels and their pieces, path words, query keys). Spark's
FP-growth mines the labelled URLs' frequent token combinations, the label being one more item of the blocked ones, so
it counts each combination with and without the label. Every token above the support floor is mined; of tokens that
occur in the very same labelled URLs one stands for all (their combinations have the same counts), and tokens of all
labelled URLs are left out (they change no count). A combination becomes a rule if enough URLs have it (support),
enough of these are blocked (confidence), this is far above the share of all URLs (lift, and the Wilson bound of the
confidence), and no shorter rule that it holds is as confident. All rules are kept.

Rules are found by an inverted index: each stands under its rarest token, the tokens of the URLs are joined with
these, and a rule that is met applies if the URL has the rest of it. Each distinct URL is looked up once.
Listed rules of the form host/path come before the mined ones; of several that fit, the longest wins.

Bound: rules are mined from at most ``max_labelled`` labelled URLs, in the order of a hash of page_id (a documented
sample of labelled rows, taken after labels and pages have met); every URL is judged.

Defined cases: a null URL, or one without ``://``, has empty host and path and is allowed by the method;
null labels teach nothing; several labels of one page count as the worst; repeated rows each return a row;
without blocked labels no rules are mined; further columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

#: (verdict, host/path): a rule fits its host and all subdomains if the path begins with the rule's.
LISTED = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Item that stands for the label; no token looks like it.
BLOCKED = "!"


def host_of(url: str = "url") -> Column:
    """From after the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str = "url") -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: str, host: str, path: str) -> Column:
    """The URL's token set: ``s:`` scheme, ``d:`` domain suffixes, ``h:`` host labels and their hyphenated pieces, ``p:``
    words of the path that aren't numbers, ``q:`` query keys."""
    labels = F.split(F.col(host), "[.]")
    named = lambda kind, words: F.transform(words, lambda x: F.concat(F.lit(kind), x))
    scheme = F.array(F.lower(F.regexp_extract(F.col(url), r"(?s)^(.*?)://", 1)))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    pieces = F.flatten(F.transform(labels, lambda x: F.array_union(F.array(x), F.split(x, "-"))))
    words = F.filter(F.split(F.lower(F.col(path)), "[^a-z]+"), lambda x: F.length(x) > 1)
    query = F.regexp_extract(F.col(url), r"(?s)^[^?#]*[?]([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.substring_index(x, "=", 1))
    some = F.array_distinct(F.concat(named("s:", scheme), named("d:", suffixes), named("h:", pieces), named("p:", words), named("q:", keys)))
    return F.when(F.col(host) == "", F.array().cast("array<string>")).otherwise(F.filter(some, lambda x: F.length(x) > 2))


def with_tokens(pages: DataFrame) -> DataFrame:
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    return rows.withColumns({"host": host_of(), "path": path_of()}).withColumn("tokens", tokens_of("url", "host", "path"))


RULES = "rule_id bigint, items array<string>, anchor string, support double, confidence double"


def mine(
    tokened: DataFrame, labels: DataFrame, id_col: str = "doc_id", min_support: float = 0.001, min_count: int = 30, min_confidence: float = 0.5, min_lift: float = 1.5,
    z: float = 3.0, max_labelled: int = 100_000, max_tokens: int = 4,
) -> DataFrame:
    """Rules ``(rule_id, items, anchor, support, confidence)`` from labels: quality 0 or toxic 1 is to block."""
    spark = tokened.sparkSession
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0))
    own = labels.where(f"{id_col} is not null and (quality is not null or toxic is not null)")
    own = own.groupBy(F.col(id_col).cast("bigint").alias("page_id")).agg(bad.alias("bad"))
    rows = tokened.where("size(tokens) > 0").join(own, "page_id").select("page_id", "tokens", "bad")
    rows = materialize(spark, rows.orderBy(F.xxhash64("page_id"), "page_id", "tokens").limit(max_labelled), "labelled")
    total, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("bad"), F.lit(0))).first()
    if not blocked or blocked == total:
        return spark.createDataFrame([], RULES)
    base, floor = blocked / total, max(min_count, min_support * total)
    # tokens of the same URLs, told by two sums of hashes, are one item
    mark = F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("at")).alias("x"), F.sum(F.xxhash64("at", F.lit(1)).cast("decimal(38,0)")).alias("y"))
    met = rows.withColumn("at", F.monotonically_increasing_id()).select("at", F.explode("tokens").alias("t")).groupBy("t").agg(mark.alias("mark"))
    met = met.where((F.col("mark.n") >= floor) & (F.col("mark.n") < total))
    alike = materialize(spark, met.groupBy("mark").agg(F.min(F.struct(F.length("t"), "t"))["t"].alias("t")).select("t", "mark.n"), "items")
    items = alike.agg(F.coalesce(F.collect_set("t"), F.array().cast("array<string>")).alias("t"))  # at most tokens of max_labelled URLs / floor
    baskets = rows.withColumn("items", F.array_intersect("tokens", items.scalar())).where("size(items) > 0")
    baskets = baskets.select(F.when(F.col("bad") == 1, F.array_append("items", F.lit(BLOCKED))).otherwise(F.col("items")).alias("items"))
    lowest = max(min_confidence, min_lift * base)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, lowest * floor / total), numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = model.fit(baskets).freqItemsets.where(f"size(items) <= {max_tokens + 1}")
    # support of a combination with the label over its support: the rule's confidence
    hits = found.where(F.array_contains("items", BLOCKED) & (F.size("items") > 1)).select(F.array_sort(F.array_remove("items", BLOCKED)).alias("items"), F.col("freq").alias("hits"))
    every = found.where(~F.array_contains("items", BLOCKED)).select(F.array_sort("items").alias("items"), F.col("freq").alias("n")).where(F.col("n") >= floor)
    rules = hits.join(every, "items").where(F.size("items") <= max_tokens).withColumn("confidence", F.col("hits") / F.col("n")).where(F.col("confidence") >= lowest)
    p, n = F.col("confidence"), F.col("n")
    wilson = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    rules = materialize(spark, rules.where(wilson > base), "rules")
    # rules fall to shorter ones that they hold: each is looked up under its proper subsets
    lesser = rules.select("items", "confidence", F.explode(F.expr(SUBSETS)).alias("part")).where(F.size("part") < F.size("items"))
    fallen = lesser.join(rules.select(F.col("items").alias("part"), F.col("confidence").alias("theirs")), "part").where("theirs >= confidence").select("items").distinct()
    kept = rules.join(fallen, "items", "left_anti")
    # each under its rarest token
    rare = kept.select("items", F.explode("items").alias("t")).join(alike, "t").groupBy("items").agg(F.min(F.struct("n", "t"))["t"].alias("anchor"))
    out = kept.join(rare, "items").withColumn("rule_id", F.xxhash64("items"))
    return out.select("rule_id", "items", "anchor", (F.col("n") / total).alias("support"), "confidence")


#: All subsets of ``items`` but the empty one, each in order.
SUBSETS = "transform(sequence(1, shiftleft(1, size(items)) - 1), m -> filter(items, (x, i) -> shiftright(m, i) % 2 = 1))"


def matched(spark: SparkSession, tokened: DataFrame, rules: DataFrame) -> DataFrame:
    """``(url, best)`` of the URLs that some rule applies to: the most confident one, as struct (confidence, mined_rule)."""
    rules = materialize(spark, rules.select("items", "anchor", "confidence"), "index")  # its size is known to the join
    if rules.isEmpty():
        return spark.createDataFrame([], "url string, best struct<confidence:double,mined_rule:string>")
    urls = tokened.where("size(tokens) > 0").select("url", "tokens").distinct()
    met = urls.select("url", "tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor")
    fits = met.where(F.size(F.array_except("items", "tokens")) == 0)
    best = F.max(F.struct("confidence", F.concat_ws(" ", "items").alias("mined_rule")))
    return fits.groupBy("url").agg(best.alias("best"))


def judge(spark: SparkSession, pages: DataFrame, labels: DataFrame, listed: tuple = LISTED, **mining) -> DataFrame:
    """``(page_id, host, path, rule, verdict, mined_rule, confidence)``: one row for each row of ``pages``."""
    tokened = with_tokens(pages)
    met = matched(spark, tokened, mine(tokened, labels, **mining))
    told = tokened.drop("tokens").join(met, "url", "left")
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("best").isNotNull(), "block").otherwise("allow")
    for kind, text in sorted(listed, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first, so it's added last
        host, slash, rest = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return told.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.col("best.mined_rule").alias("mined_rule"), F.col("best.confidence").alias("confidence"))
