"""The engine's input views, made from the sample tables by integer rules alike in both engines.

Each view is a DataFrame here, and a common table expression of the same name for the oracle. The sample
tables hold no page images or boxes, so lines, blocks, boxes, candidates and cells are derived from row
numbers and lengths; all arithmetic is on integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LABELS = ["doc_title", "text", "table", "figure", "footnote", "footer", "aside_text", "number", "Header", "unknown_label"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan of a few splits, which would keep most cores idle; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() * 4 < cores else df


def v_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of a document (one page each) with boxes and confidences."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).where("doc_id is not null and text is not null")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    x0, y0 = F.expr("cast((ord % 3) * 200 as int)"), F.expr("cast((ord div 3) * 24 + (doc_id + ord) % 5 as int)")
    wide = F.expr("cast(8 * least(length(text), 24) + ((ord * 13) % 60) as int)")
    conf = F.expr("cast((doc_id * 31 + ord * 17) % 100 as double) / 100")
    return rows.select("doc_id", F.col("ord").cast("bigint").alias("ord"), "text", x0.alias("x0"), y0.alias("y0"), (x0 + wide).alias("x1"), (y0 + 20).alias("y1"), conf.alias("confidence"))


V_LINE = """
v_line AS (
  SELECT doc_id, ord, text, x0, y0, x0 + wide AS x1, y0 + 20 AS y1, CAST((doc_id * 31 + ord * 17) % 100 AS DOUBLE) / 100 AS confidence
  FROM (SELECT *, (ord % 3) * 200 AS x0, (ord // 3) * 24 + (doc_id + ord) % 5 AS y0, 8 * least(length(text), 24) + ((ord * 13) % 60) AS wide
        FROM (SELECT doc_id, unnest(range(len(parts))) AS ord, unnest(parts) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL))))"""


def v_line_tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a jittered, less confident copy of every fourth, as overlapping tiles give."""
    lines = v_line(spark, sf_dir)
    copies = lines.where("ord % 4 = 0").select(
        "doc_id", (F.col("ord") + 100000).alias("ord"), "text", (F.col("x0") + 2).alias("x0"), (F.col("y0") + 1).alias("y0"),
        (F.col("x1") + 2).alias("x1"), (F.col("y1") + 1).alias("y1"), (F.col("confidence") / 2).alias("confidence"),
    )
    return lines.unionByName(copies)


V_LINE_TILED = """
v_line_tiled AS (
  SELECT doc_id, ord, text, x0, y0, x1, y1, confidence FROM v_line
  UNION ALL SELECT doc_id, ord + 100000, text, x0 + 2, y0 + 1, x1 + 2, y1 + 1, confidence / 2 FROM v_line WHERE ord % 4 = 0)"""


def v_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout blocks: one for every four rows of a document's lines, some narrow, every seventh left out."""
    rows = v_line(spark, sf_dir).groupBy("doc_id").agg(F.max("ord").alias("top"))
    blocks = rows.select("doc_id", F.explode(F.expr("sequence(0L, (top div 3) div 4)")).alias("block")).where("(doc_id + block) % 7 <> 6")
    label = F.element_at(F.array(*[F.lit(x) for x in LABELS]), F.expr(f"cast((doc_id + block) % {len(LABELS)} as int) + 1"))
    x1 = F.expr("cast(if((doc_id + block) % 3 = 0, 350, 700) as int)")
    y0 = F.expr("cast(block * 96 as int)")
    return blocks.select("doc_id", "block", label.alias("label"), F.lit(0).alias("x0"), y0.alias("y0"), x1.alias("x1"), (y0 + 96).alias("y1"), F.expr("cast((doc_id + block * 7) % 100 as double) / 100").alias("score"))


V_BLOCK = f"""
v_block AS (
  SELECT doc_id, block, ({LABELS!r})[CAST((doc_id + block) % {len(LABELS)} AS BIGINT) + 1] AS label, 0 AS x0, block * 96 AS y0,
         CASE WHEN (doc_id + block) % 3 = 0 THEN 350 ELSE 700 END AS x1, block * 96 + 96 AS y1, CAST((doc_id + block * 7) % 100 AS DOUBLE) / 100 AS score
  FROM (SELECT doc_id, unnest(range((top // 3) // 4 + 1)) AS block FROM (SELECT doc_id, max(ord) AS top FROM v_line GROUP BY doc_id))
  WHERE (doc_id + block) % 7 <> 6)"""


def v_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readings of each line: alike, head or tail cut, longer, with a lost decimal point, or unrelated."""
    case = "(doc_id + ord) % 6"
    ocr = f"if({case} = 4, concat(text, ' 7.1%'), text)"
    cand = (
        f"case {case} when 0 then text when 1 then substring(text, cast(1 + length(text) div 3 as int)) when 2 then substring(text, 1, cast(2 * length(text) div 3 as int)) "
        f"when 3 then concat(text, ' and twelve more words') when 4 then concat(text, ' 71%') else reverse(text) end"
    )
    return v_line(spark, sf_dir).select("doc_id", "ord", "x0", "y0", F.expr(ocr).alias("ocr"), F.expr(cand).alias("cand"))


V_READING = """
v_reading AS (
  SELECT doc_id, ord, x0, y0, CASE WHEN (doc_id + ord) % 6 = 4 THEN text || ' 7.1%' ELSE text END AS ocr,
         CASE (doc_id + ord) % 6 WHEN 0 THEN text WHEN 1 THEN substring(text, 1 + length(text) // 3) WHEN 2 THEN substring(text, 1, 2 * length(text) // 3)
         WHEN 3 THEN text || ' and twelve more words' WHEN 4 THEN text || ' 71%' ELSE reverse(text) END AS cand
  FROM v_line)"""


def v_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of order lines, a page for each order: a table that grows with the data."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("q"))
    x0, y0 = F.expr("cast(l_partkey % 400 as int)"), F.expr("cast(l_suppkey % 300 as int)")
    return rows.select(
        F.col("l_orderkey").cast("bigint").alias("page"), F.expr("cast(l_linenumber as bigint) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000").alias("ord"), x0.alias("x0"), y0.alias("y0"),
        (x0 + 40 + F.col("q").cast("int") * 4).alias("x1"), (y0 + 20 + F.col("q").cast("int")).alias("y1"), F.expr("cast(l_partkey % 97 as double) / 97").alias("confidence"),
    )


V_BOX = """
v_box AS (
  SELECT l_orderkey AS page, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000 AS ord, x0, y0, x0 + 40 + q * 4 AS x1, y0 + 20 + q AS y1, CAST(l_partkey % 97 AS DOUBLE) / 97 AS confidence
  FROM (SELECT *, l_partkey % 400 AS x0, l_suppkey % 300 AS y0, CAST(l_quantity AS BIGINT) AS q FROM lineitem))"""


def v_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-D mass profiles of 400 positions: orders by day; positions 30 to 54 of every hundred are empty."""
    orders = table(spark, sf_dir, "orders")
    days = orders.select(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint").alias("day")).where("day >= 0")
    mass = days.groupBy(F.expr("day div 400").alias("profile"), F.expr("day % 400").alias("pos")).agg(F.count("*").alias("n"))
    every = mass.select("profile").distinct().select("profile", F.explode(F.expr("sequence(0L, 399L)")).alias("pos"))
    return every.join(mass, ["profile", "pos"], "left").select("profile", "pos", F.expr("if(pos % 100 between 30 and 54, 0L, coalesce(n, 0L))").alias("mass"))


V_PROFILE = """
v_profile AS (
  SELECT e.profile, e.pos, CASE WHEN e.pos % 100 BETWEEN 30 AND 54 THEN 0 ELSE coalesce(n, 0) END AS mass
  FROM (SELECT profile, unnest(range(400)) AS pos FROM (SELECT DISTINCT day // 400 AS profile FROM (SELECT CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS day FROM orders) WHERE day >= 0)) e
  LEFT JOIN (SELECT day // 400 AS profile, day % 400 AS pos, count(*) AS n FROM (SELECT CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS day FROM orders) WHERE day >= 0 GROUP BY ALL) m
  ON e.profile = m.profile AND e.pos = m.pos)"""


def v_htmlblock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings, paragraphs and list items of pages in order, as blocks for chunking; list items count as tables."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html")).where("page_id is not null and html is not null")
    found = F.regexp_extract_all("html", F.lit(r"(?s)(<h1>.*?</h1>|<p>.*?</p>|<li>.*?</li>)"), F.lit(1))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.posexplode(found).alias("ord", "raw"))
    kind = F.when(F.col("raw").startswith("<li>"), "table").otherwise("text")
    text = F.regexp_replace("raw", "<[^>]*>", "")
    marked = F.when(F.col("raw").startswith("<h1>"), F.concat(F.lit("1. "), F.substring(text, 1, 60))).otherwise(text)
    return rows.select("page_id", F.col("ord").cast("bigint").alias("ord"), kind.alias("kind"), marked.alias("text"))


V_HTMLBLOCK = """
v_htmlblock AS (
  SELECT page_id, ord, CASE WHEN starts_with(raw, '<li>') THEN 'table' ELSE 'text' END AS kind,
         CASE WHEN starts_with(raw, '<h1>') THEN '1. ' || substring(regexp_replace(raw, '<[^>]*>', '', 'g'), 1, 60) ELSE regexp_replace(raw, '<[^>]*>', '', 'g') END AS text
  FROM (SELECT page_id, unnest(range(len(found))) AS ord, unnest(found) AS raw
        FROM (SELECT page_id, regexp_extract_all(html, '(?s)(<h1>.*?</h1>|<p>.*?</p>|<li>.*?</li>)', 1) AS found FROM pages WHERE page_id IS NOT NULL AND html IS NOT NULL)))"""


def v_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field cells of a user's document, from events: document and event scope, sentinels and statuses by rule."""
    rows = table(spark, sf_dir, "events").where("user_id is not null and event_id is not null")
    value = (
        "case event_id % 9 when 0 then 'not_found' when 1 then ' 없음 ' when 2 then '' when 3 then '-' when 4 then concat('rate ', event_id % 50, '.', event_id % 10, '%') "
        "when 5 then '\"N/A\"' else concat(event_type, ' ', event_id % 1000) end"
    )
    status = "element_at(array('found', 'not_found', 'uncertain'), cast(event_id % 3 as int) + 1)"
    return rows.select(
        F.col("user_id").cast("bigint").alias("doc_id"), F.expr("if(event_id % 5 = 0, 'event', 'field')").alias("scope"), F.expr("cast(if(event_id % 5 = 0, event_id % 3 + 1, 0) as bigint)").alias("event_no"),
        F.expr("concat('f', event_id % 12)").alias("field_key"), F.expr(value).alias("value"), F.expr(status).alias("status"), F.col("event_id").cast("bigint").alias("ord"),
    )


V_CELL = """
v_cell AS (
  SELECT user_id AS doc_id, CASE WHEN event_id % 5 = 0 THEN 'event' ELSE 'field' END AS scope, CASE WHEN event_id % 5 = 0 THEN event_id % 3 + 1 ELSE 0 END AS event_no,
         'f' || (event_id % 12) AS field_key,
         CASE event_id % 9 WHEN 0 THEN 'not_found' WHEN 1 THEN ' 없음 ' WHEN 2 THEN '' WHEN 3 THEN '-' WHEN 4 THEN 'rate ' || (event_id % 50) || '.' || (event_id % 10) || '%'
         WHEN 5 THEN '"N/A"' ELSE event_type || ' ' || (event_id % 1000) END AS value,
         (['found', 'not_found', 'uncertain'])[event_id % 3 + 1] AS status, event_id AS ord
  FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL)"""

#: Field specifications: key, obligation, enum or derived, order.
SPECS = [
    ("f0", "필수", False), ("f1", "필수", False), ("f2", "권장", False), ("f3", "분류", True), ("f4", "수집", False), ("f5", "필수", False),
    ("f6", "관측", False), ("f7", None, False), ("f8", "필수", True), ("f9", "권장", False), ("f10", "필수", False),
]
#: Conditions: key, order, rule, values, fields.
CONDITIONS = [
    ("f0", 0, "subtype_in", ["적금", "예금"], []), ("f0", 1, "trigger_any", [], ["f1", "f2"]), ("f1", 0, "subtype_not_in", ["입출금"], []),
    ("f2", 0, "ad_type_in", ["view", "click"], []), ("f5", 0, "conditional", [], ["f9"]), ("f9", 0, "unknown", [], []), ("f10", 0, "trigger_any", [], ["f4"]),
    ("f8", 0, "subtype_in", ["적금"], []),
]


def v_spec(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SPECS, "field_key string, obligation string, unverifiable boolean")


def v_cond(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONDITIONS, "field_key string, ord int, rule string, choices array<string>, fields array<string>")


def _sql(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).upper()
    if isinstance(x, list):
        return "[" + ", ".join(map(_sql, x)) + "]" if x else "CAST([] AS VARCHAR[])"
    return str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


V_SPEC = "v_spec(field_key, obligation, unverifiable) AS (VALUES " + ", ".join("(" + ", ".join(map(_sql, r)) + ")" for r in SPECS) + ")"
V_COND = "v_cond(field_key, ord, rule, choices, fields) AS (VALUES " + ", ".join("(" + ", ".join(map(_sql, r)) + ")" for r in CONDITIONS) + ")"


def v_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtype and ad type of each user's document."""
    users = table(spark, sf_dir, "events").where("user_id is not null").select(F.col("user_id").cast("bigint").alias("doc_id")).distinct()
    subtype = F.element_at(F.array(F.lit("적금"), F.lit("예금"), F.lit("입출금"), F.lit("판단불가"), F.lit(None)), F.expr("cast(doc_id % 5 as int) + 1"))
    ad_type = F.element_at(F.array(F.lit("view"), F.lit("click"), F.lit("other")), F.expr("cast(doc_id % 3 as int) + 1"))
    return users.select("doc_id", subtype.alias("subtype"), ad_type.alias("ad_type"))


V_DOC = """
v_doc AS (
  SELECT DISTINCT user_id AS doc_id, (['적금', '예금', '입출금', '판단불가', NULL])[user_id % 5 + 1] AS subtype, (['view', 'click', 'other'])[user_id % 3 + 1] AS ad_type
  FROM events WHERE user_id IS NOT NULL)"""

_ALL = {"v_line": V_LINE, "v_line_tiled": V_LINE_TILED, "v_block": V_BLOCK, "v_reading": V_READING, "v_box": V_BOX, "v_profile": V_PROFILE, "v_htmlblock": V_HTMLBLOCK, "v_cell": V_CELL, "v_spec": V_SPEC, "v_cond": V_COND, "v_doc": V_DOC}
_NEEDS = {"v_line_tiled": ["v_line"], "v_block": ["v_line"], "v_reading": ["v_line"]}


def with_views(names: str, query: str, recursive: bool = False) -> str:
    """The oracle's query with the views it names, and those they need, before it; ``query`` may begin with
    further common table expressions, each ended by a comma, before its SELECT."""
    wanted: list[str] = []
    for name in names.split():
        wanted += [n for n in [*_NEEDS.get(name, []), name] if n not in wanted]
    return "WITH " + ("RECURSIVE " if recursive else "") + ",\n".join(_ALL[n].strip() for n in wanted) + (",\n" if query.lstrip()[:6].upper() != "SELECT" else "\n") + query.strip()
