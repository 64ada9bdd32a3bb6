"""Queries over chunks, reports and recall."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunks as K
from ..operators import layout as L
from ..operators import reports as R
from .adapters import table, v_block, v_htmlblock, v_line, with_views


def rag_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.chunk_blocks(v_htmlblock(spark, sf_dir), "page_id")


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks some of which hold image markers."""
    return v_htmlblock(spark, sf_dir).withColumn("text", F.expr("if(ord % 6 = 4, concat(text, '\\n[image:a', ord % 4, ']'), text)"))


def rag_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = _marked(spark, sf_dir)
    chunks = K.chunk_blocks(blocks, "page_id")
    captions = blocks.select("page_id").distinct().select("page_id", F.explode(F.expr("sequence(0, 3)")).alias("ord"))
    captions = captions.select("page_id", F.concat(F.lit("a"), F.col("ord").cast("string")).alias("asset_id"), "ord", F.expr("if((page_id + ord) % 7 = 0, null, concat('caption ', ord))").alias("text"))
    return K.anchor_captions(chunks, captions, "page_id").select("page_id", "place", "kind", "heading", "asset_id", "notes")


def rag_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).select("page_id", "ord", K.drop_markers(F.col("text"), F.array(F.lit("a0"), F.lit("a2"))).alias("text"))


def rag_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.to_markdown(rag_chunks(spark, sf_dir), "page_id")


def chunk_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rag_chunks(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("bigint").alias("chars"))


def hwp_table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells are order lines: three columns to a row, some blank, some with a table inside."""
    rows = table(spark, sf_dir, "lineitem")
    col = F.expr("cast(l_linenumber * 1000000 + l_partkey as bigint)")
    cells = rows.select(F.col("l_orderkey").cast("bigint").alias("doc_id"), F.expr("cast(l_linenumber div 3 as bigint)").alias("row"), col.alias("col"), F.expr("if(l_suppkey % 4 = 0, ' ', concat('s', l_suppkey % 3))").alias("text"), F.expr("if(l_partkey % 10 = 0, concat('n', l_partkey % 5, '\\n\\nm'), null)").alias("nested"))
    return K.table_lines(cells, ["doc_id"])


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.assign_lines(v_line(spark, sf_dir), L.first_blocks(v_block(spark, sf_dir), ["doc_id"]), ["doc_id"])


def parse_totals_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.parse_totals(_lines(spark, sf_dir), ["doc_id"])


def stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return R.stage_stats(events.select(F.col("event_type").alias("stage"), F.expr("event_id % 4 = 0").alias("cached"), F.expr("event_id % 1000").cast("bigint").alias("ms")))


def role_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = v_block(spark, sf_dir).withColumn("rule", L.role_of_label(F.col("label"))).withColumn("judged", F.expr("if(block % 4 = 1, '기타', rule)")).withColumn("permille", F.expr("cast((doc_id + block * 7) % 100 as bigint)"))
    return R.role_disagreement(regions, "rule", "judged", "permille")


def role_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = v_block(spark, sf_dir).withColumn("role", L.role_of_label(F.col("label"))).withColumn("role_confidence", F.col("score"))
    verdicts = regions.where("block % 3 <> 1").select("doc_id", "block", F.expr("if(block % 2 = 0, '본문', role)").alias("role"), F.lit(0.75).alias("confidence"))
    out = L.judged_roles(regions, verdicts, ["doc_id", "block"])
    return out.select("doc_id", "block", "role", "role_confidence", "role_source", "role_rule")


def sentence_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold sentences are lines of the documents, altered; pages are the documents."""
    lines = _lines(spark, sf_dir)
    regions = L.build_regions(v_line(spark, sf_dir), v_block(spark, sf_dir), ["doc_id"]).withColumn("vlm_reading", F.expr("if(block % 2 = 0, concat('extra words ', block), null)"))
    gold = lines.select("doc_id", F.col("ord").alias("item_id"), F.expr("case ord % 4 when 0 then concat('«', text, '»') when 1 then concat(text, ' zz') when 2 then concat('extra words ', ord div 3) else substring(text, 3) end").alias("text"))
    return R.sentence_recall(gold, lines, regions, "doc_id").groupBy("doc_id", "found").agg(F.count("*").alias("n"))


def box_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = v_block(spark, sf_dir)
    gold = v_line(spark, sf_dir).select("doc_id", F.col("ord").alias("item"), *[F.expr(f"{c} * 2").alias(c) for c in ("x0", "y0", "x1", "y1")], F.lit(2000).alias("gold_w"), F.lit(4000).alias("gold_h"), F.lit(1000).alias("canvas_w"), F.lit(2000).alias("canvas_h"))
    return R.box_recall(gold, regions, ["doc_id"])


def field_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v_line(spark, sf_dir).withColumn("t", F.expr("concat(text, ' ', doc_id % 90, ',000원')"))
    values = lines.where("ord % 2 = 0").select("doc_id", "ord", F.concat(F.lit("f"), F.col("ord").cast("string")).alias("field"), F.col("t").alias("value"))
    gold = lines.select("doc_id", F.col("ord").alias("item_id"), F.expr("case ord % 5 when 0 then concat('zz ', doc_id % 90, ',000원') when 1 then 'nowhere' else t end").alias("value"))
    return R.field_recall(gold, values, "doc_id")


def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return R.scorecard(orders.select(F.col("o_orderpriority").alias("file"), F.col("o_orderstatus").alias("metric"), F.expr("o_orderkey % 7 <> 0").alias("passed")))


def passage_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages that documents hold verbatim."""
    gold = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    return R.passages_found(gold, docs, "doc_id").groupBy("item_id").agg(F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("first_doc"))


_CHUNKS = """
b AS (SELECT page_id, ord, kind, trim(text, ' ') AS text, length(trim(text, ' ')) <= 80 AND regexp_matches(trim(text, ' '), '^\\s*(?:제?\\s?[0-9]+\\s?[.조항편장절관)]|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+\\s?\\.?|[가-힣]\\.|\\([0-9]+\\)|[0-9]+\\)|[□■◎○●◇◆▷▶☞]|【[^】]*】)') AS head FROM {rows} WHERE trim(text, ' ') <> ''),
g AS (SELECT page_id, list(struct_pack(kind := kind, text := text, head := head) ORDER BY ord) AS xs FROM b GROUP BY ALL),
f AS (SELECT page_id, list_reduce(list_prepend(struct_pack(kind := '', text := '', head := false, hd := CAST(NULL AS VARCHAR), op := CAST(NULL AS VARCHAR), buf := CAST([] AS VARCHAR[]), n := CAST(0 AS BIGINT), out := CAST([] AS STRUCT(kind VARCHAR, heading VARCHAR, text VARCHAR)[])),
    list_transform(xs, lambda x: struct_pack(kind := x.kind, text := x.text, head := x.head, hd := CAST(NULL AS VARCHAR), op := CAST(NULL AS VARCHAR), buf := CAST([] AS VARCHAR[]), n := CAST(0 AS BIGINT), out := CAST([] AS STRUCT(kind VARCHAR, heading VARCHAR, text VARCHAR)[])))),
  lambda a, x: CASE
    WHEN x.kind = 'table' THEN struct_pack(kind := '', text := '', head := false, hd := a.hd, op := CAST(NULL AS VARCHAR), buf := CAST([] AS VARCHAR[]), n := CAST(0 AS BIGINT),
      out := list_concat(a.out, CASE WHEN len(a.buf) > 0 THEN [struct_pack(kind := 'text', heading := a.op, text := array_to_string(a.buf, chr(10)))] ELSE CAST([] AS STRUCT(kind VARCHAR, heading VARCHAR, text VARCHAR)[]) END, [struct_pack(kind := 'table', heading := a.hd, text := x.text)]))
    WHEN x.head THEN struct_pack(kind := '', text := '', head := false, hd := x.text, op := x.text, buf := [x.text], n := CAST(length(x.text) AS BIGINT),
      out := list_concat(a.out, CASE WHEN len(a.buf) > 0 THEN [struct_pack(kind := 'text', heading := a.op, text := array_to_string(a.buf, chr(10)))] ELSE CAST([] AS STRUCT(kind VARCHAR, heading VARCHAR, text VARCHAR)[]) END))
    WHEN a.n + length(x.text) >= 700 THEN struct_pack(kind := '', text := '', head := false, hd := a.hd, op := CAST(NULL AS VARCHAR), buf := CAST([] AS VARCHAR[]), n := CAST(0 AS BIGINT),
      out := list_concat(a.out, [struct_pack(kind := 'text', heading := CASE WHEN len(a.buf) = 0 THEN a.hd ELSE a.op END, text := array_to_string(list_concat(a.buf, [x.text]), chr(10)))]))
    ELSE struct_pack(kind := '', text := '', head := false, hd := a.hd, op := CASE WHEN len(a.buf) = 0 THEN a.hd ELSE a.op END, buf := list_concat(a.buf, [x.text]), n := CAST(a.n + length(x.text) AS BIGINT), out := a.out) END) AS r FROM g),
c AS (SELECT page_id, CASE WHEN len(r.buf) > 0 THEN list_concat(r.out, [struct_pack(kind := 'text', heading := r.op, text := array_to_string(r.buf, chr(10)))]) ELSE r.out END AS cs FROM f),
chunk AS (SELECT page_id, i - 1 AS chunk_no, page_id || '_c' || CASE WHEN i - 1 < 1000 THEN lpad(CAST(i - 1 AS VARCHAR), 3, '0') ELSE CAST(i - 1 AS VARCHAR) END AS chunk_id, cs[i].kind AS kind, cs[i].heading AS heading, cs[i].text AS text FROM (SELECT page_id, cs, unnest(range(1, len(cs) + 1)) AS i FROM c))"""
_MARKED = "mk AS (SELECT page_id, ord, kind, CASE WHEN ord % 6 = 4 THEN text || chr(10) || '[image:a' || (ord % 4) || ']' ELSE text END AS text FROM v_htmlblock)"
_OWN = "own AS (SELECT l.doc_id, l.ord, min(b.block) AS block FROM v_line l JOIN v_block b ON l.doc_id = b.doc_id AND (l.x0 + l.x1) / 2.0 BETWEEN b.x0 AND b.x1 AND (l.y0 + l.y1) / 2.0 BETWEEN b.y0 AND b.y1 GROUP BY ALL)"
_ROLE = "CASE lower(label) WHEN 'doc_title' THEN '제목' WHEN 'table' THEN '표' WHEN 'figure' THEN '이미지' WHEN 'footnote' THEN '각주' WHEN 'footer' THEN '고지문구' WHEN 'aside_text' THEN '각주' WHEN 'number' THEN '기타' WHEN 'header' THEN '고지문구' ELSE '본문' END"
_QN = "regexp_replace({x}, '[\\s\"''`“”‘’]', '', 'g')"
_NC = "array_to_string(list_transform(regexp_extract_all(" + _QN + ", '[0-9][0-9,\\.]*\\s*(?:%p|%|원|명|팀|개월|좌)?'), lambda n: regexp_replace(replace(n, ',', ''), '\\.+$', '')), '|')"

QUERIES = {
    "rag_chunks": (rag_chunks, with_views("v_htmlblock", _CHUNKS.format(rows="v_htmlblock") + " SELECT page_id, chunk_no, chunk_id, kind, heading, text FROM chunk")),
    "rag_anchors": (rag_anchors, with_views("v_htmlblock", _MARKED + "," + _CHUNKS.format(rows="mk") + """,
        cap AS (SELECT page_id, 'a' || k AS asset_id, k AS ord, CASE WHEN (page_id + k) % 7 = 0 THEN NULL ELSE 'caption ' || k END AS text FROM (SELECT DISTINCT page_id FROM mk), (SELECT unnest(range(4)) AS k)),
        an AS (SELECT cap.page_id, asset_id, min(chunk_no) AS spot, arg_min(struct_pack(h := heading), chunk_no).h AS heading FROM cap JOIN chunk ON cap.page_id = chunk.page_id AND contains(chunk.text, '[image:' || asset_id || ']') GROUP BY ALL),
        u AS (SELECT page_id, chunk_no AS spot, 0 AS aft, 0 AS ord, kind, heading, CAST(NULL AS VARCHAR) AS asset_id, '' AS notes FROM chunk
          UNION ALL SELECT cap.page_id, coalesce(an.spot, 1099511627776), 1, ord, 'image_caption', an.heading, cap.asset_id, concat_ws('; ', CASE WHEN an.spot IS NULL THEN 'no_anchor' END, CASE WHEN text IS NULL THEN 'caption_failed' END) FROM cap LEFT JOIN an ON cap.page_id = an.page_id AND cap.asset_id = an.asset_id)
        SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY spot, aft, ord) - 1 AS place, kind, heading, asset_id, notes FROM u""")),
    "rag_markers": (rag_markers, with_views("v_htmlblock", _MARKED + """
        SELECT page_id, ord, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda t: rtrim(replace(replace(t, '[image:a0]', ''), '[image:a2]', ''), ' ')), lambda t: trim(t, ' ') <> ''), chr(10)) AS text FROM mk""")),
    "rag_markdown": (rag_markdown, with_views("v_htmlblock", _CHUNKS.format(rows="v_htmlblock") + """
        SELECT page_id, string_agg('## ' || coalesce(heading, '-') || chr(10) || '<!-- ' || chunk_id || ' ' || kind || ' -->' || chr(10) || text, chr(10) || chr(10) ORDER BY chunk_no) AS markdown FROM chunk GROUP BY ALL""")),
    "chunk_kinds": (chunk_kinds, with_views("v_htmlblock", _CHUNKS.format(rows="v_htmlblock") + " SELECT kind, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM chunk GROUP BY ALL")),
    "hwp_table_lines": (hwp_table_lines, """
        WITH c AS (SELECT l_orderkey AS doc_id, l_linenumber // 3 AS row, l_linenumber * 1000000 + l_partkey AS col, CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 's' || (l_suppkey % 3) END AS t, CASE WHEN l_partkey % 10 = 0 THEN 'n' || (l_partkey % 5) || ' / m' ELSE '' END AS n FROM lineitem),
        s AS (SELECT *, trim(t || ' ' || n) AS x FROM c)
        SELECT doc_id, CAST(row AS BIGINT) AS row, string_agg(x, ' | ' ORDER BY col, x) AS line FROM s WHERE x <> '' GROUP BY doc_id, row"""),
    "parse_totals_rollup": (parse_totals_rollup, with_views("v_line v_block", _OWN + """,
        l AS (SELECT v_line.*, own.block FROM v_line LEFT JOIN own ON v_line.doc_id = own.doc_id AND v_line.ord = own.ord)
        SELECT doc_id, count(*) AS lines, count(*) FILTER (block IS NULL) AS unassigned, count(*) FILTER (trim(text) = '') AS blank, count(*) FILTER (confidence < 0.8::DOUBLE) AS low, count(DISTINCT CASE WHEN block IS NOT NULL THEN doc_id || '/' || block END) AS regions
        FROM l GROUP BY GROUPING SETS ((doc_id), ())""")),
    "stage_stats": (stage_stats, "SELECT event_type AS stage, count(*) AS calls, count(*) FILTER (event_id % 4 = 0) AS cached, CAST(sum(event_id % 1000) AS BIGINT) AS ms FROM events GROUP BY ROLLUP (event_type)"),
    "role_pairs": (role_pairs, with_views("v_line v_block", f"""
        r AS (SELECT {_ROLE} AS rule, CASE WHEN block % 4 = 1 THEN '기타' ELSE {_ROLE} END AS judged, (doc_id + block * 7) % 100 AS permille FROM v_block)
        SELECT rule AS before, judged AS after, count(*) AS n, CAST(sum(permille) AS BIGINT) * 1.0::DOUBLE / count(*) AS mean_score, rule <> judged AS differs FROM r GROUP BY ALL""")),
    "role_updates": (role_updates, with_views("v_line v_block", f"""
        SELECT doc_id, block, CASE WHEN block % 3 <> 1 AND block % 2 = 0 THEN '본문' ELSE {_ROLE} END AS role, CASE WHEN block % 3 <> 1 THEN 0.75::DOUBLE ELSE score END AS role_confidence, CASE WHEN block % 3 <> 1 THEN 'vlm' ELSE 'rules' END AS role_source, {_ROLE} AS role_rule FROM v_block""")),
    "sentence_recall": (sentence_recall, with_views("v_line v_block", _OWN + """,
        rg AS (SELECT b.doc_id, b.block, coalesce(string_agg(l.text, chr(10) ORDER BY l.y0, l.x0, l.ord), '') AS text FROM v_block b LEFT JOIN own o ON b.doc_id = o.doc_id AND b.block = o.block LEFT JOIN v_line l ON o.doc_id = l.doc_id AND o.ord = l.ord GROUP BY b.doc_id, b.block),
        a AS (SELECT 'gold' AS what, doc_id, ord, CASE ord % 4 WHEN 0 THEN '«' || text || '»' WHEN 1 THEN text || ' zz' WHEN 2 THEN 'extra words ' || (ord // 3) ELSE substring(text, 3) END AS x FROM v_line
          UNION ALL SELECT 'line', doc_id, ord, text FROM v_line UNION ALL SELECT 'region', doc_id, block, text FROM rg UNION ALL SELECT 'candidate', doc_id, block, 'extra words ' || block FROM rg WHERE block % 2 = 0),
        e1 AS (SELECT what, doc_id, ord, regexp_replace(x, '[\\s,~:：%()\\[\\]{}''"`´『』「」〈〉<>【】·※*ㆍ■□|“”‘’]', '', 'g') AS x FROM a),
        e2 AS (SELECT what, doc_id, ord, array_to_string(list_transform(range(1, length(x) + 1), lambda i: CASE WHEN substring(x, i, 1) = '.' AND NOT (i > 1 AND regexp_matches(substring(x, i - 1, 1), '[0-9]') AND regexp_matches(substring(x, i + 1, 1), '[0-9]')) THEN '' ELSE substring(x, i, 1) END), '') AS x FROM e1),
        e3 AS (SELECT what, doc_id, ord, replace(lower(regexp_replace(x, '[\\x{10000}-\\x{10FFFF}☀-➿\\x{FE0F}\\x{200D}\\x{FFFD}]', '', 'g')), '–', '-') AS x FROM e2),
        e AS (SELECT what, doc_id, ord, array_to_string(list_transform(range(1, length(x) + 1), lambda i: CASE WHEN substring(x, i, 1) = '-' AND NOT (i > 1 AND regexp_matches(substring(x, i - 1, 1), '[0-9]') AND regexp_matches(substring(x, i + 1, 1), '[0-9]')) THEN '' ELSE substring(x, i, 1) END), '') AS f FROM e3),
        g AS (SELECT doc_id, ord, f FROM e WHERE what = 'gold' AND f <> ''),
        p AS (SELECT doc_id, string_agg(f, '' ORDER BY ord) AS f FROM e WHERE what = 'region' GROUP BY doc_id),
        h AS (SELECT g.doc_id, g.ord, bool_or(what = 'line') AS l, bool_or(what = 'region') AS r, bool_or(what = 'candidate') AS c FROM g JOIN e ON g.doc_id = e.doc_id AND e.what <> 'gold' AND contains(e.f, g.f) GROUP BY ALL),
        o AS (SELECT g.doc_id, CASE WHEN h.l THEN 'line' WHEN h.r THEN 'region' WHEN contains(p.f, g.f) THEN 'page' WHEN h.c THEN 'candidate' ELSE 'missed' END AS found FROM g LEFT JOIN h ON g.doc_id = h.doc_id AND g.ord = h.ord LEFT JOIN p ON g.doc_id = p.doc_id)
        SELECT doc_id, found, count(*) AS n FROM o GROUP BY ALL""")),
    "box_recall": (box_recall, with_views("v_line v_block", """
        SELECT l.doc_id, l.ord AS item, count(b.block) > 0 AS hit FROM v_line l LEFT JOIN v_block b ON l.doc_id = b.doc_id
          AND greatest(0, least(l.x1, b.x1) - greatest(l.x0, b.x0)) * greatest(0, least(l.y1, b.y1) - greatest(l.y0, b.y0)) * 2 >= least((l.x1 - l.x0) * (l.y1 - l.y0), (b.x1 - b.x0) * (b.y1 - b.y0)) AND least((l.x1 - l.x0) * (l.y1 - l.y0), (b.x1 - b.x0) * (b.y1 - b.y0)) > 0
        GROUP BY l.doc_id, l.ord""")),
    "field_recall": (field_recall, with_views("v_line", f"""
        t AS (SELECT doc_id, ord, text || ' ' || (doc_id % 90) || ',000원' AS t FROM v_line),
        v AS (SELECT doc_id, ord, 'f' || ord AS field, {_QN.format(x="t")} AS vn, {_NC.format(x="t")} AS vc FROM t WHERE ord % 2 = 0),
        g AS (SELECT doc_id, ord AS item_id, CASE ord % 5 WHEN 0 THEN 'zz ' || (doc_id % 90) || ',000원' WHEN 1 THEN 'nowhere' ELSE t END AS value FROM t),
        n AS (SELECT *, {_QN.format(x="value")} AS gn, {_NC.format(x="value")} AS gc FROM g),
        m AS (SELECT n.doc_id, item_id, v.ord, field, CASE WHEN gn <> '' AND contains(vn, gn) THEN 2 WHEN gc <> '' AND vc <> '' AND contains(vc, gc) THEN 1 END AS grade FROM n JOIN v ON n.doc_id = v.doc_id),
        b AS (SELECT doc_id, item_id, max(grade) AS best FROM m WHERE grade IS NOT NULL GROUP BY ALL),
        s AS (SELECT b.doc_id, b.item_id, best, arg_min(field, m.ord) AS source, count(*) AS n_sources FROM b JOIN m ON b.doc_id = m.doc_id AND b.item_id = m.item_id AND m.grade = b.best GROUP BY ALL)
        SELECT n.doc_id, n.item_id, CASE best WHEN 2 THEN 'hit' WHEN 1 THEN 'partial' ELSE 'miss' END AS outcome, source, coalesce(n_sources, 0) AS n_sources FROM n LEFT JOIN s ON n.doc_id = s.doc_id AND n.item_id = s.item_id""")),
    "scorecard": (scorecard, """
        SELECT o_orderpriority AS file, o_orderstatus AS metric, count(*) FILTER (o_orderkey % 7 <> 0) AS passed, count(*) AS total, CAST(floor(100 * count(*) FILTER (o_orderkey % 7 <> 0) / count(*)) AS BIGINT) AS percent
        FROM orders GROUP BY GROUPING SETS ((o_orderpriority, o_orderstatus), (o_orderstatus))"""),
    "passage_recall": (passage_recall, "SELECT item_id, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY item_id"),
}
