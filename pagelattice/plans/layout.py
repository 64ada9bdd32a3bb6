"""Queries over layout: regions, order, suppression and what goes with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layout as L
from .adapters import v_block, v_box, v_line, v_line_tiled, v_reading, with_views

_IOU = "{i} * 1.0::DOUBLE / greatest(1, ({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0) + ({b}.x1 - {b}.x0) * ({b}.y1 - {b}.y0) - {i})"
_INTER = "(greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)))"
_CONT = "{i} * 1.0::DOUBLE / least(greatest(1, ({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0)), greatest(1, ({b}.x1 - {b}.x0) * ({b}.y1 - {b}.y0)))"


def _iou(a: str, b: str) -> str:
    return _IOU.format(a=a, b=b, i=_INTER.format(a=a, b=b))


def _containment(a: str, b: str) -> str:
    return _CONT.format(a=a, b=b, i=_INTER.format(a=a, b=b))


def build_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.build_regions(v_line(spark, sf_dir), v_block(spark, sf_dir), ["doc_id"])
    return out.select("doc_id", "block", L.region_id(F.lit(1), F.col("block")).alias("region_id"), F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"), "text")


def unassigned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.assign_lines(v_line(spark, sf_dir), v_block(spark, sf_dir), ["doc_id"])
    return out.where("block is null").select("doc_id", "ord")


def role_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = L.build_regions(v_line(spark, sf_dir), v_block(spark, sf_dir), ["doc_id"])
    text = F.expr("case block % 5 when 0 then concat('※ 유의 사항 ', text) when 1 then concat('준법감시인 심의필 2025-0123 ', text) else text end")
    height = v_line(spark, sf_dir).groupBy("doc_id").agg(F.max("y1").alias("canvas_h"))
    out = L.apply_role_rules(regions.withColumn("text", text).join(height, "doc_id"), "canvas_h")
    return out.select("doc_id", "block", "role", "role_confidence")


def det_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected blocks are the blocks moved by a few points."""
    blocks = v_block(spark, sf_dir)
    shift = F.expr("cast(block % 4 * 3 as int)")
    moved = blocks.select("doc_id", "block", (F.col("x0") + shift).alias("x0"), (F.col("y0") + shift).alias("y0"), (F.col("x1") + shift).alias("x1"), (F.col("y1") + shift).alias("y1"), "score")
    twice = moved.unionByName(moved.withColumn("block", F.col("block") + 1000).withColumn("score", F.col("score") / 2))
    return L.attach_scores(blocks, twice, ["doc_id"]).select("doc_id", "block", "score")


def merge_digital_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v_line(spark, sf_dir)
    digital = lines.where("ord % 3 <> 1")
    ocr = lines.where("ord % 2 = 0").select("doc_id", "ord", "text", (F.col("x0") + 3).alias("x0"), (F.col("y0") + 2).alias("y0"), (F.col("x1") + 3).alias("x1"), (F.col("y1") + 2).alias("y1"), "confidence")
    return L.merge_digital_ocr(digital, ocr, ["doc_id"]).select("doc_id", "ord", "source")


def absorb_unassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some lines are far wider than the narrow ones of the blocks they touch, some were swept up without a precise box."""
    lines = v_line(spark, sf_dir).withColumn("x1", F.expr("cast(x1 + if(ord % 7 = 3, 600, 0) as int)")).withColumn("source", F.expr("if(ord % 10 = 9, 'vlm_sweep', if(ord % 2 = 0, 'ocr', 'digital'))"))
    blocks = v_block(spark, sf_dir).withColumn("x1", F.expr("if(block % 4 = 1, 120, x1)"))
    left = L.assign_lines(lines, blocks, ["doc_id"]).where("block is null").drop("block")
    height = lines.groupBy("doc_id").agg(F.max("y1").alias("canvas_h"))
    return L.absorb_unassigned(left, blocks.join(height, "doc_id"), ["doc_id"])


def nms_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.suppress(v_line_tiled(spark, sf_dir), ["doc_id"]).select("doc_id", "ord")


def nms_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppression over many small pages."""
    kept = L.suppress(v_box(spark, sf_dir), ["page"])
    return kept.groupBy("page").agg(F.count("*").alias("kept"), F.sum("ord").alias("ords"))


def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.reading_order(v_line(spark, sf_dir), ["doc_id"]).select("doc_id", "ord", F.col("row").cast("bigint").alias("row"), F.col("pos").cast("bigint").alias("pos"))


def row_merge_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.merged_text(v_line(spark, sf_dir).withColumn("region", F.expr("ord div 12")), ["doc_id", "region"])


def pseudo_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eighth row is followed by a gap."""
    gap = F.expr("cast((ord div 24) * 60 as int)")
    lines = v_line(spark, sf_dir).withColumn("y0", F.col("y0") + gap).withColumn("y1", F.col("y1") + gap)
    return L.pseudo_regions(lines, ["doc_id"]).select("doc_id", "region", *[F.col(c).cast("bigint").alias(c) for c in ("x0", "y0", "x1", "y1", "n_lines")])


def region_view_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, blocks = v_line(spark, sf_dir), v_block(spark, sf_dir)
    regions = L.build_regions(lines, blocks, ["doc_id"]).withColumn("card_no", F.expr("if((doc_id + block) % 4 = 0, null, (block % 3))"))
    regions = regions.withColumn("min_y", F.array_min(F.transform("lines", lambda s: s["y0"]))).withColumn("min_x", F.array_min(F.transform("lines", lambda s: s["x0"])))
    regions = regions.withColumn("role", L.role_of_label(F.col("label"))).withColumn("vlm_reading", F.expr("case block % 3 when 0 then text when 1 then concat(text, ' ') else concat('x', text) end"))
    return L.page_view(regions, ["doc_id"]).select("doc_id", F.col("place").cast("bigint").alias("place"), "block", "role", "text", "vlm_reading")


def phantom_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v_line_tiled(spark, sf_dir).withColumn("region", F.expr("(ord % 100000) div 12"))
    return L.phantom_lines(lines, ["doc_id", "region"]).select("doc_id", "ord", F.col("covered").cast("bigint").alias("covered"))


def label_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = v_block(spark, sf_dir).select("doc_id", F.col("block").alias("ord"), F.expr("cast(block % 3 * 30 as int)").alias("x"), F.expr("cast(block * 10 as int)").alias("y"))
    return L.push_down_labels(labels, ["doc_id"]).select("doc_id", "ord", F.col("y").cast("bigint").alias("y"))


_REGIONS = """
own AS (SELECT l.doc_id, l.ord, min(b.block) AS block FROM v_line l JOIN v_block b ON l.doc_id = b.doc_id AND (l.x0 + l.x1) / 2.0 BETWEEN b.x0 AND b.x1 AND (l.y0 + l.y1) / 2.0 BETWEEN b.y0 AND b.y1 GROUP BY ALL),
region AS (SELECT b.doc_id, b.block, any_value(b.label) AS label, any_value(b.x0) AS x0, any_value(b.y0) AS y0, count(l.ord) AS n_lines, coalesce(string_agg(l.text, chr(10) ORDER BY l.y0, l.x0, l.ord), '') AS text, min(l.y0) AS min_y, min(l.x0) AS min_x
  FROM v_block b LEFT JOIN own o ON b.doc_id = o.doc_id AND b.block = o.block LEFT JOIN v_line l ON o.doc_id = l.doc_id AND o.ord = l.ord GROUP BY b.doc_id, b.block)"""
_ROLE = "CASE lower(label) WHEN 'doc_title' THEN '제목' WHEN 'table' THEN '표' WHEN 'figure' THEN '이미지' WHEN 'footnote' THEN '각주' WHEN 'footer' THEN '고지문구' WHEN 'aside_text' THEN '각주' WHEN 'number' THEN '기타' WHEN 'header' THEN '고지문구' ELSE '본문' END"
_NMS = """
g AS (SELECT {key}, list(struct_pack(c := -confidence, ord := ord, x0 := x0, y0 := y0, x1 := x1, y1 := y1) ORDER BY -confidence, ord) AS xs FROM {rows} GROUP BY ALL),
f AS (SELECT {key}, list_reduce(list_transform(xs, lambda x: [x]), lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: {iou} >= 0.5 OR {cont} >= 0.7)) > 0 THEN acc ELSE list_concat(acc, x) END) AS kept FROM g)"""
_ROWS = """
g AS (SELECT {keys}, list(struct_pack(ord := ord, y0 := y0, y1 := y1) ORDER BY {order}) AS xs FROM {rows} GROUP BY ALL),
f AS (SELECT {keys}, list_reduce(list_transform(xs, lambda x: struct_pack(n := CAST(1 AS BIGINT), top := CAST(x.y0 AS BIGINT), bot := CAST(x.y1 AS BIGINT), items := [struct_pack(ord := CAST(x.ord AS BIGINT), n := CAST(1 AS BIGINT))])),
  lambda acc, x: CASE WHEN least(x.bot - x.top, acc.bot - acc.top) > 0 AND (least(acc.bot, x.bot) - greatest(acc.top, x.top)) * 2 >= least(x.bot - x.top, acc.bot - acc.top)
    THEN struct_pack(n := acc.n, top := least(acc.top, x.top), bot := greatest(acc.bot, x.bot), items := list_concat(acc.items, [struct_pack(ord := x.items[1].ord, n := acc.n)]))
    ELSE struct_pack(n := acc.n + 1, top := x.top, bot := x.bot, items := list_concat(acc.items, [struct_pack(ord := x.items[1].ord, n := acc.n + 1)])) END) AS r FROM g),
rows_ AS (SELECT {keys}, i.ord AS ord, i.n AS row FROM (SELECT {keys}, unnest(r.items) AS i FROM f))"""

QUERIES = {
    "build_regions": (build_regions, with_views("v_line v_block", _REGIONS + " SELECT doc_id, block, 'p1_r' || lpad(CAST(block AS VARCHAR), CAST(greatest(3, length(CAST(block AS VARCHAR))) AS INTEGER), '0') AS region_id, n_lines, text FROM region")),
    "unassigned_lines": (unassigned_lines, with_views("v_line v_block", _REGIONS + " SELECT doc_id, ord FROM v_line l WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.doc_id = l.doc_id AND o.ord = l.ord)")),
    "role_rules": (role_rules, with_views("v_line v_block", _REGIONS + f""",
        h AS (SELECT doc_id, max(y1) AS canvas_h FROM v_line GROUP BY ALL)
        SELECT r.doc_id, block, CASE WHEN block % 5 = 0 THEN '유의사항' WHEN block % 5 = 1 THEN '고지문구' WHEN {_ROLE} = '본문' AND y0 > canvas_h * 0.8 THEN '유의사항' ELSE {_ROLE} END AS role,
          CASE WHEN block % 5 IN (0, 1) THEN 0.9::DOUBLE WHEN {_ROLE} = '본문' AND y0 > canvas_h * 0.8 THEN 0.5::DOUBLE END AS role_confidence FROM region r JOIN h ON r.doc_id = h.doc_id""")),
    "det_scores": (det_scores, with_views("v_line v_block", f"""
        d AS (SELECT doc_id, block, x0 + s AS x0, y0 + s AS y0, x1 + s AS x1, y1 + s AS y1, score FROM (SELECT *, block % 4 * 3 AS s FROM v_block)),
        e AS (SELECT * FROM d UNION ALL SELECT doc_id, block + 1000, x0, y0, x1, y1, score / 2 FROM d),
        m AS (SELECT p.doc_id, p.block, arg_max(e.score, struct_pack(i := {_iou("p", "e")}, o := -e.block)) AS score FROM v_block p JOIN e ON p.doc_id = e.doc_id AND {_iou("p", "e")} >= 0.8 GROUP BY ALL)
        SELECT p.doc_id, p.block, m.score FROM v_block p LEFT JOIN m ON p.doc_id = m.doc_id AND p.block = m.block""")),
    "merge_digital_ocr": (merge_digital_ocr, with_views("v_line", f"""
        d AS (SELECT * FROM v_line WHERE ord % 3 <> 1), o AS (SELECT doc_id, ord, x0 + 3 AS x0, y0 + 2 AS y0, x1 + 3 AS x1, y1 + 2 AS y1 FROM v_line WHERE ord % 2 = 0)
        SELECT doc_id, ord, 'digital' AS source FROM d UNION ALL SELECT doc_id, ord, 'ocr' FROM o WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.doc_id = o.doc_id AND {_iou("o", "d")} >= 0.5)""")),
    "absorb_unassigned": (absorb_unassigned, with_views("v_line v_block", """
        wl AS (SELECT doc_id, ord, x0, y0, x1 + CASE WHEN ord % 7 = 3 THEN 600 ELSE 0 END AS x1, y1, ord % 10 <> 9 AS precise FROM v_line),
        nb AS (SELECT doc_id, block, x0, y0, CASE WHEN block % 4 = 1 THEN 120 ELSE x1 END AS x1, y1 FROM v_block),
        hh AS (SELECT doc_id, greatest(300, CAST(floor(max(y1) * 15 / 100) AS BIGINT)) AS reach FROM wl GROUP BY doc_id),
        un AS (SELECT * FROM wl l WHERE NOT EXISTS (SELECT 1 FROM nb b WHERE b.doc_id = l.doc_id AND (l.x0 + l.x1) / 2.0 BETWEEN b.x0 AND b.x1 AND (l.y0 + l.y1) / 2.0 BETWEEN b.y0 AND b.y1)),
        ln AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS k FROM un WHERE precise),
        rg AS (SELECT nb.doc_id, any_value(reach) AS reach, list(struct_pack(b := CAST(block AS BIGINT), x0 := CAST(x0 AS BIGINT), y0 := CAST(y0 AS BIGINT), x1 := CAST(x1 AS BIGINT), y1 := CAST(y1 AS BIGINT)) ORDER BY block) AS bs FROM nb JOIN hh ON nb.doc_id = hh.doc_id GROUP BY nb.doc_id),
        -- one line after the other, as each may grow a region
        st AS (SELECT doc_id, reach, CAST(0 AS BIGINT) AS k, bs, CAST(NULL AS BIGINT) AS ord, CAST(NULL AS BIGINT) AS home FROM rg
          UNION ALL SELECT doc_id, reach, k, CASE WHEN home IS NULL THEN bs ELSE list_transform(bs, lambda r: CASE WHEN r.b = home THEN struct_pack(b := r.b, x0 := least(r.x0, lx0), y0 := least(r.y0, ly0), x1 := greatest(r.x1, lx1), y1 := greatest(r.y1, ly1)) ELSE r END) END, ord, home
          FROM (SELECT *, CASE WHEN inner_ IS NOT NULL THEN inner_.b WHEN near_.d <= reach THEN near_.b END AS home FROM (
            SELECT s.doc_id, s.reach, s.bs, l.k, l.ord, CAST(l.x0 AS BIGINT) AS lx0, CAST(l.y0 AS BIGINT) AS ly0, CAST(l.x1 AS BIGINT) AS lx1, CAST(l.y1 AS BIGINT) AS ly1,
              list_min(list_transform(list_filter(s.bs, lambda r: (l.x0 + l.x1) BETWEEN 2 * r.x0 AND 2 * r.x1 AND (l.y0 + l.y1) BETWEEN 2 * r.y0 AND 2 * r.y1), lambda r: struct_pack(a := (r.x1 - r.x0) * (r.y1 - r.y0), b := r.b))) AS inner_,
              list_min(list_transform(list_filter(s.bs, lambda r: 2 * (least(l.x1, r.x1) - greatest(l.x0, r.x0)) >= greatest(1, l.x1 - l.x0)), lambda r: struct_pack(d := greatest(0, r.y0 - l.y1, l.y0 - r.y1), s := greatest(l.x0, r.x0) - least(l.x1, r.x1), b := r.b))) AS near_
            FROM st s JOIN ln l ON l.doc_id = s.doc_id AND l.k = s.k + 1)))
        SELECT un.doc_id, un.ord, st.home AS block FROM un LEFT JOIN st ON un.doc_id = st.doc_id AND un.ord = st.ord""", recursive=True)),
    "nms_dedupe": (nms_dedupe, with_views("v_line_tiled", _NMS.format(key="doc_id", rows="v_line_tiled", iou=_iou("k", "x[1]"), cont=_containment("k", "x[1]")) + " SELECT doc_id, k.ord AS ord FROM (SELECT doc_id, unnest(kept) AS k FROM f)")),
    "nms_boxes": (nms_boxes, with_views("v_box", _NMS.format(key="page", rows="v_box", iou=_iou("k", "x[1]"), cont=_containment("k", "x[1]")) + " SELECT page, CAST(len(kept) AS BIGINT) AS kept, CAST(list_sum(list_transform(kept, lambda k: k.ord)) AS BIGINT) AS ords FROM f")),
    "reading_order": (reading_order, with_views("v_line", _ROWS.format(keys="doc_id", rows="v_line", order="y0, ord") + """
        SELECT l.doc_id, l.ord, row, row_number() OVER (PARTITION BY l.doc_id ORDER BY row, x0, y0, l.ord) AS pos FROM v_line l JOIN rows_ r ON l.doc_id = r.doc_id AND l.ord = r.ord""")),
    "row_merge_text": (row_merge_text, with_views("v_line", "l AS (SELECT *, ord // 12 AS region FROM v_line)," + _ROWS.format(keys="doc_id, region", rows="l", order="y0, ord") + """,
        p AS (SELECT l.doc_id, l.region, l.ord, l.text, l.y0, l.y1, row_number() OVER (PARTITION BY l.doc_id, l.region ORDER BY row, x0, y0, l.ord) AS pos FROM l JOIN rows_ r ON l.doc_id = r.doc_id AND l.region = r.region AND l.ord = r.ord),"""
        + _ROWS.format(keys="doc_id, region", rows="p", order="pos").replace("g AS", "g2 AS").replace("FROM g)", "FROM g2)").replace("f AS", "f2 AS").replace("FROM f)", "FROM f2)").replace("rows_ AS", "rows2 AS") + """,
        t AS (SELECT p.doc_id, p.region, row, trim(string_agg(p.text, ' ' ORDER BY pos)) AS text FROM p JOIN rows2 r ON p.doc_id = r.doc_id AND p.region = r.region AND p.ord = r.ord GROUP BY ALL)
        SELECT doc_id, region, string_agg(text, chr(10) ORDER BY row) AS text FROM t WHERE text <> '' GROUP BY ALL""")),
    "pseudo_regions": (pseudo_regions, with_views("v_line", """
        l AS (SELECT doc_id, ord, x0, x1, y0 + (ord // 24) * 60 AS y0, y1 + (ord // 24) * 60 AS y1 FROM v_line),
        m AS (SELECT doc_id, 1.5 * quantile_cont(y1 - y0, 0.5) AS gap FROM l GROUP BY ALL),
        s AS (SELECT l.*, CASE WHEN y0 - lag(y1) OVER (PARTITION BY l.doc_id ORDER BY ord) > gap THEN 1 ELSE 0 END AS starts FROM l JOIN m ON l.doc_id = m.doc_id),
        r AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS region FROM s)
        SELECT doc_id, CAST(region AS BIGINT) AS region, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n_lines FROM r GROUP BY ALL""")),
    "region_view_order": (region_view_order, with_views("v_line v_block", _REGIONS + f""",
        v AS (SELECT *, CASE WHEN (doc_id + block) % 4 = 0 THEN NULL ELSE block % 3 END AS card_no, CASE block % 3 WHEN 0 THEN text WHEN 1 THEN text || ' ' ELSE 'x' || text END AS reading FROM region)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(card_no, 0), coalesce(min_y, y0, 0), CASE WHEN min_y IS NOT NULL THEN min_x ELSE coalesce(x0, 0) END, block) AS place, block, {_ROLE} AS role, text,
          CASE WHEN trim(reading) <> trim(text) THEN reading END AS vlm_reading FROM v WHERE trim(text) <> '' OR trim(reading) <> ''""")),
    "phantom_lines": (phantom_lines, with_views("v_line_tiled", """
        l AS (SELECT *, (ord % 100000) // 12 AS region FROM v_line_tiled),
        m AS (SELECT a.doc_id, a.region, a.ord, a.x0, a.x1, greatest(a.x0, b.x0) AS p, least(a.x1, b.x1) AS q, b.ord AS o FROM l a JOIN l b ON a.doc_id = b.doc_id AND a.region = b.region AND a.ord <> b.ord AND b.confidence > a.confidence
          WHERE a.confidence < 0.8 AND greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) * 2 >= least(a.y1 - a.y0, b.y1 - b.y0) AND least(a.x1, b.x1) > greatest(a.x0, b.x0)),
        -- the union's length, point by point: every point of the line that some sibling covers
        u AS (SELECT doc_id, ord, x0, x1, count(DISTINCT t) AS covered FROM (SELECT doc_id, ord, x0, x1, unnest(range(p, q)) AS t FROM m) GROUP BY ALL)
        SELECT doc_id, ord, covered FROM u WHERE covered * 1.0::DOUBLE / greatest(1, x1 - x0) >= 0.6""")),
    "label_places": (label_places, with_views("v_line v_block", """
        g AS (SELECT doc_id, list(struct_pack(ord := block, x := CAST(block % 3 * 30 AS BIGINT), y := CAST(block * 10 AS BIGINT)) ORDER BY block) AS xs FROM v_block GROUP BY ALL),
        f AS (SELECT doc_id, list_reduce(list_transform(xs, lambda x: [x]), lambda acc, x: list_concat(acc, [struct_pack(ord := x[1].ord, x := x[1].x, y := x[1].y + 24 * list_min(list_filter(range(0, len(acc) + 1),
          lambda t: len(list_filter(acc, lambda p: abs(p.x - x[1].x) < 45 AND abs(p.y - (x[1].y + 24 * t)) < 24)) = 0)))])) AS placed FROM g)
        SELECT doc_id, p.ord AS ord, p.y AS y FROM (SELECT doc_id, unnest(placed) AS p FROM f)""")),
}
