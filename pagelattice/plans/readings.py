"""Queries over competing readings, and over the text functions they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import readings as R
from .adapters import table, v_line, v_reading, with_views

#: Normal form and shape of a relation, for the oracles (no number signs occur in the sample tables).
_NORM = "regexp_replace(replace(lower({x}), 'ß', 'ss'), '[^0-9A-Za-z가-힣]', '', 'g')"
_SIG = "list_transform(regexp_extract_all({x}, '[0-9]+(?:[.,][0-9]+)*'), lambda n: replace(n, ',', ''))"
_SHAPE = f"""
n AS (SELECT *, {_NORM.format(x="ocr")} AS a, {_NORM.format(x="cand")} AS b FROM {{rows}}),
s AS (SELECT *, strpos(a, b) - 1 AS head, length(a) AS la, length(b) AS lb FROM n),
k AS (SELECT *, CASE WHEN a = b THEN 'same' WHEN a = '' THEN 'expanded' WHEN b = '' THEN 'tail_cut'
  WHEN contains(a, b) THEN CASE WHEN greatest(head * 1.0::DOUBLE / la, (la - head - lb) * 1.0::DOUBLE / la) < 0.15::DOUBLE THEN 'same' WHEN la - head - lb >= head THEN 'tail_cut' ELSE 'head_drop' END
  WHEN contains(b, a) THEN CASE WHEN (lb - la) * 1.0::DOUBLE / lb < 0.15::DOUBLE THEN 'same' ELSE 'expanded' END END AS shape FROM s),
g AS (SELECT *, {_SIG.format(x="ocr")} AS sa, {_SIG.format(x="cand")} AS sb FROM k),
r AS (SELECT *, CASE WHEN shape = 'same' AND (list_filter(sa, lambda n: length(n) > 1) <> list_filter(sb, lambda n: length(n) > 1)
  OR (len(list_filter(sa, lambda n: length(n) = 1)) > 0 AND len(list_filter(sb, lambda n: length(n) = 1)) > 0 AND list_filter(sa, lambda n: length(n) = 1) <> list_filter(sb, lambda n: length(n) = 1)))
  THEN 'diverged' ELSE shape END AS kind FROM g)"""


def reading_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many candidates of each document relate to their reading in each way, where containment decides."""
    rows = R.classify_readings(v_reading(spark, sf_dir), full=False)
    return rows.groupBy("doc_id", F.coalesce("relation.kind", F.lit("undecided")).alias("kind")).agg(F.count("*").alias("n"))


def reading_relation_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with longest matches for the residue."""
    rows = R.classify_readings(v_reading(spark, sf_dir))
    return rows.groupBy("doc_id", F.col("relation.kind").alias("kind")).agg(F.count("*").alias("n"), F.max(T.relation_label(F.col("relation"))).alias("a_label"), F.count_if(T.is_truncated(F.col("relation"))).alias("truncated"))


def numeric_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v_reading(spark, sf_dir)
    return rows.select("doc_id", "ord", F.array_join(T.numeric_signature(F.col("ocr")), "|").alias("figures"), T.numbers_differ(F.col("ocr"), F.col("cand")).alias("differ")).where("figures <> ''")


def relation_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels by shape alone against labels with the number gate."""
    rows = v_reading(spark, sf_dir)
    shape = T.relation_by_containment(T.norm(F.col("ocr")), T.norm(F.col("cand")))
    rows = rows.withColumn("shape", F.coalesce(shape["kind"], F.lit("undecided")))
    rows = R.classify_readings(rows.withColumnRenamed("shape", "stored_label"), full=False)
    return R.confusion(rows.withColumn("label", F.coalesce("relation.kind", F.lit("undecided"))), "stored_label", "label")


def relation_order_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions are runs of nine lines; stored order is by ord."""
    rows = v_reading(spark, sf_dir).withColumn("region", F.expr("ord div 9"))
    return R.order_flips(rows, ["doc_id", "region"], "ocr", "cand")


def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.candidate_scores(v_reading(spark, sf_dir)).select("doc_id", "ord", "score", "coverage")


def relation_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What relations that containment settles are called, and which of them count as cut."""
    rows = R.classify_readings(v_reading(spark, sf_dir), full=False).where("relation is not null")
    return rows.select("doc_id", "ord", T.relation_label(F.col("relation")).alias("label"), T.is_truncated(F.col("relation")).alias("truncated"))


def _swept(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Odd lines as a sweep's, some cut to a few letters; even ones as known, some of which were swept up too or have no box."""
    rows = v_line(spark, sf_dir)
    swept = rows.where("ord % 2 = 1").withColumn("text", F.expr("case ord % 9 when 1 then substring(text, 1, 3) when 5 then concat('7 ', text) else text end"))
    known = rows.where("ord % 2 = 0").withColumn("source", F.expr("if(ord % 14 = 0, 'vlm_sweep', if(ord % 4 = 0, 'ocr', 'digital'))")).withColumn("x0", F.expr("if(ord % 22 = 0, null, x0)"))
    return swept, known


def stable_core_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    swept, known = _swept(spark, sf_dir)
    return R.twins(swept, known, ["doc_id"]).select("doc_id", "ord", "twin")


def sweep_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings again of known lines: as they are, with other figures, of something else, or empty."""
    swept, known = _swept(spark, sf_dir)
    again = known.select("doc_id", F.col("ord").alias("known_ord"), F.expr("case ord div 2 % 4 when 0 then text when 1 then concat('9 ', text) when 2 then 'qqqq xxxx' else '' end").alias("reading"))
    return R.resolve_sweeps(swept, known, again, ["doc_id"])


def eval_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v_reading(spark, sf_dir)
    return rows.select("doc_id", "ord", T.eval_norm(F.col("ocr")).alias("form"))


def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other normal forms of a line side by side."""
    x = F.col("ocr")
    rows = v_reading(spark, sf_dir)
    return rows.select(
        "doc_id", "ord", T.norm(x).alias("norm"), T.stable_core(x).alias("stable"), T.coarse(x).alias("coarse"), T.squash(x).alias("squashed"),
        T.quote_norm(x).alias("unquoted"), T.numeric_core(x).alias("numeric"), F.array_join(T.figures(x), "|").alias("figures"),
    )


def text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v_reading(spark, sf_dir).withColumn("t", F.expr("case ord % 4 when 0 then concat('(', ord, ') ', ocr) when 1 then concat('{', ocr) when 2 then concat(ocr, '\"') else ocr end"))
    x = F.col("t")
    return rows.select("doc_id", "ord", T.is_heading(x).alias("heading"), T.looks_malformed(x).alias("malformed"), T.is_empty_text(x).alias("empty"))


def unicode_squash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v_line(spark, sf_dir).groupBy("doc_id").agg(F.sum(F.length(T.squash_all(F.col("text")))).alias("kept"))


def normal_ratio_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.triage import triage

    docs = table(spark, sf_dir, "documents").where("doc_id is not null and text is not null")
    # some texts are broken on purpose: short, unreadable, or with a large picture
    text = F.expr("case doc_id % 4 when 0 then substring(text, 1, 22) when 1 then concat(repeat('\\uFFFD', 30), substring(text, 1, 40)) else text end")
    pages = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), (F.expr("doc_id % 10") / 10).alias("image_ratio"), F.expr("doc_id % 3").alias("paths"))
    return triage(pages).select("doc_id", "verdict", "char_count", "fffd_count", "reason")


def filename_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.triage import KEYWORDS, route

    pages = table(spark, sf_dir, "pages").where("page_id is not null")
    name = F.expr("concat('dir/', if(page_id % 3 = 0, '적금', if(page_id % 3 = 1, '신용대출', 'x')), page_id, element_at(array('.PDF', '.png', '.hwp', '.JPEG', '.txt', '', '.hwpx'), cast(page_id % 7 as int) + 1))")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), name.alias("path"))
    return rows.select("page_id", "path", route(F.col("path")).alias("track"), T.first_keyword(F.col("path"), KEYWORDS).alias("prior"))


def classify_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.triage import classify

    pages = table(spark, sf_dir, "pages").where("page_id is not null")
    pick = lambda n, *v: F.element_at(F.array(*[F.lit(x).cast("string") for x in v]), F.expr(f"cast((page_id div {n}) % {len(v)} as int) + 1"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), pick(1, "예금성", "대출성", None).alias("prior"), pick(3, "예금성", "대출성", "기타", "판단불가", None).alias("model_group"), F.expr("page_id % 10 / 10").alias("confidence"))
    return classify(rows).select("page_id", "product_group", "category_source")


def low_conf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.low_confidence(v_line(spark, sf_dir), ["doc_id"]).select("doc_id", "ord", "confidence", F.col("rank").cast("bigint").alias("rank"))


def sweep_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third line, and a shortened copy of every fifth, against the rest."""
    rows = v_line(spark, sf_dir)
    swept = rows.where("ord % 3 = 0").select("doc_id", "ord", F.expr("if(ord % 2 = 0, substring(text, 1, 12), text)").alias("text"))
    return R.sweep_new_lines(swept, rows.where("ord % 3 <> 0"), ["doc_id"])


def reader_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v_line(spark, sf_dir)
    asked = rows.where("ord % 4 <> 0")
    answers = rows.where("ord % 3 <> 0").select("doc_id", "ord", F.expr("case ord % 5 when 0 then ' ' when 1 then concat('{', text) else text end").alias("text")).withColumn("rid", F.col("ord"))
    out = R.reconcile(asked.withColumn("rid", F.col("ord")), answers, ["doc_id", "rid"])
    return out.groupBy("outcome").agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("bigint").alias("chars"))


_TOK = "list_filter(list_transform(regexp_split_to_array({x}, '[\\s,;/·()~]+'), lambda t: regexp_replace(replace(lower(t), 'ß', 'ss'), '[^0-9a-z가-힣.%]', '', 'g')), lambda t: t <> '')"
_PG = "regexp_replace(replace(lower({x}), 'ß', 'ss'), '[^0-9a-z가-힣.%]', '', 'g')"
_SCORE = "CASE WHEN len({t}) = 0 THEN 0.0::DOUBLE ELSE len(list_filter({t}, lambda w: contains({p}, w))) * 1.0::DOUBLE / len({t}) END"
_STABLE = "lower(regexp_replace({x}, '[0-9①②③④⑤⑥⑦⑧⑨⑩\\s%p.,:;·「」『』\"''`~()\\[\\]{{}}\\-—]+', '', 'g'))"
_TWINS = f"""
        c AS (SELECT doc_id, ord, CASE WHEN ord % 2 = 0 THEN text WHEN ord % 9 = 1 THEN substring(text, 1, 3) WHEN ord % 9 = 5 THEN '7 ' || text ELSE text END AS t FROM v_line),
        k AS (SELECT doc_id, ord, t, {_STABLE.format(x="t")} AS core FROM c),
        tw AS (SELECT a.doc_id, a.ord, any_value(a.t) AS t, any_value(a.core) AS core, min(b.ord) AS twin FROM k a LEFT JOIN k b ON a.doc_id = b.doc_id AND b.ord % 2 = 0 AND b.ord % 14 <> 0 AND b.ord % 22 <> 0 AND length(b.core) >= 4 AND length(a.core) >= 4 AND (contains(a.core, b.core) OR contains(b.core, a.core))
          WHERE a.ord % 2 = 1 GROUP BY a.doc_id, a.ord)"""
_COARSE = "lower(regexp_replace({x}, '[\\s,.~:：%()\\[\\]{{}}''\"`「」『』<>·※*!?|#-]', '', 'g'))"
# look-around isn't there, so points and hyphens are walked character by character
_EVAL = """
e1 AS (SELECT doc_id, ord, regexp_replace(ocr, '[\\s,~:：%()\\[\\]{}''"`´『』「」〈〉<>【】·※*ㆍ■□|“”‘’]', '', 'g') AS x FROM v_reading),
e2 AS (SELECT doc_id, ord, array_to_string(list_transform(range(1, length(x) + 1), lambda i: CASE WHEN substring(x, i, 1) = '.' AND NOT (i > 1 AND regexp_matches(substring(x, i - 1, 1), '[0-9]') AND regexp_matches(substring(x, i + 1, 1), '[0-9]')) THEN '' ELSE substring(x, i, 1) END), '') AS x FROM e1),
e3 AS (SELECT doc_id, ord, replace(lower(regexp_replace(x, '[\\x{10000}-\\x{10FFFF}☀-➿\\x{FE0F}\\x{200D}\\x{FFFD}]', '', 'g')), '–', '-') AS x FROM e2)
SELECT doc_id, ord, array_to_string(list_transform(range(1, length(x) + 1), lambda i: CASE WHEN substring(x, i, 1) = '-' AND NOT (i > 1 AND regexp_matches(substring(x, i - 1, 1), '[0-9]') AND regexp_matches(substring(x, i + 1, 1), '[0-9]')) THEN '' ELSE substring(x, i, 1) END), '') AS form FROM e3"""
_BARE = "lower(trim(regexp_replace({x}, '^[\\s\"'']+|[\\s\"'']+$', '', 'g')))"
_WORDS = "'', 'not_found', 'notfound', 'none', 'null', 'n/a', 'na', '-', '—', '없음', '해당없음', '해당 없음', '미표시', '미기재', '확인불가'"

QUERIES = {
    "reading_relation": (reading_relation, with_views("v_reading", _SHAPE.format(rows="v_reading") + " SELECT doc_id, coalesce(kind, 'undecided') AS kind, count(*) AS n FROM r GROUP BY ALL")),
    "reading_relation_full": (reading_relation_full, None),
    "numeric_signature": (numeric_signature, with_views("v_reading", _SHAPE.format(rows="v_reading") + """
        SELECT doc_id, ord, array_to_string(sa, '|') AS figures, (list_filter(sa, lambda n: length(n) > 1) <> list_filter(sb, lambda n: length(n) > 1)
          OR (len(list_filter(sa, lambda n: length(n) = 1)) > 0 AND len(list_filter(sb, lambda n: length(n) = 1)) > 0 AND list_filter(sa, lambda n: length(n) = 1) <> list_filter(sb, lambda n: length(n) = 1))) AS differ
        FROM r WHERE len(sa) > 0""")),
    "relation_confusion": (relation_confusion, with_views("v_reading", _SHAPE.format(rows="v_reading") + " SELECT coalesce(shape, 'undecided') AS stored, coalesce(kind, 'undecided') AS recomputed, count(*) AS n, coalesce(shape, 'undecided') <> coalesce(kind, 'undecided') AS differs FROM r GROUP BY ALL")),
    "relation_order_flip": (relation_order_flip, with_views("v_reading", """
        o AS (SELECT doc_id, ord // 9 AS region, string_agg(ocr, ' ' ORDER BY y0, x0, ord) AS placed, string_agg(ocr, ' ' ORDER BY ord) AS stored, arg_min(cand, ord) AS cand FROM v_reading GROUP BY ALL),
        u AS (SELECT doc_id, region, 1 AS which, placed AS ocr, cand FROM o WHERE regexp_replace(placed, '\\s+', '', 'g') <> regexp_replace(stored, '\\s+', '', 'g')
              UNION ALL SELECT doc_id, region, 2, stored, cand FROM o WHERE regexp_replace(placed, '\\s+', '', 'g') <> regexp_replace(stored, '\\s+', '', 'g')),""" + _SHAPE.format(rows="u") + """
        SELECT p.doc_id, p.region, p.kind AS placed, q.kind AS stored_order, p.kind IS DISTINCT FROM q.kind AS flips FROM r p JOIN r q ON p.doc_id = q.doc_id AND p.region = q.region WHERE p.which = 1 AND q.which = 2""")),
    "candidate_scores": (candidate_scores, with_views("v_reading", f"""
        t AS (SELECT doc_id, ord, {_TOK.format(x="ocr")} AS ta, {_TOK.format(x="cand")} AS tb, {_PG.format(x="ocr")} AS pa, {_PG.format(x="cand")} AS pb FROM v_reading)
        SELECT doc_id, ord, {_SCORE.format(t="tb", p="pa")} AS score, {_SCORE.format(t="ta", p="pb")} AS coverage FROM t""")),
    "stable_core_twins": (stable_core_twins, with_views("v_line", f"""
        {_TWINS} SELECT doc_id, ord, twin FROM tw""")),
    "sweep_resolution": (sweep_resolution, with_views("v_line", f"""
        {_TWINS},
        rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, twin IS NULL ORDER BY ord) AS turn FROM tw),
        rd AS (SELECT rk.*, c.text AS twin_text, CASE c.ord // 2 % 4 WHEN 0 THEN c.text WHEN 1 THEN '9 ' || c.text WHEN 2 THEN 'qqqq xxxx' ELSE '' END AS reading FROM rk LEFT JOIN v_line c ON c.doc_id = rk.doc_id AND c.ord = rk.twin),
        rc AS (SELECT *, {_STABLE.format(x="reading")} AS again FROM rd),
        oc AS (SELECT *, coalesce(twin IS NOT NULL AND turn <= 8 AND again <> '' AND (contains(again, core) OR contains(core, again)), false) AS same FROM rc)
        SELECT doc_id, ord, twin, CASE WHEN NOT same THEN 'kept' WHEN reading = twin_text THEN 'dropped' ELSE 'attached' END AS outcome, CASE WHEN same AND reading <> twin_text THEN reading END AS candidate FROM oc""")),
    "relation_labels": (relation_labels, with_views("v_reading", _SHAPE.format(rows="v_reading") + """
        SELECT doc_id, ord, CASE kind WHEN 'tail_cut' THEN '뒷부분 잘림(' || CAST(round_even(100 * CASE WHEN b = '' THEN 1.0::DOUBLE ELSE (la - head - lb) * 1.0::DOUBLE / la END, 0) AS INTEGER) || '% 소실) — 정본이 더 완전'
          WHEN 'head_drop' THEN '앞 항목명 생략 — 값 자체는 온전' WHEN 'expanded' THEN '정본보다 많이 읽음 — 누락 회수 가능' WHEN 'diverged' THEN '정본과 내용이 다름 — 원본 확인 필요' ELSE '표기 차이' END AS label, kind = 'tail_cut' AS truncated FROM r WHERE kind IS NOT NULL""")),
    "eval_norm": (eval_norm, with_views("v_reading", _EVAL)),
    "text_forms": (text_forms, with_views("v_reading", f"""
        SELECT doc_id, ord, {_NORM.format(x="ocr")} AS norm, {_STABLE.format(x="ocr")} AS stable, {_COARSE.format(x="ocr")} AS coarse, regexp_replace(ocr, '\\s+', '', 'g') AS squashed,
          regexp_replace(ocr, '[\\s"''`“”‘’]', '', 'g') AS unquoted,
          array_to_string(list_transform(regexp_extract_all(regexp_replace(ocr, '[\\s"''`“”‘’]', '', 'g'), '[0-9][0-9,\\.]*\\s*(?:%p|%|원|명|팀|개월|좌)?'), lambda n: regexp_replace(replace(n, ',', ''), '\\.+$', '')), '|') AS numeric,
          array_to_string(list_transform(regexp_extract_all(ocr, '[0-9][0-9,]*(?:\\.[0-9]+)?\\s*(?:%p|%|억원|만원|천원|원|명|팀|좌|개월|년|일|회|건)'), lambda n: regexp_replace(n, '\\s+', '', 'g')), '|') AS figures
        FROM v_reading""")),
    "text_predicates": (text_predicates, with_views("v_reading", f"""
        p AS (SELECT doc_id, ord, CASE ord % 4 WHEN 0 THEN '(' || ord || ') ' || ocr WHEN 1 THEN '{{' || ocr WHEN 2 THEN ocr || '"' ELSE ocr END AS t FROM v_reading)
        SELECT doc_id, ord, length(t) <= 80 AND regexp_matches(t, '^\\s*(?:제?\\s?[0-9]+\\s?[.조항편장절관)]|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+\\s?\\.?|[가-힣]\\.|\\([0-9]+\\)|[0-9]+\\)|[□■◎○●◇◆▷▶☞]|【[^】]*】)') AS heading,
          contains(t, '{{') OR contains(t, '}}') OR (length(t) - length(replace(t, '"', ''))) % 2 = 1 OR (length(t) - length(replace(t, '''', ''))) % 2 = 1 AS malformed,
          {_BARE.format(x="t")} IN ({_WORDS}) AS empty FROM p""")),
    "unicode_squash": (unicode_squash, with_views("v_line", "SELECT doc_id, CAST(sum(length(lower(regexp_replace(text, '[\\s\\pP\\pS\\pZ\\pC_]+', '', 'g')))) AS BIGINT) AS kept FROM v_line GROUP BY ALL")),
    "normal_ratio_triage": (normal_ratio_triage, """
        WITH p AS (SELECT doc_id, (doc_id % 10) * 1.0::DOUBLE / 10 AS image_ratio, doc_id % 3 AS paths,
          regexp_replace(CASE doc_id % 4 WHEN 0 THEN substring(text, 1, 22) WHEN 1 THEN repeat(chr(65533), 30) || substring(text, 1, 40) ELSE text END, '\\s', '', 'g') AS t FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
        c AS (SELECT *, length(t) AS char_count, length(t) - length(replace(t, chr(65533), '')) AS fffd_count, len(regexp_extract_all(t, '[가-힣ㄱ-ㆎ\\x00-\\x7F\\pL\\pN\\pP\\pS]')) AS good FROM p)
        SELECT doc_id, CASE WHEN char_count <= 20 THEN 'scan_like' WHEN fffd_count >= 8 AND fffd_count * 1.0::DOUBLE / greatest(char_count, 1) >= 0.3 THEN 'scan_like' WHEN char_count >= 50 AND good * 1.0::DOUBLE / char_count <= 0.1 THEN 'scan_like'
            WHEN image_ratio >= 0.5 THEN 'hybrid' ELSE 'structured' END AS verdict, char_count, fffd_count,
          CASE WHEN char_count <= 20 THEN 'too_few_characters' WHEN fffd_count >= 8 AND fffd_count * 1.0::DOUBLE / greatest(char_count, 1) >= 0.3 THEN 'broken_encoding' WHEN char_count >= 50 AND good * 1.0::DOUBLE / char_count <= 0.1 THEN 'unusual_characters'
            WHEN image_ratio >= 0.5 THEN 'large_images' WHEN paths > 0 THEN 'vector_shapes' END AS reason FROM c"""),
    "filename_route": (filename_route, """
        WITH p AS (SELECT page_id, 'dir/' || CASE page_id % 3 WHEN 0 THEN '적금' WHEN 1 THEN '신용대출' ELSE 'x' END || page_id || (['.PDF', '.png', '.hwp', '.JPEG', '.txt', '', '.hwpx'])[page_id % 7 + 1] AS path FROM pages WHERE page_id IS NOT NULL)
        SELECT page_id, path, CASE WHEN lower(path) LIKE '%.pdf' THEN 'pdf' WHEN lower(path) LIKE '%.hwp' OR lower(path) LIKE '%.hwpx' THEN 'hwp' WHEN lower(path) LIKE '%.png' OR lower(path) LIKE '%.jpg' OR lower(path) LIKE '%.jpeg' THEN 'image' ELSE 'unreadable' END AS track,
          CASE WHEN contains(path, '예금') OR contains(path, '적금') OR contains(path, '입출금') THEN '예금성' WHEN contains(path, '대출') OR contains(path, '담보') THEN '대출성' END AS prior FROM p"""),
    "classify_source": (classify_source, """
        WITH p AS (SELECT page_id, (['예금성', '대출성', NULL])[page_id % 3 + 1] AS prior, (['예금성', '대출성', '기타', '판단불가', NULL])[(page_id // 3) % 5 + 1] AS raw FROM pages WHERE page_id IS NOT NULL),
        q AS (SELECT *, raw IN ('기타', '판단불가') AND raw IS NOT NULL AS abstained, CASE WHEN raw IN ('기타', '판단불가') THEN NULL ELSE raw END AS seen FROM p)
        SELECT page_id, coalesce(seen, prior) AS product_group, CASE WHEN prior IS NOT NULL AND seen IS NOT NULL THEN CASE WHEN prior = seen THEN 'filename_and_vlm' ELSE 'vlm_overrode_filename' END WHEN seen IS NOT NULL THEN 'vlm'
          WHEN prior IS NOT NULL AND abstained THEN 'filename_vlm_abstained' WHEN prior IS NOT NULL THEN 'filename_vlm_failed' WHEN abstained THEN 'vlm_abstained' ELSE 'none' END AS category_source FROM q"""),
    "low_conf_topk": (low_conf_topk, with_views("v_line", "SELECT doc_id, ord, confidence, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence, ord) AS rank FROM v_line WHERE confidence < 0.8::DOUBLE) WHERE rank <= 12")),
    "sweep_dedupe": (sweep_dedupe, with_views("v_line", f"""
        w AS (SELECT doc_id, ord, t, {_COARSE.format(x="t")} AS c FROM (SELECT doc_id, ord, CASE WHEN ord % 2 = 0 THEN substring(text, 1, 12) ELSE text END AS t, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS rank FROM v_line WHERE ord % 3 = 0) WHERE rank <= 20),
        b AS (SELECT doc_id, string_agg({_COARSE.format(x="text")}, '' ORDER BY ord) AS base FROM v_line WHERE ord % 3 <> 0 GROUP BY ALL),
        l AS (SELECT doc_id, list(struct_pack(ord := ord, t := t, c := c) ORDER BY ord) AS xs FROM w GROUP BY ALL),
        f AS (SELECT l.doc_id, list_reduce(list_prepend(struct_pack(seen := coalesce(base, ''), kept := CAST([] AS STRUCT(ord BIGINT, text VARCHAR)[])), list_transform(xs, lambda x: struct_pack(seen := x.c, kept := [struct_pack(ord := CAST(x.ord AS BIGINT), text := x.t)]))),
              lambda acc, x: CASE WHEN x.seen <> '' AND NOT contains(acc.seen, x.seen) THEN struct_pack(seen := acc.seen || x.seen, kept := list_concat(acc.kept, x.kept)) ELSE acc END) AS r FROM l LEFT JOIN b ON l.doc_id = b.doc_id)
        SELECT doc_id, k.ord AS ord, k.text AS text FROM (SELECT doc_id, unnest(r.kept) AS k FROM f)""")),
    "reader_reconcile": (reader_reconcile, with_views("v_line", """
        a AS (SELECT doc_id, ord FROM v_line WHERE ord % 4 <> 0),
        b AS (SELECT doc_id, ord, CASE ord % 5 WHEN 0 THEN ' ' WHEN 1 THEN '{' || text ELSE text END AS t FROM v_line WHERE ord % 3 <> 0),
        j AS (SELECT CASE WHEN a.ord IS NULL THEN 'unknown_id' WHEN b.ord IS NULL THEN 'unanswered' WHEN trim(t) = '' THEN 'empty'
          WHEN contains(t, '{') OR contains(t, '}') OR (length(t) - length(replace(t, '"', ''))) % 2 = 1 OR (length(t) - length(replace(t, '''', ''))) % 2 = 1 THEN 'malformed' ELSE 'read' END AS outcome, t
          FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.ord = b.ord)
        SELECT outcome, count(*) AS n, CAST(sum(CASE WHEN outcome = 'read' THEN length(t) END) AS BIGINT) AS chars FROM j GROUP BY ALL""")),
}
