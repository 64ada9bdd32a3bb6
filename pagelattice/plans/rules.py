"""Queries over field rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rules as R
from .adapters import table, v_cell, v_cond, v_doc, v_line, v_spec, with_views


def status_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.normalise_status(v_cell(spark, sf_dir), None).select("doc_id", "ord", "value", "status", "corrected")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell for each key of a document or event: the last event row wins."""
    cells = R.normalise_status(v_cell(spark, sf_dir), None)
    return cells.groupBy("doc_id", "scope", "event_no", "field_key").agg(F.max_by("value", "ord").alias("value"), F.max_by("status", "ord").alias("status"), F.max("ord").alias("ord"))


def absence_four_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.classify_absences(_cells(spark, sf_dir), v_spec(spark), v_cond(spark), v_doc(spark, sf_dir))
    return out.select("doc_id", "scope", "event_no", "field_key", "kind", "obligation", "rule", F.array_join("detail", ",").alias("detail"))


def absence_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.absence_buckets(R.classify_absences(_cells(spark, sf_dir), v_spec(spark), v_cond(spark), v_doc(spark, sf_dir)))
    return out.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("missing", "not_applicable", "out_of_scope", "needs_check")])


def prune_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, dropped = R.prune_events(_cells(spark, sf_dir))
    left = kept.where("scope = 'event'").groupBy("doc_id").agg(F.max("event_no").alias("events_left"))
    return dropped.join(left, "doc_id", "left").select("doc_id", F.array_join(F.transform("dropped", lambda x: x.cast("string")), ",").alias("dropped"), "reported", F.coalesce("events_left", F.lit(0).cast("bigint")).alias("events_left"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v_line(spark, sf_dir).select("doc_id", "ord", F.concat(F.lit("r"), F.col("ord").cast("string")).alias("region_id"), F.expr("concat(text, if(ord % 3 = 0, concat(' ', doc_id % 90, '.5% ', ord, ' 개월'), ''))").alias("text"))


def evidence_backing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims are each line's beginning, with a note of where it stands; evidence is the line, a stranger, both or none."""
    lines = v_line(spark, sf_dir)
    claim = F.expr("case ord % 6 when 5 then ' ' else concat(substring(text, 1, 30), if(ord % 2 = 0, ' (p1_r001, p1_r002)', ' zzzq')) end")
    ids = F.expr("case ord % 4 when 0 then array(concat('r', ord)) when 1 then array('r99999', concat('r', ord + 1)) when 2 then array('r99999') else array(concat('r', ord), concat('r', ord + 1), 'x') end")
    claims = lines.select("doc_id", F.col("ord").alias("claim_id"), claim.alias("value"), ids.alias("evidence"))
    out = R.score_evidence(claims, _texts(spark, sf_dir), ["doc_id"])
    return out.select("doc_id", "claim_id", "score", "backed", F.array_join("missing", ",").alias("missing"))


def unused_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(spark, sf_dir)
    return R.unused_figures(texts, texts.where("ord % 2 = 0").select("doc_id", F.col("text").alias("value")), ["doc_id"])


def _unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v_line(spark, sf_dir)
    text = F.expr("concat(' ', substring(text, 1, 8), ' ')")
    return lines.select("doc_id", "ord", text.alias("text"), F.expr("if(ord % 5 = 3, '심의관련_필드없음', '무관')").alias("kind"), F.expr("if(ord % 2 = 0, concat('because ', ord), '')").alias("reason"), F.expr("if(ord % 7 = 0, null, concat('G', ord % 4))").alias("group"), F.expr("array(concat('r', ord % 6))").alias("evidence"))


def unmapped_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings are lines' first letters of every ninth place, so many repeat."""
    items = _unmapped(spark, sf_dir).withColumn("text", F.expr("concat(' ', substring(trim(text), 1, 2), ' ')"))
    out = R.merge_unmapped(items, ["doc_id"])
    return out.select("doc_id", "ord", "text", "kind", "reason", F.array_join("groups", ",").alias("groups"), F.array_join("evidence", ",").alias("evidence"))


def unmapped_reclassify(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _unmapped(spark, sf_dir)
    values = v_line(spark, sf_dir).where("ord % 3 = 0").select("doc_id", F.expr("if(ord % 2 = 0, text, substring(text, 1, 5))").alias("value"))
    return R.reclassify_handled(items, values, ["doc_id"]).select("doc_id", "ord", "kind")


def input_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _texts(spark, sf_dir).withColumn("is_illustrative", F.expr("ord % 5 = 0"))
    return R.input_gap(parsed, parsed.where("(doc_id + ord) % 3 <> 0"), ["doc_id"])


def coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    absences = R.classify_absences(cells, v_spec(spark), v_cond(spark), v_doc(spark, sf_dir))
    cited = cells.withColumn("evidence", F.expr("if(status = 'not_found', cast(array() as array<string>), array(concat('r', ord % 40), concat('r', ord % 7)))"))
    regions = v_doc(spark, sf_dir).select("doc_id", F.explode(F.expr("sequence(0L, doc_id % 30)")).alias("k")).select("doc_id", F.concat(F.lit("r"), F.col("k").cast("string")).alias("region_id"))
    out = R.coverage(regions, cited, absences, ["doc_id"])
    return out.withColumn("uncited", F.size("uncited").cast("bigint"))


def ledger_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a catalogue; order lines as fields that refer to it."""
    ledger = table(spark, sf_dir, "part").select(F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("item_id"), F.expr("case p_partkey % 6 when 0 then 'layout' when 1 then 'metadata' else null end").alias("source"), F.expr("if(p_partkey % 11 = 0, '절차', '내용')").alias("category"))
    fields = table(spark, sf_dir, "lineitem").select(F.expr("if(l_partkey % 3 = 0, null, concat('c', l_partkey))").alias("catalog_ref"), F.expr("if(l_partkey % 5 = 0, array(concat('c', l_partkey + 1)), null)").alias("catalog_refs"))
    return R.ledger_coverage(ledger, fields).select("item_id")


def answer_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers are event cells as JSON, some with wrong statuses or further members."""
    cells = v_cell(spark, sf_dir).withColumn("cell", F.expr(
        "concat('{\"value\":\"v\",\"evidence\":[],\"status\":\"', if(ord % 97 = 0, 'maybe', status), '\"', if(ord % 89 = 0, ',\"extra\":1', ''), '}')"))
    one = cells.groupBy("doc_id", "field_key").agg(F.max_by("cell", "ord").alias("cell"))
    raw = one.groupBy("doc_id").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(F.concat(F.lit('"'), F.col("field_key"), F.lit('":'), F.col("cell")))), ","), F.lit("}")).alias("raw"))
    return R.check_contract(raw, ["doc_id"])


_BARE = "lower(trim(regexp_replace({x}, '^[\\s\"'']+|[\\s\"'']+$', '', 'g')))"
_WORDS = "'', 'not_found', 'notfound', 'none', 'null', 'n/a', 'na', '-', '—', '없음', '해당없음', '해당 없음', '미표시', '미기재', '확인불가'"
_NORMAL = f"""
e AS (SELECT *, {_BARE.format(x="value")} IN ({_WORDS}) AS empty FROM v_cell),
nc AS (SELECT doc_id, scope, event_no, field_key, ord, CASE WHEN empty THEN '' ELSE value END AS value,
  CASE WHEN NOT empty AND status = 'not_found' THEN 'found' WHEN empty THEN 'not_found' ELSE status END AS status, status AS old, empty AND value <> '' AS blanked FROM e),
cells AS (SELECT doc_id, scope, event_no, field_key, arg_max(value, ord) AS value, arg_max(status, ord) AS status, max(ord) AS ord FROM nc GROUP BY ALL)"""
_ABSENT = _NORMAL + """,
x AS (SELECT c.*, d.subtype, d.ad_type, s.field_key IS NOT NULL AS known, coalesce(s.obligation, '필수') AS obligation FROM cells c LEFT JOIN v_doc d ON c.doc_id = d.doc_id LEFT JOIN v_spec s ON c.field_key = s.field_key WHERE c.status = 'not_found'),
j AS (SELECT x.*, r.ord AS rord, r.rule AS rrule, r.choices, r.fields, coalesce(x.subtype IN ('', '판단불가'), true) AS nosub,
  EXISTS (SELECT 1 FROM cells f WHERE f.doc_id = x.doc_id AND f.status IN ('found', 'uncertain') AND list_contains(r.fields, f.field_key) AND (f.scope = 'field' OR (x.scope = 'event' AND f.event_no = x.event_no))) AS fires
  FROM x LEFT JOIN v_cond r ON x.field_key = r.field_key),
y AS (SELECT *, CASE WHEN rrule IS NULL THEN false WHEN rrule = 'subtype_in' THEN nosub OR NOT list_contains(choices, subtype) WHEN rrule = 'subtype_not_in' THEN nosub OR list_contains(choices, subtype)
  WHEN rrule = 'ad_type_in' THEN NOT coalesce(list_contains(choices, ad_type), false) WHEN rrule = 'trigger_any' THEN NOT fires ELSE true END AS fails FROM j),
z AS (SELECT doc_id, scope, event_no, field_key, any_value(ord) AS ord, bool_or(known) AS known, any_value(obligation) AS obligation, bool_or(nosub) AS nosub,
  arg_min(rrule, rord) FILTER (fails) AS rule0, arg_min(choices, rord) FILTER (fails) AS ch, arg_min(fields, rord) FILTER (fails) AS fl FROM y GROUP BY doc_id, scope, event_no, field_key),
ab AS (SELECT *, CASE WHEN NOT known THEN 'spec_missing' WHEN obligation IN ('분류', '수집', '관측', '절차') THEN 'not_judged' WHEN rule0 IS NULL THEN 'applicable' WHEN rule0 IN ('subtype_in', 'subtype_not_in') AND nosub THEN 'subtype_unknown'
  WHEN rule0 IN ('subtype_in', 'subtype_not_in', 'ad_type_in', 'trigger_any', 'conditional') THEN rule0 ELSE 'unknown_rule:' || rule0 END AS rule FROM z),
a AS (SELECT *, CASE rule WHEN 'spec_missing' THEN '확인필요' WHEN 'not_judged' THEN '판정제외' WHEN 'applicable' THEN '미표시' WHEN 'subtype_unknown' THEN '확인필요' ELSE '해당없음' END AS kind,
  CASE WHEN scope = 'event' THEN 'event' || event_no || '.' || field_key ELSE field_key END AS name FROM ab)"""
_TEXTS = "tx AS (SELECT doc_id, ord, 'r' || ord AS region_id, text || CASE WHEN ord % 3 = 0 THEN ' ' || (doc_id % 90) || '.5% ' || ord || ' 개월' ELSE '' END AS text FROM v_line)"
_TOK = "list_filter(list_transform(regexp_split_to_array({x}, '[\\s,;/·()~]+'), lambda t: regexp_replace(replace(lower(t), 'ß', 'ss'), '[^0-9a-z가-힣.%]', '', 'g')), lambda t: t <> '')"
_PG = "regexp_replace(replace(lower({x}), 'ß', 'ss'), '[^0-9a-z가-힣.%]', '', 'g')"
_UN = "un AS (SELECT doc_id, ord, ' ' || substring(text, 1, 8) || ' ' AS text, CASE WHEN ord % 5 = 3 THEN '심의관련_필드없음' ELSE '무관' END AS kind, CASE WHEN ord % 2 = 0 THEN 'because ' || ord ELSE '' END AS reason, CASE WHEN ord % 7 = 0 THEN NULL ELSE 'G' || (ord % 4) END AS grp, 'r' || (ord % 6) AS ev FROM v_line)"

QUERIES = {
    "status_normalize": (status_normalize, with_views("v_cell", _NORMAL + """
        SELECT doc_id, ord, value, status, nullif(concat_ws(' / ', CASE WHEN blanked THEN 'value_blanked' END, CASE WHEN status <> old THEN old || ' to ' || status END), '') AS corrected FROM nc""")),
    "absence_four_way": (absence_four_way, with_views("v_cell v_doc v_spec v_cond", _ABSENT + """
        SELECT doc_id, scope, event_no, field_key, kind, CASE WHEN known THEN obligation END AS obligation, rule,
          CASE WHEN kind = '해당없음' THEN CASE WHEN len(fl) > 0 THEN array_to_string(fl, ',') WHEN len(ch) > 0 THEN array_to_string(ch, ',') END END AS detail FROM a""")),
    "absence_buckets": (absence_buckets, with_views("v_cell v_doc v_spec v_cond", _ABSENT + """
        SELECT doc_id, coalesce(string_agg(name, ',' ORDER BY scope DESC, event_no, ord) FILTER (kind = '미표시'), '') AS missing, coalesce(string_agg(name, ',' ORDER BY name) FILTER (kind = '해당없음'), '') AS not_applicable,
          coalesce(string_agg(name, ',' ORDER BY name) FILTER (kind = '판정제외'), '') AS out_of_scope, coalesce(string_agg(name, ',' ORDER BY name) FILTER (kind = '확인필요'), '') AS needs_check FROM a GROUP BY doc_id""")),
    "prune_events": (prune_events, with_views("v_cell", _NORMAL + """,
        ev AS (SELECT doc_id, event_no, bool_or(status IN ('found', 'uncertain')) AS filled FROM cells WHERE scope = 'event' GROUP BY ALL)
        SELECT doc_id, string_agg(CAST(event_no AS VARCHAR), ',' ORDER BY event_no) FILTER (NOT filled) AS dropped, count(*) AS reported, count(*) FILTER (filled) AS events_left FROM ev GROUP BY doc_id HAVING count(*) FILTER (NOT filled) > 0""")),
    "evidence_backing": (evidence_backing, with_views("v_line", _TEXTS + f""",
        cl AS (SELECT doc_id, ord AS claim_id, CASE WHEN ord % 6 = 5 THEN ' ' ELSE substring(text, 1, 30) || CASE WHEN ord % 2 = 0 THEN ' (p1_r001, p1_r002)' ELSE ' zzzq' END END AS v,
          CASE ord % 4 WHEN 0 THEN ['r' || ord] WHEN 1 THEN ['r99999', 'r' || (ord + 1)] WHEN 2 THEN ['r99999'] ELSE ['r' || ord, 'r' || (ord + 1), 'x'] END AS ids FROM v_line),
        ci AS (SELECT doc_id, claim_id, unnest(ids) AS region_id, unnest(range(len(ids))) AS pos FROM cl),
        m AS (SELECT ci.doc_id, claim_id, string_agg(tx.text, ' ' ORDER BY pos) FILTER (tx.text IS NOT NULL) AS src, coalesce(string_agg(ci.region_id, ',' ORDER BY pos) FILTER (tx.text IS NULL), '') AS missing FROM ci LEFT JOIN tx ON ci.doc_id = tx.doc_id AND ci.region_id = tx.region_id GROUP BY ALL),
        s AS (SELECT cl.doc_id, cl.claim_id, missing, src, regexp_replace(v, '\\(\\s*p[0-9]+_r[0-9]+(?:\\s*,\\s*p[0-9]+_r[0-9]+)*\\s*\\)', ' ', 'g') AS b FROM cl JOIN m ON cl.doc_id = m.doc_id AND cl.claim_id = m.claim_id),
        k AS (SELECT *, {_TOK.format(x="b")} AS t, {_PG.format(x="src")} AS p FROM s),
        q AS (SELECT *, CASE WHEN trim(b) = '' OR src IS NULL THEN NULL WHEN len(t) = 0 THEN 0.0::DOUBLE ELSE len(list_filter(t, lambda w: contains(p, w))) * 1.0::DOUBLE / len(t) END AS score FROM k)
        SELECT doc_id, claim_id, score, score >= 0.5 AS backed, missing FROM q""")),
    "unused_figures": (unused_figures, with_views("v_line", _TEXTS + """,
        fg AS (SELECT doc_id, ord, region_id, unnest(found) AS figure, unnest(range(len(found))) AS nth FROM (SELECT *, regexp_extract_all(text, '[0-9][0-9,]*(?:\\.[0-9]+)?\\s*(?:%p|%|억원|만원|천원|원|명|팀|좌|개월|년|일|회|건)') AS found FROM tx)),
        ff AS (SELECT *, regexp_replace(figure, '\\s+', '', 'g') AS folded FROM fg),
        bl AS (SELECT doc_id, string_agg(regexp_replace(text, '\\s+', '', 'g'), chr(10)) AS blob FROM tx WHERE ord % 2 = 0 GROUP BY ALL),
        fi AS (SELECT doc_id, folded, arg_min(struct_pack(f := figure, r := region_id, o := ord), struct_pack(o := ord, a := nth)) AS x FROM ff GROUP BY ALL)
        SELECT fi.doc_id, x.f AS figure, x.r AS region_id, x.o AS ord FROM fi LEFT JOIN bl ON fi.doc_id = bl.doc_id WHERE NOT contains(coalesce(blob, ''), folded)""")),
    "unmapped_dedupe": (unmapped_dedupe, with_views("v_line", _UN + """,
        t AS (SELECT *, trim(substring(trim(text), 1, 2)) AS k FROM un),
        g AS (SELECT doc_id, k, min(ord) AS ord, arg_min(kind, ord) AS k1, arg_min(reason, ord) AS r1, bool_or(kind = '심의관련_필드없음') AS rel, arg_max(reason, ord) FILTER (kind = '심의관련_필드없음' AND reason <> '') AS lifted FROM t WHERE k <> '' GROUP BY ALL),
        h AS (SELECT doc_id, k, string_agg(grp, ',' ORDER BY o) AS groups FROM (SELECT doc_id, k, grp, min(ord) AS o FROM t WHERE grp IS NOT NULL GROUP BY ALL) GROUP BY ALL),
        i AS (SELECT doc_id, k, string_agg(ev, ',' ORDER BY o) AS evidence FROM (SELECT doc_id, k, ev, min(ord) AS o FROM t GROUP BY ALL) GROUP BY ALL)
        SELECT g.doc_id, ord, g.k AS text, CASE WHEN rel THEN '심의관련_필드없음' ELSE k1 END AS kind, CASE WHEN rel THEN coalesce(lifted, r1) ELSE r1 END AS reason, coalesce(groups, '') AS groups, evidence
        FROM g LEFT JOIN h ON g.doc_id = h.doc_id AND g.k = h.k LEFT JOIN i ON g.doc_id = i.doc_id AND g.k = i.k""")),
    "unmapped_reclassify": (unmapped_reclassify, with_views("v_line", _UN + f""",
        va AS (SELECT doc_id, value, regexp_replace(value, '\\s+', '', 'g') AS sq FROM (SELECT doc_id, CASE WHEN ord % 2 = 0 THEN text ELSE substring(text, 1, 5) END AS value FROM v_line WHERE ord % 3 = 0)),
        bl AS (SELECT doc_id, list(sq) AS known, string_agg(value, ' ' ORDER BY value) AS blob FROM va WHERE length(sq) >= 6 GROUP BY ALL),
        u AS (SELECT un.*, regexp_replace(un.text, '\\s+', '', 'g') AS sq, {_TOK.format(x="un.text")} AS t, {_PG.format(x="coalesce(blob, '')")} AS p, coalesce(known, CAST([] AS VARCHAR[])) AS known FROM un LEFT JOIN bl ON un.doc_id = bl.doc_id)
        SELECT doc_id, ord, CASE WHEN kind = '심의관련_필드없음' AND sq <> '' AND (len(list_filter(known, lambda k: contains(k, sq) OR contains(sq, k))) > 0 OR (len(t) > 0 AND len(list_filter(t, lambda w: contains(p, w))) * 1.0::DOUBLE / len(t) >= 0.6)) THEN '다른항목에서_처리됨' ELSE kind END AS kind FROM u""")),
    "input_gap": (input_gap, with_views("v_line", _TEXTS + " SELECT doc_id, region_id, substring(text, 1, 200) AS text, CASE WHEN ord % 5 = 0 THEN 'illustrative' ELSE 'not_in_view' END AS reason FROM tx WHERE (doc_id + ord) % 3 = 0 AND trim(text) <> ''")),
    "coverage_metrics": (coverage_metrics, with_views("v_cell v_doc v_spec v_cond", _ABSENT + """,
        rg AS (SELECT doc_id, 'r' || k AS rid FROM (SELECT doc_id, unnest(range(doc_id % 30 + 1)) AS k FROM v_doc)),
        ct AS (SELECT DISTINCT doc_id, rid FROM (SELECT doc_id, unnest(['r' || (ord % 40), 'r' || (ord % 7)]) AS rid FROM cells WHERE status <> 'not_found')),
        rc AS (SELECT rg.doc_id, count(*) AS regions_total, count(ct.rid) AS regions_cited FROM rg LEFT JOIN ct ON rg.doc_id = ct.doc_id AND rg.rid = ct.rid GROUP BY ALL),
        st AS (SELECT doc_id, count(*) FILTER (status = 'found') AS n_found, count(*) FILTER (status = 'not_found') AS n_not_found, count(*) FILTER (status = 'uncertain') AS n_uncertain FROM cells WHERE scope = 'field' GROUP BY ALL),
        kd AS (SELECT doc_id, count(*) FILTER (kind = '미표시') AS n_missing, count(*) FILTER (kind = '해당없음') AS n_not_applicable, count(*) FILTER (kind = '판정제외') AS n_out_of_scope, count(*) FILTER (kind = '확인필요') AS n_needs_check,
          count(*) FILTER (kind = '미표시' AND scope = 'event') AS n_event_missing FROM a GROUP BY ALL)
        SELECT rc.doc_id, regions_total, regions_cited, round_even(regions_cited * 1.0::DOUBLE / regions_total, 3) AS region_coverage, regions_total - regions_cited AS uncited, coalesce(n_found, 0) AS n_found, coalesce(n_not_found, 0) AS n_not_found, coalesce(n_uncertain, 0) AS n_uncertain,
          coalesce(n_missing, 0) AS n_missing, coalesce(n_not_applicable, 0) AS n_not_applicable, coalesce(n_out_of_scope, 0) AS n_out_of_scope, coalesce(n_needs_check, 0) AS n_needs_check, coalesce(n_event_missing, 0) AS n_event_missing
        FROM rc LEFT JOIN st ON rc.doc_id = st.doc_id LEFT JOIN kd ON rc.doc_id = kd.doc_id""")),
    "ledger_coverage": (ledger_coverage, """
        WITH f AS (SELECT 'c' || l_partkey AS id FROM lineitem WHERE l_partkey % 3 <> 0 UNION SELECT 'c' || (l_partkey + 1) FROM lineitem WHERE l_partkey % 5 = 0)
        SELECT 'c' || p_partkey AS item_id FROM part WHERE p_partkey % 6 NOT IN (0, 1) AND p_partkey % 11 <> 0 AND 'c' || p_partkey NOT IN (SELECT id FROM f)"""),
    "answer_contract": (answer_contract, with_views("v_cell", """
        o AS (SELECT doc_id, field_key, arg_max(ord % 97 = 0 OR ord % 89 = 0, ord) AS bad FROM v_cell GROUP BY ALL)
        SELECT doc_id, NOT bool_or(bad) AS ok, 'cells: ' || string_agg(field_key, ',' ORDER BY field_key) FILTER (bad) AS error FROM o GROUP BY doc_id""")),
}
