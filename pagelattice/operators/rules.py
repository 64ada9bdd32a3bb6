"""Field rules: statuses, absences, events, evidence, unmapped findings, coverage and the answer contract.

Cells are a long table: doc_id, scope ('field' or 'event'), event_no (0 for fields), field_key, value,
status, ord. A value is one text here; lists are arrays in the general functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Kinds of absence, obligations that aren't judged, the undecided subtype, kinds of unmapped findings (fixed values).
MISSING, NOT_APPLICABLE, UNKNOWN, OUT_OF_SCOPE = "미표시", "해당없음", "확인필요", "판정제외"
NOT_JUDGED = ("분류", "수집", "관측", "절차")
UNDECIDED = "판단불가"
REVIEW_RELATED, ALREADY_HANDLED = "심의관련_필드없음", "다른항목에서_처리됨"


def normalise_status(cells: DataFrame, scope: str | None = "field") -> DataFrame:
    """Values that stand for nothing are blanked and statuses follow the values; ``corrected`` says what changed.

    Only cells of ``scope`` are touched (null: all).
    """
    touched = F.lit(True) if scope is None else F.col("scope") == scope
    empty = T.is_empty_text(F.col("value"))
    blanked = F.when(empty & (F.coalesce("value", F.lit("")) != ""), "value_blanked")
    status = F.when(~empty & (F.col("status") == "not_found"), "found").when(empty & (F.col("status") != "not_found"), "not_found").otherwise(F.col("status"))
    moved = F.when(status != F.col("status"), F.concat(F.col("status"), F.lit(" to "), status))
    corrected = F.nullif(F.concat_ws(" / ", blanked, moved), F.lit(""))
    return cells.withColumns({"value": F.when(touched & empty, "").otherwise(F.col("value")), "status": F.when(touched, status).otherwise(F.col("status")), "corrected": F.when(touched, corrected)})


def is_filled(status: Column) -> Column:
    return status.isin("found", "uncertain")


def prune_events(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells without the events that have no filled cell, those left numbered anew; and what was dropped.

    The second frame has (doc_id, dropped: old numbers in order, reported: how many there were).
    """
    events = cells.where("scope = 'event'").groupBy("doc_id", "event_no").agg(F.max(is_filled(F.col("status"))).alias("filled"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("event_no"))
    kept = events.where("filled").withColumn("new_no", number.cast("bigint")).select("doc_id", "event_no", "new_no")
    dropped = F.array_sort(F.collect_list(F.when(~F.col("filled"), F.col("event_no"))))
    record = events.groupBy("doc_id").agg(dropped.alias("dropped"), F.count("*").alias("reported")).where("size(dropped) > 0")
    inside = cells.where("scope = 'event'").join(kept, ["doc_id", "event_no"]).withColumn("event_no", F.col("new_no")).drop("new_no")
    return cells.where("scope <> 'event'").unionByName(inside), record


def classify_absences(cells: DataFrame, spec: DataFrame, cond: DataFrame, docs: DataFrame) -> DataFrame:
    """For each cell that wasn't found: (kind, obligation, rule, detail).

    ``spec`` (field_key, obligation) and ``cond`` (field_key, ord, rule, choices, fields) are the schema;
    they don't grow with the documents. ``docs``: doc_id, subtype, ad_type. The first condition that fails
    decides; event cells also see what their own event has filled.
    """
    filled = cells.where(is_filled(F.col("status")))
    of_doc = filled.where("scope = 'field'").groupBy("doc_id").agg(F.collect_set("field_key").alias("doc_filled"))
    of_event = filled.where("scope = 'event'").groupBy("doc_id", "event_no").agg(F.collect_set("field_key").alias("event_filled"))
    absent = cells.where("status = 'not_found'").join(docs, "doc_id", "left").join(of_doc, "doc_id", "left").join(of_event, ["doc_id", "event_no"], "left")
    none = F.array().cast("array<string>")
    have = F.array_union(F.coalesce("doc_filled", none), F.when(F.col("scope") == "event", F.coalesce("event_filled", none)).otherwise(none))
    rules = cond.groupBy("field_key").agg(F.array_sort(F.collect_list(F.struct("ord", "rule", "choices", "fields"))).alias("conditions"))
    known = spec.select("field_key", F.coalesce("obligation", F.lit("필수")).alias("obligation"), F.lit(True).alias("known")).join(rules, "field_key", "left")
    rows = absent.withColumn("have", have).join(known, "field_key", "left")
    no_subtype = F.col("subtype").isNull() | F.col("subtype").isin("", UNDECIDED)

    def failed(c: Column) -> Column:
        inside = F.array_contains(c["choices"], F.col("subtype"))
        ok = (
            F.when(c["rule"] == "subtype_in", ~no_subtype & F.coalesce(inside, F.lit(False)))
            .when(c["rule"] == "subtype_not_in", ~no_subtype & ~F.coalesce(inside, F.lit(False)))
            .when(c["rule"] == "ad_type_in", F.coalesce(F.array_contains(c["choices"], F.col("ad_type")), F.lit(False)))
            .when(c["rule"] == "trigger_any", F.arrays_overlap(c["fields"], F.col("have")))
            .otherwise(False)
        )
        return ~ok

    def code(c: Column) -> Column:
        asks = c["rule"].isin("subtype_in", "subtype_not_in")
        named = c["rule"].isin("subtype_in", "subtype_not_in", "ad_type_in", "trigger_any", "conditional")
        return F.when(asks & no_subtype, "subtype_unknown").when(named, c["rule"]).otherwise(F.concat(F.lit("unknown_rule:"), c["rule"]))

    first = F.try_element_at(F.filter(F.coalesce("conditions", F.array().cast("array<struct<ord:int,rule:string,choices:array<string>,fields:array<string>>>")), failed), F.lit(1))
    rows = rows.withColumn("first", first)
    f = F.col("first")
    judged = ~F.col("obligation").isin(*NOT_JUDGED)
    rule = F.when(F.col("known").isNull(), "spec_missing").when(~judged, "not_judged").when(f.isNull(), "applicable").otherwise(code(f))
    kind = F.when(F.col("known").isNull(), UNKNOWN).when(~judged, OUT_OF_SCOPE).when(f.isNull(), MISSING).when(code(f) == "subtype_unknown", UNKNOWN).otherwise(NOT_APPLICABLE)
    detail = F.when(F.size(f["fields"]) > 0, f["fields"]).when(F.size(f["choices"]) > 0, f["choices"])
    rows = rows.withColumns({"kind": kind, "rule": rule})
    rows = rows.withColumn("detail", F.when(F.col("kind") == NOT_APPLICABLE, detail))
    return rows.select("doc_id", "scope", "event_no", "field_key", "ord", "kind", "obligation", "rule", "detail")


def label_of(scope: Column, event_no: Column, field_key: Column) -> Column:
    """Name of a cell in reports: event cells carry the number of their event."""
    return F.when(scope == "event", F.concat(F.lit("event"), event_no.cast("string"), F.lit("."), field_key)).otherwise(field_key)


def absence_buckets(absences: DataFrame) -> DataFrame:
    """Per document the names in each kind: missing in order of the cells, the others sorted."""
    name = label_of(F.col("scope"), F.col("event_no"), F.col("field_key"))
    pick = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, name)))
    missing = F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == MISSING, F.struct(F.when(F.col("scope") == "event", 1).otherwise(0).alias("s"), "event_no", "ord", name.alias("n"))))), lambda s: s["n"])
    return absences.groupBy("doc_id").agg(missing.alias("missing"), pick(NOT_APPLICABLE).alias("not_applicable"), pick(OUT_OF_SCOPE).alias("out_of_scope"), pick(UNKNOWN).alias("needs_check"))


def score_evidence(claims: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """How much of each claim its evidence backs.

    ``claims``: keys, claim_id, value, evidence array<string>; ``texts``: keys, region_id, text. The texts of
    the known ids are joined in the order cited; unknown ids are returned as missing. A blank value gets no
    score; without known ids ``backed`` is null.
    """
    cited = claims.select(*keys, "claim_id", F.posexplode(F.coalesce("evidence", F.array().cast("array<string>"))).alias("pos", "region_id"))
    met = cited.join(texts.select(*keys, "region_id", F.col("text").alias("cited_text")), [*keys, "region_id"], "left")
    joined = met.groupBy(*keys, "claim_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("cited_text").isNotNull(), F.struct("pos", "cited_text")))), lambda s: s["cited_text"]), " ").alias("source"),
        F.count("cited_text").alias("n_known"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("cited_text").isNull(), F.struct("pos", "region_id")))), lambda s: s["region_id"]).alias("missing"),
    )
    out = claims.join(joined, [*keys, "claim_id"], "left")
    bare = T.strip_annotations(F.coalesce("value", F.lit("")))
    blank = F.trim(bare) == ""
    score = F.when(~blank & (F.col("n_known") > 0), T.consistency(bare, F.col("source")))
    return out.withColumn("score", score).withColumn("backed", F.col("score") >= 0.5).withColumn("missing", F.coalesce("missing", F.array().cast("array<string>"))).drop("source", "n_known")


def unused_figures(texts: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Figures of the regions' texts that no value of the document holds, as written at their first place:
    (keys, figure, region_id, ord). Only the comparison ignores white space.

    ``texts``: keys, region_id, ord, text; ``values``: keys, value.
    """
    found = texts.select(*keys, "region_id", "ord", F.posexplode(T.raw_figures(F.coalesce("text", F.lit("")))).alias("at", "figure"))
    found = found.withColumn("folded", T.squash(F.col("figure")))
    first = found.groupBy(*keys, "folded").agg(F.min(F.struct("ord", "at", "region_id", "figure")).alias("first"))
    blob = values.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(T.squash(F.coalesce("value", F.lit(""))))), "\n").alias("blob"))
    out = first.join(blob, keys, "left").where(~F.contains(F.coalesce("blob", F.lit("")), F.col("folded")))
    return out.select(*keys, F.trim("first.figure").alias("figure"), F.col("first.region_id").alias("region_id"), F.col("first.ord").alias("ord"))


def merge_unmapped(items: DataFrame, keys: list[str]) -> DataFrame:
    """Findings with the same trimmed text as one: the first stands, groups and evidence are united in order.

    ``items``: keys, ord, text, kind, reason, group, evidence array. If any is review-related, all are, and
    the last such reason that isn't blank stands.
    """
    rows = items.withColumn("text", F.trim("text")).where("text <> ''")
    flat = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", c))), lambda s: s[c])))
    rows = rows.withColumn("groups", F.when(F.col("group").isNull() | (F.col("group") == ""), F.array().cast("array<string>")).otherwise(F.array("group"))).withColumn("evidence", F.coalesce("evidence", F.array().cast("array<string>")))
    related = F.max(F.col("kind") == REVIEW_RELATED)
    lifted = F.max_by("reason", F.when((F.col("kind") == REVIEW_RELATED) & (F.coalesce("reason", F.lit("")) != ""), F.col("ord")))
    out = rows.groupBy(*keys, "text").agg(F.min("ord").alias("ord"), F.min_by("kind", "ord").alias("first_kind"), F.min_by("reason", "ord").alias("first_reason"), related.alias("related"), lifted.alias("lifted"), flat("groups").alias("groups"), flat("evidence").alias("evidence"))
    return out.select(*keys, "ord", "text", F.when(F.col("related"), REVIEW_RELATED).otherwise(F.col("first_kind")).alias("kind"), F.when(F.col("related"), F.coalesce("lifted", "first_reason")).otherwise(F.col("first_reason")).alias("reason"), "groups", "evidence")


def reclassify_handled(items: DataFrame, values: DataFrame, keys: list[str], least: int = 6, share: float = 0.6) -> DataFrame:
    """Review-related findings that other fields already hold become handled: contained either way, or most
    tokens known. Findings of other kinds, and blank ones, stay as they are.

    Values under ``least`` characters match nothing.
    """
    v = values.withColumn("sq", T.squash(F.coalesce("value", F.lit("")))).where(F.length("sq") >= least)
    of_doc = v.groupBy(*keys).agg(F.collect_set("sq").alias("known"), F.array_join(F.array_sort(F.collect_list("value")), " ").alias("blob"))
    rows = items.join(of_doc, keys, "left").withColumn("sq", T.squash(F.coalesce("text", F.lit(""))))
    held = F.coalesce(F.exists("known", lambda k: F.contains(k, F.col("sq")) | F.contains(F.col("sq"), k)), F.lit(False))
    alike = F.coalesce(T.consistency(F.coalesce("text", F.lit("")), F.coalesce("blob", F.lit(""))) >= share, F.lit(False))
    return rows.withColumn("kind", F.when((F.col("kind") == REVIEW_RELATED) & (F.col("sq") != "") & (held | alike), ALREADY_HANDLED).otherwise(F.col("kind"))).drop("known", "blob", "sq")


def input_gap(parsed: DataFrame, view: DataFrame, keys: list[str]) -> DataFrame:
    """Regions with text that the view lacks: text cut to 200 characters, with the reason."""
    lost = parsed.join(view.select(*keys, "region_id"), [*keys, "region_id"], "left_anti").where("trim(text) <> ''")
    reason = F.when(F.coalesce("is_illustrative", F.lit(False)), "illustrative").otherwise("not_in_view")
    return lost.select(*keys, "region_id", F.substring("text", 1, 200).alias("text"), reason.alias("reason"))


def ledger_coverage(ledger: DataFrame, fields: DataFrame) -> DataFrame:
    """Catalogue items that no field refers to, but for those that the layout, the metadata or a procedure covers.

    ``ledger``: item_id, source, category; ``fields``: catalog_ref, catalog_refs.
    """
    refs = fields.select(F.explode(F.array_compact(F.array_append(F.coalesce("catalog_refs", F.array().cast("array<string>")), F.col("catalog_ref")))).alias("item_id")).distinct()
    needed = ledger.where(~F.coalesce(F.col("source").isin("layout", "metadata"), F.lit(False)) & ~F.coalesce(F.col("category") == "절차", F.lit(False)))
    return needed.join(refs, "item_id", "left_anti")


def coverage(regions: DataFrame, cells: DataFrame, absences: DataFrame, keys: list[str]) -> DataFrame:
    """One row of coverage figures for each document: regions cited of all, statuses, kinds of absence.

    ``regions``: keys, region_id; ``cells``: keys, scope, status, evidence array<string>.
    """
    every = regions.groupBy(*keys).agg(F.count_distinct("region_id").alias("regions_total"), F.collect_set("region_id").alias("all_ids"))
    cited = cells.select(*keys, F.explode_outer("evidence").alias("rid")).groupBy(*keys).agg(F.collect_set("rid").alias("cited_ids"))
    counts = cells.where("scope = 'field'").groupBy(*keys).agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("found", "not_found", "uncertain")])
    kinds = absences.groupBy(*keys).agg(
        F.count_if(F.col("kind") == MISSING).alias("n_missing"), F.count_if(F.col("kind") == NOT_APPLICABLE).alias("n_not_applicable"), F.count_if(F.col("kind") == OUT_OF_SCOPE).alias("n_out_of_scope"),
        F.count_if(F.col("kind") == UNKNOWN).alias("n_needs_check"), F.count_if((F.col("kind") == MISSING) & (F.col("scope") == "event")).alias("n_event_missing"),
    )
    out = every.join(cited, keys, "left").join(counts, keys, "left").join(kinds, keys, "left")
    n_cited = F.size(F.array_intersect("all_ids", F.coalesce("cited_ids", F.array().cast("array<string>"))))
    out = out.withColumn("regions_cited", n_cited.cast("bigint")).withColumn("region_coverage", F.when(F.col("regions_total") > 0, F.bround(F.col("regions_cited") / F.col("regions_total"), 3)))
    out = out.withColumn("uncited", F.array_sort(F.array_except("all_ids", F.coalesce("cited_ids", F.array().cast("array<string>"))))).drop("all_ids", "cited_ids")
    return out.na.fill(0)


def check_contract(answers: DataFrame, keys: list[str], statuses: tuple[str, ...] = ("found", "not_found", "uncertain")) -> DataFrame:
    """Whole groups of answers that break the contract: (keys, ok, error).

    ``answers``: keys, raw (JSON of one group: key to {value, evidence, status, note}). A cell with another
    status, an unknown member, or evidence that isn't a list rejects its group.
    """
    cells = F.from_json("raw", "map<string,string>")
    cell = "struct<value:string,evidence:array<string>,status:string,note:string>"
    bad = lambda k, v: ~F.coalesce(F.from_json(v, cell)["status"].isin(*statuses), F.lit(False)) | (F.size(F.array_except(F.coalesce(F.json_object_keys(v), F.array().cast("array<string>")), F.array(*map(F.lit, ("value", "evidence", "status", "note"))))) > 0)
    wrong = F.map_keys(F.map_filter(cells, bad))
    error = F.when(cells.isNull(), "not_json").when(F.size(wrong) > 0, F.concat(F.lit("cells: "), F.array_join(F.array_sort(wrong), ",")))
    return answers.select(*keys, error.isNull().alias("ok"), error.alias("error"))


def check_schema(fields: DataFrame) -> DataFrame:
    """Fields of a schema that lack an obligation or the conditions they apply under."""
    problems = F.array_compact(F.array(F.when(F.col("obligation").isNull(), "no_obligation"), F.when(F.coalesce(F.size("conditions"), F.lit(0)) <= 0, "no_conditions")))
    return fields.select("field_key", problems.alias("problems")).where("size(problems) > 0")


def flatten_values(cells: DataFrame, observations: DataFrame, unmapped: DataFrame) -> DataFrame:
    """All values of a document as (doc_id, field, value): fields, event cells, observations and unmapped texts."""
    own = cells.select("doc_id", label_of(F.col("scope"), F.col("event_no"), F.col("field_key")).alias("field"), "value")
    seen = observations.select("doc_id", F.concat(F.lit("obs."), F.col("field_key")).alias("field"), F.col("quote").alias("value"))
    rest = unmapped.select("doc_id", F.lit("unmapped").alias("field"), F.col("text").alias("value"))
    return own.unionByName(seen).unionByName(rest).where("value is not null and value <> ''")
