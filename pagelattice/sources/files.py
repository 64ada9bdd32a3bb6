"""File sources and sinks: routing scans, JSON documents, schema packs, conversion reports, writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.triage import route

LINE = "struct<text:string,bbox:array<int>,confidence:double,source:string,vlm_reading:string,vlm_reading_conf:double,vlm_reading_stage:string>"
REGION = (
    f"struct<region_id:string,bbox:array<int>,label:string,layout_score:double,role:string,role_confidence:double,role_source:string,role_rule:string,role_rule_confidence:double,card_no:int,"
    f"is_illustrative:boolean,lines:array<{LINE}>,vlm_reading:string,vlm_reading_score:double,vlm_reading_coverage:double,vlm_reading_relation:string>"
)
PAGE = f"struct<page_no:int,canvas_w:int,canvas_h:int,dpi:double,parse_route:string,parse_status:string,regions:array<{REGION}>,unassigned_lines:array<{LINE}>,notes:array<string>>"
#: Schema of one parsed document.
DOCUMENT = f"doc_id string, source_file string, file_type string, product_group string, ad_type string, category_source string, classification_confidence double, pages array<{PAGE}>, notes array<string>"
#: Schema of a document's lean view.
VIEW = "document string, doc_id string, product_group string, ad_type string, pages array<struct<page_number:int,regions:array<struct<region_id:string,role:string,text:string,vlm_reading:string>>,unassigned:string>>"
#: Schema of a field pack.
_CONDITION = "struct<rule:string,values:array<string>,fields:array<string>,basis:string,why:string>"
_FIELD = f"struct<field_key:string,label:string,prompt:string,type:string,enum:array<string>,required_by_rule:boolean,derived:boolean,obligation:string,applicability:struct<conditions:array<{_CONDITION}>>,catalog_ref:string,catalog_refs:array<string>>"
PACK = f"schema_id string, version string, applies_to struct<product_group:array<string>,ad_type:array<string>>, call_groups array<struct<group_id:string,cardinality:string,instruction:string,fields:array<{_FIELD}>,observation_fields:array<{_FIELD}>>>"


def scan_files(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """(path, length, track[, content]) of all files below ``path``; unreadable ones are kept with that track."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", route(F.col("path")).alias("track"), *(["content"] if content else []))


def read_documents(spark: SparkSession, path: str, one_to_a_file: bool = True) -> DataFrame:
    """Parsed documents, one JSON file each; or, as ``write_documents`` leaves them, one to a line."""
    return spark.read.schema(DOCUMENT).option("multiLine", str(one_to_a_file).lower()).json(path)


def read_views(spark: SparkSession, path: str, one_to_a_file: bool = True) -> DataFrame:
    return spark.read.schema(VIEW).option("multiLine", str(one_to_a_file).lower()).json(path)


def lines_of(documents: DataFrame) -> DataFrame:
    """All lines of all pages as a flat table: those of regions, and unassigned ones with a null region_id."""
    pages = documents.select("doc_id", F.explode("pages").alias("p"))
    inside = pages.select("doc_id", F.col("p.page_no").alias("page_no"), F.posexplode("p.regions").alias("block", "r")).select("doc_id", "page_no", "block", "r.region_id", F.posexplode("r.lines").alias("ord", "l"))
    outside = pages.select("doc_id", F.col("p.page_no").alias("page_no"), F.lit(None).cast("int").alias("block"), F.lit(None).cast("string").alias("region_id"), F.posexplode("p.unassigned_lines").alias("ord", "l"))
    box = [F.col("l.bbox")[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))]
    return inside.unionByName(outside).select("doc_id", "page_no", "block", "region_id", F.col("ord").cast("bigint").alias("ord"), "l.text", "l.confidence", "l.source", *box)


def view_texts(views: DataFrame) -> DataFrame:
    """(doc_id, region_id, text) of a view: texts with their candidates, and each page's unassigned text under a virtual id."""
    pages = views.select("doc_id", F.explode("pages").alias("p"))
    regions = pages.select("doc_id", F.explode("p.regions").alias("r")).select("doc_id", "r.region_id", F.concat_ws(" ", "r.text", "r.vlm_reading").alias("text"))
    rest = pages.where("p.unassigned is not null").select("doc_id", F.concat(F.lit("p"), F.col("p.page_number"), F.lit("_unassigned")).alias("region_id"), F.col("p.unassigned").alias("text"))
    return regions.unionByName(rest)


def prompt_of(views: DataFrame) -> DataFrame:
    """Documents as one text for a reader: a line for each region, its role and, where it differs, its candidate."""
    line = lambda r: F.concat(F.lit("["), r["region_id"], F.lit("|"), F.coalesce(r["role"], F.lit("")), F.lit("] "), r["text"], F.coalesce(F.concat(F.lit(" <"), r["vlm_reading"], F.lit(">")), F.lit("")))
    page = lambda p: F.concat_ws("\n", F.concat(F.lit("# page "), p["page_number"]), F.array_join(F.transform(p["regions"], line), "\n"), F.concat(F.lit("[p"), p["page_number"], F.lit("_unassigned] "), p["unassigned"]))
    return views.select("doc_id", F.array_join(F.transform("pages", page), "\n").alias("prompt"))


def max_tokens(n_fields: Column) -> Column:
    return F.least(F.lit(8000), 400 * n_fields + 1500)


def read_small(spark: SparkSession, path: str) -> str:
    """Text of a small configuration file from any store that Spark can reach."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(sc._jsc.hadoopConfiguration()).open(where)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def read_pack(spark: SparkSession, base: str, overlays: list[str], product_group: str, ad_type: str | None) -> DataFrame:
    """Fields of a pack: the base file's, and those of each overlay that applies, in order of file names.

    (group_id, cardinality, observation, field_key, ..., ord); a key that comes again replaces the earlier one.
    """
    # base first, then overlays by name; Spark's readers would skip names that begin with an underscore
    texts = [(f"{k:04d}", read_small(spark, p)) for k, p in enumerate([base, *sorted(overlays)])]
    packs = spark.createDataFrame(texts, "file string, body string").select("file", F.from_json("body", PACK).alias("p")).select("file", "p.*")
    applies = F.col("applies_to").isNull() | (
        F.coalesce(F.array_contains("applies_to.product_group", F.lit(product_group).cast("string")), F.lit(True)) & F.coalesce(F.array_contains("applies_to.ad_type", F.lit(ad_type).cast("string")), F.col("applies_to.ad_type").isNull())
    )
    groups = packs.where(applies).select("file", F.posexplode("call_groups").alias("g_no", "g"))
    one = lambda col, observed: groups.select("file", "g_no", "g.group_id", "g.cardinality", F.lit(observed).alias("observation"), F.posexplode(f"g.{col}").alias("f_no", "f"))
    fields = one("fields", False).unionByName(one("observation_fields", True)).select("file", "g_no", "f_no", "group_id", "cardinality", "observation", "f.*")
    columns = [c for c in fields.columns if c not in ("file", "g_no", "f_no", "field_key")]
    last = fields.groupBy("field_key").agg(F.max_by(F.struct(*columns), F.struct("file", "g_no", "f_no")).alias("f"))
    return last.select("field_key", "f.*").withColumn("unverifiable", F.coalesce(F.size("enum") > 0, F.lit(False)) | F.coalesce("derived", F.lit(False)))


def conditions_of(fields: DataFrame) -> DataFrame:
    """(field_key, ord, rule, choices, fields, basis) of a pack's fields."""
    rows = fields.select("field_key", F.posexplode("applicability.conditions").alias("ord", "c"))
    return rows.select("field_key", "ord", "c.rule", F.col("c.values").alias("choices"), F.col("c.fields").alias("fields"), "c.basis")


def derived_rules(fields: DataFrame) -> DataFrame:
    """Conditions that no regulation states, but practice."""
    return conditions_of(fields).where("basis = 'derived'")


def response_schema(fields: list[dict], kind: str = "fields") -> dict:
    """JSON schema of an answer: ``fields``, ``observations`` or ``events``; enums may also be empty."""

    def value(f: dict) -> dict:
        one = {"type": "string", **({"enum": [*f["enum"], ""]} if f.get("enum") else {})}
        return {"type": "array", "items": one} if f.get("type") == "list" else one

    def cell(f: dict) -> dict:
        members = {"value": value(f), "evidence": {"type": "array", "items": {"type": "string"}}, "status": {"type": "string", "enum": ["found", "not_found", "uncertain"]}, "note": {"type": "string"}}
        return {"type": "object", "properties": members, "required": list(members), "additionalProperties": False}

    text = {"type": "string"}
    quote = {"type": "object", "properties": {"quote": text, "evidence": {"type": "array", "items": text}, "why": text}, "required": ["quote", "evidence", "why"], "additionalProperties": False}
    body = {f["field_key"]: {"type": "array", "items": quote} if kind == "observations" else cell(f) for f in fields}
    found = {"type": "object", "properties": body, "required": list(body), "additionalProperties": False}
    return {"type": "array", "items": found} if kind == "events" else found


def markdown_counts(text: Column) -> Column:
    """Lines, characters, headings, table rows and pictures of a Markdown text."""
    lines = F.split(text, "\n")
    n = lambda test: F.size(F.filter(lines, test)).cast("bigint")
    return F.struct(
        F.size(lines).cast("bigint").alias("lines"), F.length(text).cast("bigint").alias("chars"), n(lambda t: t.rlike(r"^#{1,6}\s")).alias("headings"),
        n(lambda t: F.ltrim(t).startswith("|")).alias("table_rows"), F.regexp_count(text, F.lit(r"!\[")).cast("bigint").alias("images"),
    )


def conversion_status(results: DataFrame) -> DataFrame:
    """Status of conversions (error, fallback_text, excluded): ok, recovered, error or excluded, and their counts."""
    status = F.when(F.col("excluded"), "excluded").when(F.col("error").isNull(), "ok").when(F.col("fallback_text").isNotNull(), "recovered").otherwise("error")
    return results.withColumn("status", status)


def asset_meta(encoded: Column) -> Column:
    """Approximate bytes behind base64 text, without decoding it."""
    return F.expr("cast(0 as bigint)") + F.floor(F.length(encoded) * 3 / 4).cast("bigint")


def write_documents(documents: DataFrame, path: str, views: DataFrame | None = None) -> None:
    """Sinks: parsed documents and lean views as JSON, one to a line, in files by ranges of doc_id."""
    for rows, name in ((documents, "json"), (views, "llm_view")):
        if rows is not None:
            n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id").write.mode("overwrite").json(f"{path}/{name}")


def documents_of(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Parsed documents of one page each from flat tables: lines (doc_id, block or null, ord, text, confidence, source,
    box) and regions (doc_id, block, region_id, label, role, box, vlm_reading)."""
    box = lambda: F.when(F.col("x0").isNotNull(), F.array("x0", "y0", "x1", "y1"))
    line = F.struct("ord", F.struct("text", box().alias("bbox"), "confidence", "source").alias("l"))
    # texts are dealt out once, by document; regions come to them without texts
    grouped = lines.repartition("doc_id").groupBy("doc_id", "block").agg(F.transform(F.array_sort(F.collect_list(line)), lambda s: s["l"]).alias("lines"))
    held = F.collect_list(F.when(F.col("block").isNotNull(), F.struct("block", "lines")))
    texts = grouped.groupBy("doc_id").agg(held.alias("held"), F.first(F.when(F.col("block").isNull(), F.col("lines")), ignorenulls=True).alias("unassigned_lines"))
    own = regions.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("block", "region_id", box().alias("bbox"), "label", "role", "vlm_reading"))).alias("own"))
    none = F.array().cast(grouped.schema["lines"].dataType)
    lines_in = lambda r: F.coalesce(F.get(F.filter("held", lambda h: h["block"] == r["block"]), F.lit(0))["lines"], none)
    region = lambda r: F.struct(r["region_id"].alias("region_id"), r["bbox"].alias("bbox"), r["label"].alias("label"), r["role"].alias("role"), lines_in(r).alias("lines"), r["vlm_reading"].alias("vlm_reading"))
    both = own.join(texts, "doc_id", "full").select("doc_id", "unassigned_lines", F.transform("own", region).alias("regions"))
    page = F.struct(F.lit(1).alias("page_no"), F.coalesce("regions", F.array().cast(both.schema["regions"].dataType)).alias("regions"), F.coalesce("unassigned_lines", none).alias("unassigned_lines"))
    return both.select(F.col("doc_id").cast("string").alias("doc_id"), F.array(page).alias("pages"))


def views_of(documents: DataFrame) -> DataFrame:
    """Lean views of stored documents, built anew: regions in the order they are read in, with their lines' text by
    visual rows, and candidates only where they differ; unassigned lines as one text."""
    from ..operators import layout as L

    keys = ["doc_id", "page_no"]
    lines = lines_of(documents)
    text = L.merged_text(lines.where("block is not null"), [*keys, "block"])
    tops = lines.where("block is not null").groupBy(*keys, "block").agg(F.min("y0").alias("min_y"), F.min("x0").alias("min_x"))
    pages = documents.select("doc_id", F.explode("pages").alias("p"))
    r = pages.select("doc_id", F.col("p.page_no").alias("page_no"), F.posexplode("p.regions").alias("block", "r"))
    r = r.select(*keys, "block", "r.region_id", "r.role", "r.card_no", "r.vlm_reading", *[F.get("r.bbox", F.lit(k)).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))])
    r = r.join(text, [*keys, "block"], "left").join(tops, [*keys, "block"], "left").withColumn("text", F.coalesce("text", F.lit("")))
    shown = L.page_view(r, keys, extra=("region_id",))
    regions = shown.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.struct("region_id", "role", "text", "vlm_reading").alias("r")))), lambda s: s["r"]).alias("regions"))
    rest = L.merged_text(lines.where("block is null"), keys).withColumnRenamed("text", "unassigned")
    every = pages.select("doc_id", F.col("p.page_no").alias("page_no"))
    view = every.join(regions, keys, "left").join(rest, keys, "left")
    page = F.struct(F.col("page_no").alias("page_number"), F.coalesce("regions", F.array().cast(regions.schema["regions"].dataType)).alias("regions"), "unassigned")
    return view.groupBy("doc_id").agg(F.array_sort(F.collect_list(page)).alias("pages"))


def rebuild_views(spark: SparkSession, path: str) -> None:
    """Sink: the views below ``path`` anew from the documents stored there."""
    views = views_of(read_documents(spark, f"{path}/json", one_to_a_file=False))
    write = views.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").sortWithinPartitions("doc_id").write
    write.mode("overwrite").json(f"{path}/llm_view")


def write_results(results: DataFrame, summary: DataFrame, path: str) -> None:
    results.write.mode("overwrite").parquet(f"{path}/extracted")
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/_summary")


def load_env(text: str, present: dict[str, str]) -> dict[str, str]:
    """Settings from the lines of a .env file; what is set already wins."""
    found = {}
    for line in text.splitlines():
        name, eq, value = line.strip().partition("=")
        if eq and name and not name.startswith("#"):
            found[name.strip()] = value.strip().strip("'\"")
    return {**found, **present}
