"""Counts with their totals, and recall against hand-made gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .readings import settled


def with_total(rows: DataFrame, keys: list[str], **figures: Column) -> DataFrame:
    """Figures for each key, and one row of totals with null keys (grouping sets of all keys and none)."""
    out = rows.rollup(*keys).agg(F.grouping_id().alias("__g"), *[c.alias(n) for n, c in figures.items()])
    return out.where(f"__g in (0, {(1 << len(keys)) - 1})").drop("__g")


def parse_totals(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines, unassigned lines, blank texts, low confidences and candidates of each page, and of all."""
    return with_total(
        lines, keys, lines=F.count("*"), unassigned=F.count_if(F.col("block").isNull()), blank=F.count_if(F.trim("text") == ""), low=F.count_if(F.col("confidence") < 0.8),
        regions=F.count_distinct(*[F.col(k) for k in keys], "block"),
    )


def stage_stats(calls: DataFrame) -> DataFrame:
    """Calls, cached calls and milliseconds by stage, most calls first, and in all."""
    return with_total(calls, ["stage"], calls=F.count("*"), cached=F.count_if("cached"), ms=F.sum("ms"))


def histogram(rows: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Counts of each kind as a map column."""
    counted = rows.groupBy(*keys, kind).agg(F.count("*").alias("n"))
    return counted.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(kind, "n")))).alias("kinds"))


def role_disagreement(regions: DataFrame, before: str, after: str, score: str) -> DataFrame:
    """Pairs of roles that two judges gave, with the mean layout score of each pair."""
    pairs = regions.groupBy(F.col(before).alias("before"), F.col(after).alias("after")).agg(F.count("*").alias("n"), F.sum(score).alias("total"))
    return pairs.select("before", "after", "n", (F.col("total") / F.col("n")).alias("mean_score"), (~F.col("before").eqNullSafe(F.col("after"))).alias("differs"))


def sentence_recall(gold: DataFrame, lines: DataFrame, regions: DataFrame, key: str, view: DataFrame | None = None) -> DataFrame:
    """Where each gold sentence (key, item_id, text) is found, by containment of scoring forms.

    Order: line, region, page, candidate (a region's ``vlm_reading``), else missed. ``in_view``: whether the
    page's view holds it.
    """
    form = lambda c: T.eval_norm(F.coalesce(c, F.lit("")))
    g = settled(gold.withColumn("__g", form(F.col("text"))), "__g").where("__g <> ''")
    # one row for each page: forms hold no white space, so where they stand line by line, one holds a sentence or none does
    kinds = F.array(F.struct(F.lit("region").alias("what"), F.col("text").alias("t")), F.struct(F.lit("cand").alias("what"), F.col("vlm_reading").alias("t")))
    every = lines.select(key, F.lit(None).cast("bigint").alias("o"), F.lit("line").alias("what"), F.col("text").alias("t")).unionByName(regions.select(key, F.col("block").cast("bigint").alias("o"), F.inline(kinds)))
    every = every.select(key, "o", "what", form(F.col("t")).alias("f"))
    list_of = lambda what, item: F.collect_list(F.when(F.col("what") == what, item))
    page = every.groupBy(key).agg(list_of("line", F.col("f")).alias("l"), F.array_sort(list_of("region", F.struct("o", "f"))).alias("r"), list_of("cand", F.col("f")).alias("c"))
    r = F.transform("r", lambda s: s["f"])
    page = settled(page.select(key, F.array_join("l", "\n").alias("__l"), F.array_join(r, "\n").alias("__r"), F.array_join(r, "").alias("__p"), F.array_join("c", "\n").alias("__c")), "__l", "__r", "__p", "__c")
    held = lambda c: F.coalesce(F.contains(c, F.col("__g")), F.lit(False))
    out = g.join(page, key, "left")
    out = out.withColumns({"in_line": held("__l"), "in_region": held("__r"), "in_page": held("__p"), "in_cand": held("__c")}).drop("__l", "__r", "__p", "__c")
    # a sentence that comes several times under its number is found where any of them is
    own = Window.partitionBy(key, "item_id")
    out = out.withColumns({c: F.max(c).over(own) for c in ("in_line", "in_region", "in_cand")})
    place = F.when(F.col("in_line"), "line").when(F.col("in_region"), "region").when(F.col("in_page"), "page").when(F.col("in_cand"), "candidate").otherwise("missed")
    out = out.withColumn("found", place)
    if view is not None:
        shown = view.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", form(F.concat_ws("", "text", "vlm_reading")).alias("t")))), lambda s: s["t"]), "").alias("__v"))
        out = out.join(shown, key, "left").withColumn("in_view", F.contains(F.coalesce("__v", F.lit("")), F.col("__g")))
    return out.drop("__g", "__v", "in_line", "in_region", "in_page", "in_cand")


def box_recall(gold: DataFrame, regions: DataFrame, keys: list[str], share: float = 0.5) -> DataFrame:
    """Gold boxes (keys, item, box, canvas) and whether any region covers half of the smaller of the two.

    Gold boxes are rescaled from their canvas (gold_w, gold_h) to the page's (canvas_w, canvas_h).
    """
    sx, sy = F.col("canvas_w") / F.col("gold_w"), F.col("canvas_h") / F.col("gold_h")
    g = gold.select(*keys, "item", *[(F.col(c) * s).alias("g" + c) for c, s in (("x0", sx), ("y0", sy), ("x1", sx), ("y1", sy))])
    inter = F.greatest(F.lit(0.0), F.least("gx1", "x1") - F.greatest("gx0", "x0")) * F.greatest(F.lit(0.0), F.least("gy1", "y1") - F.greatest("gy0", "y0"))
    smaller = F.least((F.col("gx1") - F.col("gx0")) * (F.col("gy1") - F.col("gy0")), (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    hit = g.join(regions.where("x0 is not null"), keys).where((smaller > 0) & (inter >= share * smaller)).select(*keys, "item", F.lit(True).alias("hit")).distinct()
    return g.select(*keys, "item").join(hit, [*keys, "item"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def field_recall(gold: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Gold fields (key, item_id, value): hit if a value holds the text, partial if one has its figures, else miss.

    ``source`` is the first field by ord that matched, ``n_sources`` how many did. Values: key, ord, field, value.
    """
    g = gold.withColumn("__n", T.quote_norm(F.coalesce("value", F.lit("")))).withColumn("__c", T.numeric_core(F.coalesce("value", F.lit(""))))
    v = values.select(key, "ord", "field", T.quote_norm(F.coalesce("value", F.lit(""))).alias("vn"), T.numeric_core(F.coalesce("value", F.lit(""))).alias("vc"))
    met = g.join(v, key).withColumn("grade", F.when((F.col("__n") != "") & F.contains("vn", "__n"), 2).when((F.col("__c") != "") & (F.col("vc") != "") & F.contains("vc", "__c"), 1)).where("grade is not null")
    best = met.groupBy(key, "item_id").agg(F.max("grade").alias("best"), F.max_by("field", F.struct("grade", -F.col("ord"))).alias("source"), F.sum(F.lit(1)).alias("n"))
    top = met.groupBy(key, "item_id", "grade").agg(F.count("*").alias("n_sources"))
    out = g.join(best, [key, "item_id"], "left").join(top.withColumnRenamed("grade", "best"), [key, "item_id", "best"], "left")
    return out.select(key, "item_id", F.when(F.col("best") == 2, "hit").when(F.col("best") == 1, "partial").otherwise("miss").alias("outcome"), "source", F.coalesce("n_sources", F.lit(0)).alias("n_sources"))


def passages_found(gold: DataFrame, docs: DataFrame, key: str, words: int = 8) -> DataFrame:
    """(item_id, key) of each gold passage (item_id, text) that a document (key, text) holds verbatim.

    The words of a passage but its first and last stand as whole words wherever it is held, so up to ``words``
    of them, hashed, find the few documents to look at; only these give their texts. Passages without two such
    words are looked for in all documents: they are part of the query set, and sent along with it.
    """
    cut = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    g = gold.where("text is not null and text <> ''").select("item_id", "text", cut.alias("w"))
    g = g.select("item_id", "text", F.least(F.lit(words), F.size("w") - 2).alias("n"), "w").withColumn("h", F.xxhash64(F.array_join(F.slice("w", F.lit(2), F.greatest("n", F.lit(0))), " ")))
    sizes = [r["n"] for r in g.where("n >= 2").select("n").distinct().collect()]  # at most ``words`` numbers
    d = docs.select(key, F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ").alias("w"))
    gram = lambda n: F.expr(f"transform(sequence(1, greatest(1, size(w) - {n - 1})), i -> xxhash64(array_join(slice(w, i, {n}), ' ')))")
    every = F.array_distinct(F.concat(*[gram(n) for n in sizes])) if sizes else F.array().cast("array<bigint>")
    met = d.select(key, F.explode(every).alias("h")).join(g.where("n >= 2").select("item_id", "h"), "h").select(key, "item_id").distinct()
    texts = docs.select(key, F.col("text").alias("whole"))
    found = met.join(texts, key).join(g.select("item_id", "text"), "item_id").where(F.contains("whole", "text")).select("item_id", key)
    short = g.where("n < 2").agg(F.collect_list(F.struct("item_id", "text")).alias("items"))
    lone = docs.select(key, "text", short.scalar().alias("short"))
    lone = lone.select(key, F.explode(F.filter("short", lambda s: F.contains(F.col("text"), s["text"]))).alias("s")).select("s.item_id", key)
    return found.unionByName(lone).distinct()


def scorecard(results: DataFrame) -> DataFrame:
    """Passes, totals and whole percents of each metric, by file and in all (results: file, metric, passed)."""
    out = results.groupingSets([["file", "metric"], ["metric"]], "file", "metric").agg(F.count_if("passed").alias("passed"), F.count("*").alias("total"))
    return out.withColumn("percent", F.floor(100 * F.col("passed") / F.col("total")).cast("bigint"))


def dead_pages(pages: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Pages with a canvas and lines of whose regions none got a candidate: the reader failed there."""
    seen = regions.groupBy(*keys).agg(F.max(F.coalesce(F.col("n_lines") > 0, F.lit(False))).alias("lines"), F.max(F.col("vlm_reading").isNotNull()).alias("read"))
    return pages.where("canvas_w > 0").join(seen, keys).where("lines and not read").select(*keys)


def risk_first(rows: DataFrame) -> DataFrame:
    """Differences of readings, worst first: diverged or cut, then expanded, then the rest; same ones are left out."""
    rank = F.when(F.col("kind").isin("diverged", "tail_cut", "head_drop"), 0).when(F.col("kind") == "expanded", 1).otherwise(2)
    return rows.withColumn("risk", rank).where("not (kind = 'same' and identical)").orderBy("risk", "ord")


def page_fields(cells: DataFrame, page_no: Column) -> Column:
    """Whether a field belongs on a page: some evidence is of it; what wasn't found is on page 1 alone."""
    prefix = F.concat(F.lit("p"), page_no.cast("string"), F.lit("_"))
    return F.when(F.col("status") == "not_found", page_no == 1).otherwise(F.exists("evidence", lambda e: e.startswith(prefix)))
