"""Layout operators: which line belongs to which block, in what order, and which boxes are the same.

Lines and blocks are flat tables with keys of the page and columns x0, y0, x1, y1 (null: no box) and ord.
Operators whose outcome depends on what was decided before (greedy suppression, row building, absorbing)
fold over the sorted boxes of one page, a page being the unit that always fits a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from .clusters import by_pages, key_schema

#: Pairs of boxes that a sweep holds at a time; height of the strips that tall pages are joined by.
MEETINGS, STRIP = 1 << 21, 1024

#: Roles by layout label; what isn't here is body text (fixed values).
ROLES = {
    "doc_title": "제목", "paragraph_title": "제목", "title": "제목", "text": "본문", "abstract": "본문", "table": "표", "table_title": "각주", "figure": "이미지", "image": "이미지",
    "chart": "이미지", "chart_title": "각주", "seal": "이미지", "header_image": "이미지", "footer_image": "이미지", "figure_title": "각주", "footnote": "각주", "vision_footnote": "각주",
    "aside_text": "각주", "number": "기타", "page_number": "기타", "formula": "기타", "formula_number": "기타", "algorithm": "기타", "footer": "고지문구", "header": "고지문구",
}
#: Patterns of notices and review numbers (fixed values).
NOTICE = r"유의\s*사항|알아\s*두|꼭\s*확인|주의\s*사항"
REVIEW_NO = r"(준법\s*감시인?\s*)?심의필\s*[:：]?\s*제?\s*([0-9]{4}\s*[-–~]\s*[0-9O]+)"


def boxed(prefix: str = "") -> Column:
    """The four box columns as a struct, null where the box is."""
    c = [F.col(prefix + n) for n in ("x0", "y0", "x1", "y1")]
    return F.when(c[0].isNotNull(), G.box(*c))


def first_blocks(blocks: DataFrame, keys: list[str], ord_col: str = "block") -> DataFrame:
    """Blocks without exact repeats of a box: the first one stays; order numbers keep their gaps."""
    rank = F.row_number().over(Window.partitionBy(*keys, "x0", "y0", "x1", "y1").orderBy(ord_col))
    return blocks.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def strip_of(b: Column) -> Column:
    """The horizontal strip of a page that a box's centre lies in."""
    return F.floor((b["y0"] + b["y1"]) / 2 / STRIP).cast("bigint")


def strips(boxes: DataFrame, column: str) -> DataFrame:
    """``boxes`` once for each strip that they reach into, so that joins on page and strip stay small however
    tall a page is; boxes that are null go."""
    b = F.col(column)
    every = F.sequence(F.floor(b["y0"] / STRIP).cast("bigint"), F.greatest(F.floor(b["y0"] / STRIP), F.floor(b["y1"] / STRIP)).cast("bigint"))
    return boxes.where(b.isNotNull()).withColumn("__strip", F.explode(every))


def assign_lines(lines: DataFrame, blocks: DataFrame, keys: list[str], ord_col: str = "block") -> DataFrame:
    """Each line with the first block, in block order, that holds its centre; null where none does."""
    b = strips(blocks.select(*keys, F.col(ord_col).alias("__block"), boxed().alias("__box")), "__box")
    a = lines.where("x0 is not null").withColumn("__strip", strip_of(boxed()))
    hit = a.join(b, [*keys, "__strip"]).where(G.center_inside(boxed(), F.col("__box")))
    first = hit.groupBy(*keys, "ord").agg(F.min("__block").alias(ord_col))
    return lines.join(first, [*keys, "ord"], "left")


def region_id(page: Column, block: Column) -> Column:
    return F.format_string("p%d_r%03d", page.cast("bigint"), block.cast("bigint"))


def build_regions(lines: DataFrame, blocks: DataFrame, keys: list[str], ord_col: str = "block") -> DataFrame:
    """Regions with their lines sorted by (top, left), and their text; regions without lines stay, empty."""
    kept = first_blocks(blocks, keys, ord_col)
    owned = assign_lines(lines, kept, keys, ord_col).where(f"{ord_col} is not null")
    line = F.struct(F.coalesce("y0", F.lit(0)).alias("y0"), F.coalesce("x0", F.lit(0)).alias("x0"), "ord", "text")
    grouped = owned.groupBy(*keys, ord_col).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    out = kept.join(grouped, [*keys, ord_col], "left")
    return out.withColumn("text", F.coalesce(F.array_join(F.transform("lines", lambda s: s["text"]), "\n"), F.lit("")))


def role_of_label(label: Column) -> Column:
    pairs = [F.lit(x) for kv in ROLES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(label)), F.lit("본문"))


def apply_role_rules(regions: DataFrame, canvas_h: str) -> DataFrame:
    """Role by label, then by rules: notices, review numbers, body text in the lowest fifth; with a confidence."""
    base = role_of_label(F.col("label"))
    low = (base == "본문") & (F.col("y0") > F.col(canvas_h) * 0.8) & (F.col(canvas_h) > 0)
    role = F.when(F.col("text").rlike(NOTICE), "유의사항").when(F.col("text").rlike(REVIEW_NO), "고지문구").when(low, "유의사항").otherwise(base)
    conf = F.when(F.col("text").rlike(NOTICE) | F.col("text").rlike(REVIEW_NO), 0.9).when(low, 0.5)
    return regions.withColumns({"role": role, "role_confidence": conf})


def judged_roles(regions: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Left outer update: a model's verdict replaces the role by rule, which is kept beside it."""
    v = verdicts.select(*keys, F.col("role").alias("__role"), F.col("confidence").alias("__conf"))
    out = regions.withColumnsRenamed({"role": "role_rule", "role_confidence": "role_rule_confidence"}).join(v, keys, "left")
    out = out.withColumn("role", F.coalesce("__role", "role_rule")).withColumn("role_confidence", F.when(F.col("__role").isNotNull(), F.col("__conf")).otherwise(F.col("role_rule_confidence")))
    return out.withColumn("role_source", F.when(F.col("__role").isNotNull(), "vlm").otherwise("rules")).drop("__role", "__conf")


def attach_scores(primary: DataFrame, detected: DataFrame, keys: list[str], min_iou: float = 0.8) -> DataFrame:
    """Each primary block with the score of the detected block it overlaps best, from ``min_iou`` on; ties to the earlier."""
    d = detected.select(*keys, F.col("block").alias("__d"), F.col("score").alias("__score"), boxed().alias("__box"))
    met = primary.drop("score").join(d, keys).withColumn("__iou", G.iou(boxed(), F.col("__box"))).where(F.col("__iou") >= min_iou)
    best = met.groupBy(*keys, "block").agg(F.max_by("__score", F.struct("__iou", -F.col("__d"))).alias("score"))
    return primary.drop("score").join(best, [*keys, "block"], "left")


def merge_digital_ocr(digital: DataFrame, ocr: DataFrame, keys: list[str], min_iou: float = 0.5) -> DataFrame:
    """Digital lines, and the OCR lines that overlap none of them by ``min_iou``."""
    if min_iou < 0.5:
        raise ValueError("below a half, a line's centre may lie outside of the one it overlaps")
    d = strips(digital.select(*keys, boxed().alias("__box")), "__box")
    o = ocr.withColumn("__strip", strip_of(boxed()))
    fresh = o.join(d, [o[k] == d[k] for k in [*keys, "__strip"]] + [G.iou(G.box(*[o[c] for c in ("x0", "y0", "x1", "y1")]), d["__box"]) >= min_iou], "left_anti")
    return digital.withColumn("source", F.lit("digital")).unionByName(fresh.drop("__strip").withColumn("source", F.lit("ocr")))


def suppress(lines: DataFrame, keys: list[str], min_iou: float = 0.5, min_containment: float = 0.7) -> DataFrame:
    """Greedy suppression: by falling confidence, a line stays unless it repeats one that stayed.

    Lines without a box always stay. Boxes meet in a sweep over the whole pages of a task, sorted by their top
    edges; then, round by round, a box stays once all earlier boxes that it repeats have gone, and goes once one
    of them stays.
    """
    if min_iou <= 0 or min_containment <= 0:
        raise ValueError("thresholds must be above 0: boxes that don't touch never repeat each other")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        page = rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        # earlier means more confident, ties to the lower ord; pages are apart
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort((rows.ord.to_numpy(), -rows.confidence.fillna(0.0).to_numpy(), page))] = np.arange(len(rows))
        has = rows.x0.notna().to_numpy()
        x0, y0, x1, y1 = (rows[c].fillna(0).to_numpy(np.int64) for c in ("x0", "y0", "x1", "y1"))
        earlier, later = [], []
        spot = np.flatnonzero(has & (y1 > y0) & (x1 > x0))
        spot = spot[np.lexsort((y0[spot], page[spot]))]
        away = (y1.max(initial=0) - y0.min(initial=0) + 1) * page
        top, end = (y0 + away)[spot], (y1 + away)[spot]
        many = np.searchsorted(top, end, side="left") - np.arange(len(spot)) - 1
        total = np.concatenate([[0], np.cumsum(many)])
        lo = 0
        while lo < len(spot):  # a bounded number of meetings at a time
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + MEETINGS, side="right")) - 1)
            a = np.repeat(np.arange(lo, hi), many[lo:hi])
            b = a + 1 + np.arange(len(a)) - np.repeat(total[lo:hi] - total[lo], many[lo:hi])
            a, b = spot[a], spot[b]
            inter = np.clip(np.minimum(x1[a], x1[b]) - np.maximum(x0[a], x0[b]), 0, None) * np.clip(np.minimum(y1[a], y1[b]) - np.maximum(y0[a], y0[b]), 0, None)
            area_a, area_b = (x1[a] - x0[a]) * (y1[a] - y0[a]), (x1[b] - x0[b]) * (y1[b] - y0[b])
            same = (inter / np.maximum(1, area_a + area_b - inter) >= min_iou) | (inter / np.maximum(1, np.minimum(area_a, area_b)) >= min_containment)
            a, b = a[same], b[same]
            swap = rank[a] > rank[b]
            earlier.append(np.where(swap, b, a))
            later.append(np.where(swap, a, b))
            lo = hi
        earlier, later = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (earlier, later))
        stays, goes = np.ones(len(rows), bool), np.zeros(len(rows), bool)
        stays[later] = False
        while len(later):
            goes[later[stays[earlier]]] = True
            open_ = ~goes[earlier] & ~goes[later]
            earlier, later = earlier[open_], later[open_]
            waits = np.zeros(len(rows), bool)
            waits[later] = True
            stays = ~goes & ~waits
        return rows.loc[stays & ~goes, [*keys, "ord"]]

    box = [F.col(c).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")]
    rows = lines.select(*keys, F.col("ord").cast("bigint").alias("ord"), F.col("confidence").cast("double").alias("confidence"), *box)
    kept = by_pages(rows, keys, run, f"{key_schema(lines, keys)}, ord bigint")
    return lines.join(kept, [*keys, "ord"], "left_semi")


def reading_rows(lines: DataFrame, keys: list[str], order: tuple[str, ...] = ("y0", "ord")) -> DataFrame:
    """Visual rows: lines in ``order``; one joins the last row if it shares half of the lower height with it.

    Adds ``row`` (from 1). Rows grow with what they take in; lines without a box have row null.
    """
    item = F.struct(*[F.col(c) for c in order], F.col("ord").alias("__ord"), F.col("y0").alias("__y0"), F.col("y1").alias("__y1"))
    sorted_ = lines.where("x0 is not null").groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
    start = F.struct(F.lit(0).alias("row"), F.lit(0).alias("top"), F.lit(0).alias("bot"), F.array().cast("array<struct<ord:bigint,row:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        top, bot = x["__y0"].cast("int"), x["__y1"].cast("int")
        shared = F.least(acc["bot"], bot) - F.greatest(acc["top"], top)
        lower = F.least(bot - top, acc["bot"] - acc["top"])
        joins = (acc["row"] > 0) & (lower > 0) & (shared * 2 >= lower)
        row = F.when(joins, acc["row"]).otherwise(acc["row"] + 1)
        new_top, new_bot = F.when(joins, F.least(acc["top"], top)).otherwise(top), F.when(joins, F.greatest(acc["bot"], bot)).otherwise(bot)
        return F.struct(row.alias("row"), new_top.alias("top"), new_bot.alias("bot"), F.concat(acc["out"], F.array(F.struct(x["__ord"].cast("bigint").alias("ord"), row.alias("row")))).alias("out"))

    rows = sorted_.select(*keys, F.inline(F.aggregate("items", start, step)["out"]))
    return lines.join(rows, [*keys, "ord"], "left")


def reading_order(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``row`` and ``pos``: rows from top to bottom, lines of a row from left to right, unboxed ones last."""
    rows = reading_rows(lines, keys)
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("row").asc_nulls_last(), "x0", "y0", "ord"))
    return rows.withColumn("pos", pos)


def reading_places(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ord, row, pos): where lines stand in a group's text; ``lines`` needs no text for that."""
    ordered = reading_order(lines.select(*keys, "ord", "x0", "y0", "x1", "y1"), keys).drop("row")
    # an unboxed line is a row of its own
    row = F.coalesce(F.col("row").cast("bigint"), F.lit(1 << 40) + F.col("pos"))
    return reading_rows(ordered, keys, ("pos",)).select(*keys, "ord", row.alias("row"), "pos")


def text_of_places(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Text of each group of lines (keys, row, pos, text): pieces of a row joined by spaces, blank rows left out.
    Rows dealt out by ``keys`` aren't dealt out again."""
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda s: s["text"])
    by_row = placed.groupBy(*keys, "row").agg(F.trim(F.array_join(pieces, " ")).alias("text"))
    return by_row.where("text <> ''").groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "text"))), lambda s: s["text"]), "\n").alias("text"))


def merged_text(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Text of each group of lines: reading order, pieces of a row joined by spaces, blank rows left out."""
    texts = lines.select(*keys, "ord", "text", F.lit(None).cast("bigint").alias("row"), F.lit(None).cast("int").alias("pos"), F.lit(True).alias("is_text"))
    places = reading_places(lines, keys).select(*keys, "ord", F.lit(None).cast("string").alias("text"), "row", "pos", F.lit(False).alias("is_text"))
    # places meet texts after one deal by group, instead of a join by line and another deal
    own = Window.partitionBy(*keys, "ord")
    both = texts.unionByName(places).repartition(*keys).withColumns({"row": F.max("row").over(own), "pos": F.max("pos").over(own)})
    return text_of_places(both.where("is_text"), keys)


def pseudo_regions(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Regions of pages without blocks: a gap over 1.5 median heights begins a new one (gaps and islands).

    Lines come in reading order (ord). Unboxed lines are left out, unless a page has no boxes at all.
    """
    order = Window.partitionBy(*keys).orderBy("ord")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # all windows share one sort of the boxes, dealt out once by page
    flat = lines.na.drop(subset=keys).select(*keys, "ord", "x0", "y0", "x1", "y1")
    flat = flat.withColumn("any", F.max(F.col("x0").isNotNull()).over(whole)).where("x0 is not null or not any")
    limit = 1.5 * F.percentile(F.col("y1") - F.col("y0"), 0.5).over(whole)
    starts = F.coalesce((F.col("any") & (F.col("y0") - F.lag("y1").over(order) > limit)).cast("int"), F.lit(0))
    grouped = flat.withColumn("starts", starts).withColumn("region", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    label = F.when(F.max("any"), "text_cluster").otherwise("page")
    return grouped.groupBy(*keys, "region").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("n_lines"), label.alias("label"))


def view_order(regions: DataFrame, keys: list[str], ord_col: str = "block") -> DataFrame:
    """Adds ``place``: by card, then top and left of the regions' lines (``min_y``, ``min_x``), else of the box."""
    order = [F.coalesce("card_no", F.lit(0)), F.coalesce("min_y", "y0", F.lit(0)), F.when(F.col("min_y").isNotNull(), F.col("min_x")).otherwise(F.coalesce("x0", F.lit(0))), F.col(ord_col)]
    return regions.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def page_view(regions: DataFrame, keys: list[str], ord_col: str = "block", extra: tuple[str, ...] = ()) -> DataFrame:
    """Lean view of regions in order: id, role, text, and the candidate only where it differs; empty ones are left out.
    ``extra`` columns come along."""
    cand = F.when(F.trim("vlm_reading") != F.trim("text"), F.col("vlm_reading"))
    shown = regions.where("trim(text) <> '' or trim(coalesce(vlm_reading, '')) <> ''")
    return view_order(shown, keys, ord_col).select(*keys, "place", ord_col, *extra, "role", "text", cand.alias("vlm_reading"))


def phantom_lines(lines: DataFrame, keys: list[str], below: float = 0.8, row_share: float = 0.5, cover: float = 0.6) -> DataFrame:
    """Lines of low confidence whose row is covered, by ``cover`` of their width, by more confident siblings.

    Siblings are all lines of the region before any is dropped. Coverage is of the union of their intervals.
    """
    sib = lines.select(*keys, F.col("ord").alias("s_ord"), F.col("x0").alias("s_x0"), F.col("x1").alias("s_x1"), F.col("y0").alias("s_y0"), F.col("y1").alias("s_y1"), F.col("confidence").alias("s_conf"))
    low = lines.where((F.col("confidence") < below) & F.col("x0").isNotNull())
    shared = F.greatest(F.lit(0), F.least("y1", "s_y1") - F.greatest("y0", "s_y0")) / F.greatest(F.lit(1), F.least(F.col("y1") - F.col("y0"), F.col("s_y1") - F.col("s_y0")))
    met = low.join(sib, keys).where("s_ord <> ord and s_x0 is not null and (s_conf is null or s_conf > confidence)").where(shared >= row_share)
    met = met.withColumn("a", F.greatest("x0", "s_x0")).withColumn("b", F.least("x1", "s_x1")).where("b > a")
    # length of the union: what each interval adds beyond the furthest end so far
    so_far = F.max("b").over(Window.partitionBy(*keys, "ord").orderBy("a", "b", "s_ord").rowsBetween(Window.unboundedPreceding, -1))
    adds = F.greatest(F.lit(0), F.col("b") - F.greatest(F.col("a"), F.coalesce("so_far", F.col("a"))))
    covered = met.withColumn("so_far", so_far).withColumn("adds", adds).groupBy(*keys, "ord", "x0", "x1").agg(F.sum("adds").alias("covered"))
    return covered.where(F.col("covered") / F.greatest(F.lit(1), F.col("x1") - F.col("x0")) >= cover).select(*keys, "ord", "covered")


def absorb_unassigned(lines: DataFrame, regions: DataFrame, keys: list[str], canvas_h: str = "canvas_h") -> DataFrame:
    """Gives unassigned lines, one after the other, to the region that holds or is nearest to them.

    Smallest region that holds the centre; else, among regions that hold half of the line's width, the nearest
    within max(300, 15 % of the canvas). A region grows with every line, so later lines see it larger; this
    order-dependent step runs over whole pages. If lines have a ``source``, only precise ones are given away.
    Returns (keys, ord, block); block is null for lines that stay unassigned.
    """

    def fold(left: np.ndarray, precise: np.ndarray, right: np.ndarray, tall: float) -> list[int]:
        """Places of the regions that take the lines of one page, -1 for none."""
        x0, y0, x1, y1 = (np.ascontiguousarray(right[:, k]) for k in range(4))  # the regions' boxes, as they are so far
        area = (x1 - x0) * (y1 - y0)
        reach = max(300, int(tall * 0.15)) if tall > 0 else -1.0
        homes = []
        for (a0, b0, a1, b1), given in zip(left.tolist(), precise.tolist(), strict=True):
            if not given or a0 != a0 or not len(x0):
                homes.append(-1)
                continue
            mx, my = (a0 + a1) / 2, (b0 + b1) / 2
            holds = np.flatnonzero((x0 <= mx) & (mx <= x1) & (y0 <= my) & (my <= y1))
            if len(holds):
                best = int(holds[np.argmin(area[holds])])
            else:
                shared = np.minimum(x1, a1) - np.maximum(x0, a0)
                wide = np.flatnonzero(shared / max(1, a1 - a0) >= 0.5)
                best = -1
                if len(wide):
                    # nearest first, then the larger share, then the earlier region
                    away = np.maximum(0, np.maximum(y0[wide] - b1, b0 - y1[wide]))
                    near = away.min()
                    if near <= reach:
                        wide = wide[away == near]
                        best = int(wide[np.argmax(shared[wide])])
            homes.append(best)
            if best >= 0:
                x0[best], y0[best], x1[best], y1[best] = min(x0[best], a0), min(y0[best], b0), max(x1[best], a1), max(y1[best], b1)
                area[best] = (x1[best] - x0[best]) * (y1[best] - y0[best])
        return homes

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        page = rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        line, region = rows.precise.notna().to_numpy(), (rows.precise.isna() & rows.x0.notna()).to_numpy()
        box, ords = rows[["x0", "y0", "x1", "y1"]].to_numpy(float), rows.ord.to_numpy()
        precise, tall = rows.precise.eq(True).to_numpy(bool), rows.tall.fillna(0).to_numpy(float)
        # rows of a page come one after the other
        ends = [*np.flatnonzero(page[1:] != page[:-1]) + 1, len(rows)]
        block, some = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        start = 0
        for end in ends:
            left, right = start + np.flatnonzero(line[start:end]), start + np.flatnonzero(region[start:end])
            if len(left) and len(right):
                homes = np.array(fold(box[left], precise[left], box[right], tall[right].max()))
                took = homes >= 0
                block[left[took]], some[left[took]] = ords[right[homes[took]]], True
            start = end
        return rows.loc[line, [*keys, "ord"]].assign(block=pd.array(np.where(some, block, 0)[line], dtype="Int64")).assign(block=lambda d: d.block.mask(~some[line]))

    precise = F.col("source").isin("ocr", "digital") if "source" in lines.columns else F.lit(True)
    box = [F.col(c).cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")]
    left = lines.select(*keys, F.col("ord").cast("bigint").alias("ord"), *box, F.coalesce(precise, F.lit(False)).alias("precise"), F.lit(None).cast("int").alias("tall"))
    right = regions.select(*keys, F.col("block").cast("bigint").alias("ord"), *box, F.lit(None).cast("boolean").alias("precise"), F.col(canvas_h).cast("int").alias("tall"))
    return by_pages(left.unionByName(right), keys, run, f"{key_schema(lines, keys)}, ord bigint, block bigint")


def push_down_labels(labels: DataFrame, keys: list[str], step: int = 24, near_x: int = 45) -> DataFrame:
    """Places of labels: each is pushed down by ``step`` while an earlier one is within (near_x, step)."""
    item = F.struct("ord", "x", "y")
    sorted_ = labels.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))

    def one(placed: Column, x: Column) -> Column:
        # at most one push for each label placed before is needed
        tries = F.sequence(F.lit(0), F.size(placed))
        free = F.filter(tries, lambda t: ~F.exists(placed, lambda p: (F.abs(p["x"] - x["x"]) < near_x) & (F.abs(p["y"] - (x["y"] + t * step)) < step)))
        return F.concat(placed, F.array(F.struct(x["ord"].cast("bigint").alias("ord"), x["x"].cast("int").alias("x"), (x["y"] + F.coalesce(F.try_element_at(free, F.lit(1)), F.size(placed)) * step).cast("int").alias("y"))))

    return sorted_.select(*keys, F.inline(F.aggregate("items", F.array().cast("array<struct<ord:bigint,x:int,y:int>>"), one)))


def make_page_regions(lines: DataFrame, blocks: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Regions, and the lines that no block holds."""
    kept = first_blocks(blocks, keys)
    return build_regions(lines, kept, keys), assign_lines(lines, kept, keys).where("block is null").drop("block")
