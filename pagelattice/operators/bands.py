"""Density-based splitting of canvases: spans, equal-mass cuts, snapping, bands and their owners.

Profiles are long tables (keys, pos, mass), one row for each position, so the splits are plain windows and
joins; only a cut's fallback, which looks at the cut before, is a fold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import profiles as P
from ..functions import text as T

#: What stands between a span's number and its range in the hint for a reader (fixed value).
HINT_PART = "번 x_ratio "


def content_spans(profile: DataFrame, keys: list[str], min_gap: int = 20, min_mass: float = 0.10, clean: float = P.CLEAN) -> DataFrame:
    """Spans between the middles of empty runs (islands of pos minus row number) that hold enough mass."""
    empty = profile.where(F.col("mass") <= clean)
    island = F.col("pos") - F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))
    runs = empty.withColumn("island", island).groupBy(*keys, "island").agg(F.min("pos").alias("a"), (F.max("pos") + 1).alias("b"))
    cuts = runs.where(F.col("b") - F.col("a") >= min_gap).select(*keys, F.expr("(a + b) div 2").alias("pos"), F.lit(1).alias("cut"))
    order = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = profile.join(cuts, [*keys, "pos"], "left").withColumn("span", F.sum(F.coalesce("cut", F.lit(0))).over(order))
    spans = numbered.groupBy(*keys, "span").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("stop"), F.sum("mass").alias("mass"))
    total = F.sum("mass").over(Window.partitionBy(*keys))
    return spans.withColumn("total", total).withColumn("share", F.col("mass") / F.when(F.col("total") == 0, F.lit(1)).otherwise(F.col("total"))).where(F.col("share") >= min_mass).drop("span", "total")


def card_counts(profile: DataFrame, keys: list[str]) -> DataFrame:
    """Cards side by side, counted by density alone: (keys, density_count, hint).

    ``profile``: density by column. The count is null where there is nothing to judge by; the hint, for a reader, gives
    the spans as shares of the width where there are two or more.
    """
    spans = content_spans(profile, keys)
    wide = profile.groupBy(*keys).agg((F.max("pos") + 1).alias("width"))
    share = lambda c: T.two_places(c / F.col("width"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("start"))
    told = spans.join(wide, keys).withColumn("k", number).withColumn("t", F.concat(F.col("k").cast("string"), F.lit(HINT_PART), share(F.col("start")), F.lit("~"), share(F.col("stop"))))
    found = told.groupBy(*keys).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda s: s["t"]), ", ").alias("ranges"))
    out = wide.join(found, keys, "left")
    return out.select(*keys, F.col("n").alias("density_count"), F.when(F.col("n") >= 2, F.col("ranges")).alias("hint"))


def equal_mass_targets(profile: DataFrame, keys: list[str], n: Column | int) -> DataFrame:
    """(keys, k, target): first position where the running mass reaches k/n of the whole; equal lengths without mass."""
    n = n if isinstance(n, Column) else F.lit(n)
    order = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    acc = profile.select(*keys, "pos", "mass").withColumn("acc", F.sum("mass").over(order))
    whole = profile.groupBy(*keys).agg(F.sum("mass").alias("total"), (F.max("pos") + 1).alias("length"), F.first(n).alias("n"))
    # k runs up to n - 1, so a page has few rows here
    shares = whole.where("n > 1").withColumn("k", F.explode(F.expr("sequence(1, cast(n - 1 as int))")))
    met = acc.join(shares.where("total > 0"), keys).where("acc * n >= total * k").groupBy(*keys, "k", "n", "length").agg(F.min("pos").alias("target"))
    even = shares.where("total <= 0").select(*keys, "k", "n", "length", F.expr("cast(floor(length / n * k) as bigint)").alias("target"))
    return met.unionByName(even)


def snap_to_clean(targets: DataFrame, profile: DataFrame, keys: list[str], window: int = P.SNAP, clean: float = P.CLEAN) -> DataFrame:
    """Adds (pos, snapped): the nearest empty position within the window, the lower one of two at equal distance."""
    empty = profile.where(F.col("mass") <= clean).select(*keys, F.col("pos").alias("cand"))
    near = targets.join(empty, keys).where(F.abs(F.col("cand") - F.col("target")) <= window).where("cand = target or (cand > 0 and cand < length)")
    best = near.groupBy(*keys, "k").agg(F.min_by("cand", F.struct(F.abs(F.col("cand") - F.col("target")), "cand")).alias("cand"))
    out = targets.join(best, [*keys, "k"], "left")
    return out.withColumn("pos", F.coalesce("cand", "target")).withColumn("snapped", F.col("cand").isNotNull()).drop("cand")


def clamp_targets(targets: DataFrame, max_shift: float) -> DataFrame:
    """Targets kept within ``max_shift`` equal lengths of where equal lengths would cut."""
    u = F.col("length") / F.col("n")
    return targets.withColumn("target", F.floor(F.least(F.greatest(F.col("target"), u * (F.col("k") - max_shift)), u * (F.col("k") + max_shift))).cast("bigint"))


def plan_cuts(snapped: DataFrame, keys: list[str]) -> DataFrame:
    """Cuts in order: one that doesn't get past the last falls back to its target, or is left out (a fold)."""
    items = snapped.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "target", "pos", "snapped"))).alias("items"), F.first("length").alias("length"))
    start = F.struct(F.lit(-1).cast("bigint").alias("last"), F.array().cast("array<struct<cut:bigint,snapped:boolean>>").alias("cuts"))

    def step(acc: Column, x: Column) -> Column:
        past = x["pos"] > acc["last"]
        pos, ok = F.when(past, x["pos"]).otherwise(x["target"]), past & x["snapped"]
        taken = F.concat(acc["cuts"], F.array(F.struct(pos.cast("bigint").alias("cut"), ok.alias("snapped"))))
        return F.when((F.size(acc["cuts"]) == 0) | (pos > acc["last"]), F.struct(pos.cast("bigint").alias("last"), taken.alias("cuts"))).otherwise(acc)

    return items.select(*keys, "length", F.aggregate("items", start, step)["cuts"].alias("cuts"))


def bands_from_cuts(cuts: DataFrame, profile: DataFrame, keys: list[str], overlap: int = P.OVERLAP) -> DataFrame:
    """(keys, band, start, offset, stop, mass): hopping bands; the mass is that of the band without its overlap."""
    edges = cuts.select(*keys, "length", F.expr("concat(array(0L), transform(cuts, c -> c.cut), array(length))").alias("edges"))
    bands = edges.select(*keys, F.posexplode(F.expr("transform(sequence(1, size(edges) - 1), i -> struct(edges[i - 1] as start, edges[i] as stop))")).alias("band", "e"))
    bands = bands.select(*keys, "band", "e.start", "e.stop").withColumn("offset", F.when(F.col("band") > 0, F.greatest(F.lit(0), F.col("start") - overlap)).otherwise(F.lit(0)))
    mass = bands.join(profile, keys).where("pos >= start and pos < stop").groupBy(*keys, "band").agg(F.sum("mass").alias("mass"))
    return bands.join(mass, [*keys, "band"], "left").where("stop - offset >= 1").withColumn("mass", F.coalesce("mass", F.lit(0)))


def band_count(length: Column, span: Column, overlap: int = P.OVERLAP) -> Column:
    """How many overlapping bands of ``span`` cover a length; a rest within the overlap goes to the last."""
    more = F.ceil((length - overlap - span) / (span - overlap))
    return F.when(length <= span, F.lit(1)).otherwise(1 + F.greatest(F.lit(0), more)).cast("bigint")


def reader_span(width: Column) -> Column:
    """Height of canvas that a reader can take at once."""
    return F.greatest(F.lit(P.BAND_MIN), F.floor(width * P.BAND_RATIO)).cast("bigint")


def band_owner(regions: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """Each region with the band that covers most of it, the earlier one of two; without overlap the nearest middle."""
    b = bands.select(*keys, "band", F.col("offset").alias("top"), F.col("stop").alias("bottom"))
    both = regions.join(b, keys).withColumn("covered", F.greatest(F.lit(0), F.least("y1", "bottom") - F.greatest("y0", "top")))
    away = F.abs(F.expr("(y0 + y1) div 2") - F.expr("top + (bottom - top) div 2"))
    best = F.max_by("band", F.struct("covered", F.when(F.col("covered") == 0, -away).otherwise(F.lit(0)), -F.col("band")))
    return both.groupBy(*keys, "block").agg(best.alias("band"))


def band_extent(owned: DataFrame, bands: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Bands grown so that each holds its regions whole; bands without regions are left out."""
    own = owned.join(regions, [*keys, "block"]).groupBy(*keys, "band").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.count("*").alias("regions"))
    out = bands.join(own, [*keys, "band"])
    return out.select(*keys, "band", "regions", F.greatest(F.lit(0), F.least("offset", "y0")).alias("top"), F.greatest("stop", "y1").alias("bottom"), ((F.col("y0") < F.col("offset")) | (F.col("y1") > F.col("stop"))).alias("grown"))


def content_bands(profile: DataFrame, keys: list[str], n: Column | int, max_span: int | None = None, max_shift: float | None = None, overlap: int = P.OVERLAP, window: int = P.SNAP) -> DataFrame:
    """Bands of equal mass; with ``max_span`` as many more as it takes for the longest to fit, up to ``P.RETRIES``.

    All numbers of bands that may be needed are tried side by side, each as a split of its own. The least
    that fits wins; if none does, the one with the shortest longest band. (keys, n, band, offset, stop, mass)
    """
    n = n if isinstance(n, Column) else F.lit(n)
    pages = profile.groupBy(*keys).agg((F.max("pos") + 1).alias("length"), F.first(n).cast("bigint").alias("least"))
    if max_span:
        least = F.greatest("least", F.ceil(F.col("length") / max_span))
        tries = pages.withColumn("attempt", F.explode(F.sequence(least, least + P.RETRIES)))
    else:
        tries = pages.withColumn("attempt", F.greatest("least", F.lit(1)))
    tries = tries.select(*keys, "length", "attempt")
    each = profile.select(*keys, "pos", "mass").join(tries.drop("length"), keys)
    own = [*keys, "attempt"]
    targets = equal_mass_targets(each, own, F.col("attempt"))
    if max_shift is not None:
        targets = clamp_targets(targets, max_shift)
    cuts = plan_cuts(snap_to_clean(targets, each, own, window), own).drop("length")
    planned = tries.join(cuts, own, "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<struct<cut:bigint,snapped:boolean>>")))
    bands = bands_from_cuts(planned, each, own, overlap)
    if max_span:
        longest = bands.groupBy(*own).agg(F.max(F.col("stop") - F.col("offset")).alias("longest"))
        # a try that fits counts by its number, the others by their longest band, after all that fit
        rank = F.when(F.col("longest") <= max_span, F.struct(F.lit(0).alias("a"), F.lit(0).cast("bigint").alias("b"), "attempt")).otherwise(F.struct(F.lit(1).alias("a"), F.col("longest").alias("b"), "attempt"))
        bands = bands.join(longest.groupBy(*keys).agg(F.min_by("attempt", rank).alias("attempt")), own)
    return bands.select(*keys, F.col("attempt").alias("n"), "band", "offset", "stop", "mass")


def off_boxes(cuts: DataFrame, boxes: DataFrame, keys: list[str], window: int = P.SNAP) -> DataFrame:
    """Moves cuts (keys, k, cut, length) off the boxes (keys, top, bottom) they cross: to the nearest free place.

    A free place next to a crossed cut is always an edge of some box, so only edges within the window are
    candidates; the upper one of two at equal distance wins, and without any the cut stays.
    """
    spots = cuts.select(*keys, "k", "cut", "length", F.col("cut").alias("spot")).unionByName(
        cuts.join(boxes.select(*keys, F.explode(F.array("top", "bottom")).alias("spot")), keys).where(F.abs(F.col("spot") - F.col("cut")) <= window).where("spot > 0 and spot < length").select(*keys, "k", "cut", "length", "spot")
    )
    b = boxes.select(*[F.col(k).alias(f"__{k}") for k in keys], "top", "bottom")
    same = [F.col(k) == F.col(f"__{k}") for k in keys]
    free = spots.join(b, [*same, F.col("top") < F.col("spot"), F.col("spot") < F.col("bottom")], "left_anti")
    best = free.groupBy(*keys, "k").agg(F.min_by("spot", F.struct(F.abs(F.col("spot") - F.col("cut")), "spot")).alias("moved"))
    return cuts.join(best, [*keys, "k"], "left").withColumn("cut", F.coalesce("moved", "cut")).drop("moved")


def sweep_bands(profile: DataFrame, widths: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Bands of long canvases for a reader (widths: keys, width): planned by mass, then moved off the boxes."""
    pages = profile.groupBy(*keys).agg((F.max("pos") + 1).alias("length")).join(widths, keys)
    pages = pages.withColumn("span", reader_span(F.col("width"))).withColumn("n", band_count(F.col("length"), F.col("span")))
    each = profile.join(pages.where("length > span").select(*keys, "n"), keys)
    cuts = plan_cuts(snap_to_clean(equal_mass_targets(each, keys, F.col("n")), each, keys), keys)
    flat = cuts.select(*keys, "length", F.posexplode("cuts").alias("k", "c")).select(*keys, "length", "k", "c.cut")
    moved = off_boxes(flat, boxes, keys).where("cut > 0 and cut < length")
    again = moved.groupBy(*keys, "length").agg(F.array_sort(F.collect_set(F.struct("cut", F.lit(True).alias("snapped")))).alias("cuts"))
    planned = pages.select(*keys, "length").join(again.drop("length"), keys, "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<struct<cut:bigint,snapped:boolean>>")))
    return bands_from_cuts(planned, profile, keys).select(*keys, "band", "offset", "stop")


def tiles(profile: DataFrame, keys: list[str]) -> DataFrame:
    """Tiles of canvases: one up to ``P.UNTILED``, else equal-mass bands no longer than ``P.TILE``."""
    pages = profile.groupBy(*keys).agg((F.max("pos") + 1).alias("length"))
    low = pages.where(F.col("length") <= P.UNTILED).select(*keys, F.lit(0).alias("band"), F.lit(0).cast("bigint").alias("offset"), F.col("length").alias("stop"))
    tall = pages.where(F.col("length") > P.UNTILED).select(*keys, band_count(F.col("length"), F.lit(P.TILE)).alias("n"))
    split = content_bands(profile.join(tall, keys), keys, F.col("n"), max_span=P.TILE)
    return low.unionByName(split.select(*keys, "band", F.col("offset").cast("bigint").alias("offset"), "stop"))


def edge_profiles(pictures: DataFrame, key: str, axis: str = "y") -> DataFrame:
    """Edge density of pictures (``key``, ``luma`` array of rows of 0..255) along an axis, as an array of doubles."""

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "profile": [P.edge_profile(np.array([list(r) for r in p]), axis).tolist() for p in batch["luma"]]})

    return pictures.select(key, "luma").mapInPandas(run, f"{key} bigint, profile array<double>")


def crop_box(b: Column, width: Column, height: Column, pad_x: int = 24, pad_y: int = 12, least: int = 8, target: int = 600) -> Column:
    """Padded crop of a box within its canvas, and the factor that brings it to ``target`` wide; null if too small."""
    x0, y0 = F.greatest(F.lit(0), b["x0"] - pad_x), F.greatest(F.lit(0), b["y0"] - pad_y)
    x1, y1 = F.least(width, b["x1"] + pad_x), F.least(height, b["y1"] + pad_y)
    fits = (x1 - x0 >= least) & (y1 - y0 >= least)
    return F.when(fits, F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), F.greatest(F.lit(1.0), target / (x1 - x0)).alias("scale")))
