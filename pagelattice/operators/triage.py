"""Routing of files and pages: by extension, by the state of a page's text layer, by name and model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Keywords of file names by product group (fixed values).
KEYWORDS = {"예금성": ("예금성", "예금", "적금", "입출금"), "대출성": ("대출성", "대출", "신용대출", "담보")}
#: Thresholds of the page triage (fixed values).
MIN_CHARS, MIN_BROKEN, BROKEN_SHARE, MIN_JUDGED, NORMAL_SHARE, IMAGE_SHARE = 20, 8, 0.3, 50, 0.1, 0.5


def route(path: Column) -> Column:
    """Track of a file; what no track reads is kept as unreadable."""
    ext = T.extension(path)
    return F.when(ext.isin("hwp", "hwpx"), "hwp").when(ext.isin("png", "jpg", "jpeg"), "image").when(ext == "pdf", "pdf").otherwise("unreadable")


def triage(pages: DataFrame) -> DataFrame:
    """Verdict on pages (text, image_ratio, paths): scan_like, hybrid or structured, with the reason."""
    bare = F.regexp_replace("text", r"\s", "")
    rows = pages.withColumn("bare", bare).withColumns({"char_count": F.length("bare"), "korean_count": F.regexp_count("bare", F.lit("[가-힣]"))})
    rows = rows.withColumn("fffd_count", F.length("bare") - F.length(F.replace(F.col("bare"), F.lit("�"), F.lit(""))))
    n, broken = F.col("char_count"), F.col("fffd_count")
    reason = (
        F.when(n <= MIN_CHARS, "too_few_characters")
        .when((broken >= MIN_BROKEN) & (broken / F.greatest(n, F.lit(1)) >= BROKEN_SHARE), "broken_encoding")
        .when((n >= MIN_JUDGED) & (T.normal_ratio(F.col("bare")) <= NORMAL_SHARE), "unusual_characters")
        .when(F.col("image_ratio") >= IMAGE_SHARE, "large_images")
        .when(F.col("paths") > 0, "vector_shapes")
    )
    scan = F.col("reason").isin("too_few_characters", "broken_encoding", "unusual_characters")
    verdict = F.when(scan, "scan_like").when(F.col("reason") == "large_images", "hybrid").otherwise("structured")
    whole = {"char_count": n.cast("bigint"), "korean_count": F.col("korean_count").cast("bigint"), "fffd_count": broken.cast("bigint")}
    return rows.withColumn("reason", reason).withColumn("verdict", verdict).withColumns(whole).drop("bare")


def object_census(objects: DataFrame, keys: list[str]) -> DataFrame:
    """Shares of a page that images and paths cover (objects: kind, area, page_area): images at most 1.

    A page without an area has no shares and no paths counted: all three figures are 0.
    """
    covered = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("area"))), F.lit(0))
    sums = objects.groupBy(*keys).agg(covered("image").alias("image"), F.count_if(F.col("kind") == "path").alias("paths"), covered("path").alias("path"), F.max("page_area").alias("whole"))
    flat = ~F.coalesce(F.col("whole") > 0, F.lit(False))
    share = lambda part: F.when(flat, 0.0).otherwise(F.try_divide(F.col(part).cast("double"), F.col("whole")))
    return sums.select(*keys, F.least(F.lit(1.0), share("image")).alias("image_ratio"), F.when(flat, F.lit(0)).otherwise(F.col("paths")).cast("bigint").alias("paths"), share("path").alias("path_ratio"))


def classify(rows: DataFrame) -> DataFrame:
    """Product group from the name's prior and the model's group (null: not asked or failed), and where it came from."""
    abstained = F.coalesce(F.col("model_group").isin("기타", "판단불가"), F.lit(False))
    seen = F.when(~abstained, F.col("model_group"))
    prior = F.col("prior")
    source = (
        F.when(prior.isNotNull() & seen.isNotNull(), F.when(prior == seen, "filename_and_vlm").otherwise("vlm_overrode_filename"))
        .when(seen.isNotNull(), "vlm")
        .when(prior.isNotNull() & abstained, "filename_vlm_abstained")
        .when(prior.isNotNull(), "filename_vlm_failed")
        .when(abstained, "vlm_abstained")
        .otherwise("none")
    )
    return rows.withColumns({"product_group": F.coalesce(seen, prior), "category_source": source})


def is_decorative(w: Column, h: Column) -> Column:
    """Pictures too small to hold text."""
    return (F.least(w, h) < 32) | (w.cast("bigint") * h < 20000)
