"""Retrieval chunks: segmentation of blocks, captions at their anchors, markers, tables as lines, Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Characters after which a chunk of text is closed (fixed value).
MAX_CHARS = 700

_CHUNK = "struct<kind:string,heading:string,text:string>"


def chunk_blocks(blocks: DataFrame, key: str, max_chars: int = MAX_CHARS) -> DataFrame:
    """(key, chunk_no, chunk_id, kind, heading, text) from blocks (key, ord, kind 'text' or 'table', text).

    A heading begins a chunk; a table is one of its own, under the heading in force; text is closed once its
    pieces have ``max_chars`` characters. A chunk's heading is the one in force when it began. The size
    reset makes this a fold over the blocks of one document.
    """
    item = F.struct("ord", "kind", F.trim("text").alias("text"), T.is_heading(F.trim("text")).alias("head"))
    docs = blocks.where("trim(text) <> ''").groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.array().cast("array<string>")
    start = F.struct(F.lit(None).cast("string").alias("heading"), F.lit(None).cast("string").alias("opened"), none.alias("buffer"), F.lit(0).alias("chars"), F.array().cast(f"array<{_CHUNK}>").alias("out"))

    def chunk(kind: Column, heading: Column, text: Column) -> Column:
        return F.array(F.struct(kind.alias("kind"), heading.alias("heading"), text.alias("text")))

    def flushed(acc: Column) -> Column:
        return F.when(F.size(acc["buffer"]) > 0, F.concat(acc["out"], chunk(F.lit("text"), acc["opened"], F.array_join(acc["buffer"], "\n")))).otherwise(acc["out"])

    def state(heading: Column, opened: Column, buffer: Column, chars: Column, out: Column) -> Column:
        return F.struct(heading.alias("heading"), opened.alias("opened"), buffer.alias("buffer"), chars.cast("int").alias("chars"), out.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        size = F.length(x["text"])
        table = state(acc["heading"], F.lit(None).cast("string"), none, F.lit(0), F.concat(flushed(acc), chunk(F.lit("table"), acc["heading"], x["text"])))
        head = state(x["text"], x["text"], F.array(x["text"]), size, flushed(acc))
        opened = F.when(F.size(acc["buffer"]) == 0, acc["heading"]).otherwise(acc["opened"])
        buffer = F.concat(acc["buffer"], F.array(x["text"]))
        full = state(acc["heading"], F.lit(None).cast("string"), none, F.lit(0), F.concat(acc["out"], chunk(F.lit("text"), opened, F.array_join(buffer, "\n"))))
        more = state(acc["heading"], opened, buffer, acc["chars"] + size, acc["out"])
        return F.when(x["kind"] == "table", table).when(x["head"], head).when(acc["chars"] + size >= max_chars, full).otherwise(more)

    folded = docs.select(key, F.aggregate("items", start, step, flushed).alias("chunks"))
    out = folded.select(key, F.posexplode("chunks").alias("chunk_no", "c"))
    name = F.format_string("%s_c%03d", F.col(key).cast("string"), F.col("chunk_no"))
    return out.select(key, F.col("chunk_no").cast("bigint").alias("chunk_no"), name.alias("chunk_id"), "c.kind", "c.heading", "c.text")


def anchor_captions(chunks: DataFrame, captions: DataFrame, key: str) -> DataFrame:
    """Chunks with captions put in: each right after the first chunk that holds its marker, else at the end.

    ``captions``: key, asset_id, ord, text (null: captioning failed). An anchored caption takes the chunk's
    heading; one without a place, or without a text, says so in ``notes``.
    """
    marker = F.concat(F.lit("[image:"), F.col("asset_id"), F.lit("]"))
    met = captions.join(chunks.select(key, "chunk_no", "heading", F.col("text").alias("__text")), key).where(F.contains("__text", marker))
    first = met.groupBy(key, "asset_id").agg(F.min("chunk_no").alias("at"), F.min_by("heading", "chunk_no").alias("heading"))
    placed = captions.join(first, [key, "asset_id"], "left")
    notes = F.concat_ws("; ", F.when(F.col("at").isNull(), "no_anchor"), F.when(F.col("text").isNull(), "caption_failed"))
    caps = placed.select(key, F.coalesce("at", F.lit(1 << 40)).alias("at"), F.lit(1).alias("after"), F.col("ord").cast("bigint").alias("ord"), F.lit("image_caption").alias("kind"), "heading", F.coalesce("text", F.lit("")).alias("text"), "asset_id", notes.alias("notes"))
    own = chunks.select(key, F.col("chunk_no").alias("at"), F.lit(0).alias("after"), F.lit(0).cast("bigint").alias("ord"), "kind", "heading", "text", F.lit(None).cast("string").alias("asset_id"), F.lit("").alias("notes"))
    order = F.row_number().over(Window.partitionBy(key).orderBy("at", "after", "ord")) - 1
    return own.unionByName(caps).withColumn("place", order.cast("bigint")).drop("at", "after", "ord")


def drop_markers(text: Column, asset_ids: Column) -> Column:
    """Text without the markers of some assets; lines that nothing else was on go too."""
    clean = lambda line: F.rtrim(F.aggregate(asset_ids, line, lambda t, a: F.replace(t, F.concat(F.lit("[image:"), a, F.lit("]")), F.lit(""))))
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), clean), lambda t: F.trim(t) != ""), "\n")


def to_markdown(chunks: DataFrame, key: str) -> DataFrame:
    """One Markdown text for each document."""
    part = F.concat_ws("\n", F.concat(F.lit("## "), F.coalesce("heading", F.lit("-"))), F.concat(F.lit("<!-- "), F.col("chunk_id"), F.lit(" "), F.col("kind"), F.lit(" -->")), F.col("text"))
    return chunks.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", part.alias("part")))), lambda s: s["part"]), "\n\n").alias("markdown"))


def table_lines(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a table from cells (keys, row, col, text, nested): blanks left out, equal neighbours kept.

    ``nested`` is the text of a table within the cell, its lines by newlines; it is put in once, by `` / ``.
    """
    inner = F.array_join(F.filter(F.split(F.coalesce("nested", F.lit("")), "\n"), lambda t: F.trim(t) != ""), " / ")
    text = F.trim(F.concat_ws(" ", F.nullif(F.trim(F.coalesce("text", F.lit(""))), F.lit("")), F.nullif(inner, F.lit(""))))
    shown = cells.withColumn("__text", text).where("__text <> ''")
    return shown.groupBy(*keys, "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "__text"))), lambda s: s["__text"]), " | ").alias("line"))


def markdown_table_lines(text: Column) -> Column:
    """Rows of a Markdown table as lines: rules left out, runs of equal cells folded."""
    rows = F.filter(F.split(text, "\n"), lambda r: F.contains(r, F.lit("|")) & ~r.rlike(r"^[\s|:\-]+$"))
    cells = lambda r: F.filter(F.transform(F.split(F.regexp_replace(r, r"^\s*\||\|\s*$", ""), r"\|"), lambda c: F.trim(c)), lambda c: c != "")
    folded = lambda r: F.aggregate(cells(r), F.array().cast("array<string>"), lambda acc, c: F.when(F.coalesce(F.try_element_at(acc, F.lit(-1)) == c, F.lit(False)), acc).otherwise(F.concat(acc, F.array(c))))
    return F.filter(F.transform(rows, lambda r: F.array_join(folded(r), " | ")), lambda t: t != "")
