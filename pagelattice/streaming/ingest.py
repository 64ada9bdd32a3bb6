"""Streaming forms (an extension: the batch operators have no streaming counterpart to match)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunks import chunk_blocks

BLOCK = "doc_id string, ord bigint, kind string, text string"


def read_blocks(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Blocks of arriving documents: each JSON file holds all blocks of one document."""
    return spark.readStream.schema(BLOCK).option("maxFilesPerTrigger", files_per_trigger).json(path)


def stream_chunks(blocks: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Chunks of arriving documents, appended to ``out``; as a document comes whole, no state is kept."""

    def batch(rows: DataFrame, _: int) -> None:
        chunk_blocks(rows, "doc_id").write.mode("append").parquet(out)

    return blocks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of users over events (user_id, ts, value), late ones up to ``late``; batch and streaming."""
    watched = events.withWatermark("ts", late) if events.isStreaming else events
    out = watched.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("events"), F.max("value").alias("top"))
    return out.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("stop"), "events", "top")


def windows(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Tumbling or sliding counts by event type."""
    watched = events.withWatermark("ts", late) if events.isStreaming else events
    out = watched.groupBy(F.window("ts", size, slide).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "event_type", "n")
