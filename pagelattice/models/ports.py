"""Ports to models: requests as rows, answers as rows, with a cache between.

A port is a callable ``(list of request texts) -> list of answers``. Requests are keyed by their content, so
a cache table turns a second run into a join: known keys are answered from it, and only the rest is sent.
"""

from __future__ import annotations

import json
import time
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OFF, RECORD, REPLAY = "off", "record", "replay"


class ReplayMiss(RuntimeError):
    pass


def request_key(parts: Column, schema_name: str, schema: dict, limit: int, model: str) -> Column:
    """SHA-256 over the typed parts (array of struct kind, body), the schema with sorted keys, the limit and the model."""
    body = F.array_join(F.transform(parts, lambda p: F.concat(p["kind"], F.lit(":"), F.sha2(p["body"], 256))), "|")
    tail = f"|{schema_name}|{json.dumps(schema, sort_keys=True, ensure_ascii=False)}|{limit}|{model}"
    return F.sha2(F.concat(body, F.lit(tail)), 256)


def split_by_cache(requests: DataFrame, cache: DataFrame, mode: str = RECORD) -> tuple[DataFrame, DataFrame]:
    """(answered, to send): requests with a stored answer that is valid JSON, and the others.

    Off: all are sent. Replay: a request without an answer is an error. A broken entry counts as none.
    """
    if mode == OFF:
        return requests.withColumn("answer", F.lit(None).cast("string")).limit(0), requests
    good = cache.where(F.try_parse_json("answer").isNotNull()).groupBy("key").agg(F.min("answer").alias("answer"))
    hits, misses = requests.join(good, "key"), requests.join(good, "key", "left_anti")
    if mode == REPLAY and not misses.isEmpty():
        raise ReplayMiss("a request has no stored answer")
    return hits, misses


def ask(requests: DataFrame, port: Callable[[list[str]], list[str]], retries: int = 2, pause: float = 2.0, text_col: str = "text") -> DataFrame:
    """Adds ``answer`` and ``error``: each Arrow batch is one call, tried again up to ``retries`` times."""

    def run(batches):
        for batch in batches:
            error, answers = None, [None] * len(batch)
            for attempt in range(retries + 1):
                try:
                    answers, error = port(batch[text_col].tolist()), None
                    break
                except Exception as e:  # noqa: BLE001 - errors are data here
                    error = f"{type(e).__name__}: {e}"
                    if attempt < retries:
                        time.sleep(pause * (attempt + 1))
            yield batch.assign(answer=pd.Series(answers, index=batch.index, dtype=object), error=error)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)
    return requests.mapInPandas(run, f"{kinds}, answer string, error string")


def echo_reader(texts: list[str]) -> list[str]:
    """Deterministic stand-in for a reader: it reads what is there, digits included."""
    return [" ".join((t or "").split()) for t in texts]


def stand_in_reader(texts: list[str]) -> list[str]:
    """Deterministic stand-in for a reader that errs: by a checksum of the text it reads all of it, loses the end,
    adds words, or mistakes the figures."""
    out = []
    for text in echo_reader(texts):
        error = zlib.crc32(text.encode()) % 4
        if error == 1:
            text = text[: 2 * len(text) // 3]
        elif error == 2:
            text += " and a line more"
        elif error == 3:
            text = text.translate(_MISREAD)
        out.append(text)
    return out


_MISREAD = str.maketrans("0123456789", "1234567890")


def length_reader(texts: list[str]) -> list[str]:
    """Deterministic stand-in whose answer is JSON with the request's length."""
    return [json.dumps({"n": len(t or "")}) for t in texts]


def keep_answers(cache: DataFrame, answered: DataFrame) -> DataFrame:
    """The cache with new answers (key, answer[, error]): valid JSON alone is kept, and of several answers to one
    key the cached one, else the least."""
    good = answered.where(F.try_parse_json("answer").isNotNull()).select("key", "answer", F.lit(1).alias("age"))
    both = cache.where(F.try_parse_json("answer").isNotNull()).select("key", "answer", F.lit(0).alias("age")).unionByName(good)
    return both.groupBy("key").agg(F.min_by("answer", F.struct("age", "answer")).alias("answer"))


def layout_rows(answers: DataFrame) -> DataFrame:
    """Lines of layout answers: three parallel arrays zipped, boxes that are no boxes dropped.

    ``answers``: page, rec_texts array<string>, rec_scores array<double>, rec_boxes array<array<int>>.
    """
    zipped = answers.select("page", F.posexplode(F.arrays_zip("rec_texts", "rec_scores", "rec_boxes")).alias("ord", "z"))
    b = F.col("z.rec_boxes")
    rows = zipped.select("page", F.col("ord").cast("bigint").alias("ord"), F.col("z.rec_texts").alias("text"), F.col("z.rec_scores").alias("confidence"), *[F.try_element_at(b, F.lit(k + 1)).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))])
    return rows.where("x1 > x0 and y1 > y0")
