"""Sharding by longest-processing-time scheduling.

Groups of rows that must stay together (equal texts) are taken from the largest down, and each goes to
the least-loaded shard, the heap's top. Groups of one size are interchangeable, so the schedule only needs
to know how many there are of each: the driver holds one (size, count) pair for each distinct group size, the one
thing here that grows with the data - of T bytes there can be at most sqrt(2 T), as sizes that differ add up - and
replays the heap over them; what it sends back is, for each size, the shards that get some of its groups (one shard
for a group of its own size) and how many. A long run of equal groups is settled by filling the shards to a common level first, which is where the
heap would bring them. Which of its equals a group is, is counted on the executors, in two steps (within a
slice, then over slices), so no task sees all groups of a size, nor all rows of a shard when slots are dealt.

Defined cases: null texts count as empty ones and form one group with them; rows of one group, repeated
rows too, share a shard; ties between shards go to the lower number; an empty table returns no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

#: Slices that one group size, and one shard, is counted in.
SIZE_SLICES, SLOT_SLICES = 64, 256


def schedule(sizes: list[int], counts: list[int], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy heap over groups from the largest down: (groups of each size by shard, final loads).

    ``sizes`` falls strictly; row k of the first array says how many of the ``counts[k]`` equal groups go
    to each shard.
    """
    loads = np.zeros(shards, dtype=object if sum(s * c for s, c in zip(sizes, counts, strict=True)) >= 1 << 62 else np.int64)
    given = np.zeros((len(sizes), shards), np.int64)
    heap = [(0, k) for k in range(shards)]
    for row, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        left = count
        if size > 0 and left > 8 * shards:
            # the heap serves the `left` least of all loads + j * size: all below a level, then the rest one by one
            loads[:] = [load for load, _ in sorted(heap, key=lambda x: x[1])]
            lo, hi = int(loads.min()), int(loads.max()) + size * (left // shards + 1) + 1
            while hi - lo > 1:
                mid = (lo + hi) // 2
                if int(np.maximum(0, -((loads - mid) // size)).sum()) <= left:
                    lo = mid
                else:
                    hi = mid
            more = np.maximum(0, -((loads - lo) // size)).astype(np.int64)
            given[row] += more
            loads += more * size
            left -= int(more.sum())
            heap = [(int(loads[k]), k) for k in range(shards)]
            heapq.heapify(heap)
        for _ in range(left):
            load, k = heap[0]
            given[row, k] += 1
            heapq.heapreplace(heap, (load + size, k))
    for load, k in heap:
        loads[k] = load
    return given, loads


def shard(spark: SparkSession, docs: DataFrame, shards: int = 24) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``: one row for each row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8; the rows of a shard are numbered from 0 without gaps.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    )
    rows = materialize(spark, rows, "rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("total"))
    groups = groups.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(SIZE_SLICES)).cast("int"))
    groups = materialize(spark, groups, "groups")
    in_slice = groups.groupBy("total", "slice").agg(F.count("*").alias("n"))
    have = in_slice.groupBy("total").agg(F.sum("n").alias("n")).toPandas().sort_values("total", ascending=False)
    given, _ = schedule(have["total"].tolist(), have["n"].tolist(), shards)
    row, home = np.nonzero(given)
    stop = np.cumsum(given, axis=1)[row, home]
    plan = spark.createDataFrame(pd.DataFrame({"total": have["total"].to_numpy(np.int64)[row], "stop": stop, "home": home.astype(np.int32)}), "total bigint, stop bigint, home int")
    plan = materialize(spark, plan, "plan").groupBy("total").agg(F.array_sort(F.collect_list(F.struct("stop", "home"))).alias("stops"))  # at most ``shards`` of each
    before = F.sum("n").over(Window.partitionBy("total").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    base = in_slice.withColumn("base", F.coalesce(before, F.lit(0))).join(plan, "total").select("total", "slice", "base", "stops")
    place = F.row_number().over(Window.partitionBy("total", "slice").orderBy("key")) - 1
    ranked = groups.withColumn("place", place).join(base, ["total", "slice"])
    # the first shard whose stop lies beyond the group's place
    at = F.expr("filter(stops, s -> s.stop > base + place)[0].home")
    homes = ranked.select("key", at.alias("shard"))
    # the hot groups' rows are split by Spark's skew join; each row only carries its key
    housed = rows.join(homes, "key").select("doc_id", "size", "text_crc32", "shard")
    housed = housed.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_SLICES)).cast("int"))
    housed = materialize(spark, housed, "housed")
    many = housed.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    first = many.withColumn("first", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    slot = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32")) - 1
    numbered = housed.withColumn("place", slot).join(F.broadcast(first.select("shard", "slice", "first")), ["shard", "slice"])  # shards x SLOT_SLICES rows
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).alias("slot"))
