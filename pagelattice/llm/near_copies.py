"""Operator 8 at a similarity: near copies by the Jaccard similarity of word shingles, for the pipeline's stage.

Texts are sets of ``WIDTH``-word shingles; pairs that share ``LEAST`` of them are links, and each link is checked
exactly. SimHash alone can't find these: at a similarity of 0.8 two 64-bit fingerprints differ in 10 bits on average
and in up to 19 or so, and a Gray index searched that far leaves hardly a group closed. So MinHash bands of
``DEPTH`` values bring sets together first (a pair of similarity s never meets with probability
(1 - s^DEPTH)^BANDS: 3 in 100,000 at 0.8, less above). What meets in a band is a Gray-order index of the sets' SimHash
fingerprints: a set is only compared with those within ``FAR`` bits, found by accumulated differences. ``FAR`` is
five standard deviations beyond the mean at 0.8, so it loses less than the bands do, and spares four fifths of the
comparisons of sets that have nothing in common.

Equal sets are one node. Bands with the same members are looked at once. A band of more than ``BLOCK`` members is
dealt out as pairs of blocks: each pair of members still meets, and no task holds more than two blocks. Links leave
a task as a spanning forest; components join the forests.

Defined cases: null text counts as empty; texts without words are copies of each other; texts under
``WIDTH`` words are one shingle; repeated rows and doc_ids each return a row; a row with a null doc_id
returns its component but never names one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, give_back, hash_words, materialize, settle, words_of
from .components import components
from .simhash import GrayIndex

WIDTH = 5
#: Least similarity of a link, as a fraction.
LEAST = (4, 5)
BANDS, DEPTH = 20, 4
#: Bits that fingerprints of links differ in at most; members of a band that are looked at together.
FAR, BLOCK = 28, 4096
_rng = np.random.default_rng(42)
_FACTORS = _rng.integers(0, 1 << 63, BANDS * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts to (hashes, ends): each text's distinct shingle hashes in ascending order, and where they end."""
    codes, vocabulary, ends = words_of(column)
    words = hash_words(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    size = ends - starts
    count = np.where(size > WIDTH, size - WIDTH + 1, np.minimum(size, 1))
    text = np.repeat(np.arange(len(ends)), count)
    at = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + starts[text]
    own = np.zeros(len(text), np.uint64)
    for k in range(WIDTH):
        inside = at + k < ends[text]
        own[inside] = _mix(own[inside] * np.uint64(0x9E3779B97F4A7C15) + words[at[inside] + k] + np.uint64(1))
    order = np.lexsort((own, text))
    own, text = own[order], text[order]
    first = np.ones(len(own), bool)
    first[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
    return own[first], np.cumsum(np.bincount(text[first], minlength=len(ends)))


def prints_of(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number for each set: the mixed sum of its shingles' hashes and their count (0 for an empty set)."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(hashes), dtype=np.uint64)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    return _mix(total[ends] - total[starts] + (ends - starts).astype(np.uint64))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        hashes, ends = shingles(part.column(1))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        full = np.flatnonzero(ends > starts)
        bands = np.zeros((len(full), BANDS), np.uint64)
        for k in range(BANDS * DEPTH if len(full) else 0):
            least = np.minimum.reduceat(hashes * _FACTORS[k], starts[full])
            bands[:, k // DEPTH] = _mix(bands[:, k // DEPTH] * np.uint64(31) + least + np.uint64(k // DEPTH))
        at = np.zeros(len(ends) + 1, np.int32)
        at[1:] = np.cumsum((ends > starts) * BANDS)
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(bands.ravel().view(np.int64)))
        passed = {part.schema.names[k]: part.column(k) for k in range(2, part.num_columns)}
        made = {**passed, "doc_id": part.column(0), "fp": pa.array(prints_of(hashes, ends).view(np.int64)), "bands": lists}
        yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def simhashes(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SimHash of each set: a bit is set if more than half of its shingles have it (0 for an empty set)."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    full = np.flatnonzero(ends > starts)
    out = np.zeros(len(ends), np.uint64)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, starts[full], axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * ones > (ends - starts)[full, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        hashes, ends = shingles(part.column(1))
        body = hashes.tobytes()
        cut = [0, *(ends * 8).tolist()]
        own = [body[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        prints = pa.array(prints_of(hashes, ends).view(np.int64)), pa.array(simhashes(hashes, ends).view(np.int64))
        yield pa.RecordBatch.from_arrays([*prints, pa.array(own, pa.binary())], ["fp", "sim", "hashes"])


def linked(sets: list[np.ndarray], prints: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, member) of a spanning forest of the pairs whose similarity is at least ``LEAST``.

    From one member on, all that link to it leave the rest and are gone through in turn.
    """
    up, down = LEAST
    index = GrayIndex(np.zeros(len(sets), np.int64), prints)
    order = index.order
    size = np.array([len(sets[k]) for k in order])
    left, edges = np.ones(len(sets), bool), []
    reached: list[int] = []
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first] = False
        reached.append(first)
        while reached:
            me = reached.pop()
            _, near = index.search_for(np.array([me]), FAR, after=False)
            # sets whose sizes differ by more can't be so similar
            near = near[left[near] & (down * size[near] >= up * size[me]) & (down * size[me] >= up * size[near])]
            if not len(near):
                continue
            own, flat, owner = sets[order[me]], np.concatenate([sets[k] for k in order[near]]), np.repeat(np.arange(len(near)), size[near])
            spot = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            shared = np.bincount(owner[own[spot] == flat], minlength=len(near))
            met = near[(up + down) * shared >= up * (size[near] + size[me])]
            edges += [(int(order[me]), int(order[k])) for k in met]
            left[met] = False
            reached += met.tolist()
    return edges


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, i, j, fp, sim, hashes) sorted by the first three to forest edges (a, b)."""
    key, prints, sims, sets = None, [], [], []

    def close() -> Iterator[pa.RecordBatch]:
        found = linked(sets, np.array(sims, np.int64).view(np.uint64)) if len(sets) > 1 else []
        if found:
            own = np.array(prints, np.int64)
            ends = np.array(found)
            yield pa.RecordBatch.from_arrays([pa.array(own[ends[:, 0]]), pa.array(own[ends[:, 1]])], ["a", "b"])

    for batch in batches:
        bucket, i, j, fp, sim = (batch.column(k).to_pylist() for k in range(5))
        for row, new in enumerate(zip(bucket, i, j, strict=True)):
            if new != key:
                yield from close()
                key, prints, sims, sets = new, [], [], []
            prints.append(fp[row])
            sims.append(sim[row])
            sets.append(np.frombuffer(batch.column(5)[row].as_py(), np.uint64))
    yield from close()
    give_back()


def links(spark: SparkSession, docs: DataFrame, prints: DataFrame) -> DataFrame:
    """Forest edges ``(a, b)`` among the shingle sets ``fp`` of ``prints``, whose texts are in ``docs``."""
    nodes = prints.groupBy("fp").agg(F.first("bands").alias("bands"))  # equal sets have equal bands
    dealt = materialize(spark, nodes.select("fp", F.explode("bands").alias("bucket")), "bands")
    met = dealt.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("fp")).alias("x"), F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("y"))
    once = met.where("n > 1").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"))
    once = materialize(spark, once.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "buckets")
    members = materialize(spark, dealt.join(once, "bucket"), "members")
    wanted = members.select("fp").distinct()
    ids = materialize(spark, prints.join(wanted, "fp").groupBy("fp").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct(), "wanted")
    # the list grows with the documents: a shuffle of the texts at any size, rather than a broadcast of small lists alone
    texts = docs.join(ids.hint("merge"), "doc_id", "left_semi").unionAll(docs.where("doc_id is null"))
    sets = texts.select("doc_id", "text").mapInArrow(_sets, "fp bigint, sim bigint, hashes binary").join(wanted, "fp", "left_semi")
    sets = materialize(spark, sets.groupBy("fp").agg(F.first("sim").alias("sim"), F.first("hashes").alias("hashes")), "sets")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    block = members.select("bucket", "fp", own.cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    block = block.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    settle(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = block.join(sets, "fp").select("bucket", "i", "j", "fp", "sim", "hashes").repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return rows.mapInArrow(_edges, "a bigint, b bigint").distinct()


def near_copies(spark: SparkSession, docs: DataFrame, key_col: str | None = None) -> DataFrame:
    """``(doc_id[, key_col], component, component_id)``: one row for each row of ``docs``.

    ``component`` names the component, also where no doc_id does; component_id is the least doc_id that links reach.
    ``key_col``: a bigint column that is passed on.
    """
    settle(spark)
    own = [F.col(key_col).cast("bigint").alias(key_col)] if key_col else []
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *own)
    kinds = ", ".join([*([f"`{key_col}` bigint"] if key_col else []), "doc_id bigint, fp bigint, bands array<bigint>"])
    prints = materialize(spark, docs.select("doc_id", "text", *own).mapInArrow(_signed, kinds), "prints")
    settle(spark)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(spark, links(spark, docs, prints))
    joined = least.join(roots.withColumnRenamed("node", "fp"), "fp")
    named = joined.groupBy("root").agg(F.min("least").alias("least_of_all"))
    moved = joined.join(named, "root").select("fp", "root", "least_of_all")
    labels = least.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("component"), F.coalesce("least_of_all", "least").alias("component_id"))
    labels = materialize(spark, labels, "labels")
    return prints.join(labels, "fp").select("doc_id", *([key_col] if key_col else []), "component", "component_id")
