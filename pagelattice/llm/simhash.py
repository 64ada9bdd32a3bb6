"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints link at ``radius`` or fewer differing bits. Cut into ``radius`` + 1 blocks, two such values agree on
one block at least. So each distinct fingerprint is arranged in ``radius`` + 1 ways, each with another block in
front, and each arrangement is sorted by Gray rank: neighbours differ in few bits, and those that agree on the
front block stand together. The sorted values are dealt out by ranges that keep equal front blocks together. Every
range is a hierarchical index: runs of values become nodes that hold the bits all members share, runs of nodes
become upper nodes, and a search adds up the differences from the root down: a node's children are only opened
while the sum so far is within the radius, so whole groups go at once. All pairs of a range within the radius are
found, whatever their front blocks. Links leave a task as a spanning forest, so their number is linear in the
fingerprints; components join the forests.

No front block gathers in a task without a bound: ones with more than ``HOT`` values are put off, and arranged
again by their other bits (cut into ``radius`` + 1 blocks as before, so no link is lost), until each holds less.
Blocks that a sample shows to be hot are put off before they are dealt out at all.

Defined cases: null text counts as empty; a text without words has fingerprint zero and links like any
other; texts of fewer words than a shingle are one shingle; repeated rows and doc_ids each return a row; a row with
a null doc_id returns its component but never names one; an empty table returns no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, materialize
from .components import components

SEED = 42
FANOUT = 8
#: Pairs of a fingerprint and a node that one step of a search holds.
FRONTIER = 1 << 18
#: Fingerprints of one index; of one front block, beyond which it is arranged anew; of a task; one in so many is sampled.
RANGE, HOT, TASK, SAMPLE = 1 << 15, 1 << 17, 1 << 20, 1 << 10
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of one text: a bit is set if more than half of the shingle hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 4096:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        prints = [fingerprint(t or b"", width) for t in part.column(1).cast(pa.large_binary()).to_pylist()]
        signed = np.array(prints, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(signed)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed bigint, one row for each row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, width=width), "doc_id bigint, fp bigint")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each uint64 in the reflected Gray code (prefix exclusive-or of the bits)."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over fingerprints sorted by (group, Gray rank).

    ``levels[0]`` are the fingerprints, each later level groups runs of ``FANOUT`` nodes of the one below
    within a group, up to one root for each group. A node keeps ``pattern`` and ``mask``: the bits that
    all below it share, the shared bits of its parent taken out of ``mask``, so that the differences from
    the root to a node add up without counting a bit twice.
    """

    def __init__(self, group: np.ndarray, prints: np.ndarray):
        self.order = np.lexsort((gray_rank(prints), group))
        self.group, self.prints = group[self.order], prints[self.order]
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        masks, patterns, groups, first = [np.full(len(prints), full)], [self.prints], [self.group], []
        while len(groups[-1]) > 1 and (groups[-1][1:] == groups[-1][:-1]).any() or len(groups) == 1 and len(prints):
            g = groups[-1]
            start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            within = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
            heads = np.flatnonzero(within % FANOUT == 0)
            all_and = np.bitwise_and.reduceat(patterns[-1] & masks[-1], heads)
            all_or = np.bitwise_or.reduceat(patterns[-1] & masks[-1], heads)
            shared = np.bitwise_and.reduceat(masks[-1], heads) & ~(all_and ^ all_or)
            first.append(np.append(heads, len(g)))
            masks.append(shared)
            patterns.append(all_and & shared)
            groups.append(g[heads])
        self.first = first
        self.patterns = patterns
        self.residual = [m.copy() for m in masks]
        for level, cut in enumerate(first):
            self.residual[level] &= ~np.repeat(masks[level + 1], np.diff(cut))
        self.root_groups = groups[-1]
        #: by level: the last fingerprint below each node
        self.last = [np.arange(len(prints))]
        for cut in first:
            self.last.append(self.last[-1][cut[1:] - 1])
        #: nodes that searches looked at, those they left closed, and the fingerprints below these
        self.seen = self.closed = self.spared = 0

    def search(self, lo: int, hi: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j), i < j in index order, of fingerprints lo <= i < hi and those within ``radius``."""
        return self.search_for(np.arange(lo, hi), radius)

    def search_for(self, query: np.ndarray, radius: int, after: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j) of the fingerprints ``query`` and those within ``radius``; ``after``: j behind i alone."""
        node = np.searchsorted(self.root_groups, self.group[query])
        top = len(self.first)
        sums = np.bitwise_count((self.prints[query] ^ self.patterns[top][node]) & self.residual[top][node]).astype(np.int64)
        stack, found = [(top, query, node, sums)], []
        while stack:
            level, query, node, sums = stack.pop()
            if level == 0:
                found.append((query, node))
                continue
            cut = self.first[level - 1]
            fan = cut[node + 1] - cut[node]
            ends = np.cumsum(fan)
            stop = 0
            while stop < len(query):  # as many nodes at a time as the frontier allows
                begin, base = stop, ends[stop - 1] if stop else 0
                stop = max(begin + 1, int(np.searchsorted(ends, base + FRONTIER, side="right")))
                f = fan[begin:stop]
                q, acc = np.repeat(query[begin:stop], f), np.repeat(sums[begin:stop], f)
                child = np.arange(len(q)) - np.repeat(np.cumsum(f) - f, f) + np.repeat(cut[node[begin:stop]], f)
                acc = acc + np.bitwise_count((self.prints[q] ^ self.patterns[level - 1][child]) & self.residual[level - 1][child])
                keep = acc <= radius
                if after:  # what lies before its query was met from the other side
                    ahead = self.last[level - 1][child] > q
                    self.seen += int(ahead.sum())
                    shut = child[ahead & ~keep]
                    keep &= ahead
                else:
                    self.seen += len(child)
                    shut = child[~keep]
                self.closed += len(shut)
                if level > 1:
                    below = self.last[level - 1]
                    self.spared += int((below[shut] - np.where(shut > 0, below[shut - 1], -1)).sum())
                if keep.any():
                    stack.append((level - 1, q[keep], child[keep], acc[keep]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a and b: ``label`` points to the least index of each set afterwards."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _trees(index: GrayIndex, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links of an index: (least position, member)."""
    n = len(index.prints)
    label = np.arange(n)
    step = max(1, FRONTIER // FANOUT)
    for lo in range(0, n, step):
        i, j = index.search(lo, min(lo + step, n), radius)
        if len(i):
            _settle(label, i, j)
    member = np.flatnonzero(label != np.arange(n))
    return label[member], member


def forest(group: np.ndarray, prints: np.ndarray, radius: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links inside the groups, as pairs of fingerprints."""
    index = GrayIndex(group, prints)
    a, b = _trees(index, radius)
    return index.prints[a], index.prints[b]


def pruning(prints: np.ndarray, radius: int = 2) -> dict[str, int]:
    """What the hierarchy saves on one set of fingerprints: pairs there are, nodes looked at, nodes left closed, and
    pairs that these spared."""
    index = GrayIndex(np.zeros(len(prints), np.int64), prints)
    _trees(index, radius)
    return {"pairs": len(prints) * (len(prints) - 1) // 2, "seen": index.seen, "closed": index.closed, "spared": index.spared}


def arrangements(radius: int, fixed: tuple = ((0, 64),), front: int = 0) -> list[tuple]:
    """Ways to put one of ``radius`` + 1 blocks in front: lists of (first bit, bits), front block first.

    ``fixed``: the bits in order, as pieces; the first ``front`` bits stay in front of all.
    """
    kept, rest = _cut(fixed, front)
    width = sum(n for _, n in rest)
    out = []
    for k in range(radius + 1):
        lo, hi = width * k // (radius + 1), width * (k + 1) // (radius + 1)
        head, tail = _cut(rest, lo)
        block, tail = _cut(tail, hi - lo)
        out.append((tuple(kept + block + head + tail), front + hi - lo))
    return out


def _cut(pieces: tuple | list, bits: int) -> tuple[list, list]:
    """The pieces' first bits, and the others."""
    head, tail = [], []
    for at, n in pieces:
        take = min(n, bits)
        bits -= take
        if take:
            head.append((at, take))
        if take < n:
            tail.append((at + take, n - take))
    return head, tail


def arranged(pieces: tuple) -> Column:
    """The fingerprint ``fp`` with its bits in another order; the first piece takes the highest places."""
    out, place = F.lit(0).cast("bigint"), 64
    for at, n in pieces:
        place -= n
        part = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1 if n < 64 else -1).cast("bigint"))
        out = out.bitwiseOR(F.shiftleft(part, place))
    return out


def put_back(values: np.ndarray, pieces: tuple) -> np.ndarray:
    """The inverse of ``arranged`` for uint64 values."""
    out, place = np.zeros(len(values), np.uint64), 64
    for at, n in pieces:
        place -= n
        out |= (values >> np.uint64(place) & np.uint64((1 << n) - 1)) << np.uint64(at)
    return out


def gray_column(value: Column) -> Column:
    """Gray rank of a bigint's 64 bits, as a bigint."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


def _links(batches: Iterator[pa.RecordBatch], radius: int, ways: list[tuple], last_level: bool) -> Iterator[pa.RecordBatch]:
    """Rows (way, front, rank, value) sorted by (way, rank) to forest edges (0, a, b), and the values of hot blocks
    (1 + way, fp, 0)."""

    def rows(kind: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "a", "b"])

    def as_prints(way: np.ndarray, value: np.ndarray) -> np.ndarray:
        out = np.empty(len(value), np.uint64)
        for k in np.unique(way):
            out[way == k] = put_back(value[way == k], ways[k][0])
        return out

    def edges(way: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
        index = GrayIndex(way, value)
        a, b = _trees(index, radius)
        if len(a):
            yield rows(np.zeros(len(a), np.int32), as_prints(index.group[a], index.prints[a]), as_prints(index.group[b], index.prints[b]))

    def deferred(way: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        return rows(1 + way, as_prints(way, value), np.zeros(len(way), np.uint64))

    held: list[tuple] = []  # (way, front, value) of what waits for an index to fill
    n_held = n_open = 0  # rows held, and rows of the last block so far
    last = hot = None  # that block, and one that is put off

    def flush(upto: int) -> Iterator[pa.RecordBatch]:
        """Index the rows held but for the last ``upto``, which stay."""
        nonlocal held, n_held
        if not held:
            return
        way, front, value = (np.concatenate([p[k] for p in held]) for k in range(3))
        cut = len(way) - upto
        if cut:
            yield from edges(way[:cut], value[:cut])
        held, n_held = [(way[cut:], front[cut:], value[cut:])] if upto else [], upto

    for batch in batches:
        if not batch.num_rows:
            continue
        way, front, value = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3))
        way, front, value = way.astype(np.int64), front.astype(np.int64), value.view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], (front[1:] != front[:-1]) | (way[1:] != way[:-1])]))
        sizes = np.diff(np.append(starts, len(way)))
        open_ = n_open if last == (int(way[0]), int(front[0])) else 0
        calm = last_level or sizes.max() <= HOT and open_ + sizes[0] <= HOT
        # a batch without a hot block is taken as it is, others block by block
        for lo, hi in [(0, len(way))] if calm else list(zip(starts, np.append(starts[1:], len(way)), strict=True)):
            key, end = (int(way[lo]), int(front[lo])), (int(way[hi - 1]), int(front[hi - 1]))
            if key == hot:  # such a block comes alone, as its size is above the bound by now
                yield deferred(way[lo:hi], value[lo:hi])
                continue
            run = hi - lo if key == end else hi - int(starts[-1])
            n_open = n_open + run if end == last and key == end else run
            held.append((way[lo:hi], front[lo:hi], value[lo:hi]))
            n_held, last = n_held + hi - lo, end
            if n_open > HOT and not last_level:
                yield from flush(n_open)
                yield deferred(held[0][0], held[0][2])
                held, n_held, n_open, hot = [], 0, HOT + 1, end
            elif n_held - n_open >= RANGE:
                yield from flush(n_open)
    yield from flush(0)


def links(distinct_prints: DataFrame, radius: int = 2) -> DataFrame:
    """Forest edges ``(a, b)`` among distinct fingerprints ``fp`` (bigint) at ``radius`` or fewer bits."""
    if not 0 <= radius <= 7:
        raise ValueError("radius must be 0 to 7: front blocks of less than eight bits would part nothing")
    spark = distinct_prints.sparkSession
    ways, rows, found, level = arrangements(radius), distinct_prints.select("fp", F.lit(0).alias("kind")), [], 0
    while True:
        # a block is put off as long as it has bits enough to be parted again
        last_level = min(front for _, front in ways) > 64 - 17
        out = materialize(spark, _level(rows, radius, ways, last_level), "links")
        found.append(out.where("kind = 0").select("a", "b"))
        later = out.where("kind > 0")
        if last_level or later.isEmpty():
            break
        rows, before = later.select(F.col("a").alias("fp"), "kind"), ways
        ways = [w for pieces, front in before for w in arrangements(radius, pieces, front)]
        level += 1
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionAll(more)
    return edges.distinct()


def _level(rows: DataFrame, radius: int, ways: list[tuple], last_level: bool) -> DataFrame:
    """One round over ``(fp, kind)``: kind 0 takes all ways, kind 1 + k the ``radius`` + 1 ways made of way k."""
    spark = rows.sparkSession
    own = lambda k: F.lit(True) if len(ways) == radius + 1 else F.col("kind") == 1 + k // (radius + 1)
    made = []
    for k, (pieces, front) in enumerate(ways):
        value = arranged(pieces)
        made.append(F.when(own(k), F.struct(F.lit(k).alias("way"), F.shiftrightunsigned(value, 64 - front).alias("front"), value.alias("value"))))
    dealt = rows.select("fp", F.explode(F.array_compact(F.array(*made))).alias("r")).select("fp", "r.*")
    split = None
    if not last_level:
        sampled = dealt.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLE)) == 0).groupBy("way", "front").agg(F.count("*").alias("n")).where(F.col("n") * SAMPLE > 2 * HOT)
        hot = materialize(spark, sampled.select("way", "front"), "hot")
        if not hot.isEmpty():
            split = dealt.join(hot, ["way", "front"], "left_semi").select((F.col("way") + 1).alias("kind"), F.col("fp").alias("a"), F.lit(0).cast("bigint").alias("b"))
            dealt = dealt.join(hot, ["way", "front"], "left_anti")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() * (radius + 1) // TASK))
    # ranks are compared as unsigned numbers
    ranked = dealt.select("way", "front", gray_column(F.col("value")).bitwiseXOR(F.lit(-(1 << 63))).alias("rank"), "value")
    ranked = ranked.withColumn("place", gray_column(F.col("front"))).repartitionByRange(parts, "way", "place").sortWithinPartitions("way", "rank").drop("place")
    out = ranked.mapInArrow(partial(_links, radius=radius, ways=ways, last_level=last_level), "kind int, a bigint, b bigint")
    return out if split is None else out.unionByName(split.withColumn("kind", F.col("kind").cast("int")))


def near_duplicates(spark: SparkSession, docs: DataFrame, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)``: one row for each row of ``docs``.

    component_id is the least doc_id that links of at most ``radius`` bits reach.
    """
    prints = materialize(spark, fingerprints(docs, id_col, text_col, width), "prints")
    least = materialize(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(spark, links(least.select("fp"), radius))
    linked = least.join(roots.withColumnRenamed("node", "fp"), "fp")
    named = linked.groupBy("root").agg(F.min("least").alias("least_of_all"))
    moved = linked.join(named, "root").select("fp", "least_of_all")
    labels = least.join(moved, "fp", "left").select("fp", F.coalesce("least_of_all", "least").alias("component_id"))
    labels = materialize(spark, labels, "labels")  # a plain scan on both sides lets Spark split a hot fingerprint's rows
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")
