"""Benchmark decontamination by latent semantic retrieval.

1. One pass counts in how many documents each hashed word occurs (all documents; the table has ``BUCKETS``
   rows whatever the input, so rare words that fall into one bucket share a count).
2. A distributed randomised SVD finds the latent directions of TF-IDF passages: all passages of all documents, and the
   benchmark items, weighted by ``ITEM_WEIGHT`` for every ``BALANCE`` passages, so that a large corpus doesn't drown
   them. Its vocabulary are the words of the items and the ``max_features`` words that occur in most documents. One
   pass reads every text and sums A^T A over the tasks, by bands of its upper triangle; a passage adds the pairs of its
   words, so that costs less than one product A^T(A Q). The subspace iteration runs on the sum, in a task; only the
   directions return. As many are kept as explain ``explained`` of the items, at most ``max_rank``.
3. Every whole text is cut into cells of ``CELL`` words, folded into the latent space (a passage times the directions,
   over the singular values). Sums of cells are windows of one to two and a half times an item's length, so placed
   that any stretch as long as the item lies in one; items of similar length share their windows. The cosine of each
   window with each item is taken in the latent space alone, and pairs from ``min_cosine`` on are candidates, whatever
   words they share.
4. Each candidate pair is checked: the longest common subsequence of words must hold ``verbatim`` of the
   item's words, or ``paraphrase`` of them with the answer's words present. Without an answer column the
   three rarest words of the item stand for its answer; two thirds of them must be in the window.

The benchmark is the query set; it is taken in blocks of ``block_items``, each with directions of its own and all
sought in one pass over the documents (``BLOCKS`` at a time, whose indexes have a size fixed by the bounds).

Defined cases: null or empty text holds nothing; null items and items without words match nothing; repeated items
each match; repeated rows each return a row; texts and items of any length are taken whole; further columns are
ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, drop_codes, hash_words, one_thread, settle, words_of

BUCKETS = 1 << 18
#: Words of a passage, weight of items, passages it holds for (beyond, it grows by the root of their number).
PASSAGE, ITEM_WEIGHT, BALANCE = 40, 4.0, 10_000
#: Passages that are multiplied at a time, and those whose pairs are added at a time, so that they stay in the cache.
ROWS, PAIR_ROWS = 32, 2048
#: Cells of a band of A^T A, in which its parts are shuffled; tasks for each core in which the bands are summed.
BAND, TASKS = 1 << 16, 4
#: Words of a cell; cells between windows, which are three times as long (each divides the last one that is below 48).
CELL, STRIDES, WHOLE = 4, (2, 3, 4, 6, 8, 12, 24), 24
#: Cells that are folded in at a time, so that their sums stay in the cache; text bytes of a search; blocks of items in
#: one pass.
CELLS, SEARCH_BYTES, BLOCKS = 24 * 100, 4 << 20, 4
_EDGE = string.punctuation + "…«»„“”‘’¿¡"


@dataclass
class Block:
    item_ids: list
    tokens: list  # lists of words of each item
    coded: list  # the same as features
    where: list  # places of the features in each
    answers: list  # sets of words
    feature: np.ndarray  # bucket -> feature; the number of features where there is none
    load: np.ndarray  # features and a row of zeros x rank and one: what a word adds to a window, and whether any item has it
    latent: np.ndarray  # items x rank, of unit length
    share: np.ndarray  # features x items: how often the item has the word
    size: np.ndarray  # by item: its words
    classes: list  # (stride in cells, positions of the items whose windows these are)


def tokens(text: str | None) -> list[str]:
    """Words of one text: lower-cased, split at white space, punctuation stripped at both ends."""
    return [w for w in (x.strip(_EDGE) for x in (text or "").lower().split()) if w]


def buckets(words: pa.Array) -> np.ndarray:
    return (hash_words(words) & np.uint64(BUCKETS - 1)).astype(np.int64)


def bucket(word: str) -> int:
    return int(buckets(pa.array([word], pa.large_string()))[0])


def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Texts to (codes, ends, words by code, buckets by code); words that are all punctuation are left out."""
    codes, vocabulary, ends = words_of(column)
    words = pc.utf8_trim(vocabulary, characters=_EDGE)
    codes, ends = drop_codes(codes, ends, pc.not_equal(words, "").to_numpy(zero_copy_only=False))
    return codes, ends, words, buckets(words)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(BUCKETS, np.int64)
    docs = 0
    for part in chunks(batches):
        codes, ends, _, own = encode(part.column(0))
        starts = np.concatenate([[0], ends[:-1]])
        met = np.sort(np.repeat(np.arange(len(ends)), ends - starts) * BUCKETS + own[codes])
        met = met[np.concatenate([[True], met[1:] != met[:-1]])] if len(met) else met
        seen += np.bincount(met & (BUCKETS - 1), minlength=BUCKETS)
        docs += len(ends)
    if docs:
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(seen[used], docs))], ["bucket", "n"])


def document_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, over all documents, and how many there are."""
    rows = docs.select("text").mapInArrow(_count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS, np.int64)
    words = rows[rows["bucket"] >= 0]
    counts[words["bucket"].to_numpy()] = words["n"].to_numpy()
    return counts, int(rows.loc[rows["bucket"] < 0, "n"].sum())


def _passages(codes: np.ndarray, ends: np.ndarray, feature: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """TF-IDF entries (row, column, value) of all passages of texts, rows ascending, and the number of passages. Rows have
    unit length at most, words without a feature counting towards it."""
    starts = np.concatenate([[0], ends[:-1]])
    many = -(-(ends - starts) // PASSAGE)
    first = np.cumsum(many) - many
    doc = np.repeat(np.arange(len(ends)), ends - starts)
    row = first[doc] + (np.arange(len(codes)) - starts[doc]) // PASSAGE
    n = int(many.sum())
    weight = idf[codes]
    length = np.sqrt(np.bincount(row, weights=weight**2, minlength=n))
    good = feature[codes] >= 0
    return row[good], feature[codes][good], (weight / np.maximum(length[row], 1e-9))[good], n


def _times(entries: tuple, q: np.ndarray) -> np.ndarray:
    """A^T (A q) for a sparse A given by its entries, rows ascending: some rows at a time, as a dense matrix of the
    columns that they have."""
    row, col, val, _ = entries
    out = np.zeros_like(q)
    lo = 0
    while lo < len(row):
        hi = int(np.searchsorted(row, row[lo] + ROWS))
        own, at = np.unique(col[lo:hi], return_inverse=True)
        part = np.bincount((row[lo:hi] - row[lo]) * len(own) + at, weights=val[lo:hi], minlength=ROWS * len(own))
        part = part.reshape(ROWS, len(own)).astype(np.float32)
        out[own] += part.T @ (part @ q[own])
        lo = hi
    return out


def _triangle(n: int) -> np.ndarray:
    """Where column zero of each row would stand in the upper triangle of an n x n matrix, kept row by row."""
    row = np.arange(n)
    return row * (2 * n - row - 1) // 2


def _add_pairs(entries: tuple, half: np.ndarray, start: np.ndarray) -> None:
    """Add A^T A, for a sparse A given by its entries, to ``half``: its upper triangle with half of the diagonal, in
    places by ``start``. Rows of many entries come first, so the k-th entries are those of the first rows."""
    row, col, val, _ = entries
    if not len(row):
        return
    order = np.argsort(row * len(start) + col)
    row, col, val = row[order], col[order], val[order]
    np.add.at(half, start[col] + col, val**2 / 2)
    heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.append(heads, len(row)))
    by = np.argsort(-size, kind="stable")
    heads, size = heads[by], size[by]
    for lo in range(0, len(heads), PAIR_ROWS):
        head, less = heads[lo : lo + PAIR_ROWS], -size[lo : lo + PAIR_ROWS]
        many = np.searchsorted(less, -np.arange(-less[0]))  # rows that have more than k entries
        c, v = np.zeros((len(many), len(head)), np.int64), np.zeros((len(many), len(head)))
        for k, m in enumerate(many):
            c[k, :m], v[k, :m] = col[head[:m] + k], val[head[:m] + k]
        at = start[c]
        for k, m in enumerate(many[1:], 1):  # each entry with those before it; columns rise within a row
            np.add.at(half, (at[:k, :m] + c[k, :m]).ravel(), (v[:k, :m] * v[k, :m]).ravel())


def _bands(half: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """The bands that aren't all zero, and the first one, which carries the number of passages."""
    for k in range(0, len(half), BAND):
        part = half[k : k + BAND]
        if k == 0 or part.any():
            yield _band(k // BAND, part, 0 if k else n)


def _band(band: int, part: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([band], pa.int64()), pa.array([part.astype(np.float32).tobytes()], pa.binary()), pa.array([n], pa.int64())], ["band", "part", "n"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each band's parts and numbers."""
    total: dict = {}
    for batch in batches:
        for band, part, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            own = np.frombuffer(part.as_buffer(), np.float32)
            held, many = total.get(band, (0.0, 0))
            total[band] = held + own.astype(np.float64), many + n
    for band, (part, n) in total.items():
        yield _band(band, part, n)


def _iterated(times: Callable[[np.ndarray], np.ndarray], n_features: int, rank: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and singular values by subspace iteration from a random start; ``times``: A^T A by a matrix."""
    wide = min(n_features, rank + 16)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_features, wide)))[0].astype(np.float32)
    z = last = q
    for _ in range(rounds):
        z = times(q)
        last, q = q, np.linalg.qr(z)[0].astype(np.float32)
    # Rayleigh-Ritz in the last space but one, for which A^T A Q is known
    values, turn = np.linalg.eigh((last.T @ z).astype(np.float64))
    best = np.argsort(-values)[:rank]
    return (last @ turn[:, best]).astype(np.float32), np.sqrt(np.maximum(values[best], 1e-9))


def randomised_svd(spark: SparkSession, docs: DataFrame, extra: tuple, feature: np.ndarray, idf: np.ndarray, n_features: int, rank: int, rounds: int = 3, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Latent directions (n_features x rank) and singular values of the passages of ``docs`` and the entries in
    ``extra`` (from ``BALANCE`` passages on, these keep their share); ``feature``: bucket to feature, -1: none.

    The texts are read once, whatever the rounds: one job sums A^T A over the tasks and iterates on the sum.
    """
    rank = min(rank, n_features)
    cores = spark.sparkContext.defaultParallelism
    # a task goes through several partitions, so the parts that are shuffled grow with the cores, not with the input
    texts = docs.select("text").coalesce(cores)
    # in the sum, features of the commonest words come first: the cells that are added to most lie together
    known = feature >= 0
    light = np.zeros(n_features)
    light[feature[known]] = idf[known]
    order = np.argsort(light, kind="stable")
    place = np.argsort(order)
    # sizes are fixed by the bounds on features and items
    shared = spark.sparkContext.broadcast((np.where(known, place[feature], -1).astype(np.int32), idf, extra, order, place))
    cells = n_features * (n_features + 1) // 2

    def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
        feature, idf = shared.value[:2]
        half, start, n = None, _triangle(n_features), 0
        for part in chunks(batches):
            codes, ends, _, own = encode(part.column(0))
            entries = _passages(codes, ends, feature[own], idf[own])
            half, n = np.zeros(cells) if half is None else half, n + entries[3]
            _add_pairs(entries, half, start)
        if half is not None:
            yield from _bands(half, n)

    def solve(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
        one_thread()
        extra, order, place = shared.value[2:]
        half, n = np.zeros(cells, np.float32), 0
        for batch in batches:
            for band, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(part.as_buffer(), np.float32)
                half[band * BAND : band * BAND + len(own)] = own
            n += pc.sum(batch.column(2)).as_py() or 0
        whole = np.zeros((n_features, n_features), np.float32)
        for k, at in enumerate(_triangle(n_features)):
            whole[k, k:] = half[at + k : at + n_features]
        whole += whole.T
        held = np.float32(max(1, n / BALANCE))
        found = _iterated(lambda q: _times(extra, q) * held + (whole @ q[order])[place], n_features, rank, rounds, seed)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in found], ["directions", "sizes"])

    schema = "band bigint, part binary, n bigint"
    summed = texts.mapInArrow(run, schema).repartition(TASKS * cores, "band").mapInArrow(_added, schema)
    rows = summed.repartition(1).mapInArrow(solve, "directions binary, sizes binary").collect()
    shared.unpersist()
    for row in rows:
        return np.frombuffer(row["directions"], np.float32).reshape(n_features, -1), np.frombuffer(row["sizes"], np.float64)
    return _iterated(lambda q: _times(extra, q), n_features, rank, rounds, seed)  # no documents


def places(a: list) -> dict:
    """Where each word of a list stands, as bits."""
    where: dict = {}
    for k, w in enumerate(a):
        where[w] = where.get(w, 0) | (1 << k)
    return where


def lcs(a: list, b: list, where: dict | None = None) -> int:
    """Length of the longest common subsequence of two word lists (bit-parallel; ``where``: places(a))."""
    get = (places(a) if where is None else where).get
    v = full = (1 << len(a)) - 1
    for w in b:
        if m := get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def stride_of(words: int) -> int:
    """Cells between the windows of items of so many words: two strides hold any stretch of that length."""
    cells = -(-words // CELL) + 1
    need = -(-cells // 2)
    small = [s for s in STRIDES if s >= need]
    if small:
        return small[0]
    return WHOLE << (-(-need // WHOLE) - 1).bit_length()


def _sums(cells: np.ndarray, stride: int, made: dict) -> np.ndarray:
    """Sums of ``stride`` cells each, from those of its divisors."""
    if stride == 1:
        return cells
    if stride not in made:
        part = 3 if stride == 3 else 2
        below = _sums(cells, stride // part, made)
        made[stride] = sum((below[k::part] for k in range(1, part)), start=below[::part])
    return made[stride]


def _segments(starts: np.ndarray, ends: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, end): texts, those of more than ``CELLS`` cells in stretches that overlap."""
    size = max(CELLS * CELL, 4 * overlap)
    step = size - overlap
    many = np.maximum(1, -(-(ends - starts - overlap) // step))
    doc = np.repeat(np.arange(len(starts)), many)
    first = starts[doc] + step * (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many))
    return doc, first, np.minimum(first + size, ends[doc])


def _fold(block: Block, feature: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Latent sums of the cells of segments, each filled up to a multiple of ``WHOLE`` cells; and the first row of each."""
    rows = -(-(-(-(stop - first) // CELL)) // WHOLE) * WHOLE
    base = np.concatenate([[0], np.cumsum(rows)])
    own = np.repeat(np.arange(len(first)), rows)
    word = first[own] + CELL * (np.arange(base[-1]) - base[own])
    none, end = len(block.load) - 1, stop[own]
    cells, more = np.zeros((int(base[-1]), block.load.shape[1]), np.float32), np.empty((int(base[-1]), block.load.shape[1]), np.float32)
    for k in range(CELL):
        at = np.where(word + k < end, feature[np.minimum(word + k, len(feature) - 1)], none)
        np.take(block.load, at, axis=0, out=more, mode="clip")
        cells += more
    return cells, base


def candidates(block: Block, feature: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_cosine: float, least: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(item, document, first word, end, cosine) of the windows that reach ``min_cosine`` with an item and hold words of
    any items, ``least`` times as many as the item has; ``feature`` by word of all texts."""
    widest = max(s for s, _ in block.classes)
    doc, first, stop = _segments(starts, ends, 3 * widest * CELL)
    some = stop > first
    doc, first, stop = doc[some], first[some], stop[some]
    filled = np.cumsum(-(-(stop - first) // CELL))
    lo = 0
    while lo < len(first):  # as many segments as the cells allow
        hi = max(lo + 1, int(np.searchsorted(filled, (filled[lo - 1] if lo else 0) + CELLS, side="right")))
        cells, base = _fold(block, feature, first[lo:hi], stop[lo:hi])
        made: dict = {}
        words = stop[lo:hi] - first[lo:hi]
        for stride, own in block.classes:
            if stride <= WHOLE:
                sums, at = _sums(cells, stride, made), base // stride
            else:
                below, wide = _sums(cells, WHOLE, made), stride // WHOLE
                many = -(-np.diff(base) // stride)
                at = np.concatenate([[0], np.cumsum(many)])
                seg = np.repeat(np.arange(hi - lo), many)
                sums = np.add.reduceat(below, base[seg] // WHOLE + wide * (np.arange(at[-1]) - at[seg]), axis=0)
            window = sums.copy()
            window[:-1] += sums[1:]
            window[:-2] += sums[2:]
            last = at[1:] - 1  # windows that would reach into the next segment
            window[last] = sums[last]
            last = last[at[1:] - at[:-1] > 1]
            window[last - 1] = sums[last - 1] + sums[last]
            seg = np.repeat(np.arange(hi - lo), np.diff(at))
            number = np.arange(len(seg)) - at[seg]
            full = -(-words // (CELL * stride))
            # only windows that stand for themselves, and hold as many of the items' words as the checks ask for
            good = (window[:, -1] >= least * block.size[own].min()) & ((number == 0) | (number <= full[seg] - 3))
            seg, number, window = seg[good], number[good], window[good]
            known, window = window[:, -1], window[:, :-1]
            length = np.maximum(np.sqrt(np.einsum("ij,ij->i", window, window)), np.float32(1e-6))
            score = window @ block.latent[own].T
            row, col = np.nonzero(score >= (length * np.float32(min_cosine))[:, None])
            enough = known[row] >= least * block.size[own][col]
            row, col = row[enough], col[enough]
            if len(row):
                begin = first[lo + seg[row]] + number[row] * stride * CELL
                end = np.minimum(begin + 3 * stride * CELL, ends[doc[lo + seg[row]]])
                yield own[col], doc[lo + seg[row]], begin, end, score[row, col] / length[row]
        lo = hi


def search(block: Block, encoded: tuple, min_cosine: float, paraphrase: float, verbatim: float, answer_share: float) -> list[tuple]:
    """Matches (text's row, item's position, start word, lcs share, cosine) of one chunk of texts."""
    codes, ends, words, own = encoded
    if not len(codes):
        return []
    starts = np.concatenate([[0], ends[:-1]])
    feature = block.feature[own][codes]
    none = len(block.load) - 1
    best: dict = {}
    for item, doc, begin, end, cosine in candidates(block, feature, starts, ends, min_cosine, paraphrase):
        step = 1 << 14
        for lo in range(0, len(item), step):
            i, s, e = item[lo : lo + step], begin[lo : lo + step], end[lo : lo + step]
            size = e - s
            pair = np.repeat(np.arange(len(i)), size)
            f = feature[np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + s[pair]]
            # a common subsequence is no longer than what the item has of the window's words
            has = f < none
            pair, f = pair[has], f[has]
            has = block.share[f, i[pair]] > 0
            key = np.unique(pair[has] * none + f[has])
            shared = np.bincount(key // none, weights=block.share[key % none, i[key // none]], minlength=len(i))
            for k in np.flatnonzero(shared >= paraphrase * block.size[i]):
                q, d = int(i[k]), int(doc[lo + k])
                have = feature[s[k] : e[k]]
                have = have[have < none]
                if lcs(block.coded[q], have[block.share[have, q] > 0].tolist(), block.where[q]) < paraphrase * block.size[q]:
                    continue  # hashes agree at least where words do
                text = words.take(pa.array(codes[s[k] : e[k]])).to_pylist()
                share = lcs(block.tokens[q], text) / len(block.tokens[q])
                if share < paraphrase:
                    continue
                if share < verbatim and len(block.answers[q].intersection(text)) < answer_share * len(block.answers[q]):
                    continue
                found = (share, float(cosine[lo + k]), int(s[k] - starts[d]))
                if found > best.get((d, q), (0,)):
                    best[d, q] = found
    return [(d, q, start, share, near) for (d, q), (share, near, start) in best.items()]


def build_block(spark: SparkSession, items: list[tuple], counts: np.ndarray, n_docs: int, docs: DataFrame, max_features: int, max_rank: int, explained: float) -> Block | None:
    """``items``: (item_id, text, answer or None). None if no item has words."""
    toks = [tokens(text) for _, text, _ in items]
    kept = [k for k, t in enumerate(toks) if t]
    if not kept:
        return None
    toks = [toks[k] for k in kept]
    idf = np.log((1 + n_docs) / (1 + counts)) + 1
    coded = [[bucket(w) for w in t] for t in toks]
    own = {b for t in coded for b in t}
    common = np.lexsort((np.arange(BUCKETS), -counts))[:max_features]
    vocabulary = np.array(sorted(own.union(common[counts[common] > 0].tolist())))
    n = len(vocabulary)
    feature = np.full(BUCKETS, -1, np.int64)
    feature[vocabulary] = np.arange(n)
    light = idf.astype(np.float32)
    row = np.repeat(np.arange(len(toks)), [len(t) for t in toks])
    column = feature[np.concatenate([np.array(t) for t in coded])]
    length = np.sqrt(np.bincount(row, weights=idf[vocabulary[column]] ** 2))
    extra = (row, column, ITEM_WEIGHT * idf[vocabulary[column]] / length[row], len(toks))
    directions, values = randomised_svd(spark, docs, extra, feature.astype(np.int32), light, n, max_rank)
    plain = np.zeros((len(toks), n), np.float32)
    np.add.at(plain, (row, column), idf[vocabulary[column]])
    held = np.cumsum(((plain @ directions) ** 2).sum(axis=0)) / (plain**2).sum()
    rank = min(len(held), int(np.searchsorted(held, explained)) + 1)
    fold = directions[:, :rank] / values[:rank]
    latent = plain @ fold
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    load = np.zeros((n + 1, rank + 1), np.float32)
    load[:n, :rank] = idf[vocabulary][:, None] * fold
    load[feature[sorted(own)], rank] = 1
    share = np.zeros((n, len(toks)), np.int16)
    np.add.at(share, (column, row), 1)
    answers = []
    for k, t in zip(kept, toks, strict=True):
        answers.append(set(tokens(items[k][2])) or set(sorted(set(t), key=lambda w: (-idf[bucket(w)], w))[:3]))
    size = np.array([len(t) for t in toks])
    strides = np.array([stride_of(int(k)) for k in size])
    coded = [feature[t].tolist() for t in coded]
    return Block(
        [items[k][0] for k in kept], toks, coded, [places(c) for c in coded], answers, np.where(feature < 0, n, feature).astype(np.int32), load, latent.astype(np.float32), share, size,
        [(int(s), np.flatnonzero(strides == s)) for s in np.unique(strides)],
    )


def matches(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, answer_col: str | None = None, block_items: int = 240, max_features: int = 4096, max_rank: int = 224,
    explained: float = 0.95, min_cosine: float = 0.4, paraphrase: float = 0.5, verbatim: float = 0.8, answer_share: float = 0.6, drop: bool = False,
) -> DataFrame:
    """``(doc_id, item_id, start_word, lcs_share, cosine)``: one row for each document and item found in it.

    Repeated rows of a document return their rows again. ``drop``: instead the rows of ``docs``, with all their columns,
    that hold no item; they are judged where they are read, so nothing is joined or shuffled.
    """
    names = ["doc_id", "item_id", "start_word", "lcs_share", "cosine"]
    schema = ", ".join(f"`{n}` " + ("double" if n in ("lcs_share", "cosine") else "bigint") for n in names)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    queries = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer"))
    settle(spark)
    counts, n_docs = document_counts(rows)
    parts, blocks, items, left = [], [], [], docs if drop else rows

    def seek(blocks: list, left: DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast(blocks)  # bounded by BLOCKS, block_items, max_features and max_rank

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            one_thread()
            for part in chunks(batches, max_bytes=SEARCH_BYTES):
                encoded, found = encode(part.column("text")), []
                for block in shared.value:
                    found += [(d, block.item_ids[q], *more) for d, q, *more in search(block, encoded, min_cosine, paraphrase, verbatim, answer_share)]
                if drop:
                    clean = np.ones(part.num_rows, bool)
                    clean[[f[0] for f in found]] = False
                    yield part.filter(pa.array(clean))
                elif found:
                    cols = [part.column(0).take(pa.array([f[0] for f in found], pa.int64())), *(pa.array([f[k] for f in found], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.float64()), (4, pa.float64())))]
                    yield pa.RecordBatch.from_arrays(cols, names)

        return left.mapInArrow(run, docs.schema if drop else schema)

    def block_of(items: list) -> list:
        made = build_block(spark, items, counts, n_docs, rows, max_features, max_rank, explained)
        settle(spark)
        return [] if made is None else [made]

    for item in queries.toLocalIterator():  # the query set, a block at a time
        items.append((item["item_id"], item["text"], item["answer"]))
        if len(items) == block_items:
            blocks, items = blocks + block_of(items), []
            if len(blocks) == BLOCKS:
                parts, blocks = [*parts, seek(blocks, left)], []
                left = parts[-1] if drop else rows
    if items:
        blocks = blocks + block_of(items)
    if blocks:
        parts.append(seek(blocks, left))
    if drop:
        return parts[-1] if parts else docs
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
