"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word (lower-cased, punctuation stripped at both ends) and its four-letter beginning are hashed twice
each; a word's vector is the element-wise minimum of its two rows, as in a count-min sketch, next to that
of its beginning, so a clean word that shares one row with a toxic one isn't lifted by it. Filters one,
two and three words wide slide over the whole text, each keeps its largest answer, and a logistic layer
weighs these. Rows start from the evidence of their words in the training texts (a Wilson lower bound, so
a few chance meetings count nothing) and are then trained with the filters by Adam.

The labelled texts are parted in ``FOLDS``; each part calibrates the thresholds of a network that learnt from the others:
the one with the fewest errors, a false alarm counting as ``ALARM`` misses (clean texts outnumber toxic ones, and should
stay), and one of its own for each language, told apart by its function words in the text itself, that has ``ENOUGH``
toxic and clean texts in the part. Logits are shifted so that the threshold stands at ``CUT``, and a text's score is by
their mean over the networks.

Bounds: the model is fit on at most ``max_positive`` + ``max_negative`` labelled texts, whole ones of any length, taken
in the order of a hash of doc_id; executors encode them, and the driver holds four bytes a word. Scoring covers every
whole text.

Defined cases: null text counts as empty and gets the score of an empty text; a null label or doc_id
trains nothing; several labels of a doc_id count as the largest; without labelled rows of both kinds every
score is 0; repeated rows return a row each; further columns are ignored.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, drop_codes, materialize, one_thread, settle, words_of

CUT = 0.7
ROWS = 1 << 16
DIMS = 4
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Texts that a row must be met in to be trained without evidence of its own: words that tell something in company.
COMMON = 20
#: Shares that the training rows come to the driver in.
SHARES = 8
#: Parts of the labelled texts that calibrate in turn; errors that a false alarm weighs; texts of each kind for a
#: threshold of one's own.
FOLDS, ALARM, ENOUGH = 2, 4, 8
_EDGE = string.punctuation + "…«»„“”‘’¿¡"
#: Frequent function words by which a text's language is told (fixed values).
FUNCTION_WORDS = {
    "en": "the of and to in is that with for by was are this it on as at be or from".split(),
    "fr": "le la les des et est une dans pour que du au aux avec par sur pas elle vi ou".split(),
    "de": "der die das und ist nicht ein eine mit von zu den auf sich auch im dem für".split(),
    "es": "el los las que y una con por para del se no su lo como al un es".split(),
}
LANGS = [*FUNCTION_WORDS, "other"]


@dataclass
class Part:
    tables: np.ndarray  # (4, ROWS, DIMS): two for words, two for their beginnings
    filters: dict  # width -> (width, 2 * DIMS, FILTERS)
    bias: dict  # width -> (FILTERS,)
    out: np.ndarray  # (len(WIDTHS) * FILTERS,)
    out_bias: float
    shift: np.ndarray  # by LANGS
    trained: bool = True


@dataclass
class Model:
    """Networks that score by the mean of their calibrated logits; none where there was nothing to learn from."""

    parts: list[Part]

    @property
    def trained(self) -> bool:
        return bool(self.parts)


def _keys(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of each word in the four tables, its language (-1: none), and whether it has letters at all."""
    of = {w: k for k, lang in enumerate(LANGS[:-1]) for w in FUNCTION_WORDS[lang]}
    rows = np.empty((len(vocabulary), 4), np.int64)
    lang, keep = np.full(len(vocabulary), -1), np.zeros(len(vocabulary), bool)
    crc = zlib.crc32
    for k, word in enumerate(vocabulary):
        word = word.strip(_EDGE)
        a, b = word.encode(), b"^" + word[:4].encode()
        x, y = crc(a), crc(b)
        rows[k] = x, crc(a, 0x9E3779B9), y, crc(b, 0x9E3779B9)
        lang[k], keep[k] = of.get(word, -1), word != ""
    # crc32 of another start differs by a constant alone, so the second row mixes it
    mixed = (rows * np.array([1, 0x9E3779B1, 1, 0x85EBCA6B])) & 0xFFFFFFFF
    return (mixed >> 16) ^ (mixed & np.array([0xFFFF, 0x0, 0xFFFF, 0x0])), lang, keep


def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts to (codes, ends, rows by code, language of each text)."""
    codes, vocabulary, ends = words_of(column)
    rows, lang, keep = _keys(vocabulary.to_pylist())
    codes, ends = drop_codes(codes, ends, keep)
    starts = np.concatenate([[0], ends[:-1]])
    votes = np.zeros((len(ends), len(LANGS)), np.int64)
    for k in range(len(LANGS) - 1):
        total = np.concatenate([[0], np.cumsum(lang[codes] == k)]) if len(codes) else np.zeros(1, np.int64)
        votes[:, k] = total[ends] - total[starts]
    spoken = np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(LANGS) - 1) if len(ends) else np.zeros(0, np.int64)
    return codes, ends, rows, spoken


def vectors(model: Part, rows: np.ndarray) -> np.ndarray:
    t = model.tables
    return np.concatenate([np.minimum(t[0, rows[:, 0]], t[1, rows[:, 1]]), np.minimum(t[2, rows[:, 2]], t[3, rows[:, 3]])], axis=1)


def pooled(model: Part, codes: np.ndarray, ends: np.ndarray, rows: np.ndarray, at: bool = False):
    """Largest answer of each filter in each text, at least 0; with ``at`` also where it was (-1: nowhere)."""
    n = len(ends)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)
    x = vectors(model, rows)
    found, where = [], []
    for width in WIDTHS:
        parts = [(x @ model.filters[width][k])[codes] for k in range(width)]
        span = len(codes) - width + 1
        best = np.zeros((n, FILTERS), np.float32)
        spot = np.full((n, FILTERS), -1, np.int64)
        if span > 0:
            answer = sum(p[k : k + span] for k, p in enumerate(parts)) + model.bias[width]
            last = np.minimum(ends - width + 1, span)
            full = last > starts
            if full.any():
                # windows over the border of two texts mustn't count: reduce over [start, last) only
                cuts = np.stack([starts[full], last[full]], axis=1).ravel()
                padded = np.concatenate([answer, np.full((1, FILTERS), -np.inf, answer.dtype)])
                best[full] = np.maximum(np.maximum.reduceat(padded, cuts, axis=0)[::2], 0)
                if at:
                    for d in np.flatnonzero(full):
                        piece = answer[starts[d] : last[d]]
                        top = piece.argmax(axis=0)
                        spot[d] = np.where(piece[top, np.arange(FILTERS)] > 0, starts[d] + top, -1)
        found.append(best)
        where.append(spot)
    return (np.concatenate(found, axis=1), where) if at else np.concatenate(found, axis=1)


def _in_slices(model: Part, codes: np.ndarray, ends: np.ndarray, rows: np.ndarray, words: int = 1 << 17) -> np.ndarray:
    """Logits of all texts before the shift, holding about ``words`` words at a time."""
    out, lo = np.empty(len(ends)), 0
    while lo < len(ends):
        base = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + words, side="right")))
        out[lo:hi] = pooled(model, codes[base : ends[hi - 1]], ends[lo:hi] - base, rows) @ model.out + model.out_bias
        lo = hi
    return out


def logits(model: Model, column: pa.Array) -> np.ndarray:
    codes, ends, rows, spoken = encode(column)
    return np.mean([_in_slices(part, codes, ends, rows) + part.shift[spoken] for part in model.parts], axis=0)


def _wilson(pos: np.ndarray, n: np.ndarray, z: float) -> np.ndarray:
    n = np.maximum(n, 1e-9)
    p = pos / n
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def train(texts: list[str], labels: np.ndarray, seed: int = 7, epochs: int = 6, batch: int = 64, rate: float = 0.01, z: float = 3.0) -> Model:
    """A model of texts at hand; ``fit`` trains one from tables."""
    return train_encoded(*encode(pa.array(texts, pa.string())), labels, seed, epochs, batch, rate, z)


def train_encoded(
    codes: np.ndarray, ends: np.ndarray, rows: np.ndarray, spoken: np.ndarray, labels: np.ndarray,
    seed: int = 7, epochs: int = 6, batch: int = 64, rate: float = 0.01, z: float = 3.0,
) -> Model:
    """Train on texts as ``encode`` returns them: a model for each part, of the others, calibrated on that part."""
    y = np.asarray(labels, np.float32)
    fold = np.zeros(len(y), np.int64)
    fold[np.argsort(-y, kind="stable")] = np.arange(len(y)) % FOLDS  # both kinds are dealt out evenly
    parts, goal = [], np.log(CUT / (1 - CUT))
    for k in range(FOLDS):
        model = _fitted(*_only(codes, ends, fold != k), rows, y[fold != k], seed + k, epochs, batch, rate, z)
        if model.trained and 0 < y[fold == k].sum() < (fold == k).sum():
            raw, truth, tongue = _in_slices(model, *_only(codes, ends, fold == k), rows), y[fold == k], spoken[fold == k]
            everywhere = _threshold(raw, truth)
            for j in range(len(LANGS)):
                own = tongue == j
                enough = truth[own].sum() >= ENOUGH and (1 - truth[own]).sum() >= ENOUGH
                model.shift[j] = goal - (_threshold(raw[own], truth[own]) if enough else everywhere)
            parts.append(model)
    return Model(parts)


def _only(codes: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words and ends of some of the texts."""
    size = np.diff(np.concatenate([[0], ends]))
    return codes[np.repeat(kept, size)], np.cumsum(size[kept])


def _fitted(codes: np.ndarray, ends: np.ndarray, rows: np.ndarray, y: np.ndarray, seed: int, epochs: int, batch: int, rate: float, z: float) -> Part:
    """Tables, filters and weights by evidence and Adam, without thresholds."""
    rng = np.random.default_rng(seed)
    tables = np.zeros((4, ROWS, DIMS), np.float32)
    # the first filters begin as sums of evidence, the others at random, without a say until training gives them one
    led = np.arange(FILTERS) < FILTERS // 2
    filters = {w: np.where(led, rng.normal(0, 0.02, (w, 2 * DIMS, FILTERS)), rng.normal(0, 0.6, (w, 2 * DIMS, FILTERS))).astype(np.float32) for w in WIDTHS}
    bias = {w: np.where(led, -0.3, 0.0).astype(np.float32) for w in WIDTHS}
    out = np.tile(np.where(led, 0.25, 0.0), len(WIDTHS)).astype(np.float32)
    model = Part(tables, filters, bias, out, -2.0, np.zeros(len(LANGS), np.float32), trained=bool(len(y)) and 0 < y.sum() < len(y))
    if not model.trained:
        return model
    starts = np.concatenate([[0], ends[:-1]])
    prior = float(y.mean())
    # evidence: in how many texts, and in how many toxic ones, a row is met; languages apart, for each has its own words
    met_in = np.zeros((2, 4, ROWS))
    lo = 0
    while lo < len(ends):  # some texts at a time
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 17), side="right")))
        doc = np.repeat(np.arange(lo, hi), ends[lo:hi] - starts[lo:hi])
        for t in range(4):
            met = np.unique(doc * ROWS + rows[codes[starts[lo] : ends[hi - 1]], t])
            met_in[0, t] += np.bincount(met % ROWS, minlength=ROWS)
            met_in[1, t] += np.bincount(met % ROWS, weights=y[met // ROWS], minlength=ROWS)
        lo = hi
    for t in range(4):
        seen, toxic = met_in[:, t]
        low = np.clip(_wilson(toxic, seen, z), 1e-6, 1 - 1e-6)
        tables[t, :, 0] = np.maximum(0, np.log(low / (1 - low)) - np.log(prior / (1 - prior)))
        high = np.clip(1 - _wilson(seen - toxic, seen, z), 1e-6, 1 - 1e-6)
        tables[t, :, 1] = np.where(seen > 0, np.maximum(0, np.log(prior / (1 - prior)) - np.log(high / (1 - high))), 0)
        tables[t, :, 2:] = np.where(seen[:, None] >= COMMON, np.abs(rng.normal(0, 0.3, (ROWS, DIMS - 2))), 0)
    known = (tables[..., 0] + tables[..., 1] > 0) | (met_in[0] >= COMMON)
    for w in WIDTHS:
        filters[w][:, 0, led] += 0.6 / w
        filters[w][:, DIMS, led] += 0.3 / w
    params = [tables, out, *filters.values(), *bias.values()]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    mb = vb = 0.0
    weight = np.where(y > 0, 0.5 / prior, 0.5 / (1 - prior)).astype(np.float32)
    step = 0
    rates = [rate * 0.5] + [rate] * (len(params) - 1)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            ids = order[lo : lo + batch]
            span = np.concatenate([np.arange(starts[d], ends[d]) for d in ids]) if len(ids) else np.zeros(0, int)
            own, back = np.unique(codes[span], return_inverse=True)
            sub_ends = np.cumsum(ends[ids] - starts[ids])
            sub_rows = rows[own]
            hidden, where = pooled(model, back, sub_ends, sub_rows, at=True)
            score = hidden @ model.out + model.out_bias
            g = (1 / (1 + np.exp(-score)) - y[ids]) * weight[ids] / len(ids)
            x = vectors(model, sub_rows)
            grads = [np.zeros_like(p) for p in params[1:]]
            grads[0] += hidden.T @ g
            gx = np.zeros_like(x)
            for k, w in enumerate(WIDTHS):
                gh = g[:, None] * model.out[k * FILTERS : (k + 1) * FILTERS]
                d, f = np.nonzero(where[k] >= 0)
                spot, gg = where[k][d, f], gh[d, f]
                np.add.at(grads[1 + len(WIDTHS) + k], f, gg)
                for o in range(w):
                    word = back[spot + o]
                    np.add.at(grads[1 + k][o].T, f, gg[:, None] * x[word])
                    np.add.at(gx, word, gg[:, None] * filters[w][o][:, f].T)
            gt = np.zeros_like(tables)
            for half in (0, 1):
                a, b = sub_rows[:, 2 * half], sub_rows[:, 2 * half + 1]
                part = gx[:, half * DIMS : (half + 1) * DIMS]
                first = tables[2 * half, a] <= tables[2 * half + 1, b]
                np.add.at(gt[2 * half], a, np.where(first, part, 0))
                np.add.at(gt[2 * half + 1], b, np.where(first, 0, part))
            gt *= known[..., None]  # rows without evidence stay as they are
            step += 1
            for k, (p, gr) in enumerate(zip(params, [gt, *grads], strict=True)):
                m[k] += 0.1 * (gr - m[k])
                v[k] += 0.001 * (gr * gr - v[k])
                p -= rates[k] * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
            np.maximum(tables, 0, out=tables)
            gb = float(g.sum())
            mb, vb = mb + 0.1 * (gb - mb), vb + 0.001 * (gb * gb - vb)
            model.out_bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    return model


def _threshold(raw: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors, a false alarm counting as ``ALARM`` misses; in the middle of its gap."""
    order = np.argsort(raw, kind="stable")
    z, t = raw[order], y[order]
    missed = np.concatenate([[0], np.cumsum(t)])
    alarms = np.concatenate([np.cumsum((1 - t)[::-1])[::-1], [0]])
    cost = missed + ALARM * alarms
    good = np.flatnonzero(cost == cost.min())
    edges = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    gaps = edges[good + 1] - edges[good]
    k = good[int(np.argmax(gaps))]
    return float((edges[k] + edges[k + 1]) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, max_positive: int, max_negative: int) -> DataFrame:
    """Labelled texts that may be learnt from: crc32(doc_id) mod 3 is not 1; a bounded number, by hash order."""
    own = labels.where("doc_id is not null and toxic is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    own = own.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    # twice as many as wanted, for some of them may have no text here
    ids = [own.where(f"toxic = {k}").orderBy(order, "doc_id").limit(2 * n) for k, n in ((1, max_positive), (0, max_negative))]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.where("doc_id is not null").join(F.broadcast(ids[0].unionAll(ids[1])), "doc_id")  # at most 2 * (max_positive + max_negative) rows
    parts = [rows.where(f"toxic = {k}").orderBy(order, "doc_id", "text").limit(n) for k, n in ((1, max_positive), (0, max_negative))]
    return parts[0].unionAll(parts[1])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, toxic, text) to the texts' language and the four table rows of each word, eight bytes a word."""
    for part in chunks(batches):
        codes, ends, rows, spoken = encode(part.column(2))
        words = np.ascontiguousarray(rows.astype("<u2")).view("<u8").ravel()
        cut = [0, *ends.tolist()]
        own = [words[codes[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        names = ["doc_id", "toxic", "spoken", "words", "tie"]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(spoken, pa.int32()), pa.array(own, pa.binary()), part.column(3)], names)


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = 3000, max_negative: int = 5000, seed: int = 7) -> Model:
    rows = training_rows(docs, labels, max_positive, max_negative).select("doc_id", "toxic", "text", F.xxhash64("text").alias("tie"))
    packed = rows.mapInArrow(_packed, "doc_id bigint, toxic int, spoken int, words binary, tie bigint")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)).cast("int")
    packed = materialize(docs.sparkSession, packed.withColumn("share", share).repartition(SHARES, "share"), "training")
    settle(docs.sparkSession)

    def read(*columns: str) -> Iterator:
        """The rows, a share at a time, so that little of them is on the driver at once."""
        for k in range(SHARES):
            yield from packed.where(F.col("share") == k).select(*columns).toLocalIterator()

    # two passes, a partition at a time: the distinct words and the sizes, then each text as four bytes a word
    vocabulary, heads, fresh = np.zeros(0, np.uint64), [], []
    for r in read("doc_id", "tie", "toxic", "spoken", "words"):
        words = np.frombuffer(r["words"], "<u8")
        heads.append((r["doc_id"], r["tie"], r["toxic"], r["spoken"], len(words)))
        fresh.append(np.unique(words))
        if sum(map(len, fresh)) > 1 << 18:
            vocabulary, fresh = np.union1d(vocabulary, np.concatenate(fresh)), []
    vocabulary = np.union1d(vocabulary, np.concatenate([*fresh, np.zeros(0, np.uint64)]))
    order = sorted(range(len(heads)), key=lambda k: heads[k][:3])
    ends = np.cumsum([heads[k][4] for k in order], dtype=np.int64)
    marks, spoken = np.array([heads[k][2] for k in order], np.int64), np.array([heads[k][3] for k in order], np.int64)
    codes = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    place = {k: int(ends[j]) for j, k in enumerate(order)}
    for k, r in enumerate(read("words")):
        words = np.frombuffer(r["words"], "<u8")
        codes[place[k] - len(words) : place[k]] = np.searchsorted(vocabulary, words)
    of_word = vocabulary.astype("<u8").view("<u2").reshape(-1, 4).astype(np.int64)
    model = train_encoded(codes, ends, of_word, spoken, marks, seed)
    settle(docs.sparkSession)
    return model


def _scores(model: Model, column: pa.Array) -> np.ndarray:
    if not model.trained:
        return np.zeros(len(column))
    return 1 / (1 + np.exp(-np.clip(logits(model, column).astype(np.float64), -40, 40)))


def accepted(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below ``CUT``, with all their columns: rows are judged where they are read, so
    nothing is joined or shuffled."""
    shared = spark.sparkContext.broadcast(model)  # its size is fixed by ROWS, DIMS and FILTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        for part in chunks(batches):
            yield part.filter(pa.array(_scores(shared.value, part.column("text")) < CUT))

    return docs.mapInArrow(run, docs.schema)


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``."""
    shared = spark.sparkContext.broadcast(model)  # its size is fixed by ROWS, DIMS and FILTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        one_thread()
        for part in chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_scores(model, part.column(1)))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id bigint, score double")
    held = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 3 = 1"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
