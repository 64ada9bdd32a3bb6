"""SentencePiece encoding and decoding as weighted finite-state transducers.

Three machines are compiled from a model file and composed with each input:

* the normaliser N = R o W. R rewrites: user-defined pieces as they stand, then the longest key of the model's
  character map (its double array is the automaton), else the symbol itself. W sees to white space: it escapes it
  as U+2581, adds the dummy prefix and drops extra spaces, as the model asks for; its states are START, TEXT, GAP;
* the pieces P: an automaton over the symbols whose final states put out a piece at a weight;
* byte fallback B: a symbol that no piece holds puts out its UTF-8 bytes as byte pieces (or <unk>), at a weight
  beyond that of any piece.

The encoding is the path of least weight through N o (P + B)* o A in the tropical semiring (weights add along a
path, the least of all paths counts). Weights and A depend on the model:

* unigram: a piece weighs minus its score, and A lets everything pass;
* BPE: a piece weighs 0, and A is the bigram automaton: piece v after u weighs 0, or infinity where the
  merges of u and v, carried out by rank, would join the two across their border. (Merging is a regular relation:
  the sequences whose neighbours all allow each other are exactly the encodings, one for each prefix. So one
  finite path is left, a state of the lattice needs one live predecessor, and the least path is what the library's
  merging returns.)

Input is cut where a space follows another symbol, unless some piece spans such a border or some rule of N reads a
space: then each text is one word. Words are solved once while they are remembered; the arcs of A and R are
computed when a state is first met (lazy composition). Time and memory are linear in a word's length.

Defined cases: null text counts as empty; an empty text has no pieces; U+2581 in a text decodes as a
space, as in the library (``exact`` is false then); repeated rows each return a row; texts of any length
are handled whole; further columns are ignored.
"""

from __future__ import annotations

import struct
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, large_text

SPACE = "\u2581"
#: Piece types, model types, penalties and defaults of the public model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNK_PENALTY, USER_BONUS = 10.0, 0.1
#: Bytes of solved words, and pairs of the bigram automaton, that a worker remembers; longer words aren't kept.
MEMO_BYTES, MEMO_PAIRS, MEMO_WORD = 96 << 20, 400_000, 256
#: States of the white-space machine.
START, TEXT, GAP = 0, 1, 2
INFINITY = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields (number, value) of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            n, at = varint(at)
            value, at = data[at : at + n], at + n
        elif kind == 5:
            value, at = struct.unpack("<f", data[at : at + 4])[0], at + 4
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


class CharacterMap:
    """R's longest keys: a double array over UTF-8 bytes, walked as it lies in the model file."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = array("I", blob[4 : 4 + size])
        self.replaced = blob[4 + size :]
        root = self._offset(self.units[0])
        #: bytes that begin some key: all others pass at once
        self.begins = {c for c in range(1, 256) if (at := root ^ c) < len(self.units) and self.units[at] & 0x800000FF == c}
        self.keys_with_space = self._reads_space()

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _reads_space(self) -> bool:
        """Whether a key holds a plain space: the states are gone through level by level."""
        units, labels = np.array(self.units, np.int64), np.arange(1, 256)
        level = np.zeros(1, np.int64)
        while len(level):
            base = level ^ (units[level] >> 10) << ((units[level] & 0x200) >> 6)
            child = base[:, None] ^ labels
            child, label = child[child < len(units)], np.broadcast_to(labels, child.shape)[child < len(units)]
            there = units[child] & 0x800000FF == label
            if (label[there] == 32).any():
                return True
            level = child[there]
        return False

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """(end, replacement) of the longest key at ``start``."""
        units, found = self.units, None
        at = self._offset(units[0])
        for k in range(start, len(data)):
            at ^= data[k]
            if at >= len(units) or units[at] & 0x800000FF != data[k]:
                break
            unit = units[at]
            at ^= self._offset(unit)
            if unit >> 8 & 1:
                found = k + 1, units[at] & 0x7FFFFFFF
        if found is None:
            return None
        end, text = found
        return end, self.replaced[text : self.replaced.index(b"\0", text)]


class Automaton:
    """Pieces as states and arcs. A state is a list [arcs, piece, weight]: arcs map a symbol to the next state, and
    piece is what ends there (-1: nothing)."""

    def __init__(self, pieces: dict[str, int]):
        self.root: list = [{}, -1, INFINITY]
        for text, k in pieces.items():
            self.state(text)[1] = k

    def state(self, text: str) -> list:
        """The state that a text leads to, made where it isn't there yet."""
        at = self.root
        for c in text:
            to = at[0].get(c)
            if to is None:
                to = at[0][c] = [{}, -1, INFINITY]
            at = to
        return at

    def longest(self, text: str, start: int) -> int:
        """End of the longest piece at ``start``, or ``start``."""
        at, best = self.root, start
        for k in range(start, len(text)):
            at = at[0].get(text[k])
            if at is None:
                break
            if at[1] >= 0:
                best = k + 1
        return best


class Machine:
    """The compiled transducers of one model."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.model_type, self.byte_fallback, self.unk = UNIGRAM, False, 0
        self.dummy_prefix, self.remove_extra, self.escape, charsmap = True, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append(f.get(1, b"").decode())
                self.scores.append(f.get(2, 0.0))
                self.types.append(f.get(3, NORMAL))
            elif number == 2:
                f = dict(_fields(value))
                self.model_type, self.byte_fallback, self.unk = f.get(3, UNIGRAM), bool(f.get(35, 0)), f.get(40, 0)
            elif number == 3:
                f = dict(_fields(value))
                charsmap = f.get(2, b"")
                self.dummy_prefix, self.remove_extra, self.escape = bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))
        if self.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if not self.escape:
            raise ValueError("only models that escape white space are supported")
        kinds = list(enumerate(zip(self.pieces, self.types, strict=True)))
        self.text_of = {p: k for k, (p, t) in kinds if t in (NORMAL, USER_DEFINED)}
        self.byte_ids = {int(p[3:5], 16): k for k, (p, t) in kinds if t == BYTE}
        own = {p: k for k, (p, t) in kinds if t == USER_DEFINED}
        self.user = Automaton(own) if own else None
        self.map = CharacterMap(charsmap) if charsmap else None
        reads_space = any(" " in p or SPACE in p for p in own) or (self.map is not None and self.map.keys_with_space)
        self.cuts = not reads_space and not any(SPACE in p.lstrip(SPACE) for p in self.text_of)
        self.trie = Automaton(self.text_of)
        self._weigh()
        if self.model_type == BPE:
            self._compile_merges()
        self.words: tuple[dict, dict] = {}, {}  # by the state that W enters a word in: START, TEXT
        self.held = 0
        self.follows: dict[int, dict[int, bool]] = defaultdict(dict)
        self.n_follows = 0
        self.bytes_of = [self._piece_bytes(k) for k in range(len(self.pieces))]

    def _weigh(self) -> None:
        """Weights of the pieces, and of a symbol that falls back."""
        normal = [s for s, t in zip(self.scores, self.types, strict=True) if t == NORMAL] or [0.0]
        self.bad = 1.0 if self.model_type == BPE else UNK_PENALTY - min(normal)
        for piece, k in self.text_of.items():
            weight = 0.0 if self.model_type == BPE else -self.scores[k]
            if weight and self.types[k] == USER_DEFINED:  # these win over any cut into other pieces
                weight = USER_BONUS - len(piece.encode()) * max(normal)
            self.trie.state(piece)[2] = weight

    def _compile_merges(self) -> None:
        """Order of the merges, and how each piece is made: ``left`` and ``right`` of its last merge.

        A piece that merging by rank doesn't make from its own symbols can't occur; it leaves the automaton.
        """
        n = len(self.pieces)
        by_score = sorted(self.text_of.values(), key=lambda k: (-self.scores[k], k))
        self.rank = [-1] * n
        for r, k in enumerate(by_score):
            if len(self.pieces[k]) > 1:
                self.rank[k] = r
        self.left, self.right = [-1] * n, [-1] * n
        self.join: dict[int, int] = {}
        for piece, k in self.text_of.items():
            for cut in range(1, len(piece)):
                a, b = self.text_of.get(piece[:cut]), self.text_of.get(piece[cut:])
                if a is not None and b is not None:
                    self.join[a << 20 | b] = k
        for piece, k in self.text_of.items():
            if len(piece) == 1 or self.types[k] == USER_DEFINED:
                continue
            parts = [self.text_of.get(c, -1) for c in piece]
            last = None
            while len(parts) > 1:
                best = min(((self.rank[m], i, m) for i in range(len(parts) - 1) if (m := self.join.get(parts[i] << 20 | parts[i + 1])) is not None), default=None)
                if best is None:
                    break
                _, i, m = best
                last = parts[i], parts[i + 1]
                parts[i : i + 2] = [m]
            if len(parts) == 1:
                self.left[k], self.right[k] = last
            else:
                self.trie.state(piece)[1] = -1

    def may_follow(self, u: int, v: int) -> bool:
        """An arc of A: whether merging u + v leaves the two apart. Undo their merges from the last one backwards,
        and look whether what stands at the border would have merged before."""
        rank, left, right, join = self.rank, self.left, self.right, self.join
        limit = 1 << 60
        while True:
            m = join.get(u << 20 | v)
            if m is not None and rank[m] < limit:
                return False
            ru, rv = rank[u], rank[v]
            if ru < 0 and rv < 0:
                return True
            if ru > rv:
                limit, u = ru, right[u]
            else:  # of two equal merges the left one comes first, and the border is left of v's
                limit, v = rv + 1, left[v]

    def _fallback(self, symbol: str) -> list[int]:
        return [self.byte_ids[b] for b in symbol.encode()] if self.byte_fallback else [self.unk]

    def _arc(self, u: int, v: int) -> bool:
        """An arc of A that wasn't met before, remembered."""
        if self.n_follows >= MEMO_PAIRS:
            for known in self.follows.values():  # in place, as a sweep may hold one of them
                known.clear()
            self.n_follows = 0
        self.n_follows += 1
        ok = self.follows[u][v] = self.may_follow(u, v)
        return ok

    def shortest_path(self, symbols: str) -> list[int]:
        """Pieces of the least path through (P + B)* o A over the symbols: one sweep over the positions. Of two
        equal paths, the one with the longer last piece counts (the library's sums are rounded, so there ties may fall
        otherwise)."""
        n = len(symbols)
        long = n > MEMO_WORD
        dist = array("d", [INFINITY]) * (n + 1) if long else [INFINITY] * (n + 1)
        last = array("l", [-1]) * (n + 1) if long else [-1] * (n + 1)  # the piece a path ends with; -1: nothing, or fallback
        dist[0] = 0.0
        root, bad, bigrams, arc = self.trie.root[0], self.bad, self.model_type == BPE, self._arc
        nothing: dict[int, bool] = {}
        symbols_ = [*symbols, None]  # no state has an arc for the end
        for i in range(n):
            so_far = dist[i]
            if so_far == INFINITY:
                continue
            at = root.get(symbols_[i])
            j, u = i + 1, last[i]
            if (at is None or at[1] < 0) and so_far + bad < dist[j]:
                dist[j], last[j] = so_far + bad, -1
            follows = self.follows[u] if bigrams and u >= 0 else nothing
            while at is not None:
                v = at[1]
                if v >= 0 and so_far + at[2] < dist[j]:
                    ok = follows.get(v)
                    if ok is None:
                        ok = arc(u, v) if bigrams and u >= 0 else True
                    if ok:
                        dist[j], last[j] = so_far + at[2], v
                at = at[0].get(symbols_[j])
                j += 1
        out: list[int] = []
        j = n
        while j > 0:
            v = last[j]
            if v >= 0:
                out.append(v)
                j -= len(self.pieces[v])
            else:
                j -= 1
                out.extend(reversed(self._fallback(symbols[j])))
        out.reverse()
        return out

    def rewrite(self, word: str) -> str:
        """R: user-defined pieces as they are, then the longest key of the character map, else one symbol."""
        if self.map is None:
            return word
        out, i, data = [], 0, None
        begins = self.map.begins
        if self.user is None and not begins.intersection(data := word.encode()):
            return word
        data, at = word.encode() if data is None else data, 0
        while i < len(word):
            end = self.user.longest(word, i) if self.user else i
            if end > i:
                out.append(word[i:end])
                at += len(word[i:end].encode())
                i = end
                continue
            hit = self.map.longest(data, at) if data[at] in begins else None
            if hit is None:
                out.append(word[i])
                at += len(word[i].encode())
                i += 1
            else:
                out.append(hit[1].decode())
                i += len(data[at : hit[0]].decode())
                at = hit[0]
        return "".join(out)

    def white_space(self, word: str, state: int) -> tuple[str, int]:
        """W: (symbols, the state it ends in)."""
        if not word:
            return "", state
        if not self.remove_extra:
            # ending in a space, or in U+2581 itself, is another state: pieces of several spaces may begin there
            symbols = (SPACE if state == START and self.dummy_prefix else "") + word.replace(" ", SPACE)
            return symbols, GAP if symbols.endswith(SPACE) else TEXT
        out = []
        for c in word:
            if c == " ":
                state = state if state == START else GAP
            else:
                if state == GAP or state == START and self.dummy_prefix:
                    out.append(SPACE)
                out.append(c)
                state = TEXT
        if out and out[-1] == SPACE:  # U+2581 in the text itself
            state = GAP
        return "".join(out), state

    def _path(self, symbols: str) -> list[int]:
        """The least path; merging never joins a user-defined piece to what stands beside it."""
        if self.user is None or self.model_type != BPE:
            return self.shortest_path(symbols)
        out, i, held = [], 0, 0
        while i < len(symbols):
            end = self.user.longest(symbols, i)
            if end == i:
                i += 1
                continue
            out += self.shortest_path(symbols[held:i]) + [self.text_of[symbols[i:end]]]
            i = held = end
        return out + self.shortest_path(symbols[held:])

    def solve(self, word: str, state: int = START, odd: set | None = None) -> bytes:
        """Pieces, four bytes each, of one word that W enters in ``state``; ``odd`` takes the word if W doesn't leave
        it in TEXT."""
        got = self.words[state].get(word)
        if got is None:
            symbols, end = self.white_space(self.rewrite(word), state)
            got = array("i", self._path(symbols)).tobytes()
            if end != TEXT:
                if odd is not None:
                    odd.add((word, state))
            elif len(word) <= MEMO_WORD:
                size = 220 + 2 * len(word) + len(got)  # about what the dictionary, the word and the pieces take
                if self.held + size > MEMO_BYTES:
                    for known in self.words:
                        known.clear()
                    self.held = 0
                self.words[state][word] = got
                self.held += size
        return got

    def _words(self, texts: pa.Array, whole: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Words of the texts, on the texts' own bytes: (words, text of each, whether it begins its text). ``whole``
        texts aren't cut."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        starts, ends = offsets[:-1], offsets[1:]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        space = data[offsets[0] : offsets[-1]] == 32
        cut = np.flatnonzero(space[1:] & ~space[:-1]) + 1 + offsets[0]
        cut = cut[~whole[np.searchsorted(ends, cut, side="right")]]
        bounds = np.union1d(starts[ends > starts], cut)
        text = np.searchsorted(ends, bounds, side="right")
        words = pa.LargeStringArray.from_buffers(len(bounds), pa.py_buffer(np.append(bounds, offsets[-1]).astype(np.int64)), texts.buffers()[2])
        return words, text, bounds == starts[text]

    def encode(self, column: pa.Array) -> pa.Array:
        """Texts to lists of piece ids."""
        texts = large_text(column)
        whole = np.full(len(texts), not self.cuts)
        while True:
            words, text, first = self._words(texts, whole)
            coded = words.dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + first
            seen = np.zeros(2 * len(coded.dictionary), bool)
            seen[codes] = True
            used, codes = np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]
            told = coded.dictionary.take(pa.array(used >> 1)).to_pylist()
            solve, odd = self.solve, set()
            begins = (used & 1).tolist()
            paths = [solve(w, START if k else TEXT, odd) for w, k in zip(told, begins, strict=True)]
            if not odd:
                break
            # each word but a text's last must leave W where the next one begins: else its text is solved as one
            strange = np.array([(w, START if k else TEXT) in odd for w, k in zip(told, begins, strict=True)])
            goes_on = np.append(text[1:] == text[:-1], False)[: len(text)]
            again = np.unique(text[goes_on & strange[codes]])
            if not len(again):
                break
            whole[again] = True
        sizes = np.fromiter(map(len, paths), np.int64, len(paths)) // 4
        ids = np.frombuffer(b"".join(paths), np.int32)
        at = np.concatenate([[0], np.cumsum(sizes)])
        many = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(many)])
        spread = np.arange(total[-1]) - np.repeat(total[:-1] - at[codes], many) if len(codes) else np.zeros(0, np.int64)
        offsets = total[np.searchsorted(text, np.arange(len(texts) + 1))]
        return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids[spread], pa.int32()))

    def _piece_bytes(self, k: int) -> bytes:
        kind = self.types[k]
        if kind == BYTE:
            return bytes([int(self.pieces[k][3:5], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " \u2047 ".encode()
        return self.pieces[k].replace(SPACE, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """Piece ids to text: the inverse of P and B, then of N (bytes that aren't UTF-8 read as U+FFFD)."""
        of = self.bytes_of
        text = b"".join([of[k] for k in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") and self.types[ids[0]] != BYTE else text

    def decode_column(self, lists: pa.Array) -> pa.Array:
        """Lists of piece ids to texts, all at once."""
        pieces = pa.array(self.bytes_of, pa.large_binary())
        sizes = np.array([len(b) for b in self.bytes_of])
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        body = pieces.take(pa.array(ids))
        data = np.frombuffer(body.buffers()[2] or b"", np.uint8) if len(ids) else np.zeros(0, np.uint8)
        ends = np.concatenate([[0], np.cumsum(sizes[ids])])
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        cuts = ends[offsets]
        raw = data.tobytes()
        texts = []
        for k in range(len(lists)):
            text = raw[cuts[k] : cuts[k + 1]].decode("utf-8", "replace")
            if self.dummy_prefix and text.startswith(" ") and self.types[ids[offsets[k]]] != BYTE:
                text = text[1:]
            texts.append(text)
        return pa.array(texts, pa.large_string())


def zipf_unigram(data: bytes) -> bytes:
    """A unigram model with another model's pieces, scored by the rank they have there (minus its logarithm): for
    want of a public model of that kind."""

    def field(number: int, body: bytes | int) -> bytes:
        return varint(number << 3) + varint(body) if isinstance(body, int) else varint(number << 3 | 2) + varint(len(body)) + body

    def varint(n: int) -> bytes:
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    m = Machine(data)
    by_score = sorted(m.text_of.values(), key=lambda k: (-m.scores[k], k))
    rank = {k: r for r, k in enumerate(by_score)}
    out = b""
    for k, (piece, kind) in enumerate(zip(m.pieces, m.types, strict=True)):
        score = struct.pack("<f", -np.log(rank[k] + 2.0) if k in rank else 0.0)
        out += field(1, field(1, piece.encode()) + varint(2 << 3 | 5) + score + field(3, kind))
    out += field(2, field(3, UNIGRAM) + field(35, int(m.byte_fallback)) + field(40, m.unk))
    return out + field(3, field(3, int(m.dummy_prefix)) + field(4, int(m.remove_extra)) + field(5, 1))


@lru_cache(maxsize=2)
def machine(data: bytes) -> Machine:
    """The compiled machine of a model file's bytes; each worker compiles it once."""
    return Machine(data)


def _encode(batches: Iterator[pa.RecordBatch], shared, with_ids: bool) -> Iterator[pa.RecordBatch]:
    m = machine(shared.value)
    for part in chunks(batches):
        text = part.column(1)
        lists = m.encode(text)
        decoded = m.decode_column(lists)
        exact = pc.equal(decoded, large_text(text))
        count = pc.list_value_length(lists).cast(pa.int32())
        cols = [part.column(0), count, exact] + ([lists.cast(pa.list_(pa.int32()))] if with_ids else [])
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_pieces", "exact", "ids"][: len(cols)])


def encode_documents(docs: DataFrame, model: bytes, with_ids: bool = True) -> DataFrame:
    """``(doc_id, n_pieces, exact[, ids])``: the pieces of each whole text; ``exact``: they decode to it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one model file
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, n_pieces int, exact boolean" + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(partial(_encode, shared=shared, with_ids=with_ids), schema)


def _decode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    m = machine(shared.value)
    for batch in batches:
        lists = pc.if_else(pc.is_valid(batch.column(1)), batch.column(1), pa.scalar([], batch.column(1).type))
        yield pa.RecordBatch.from_arrays([batch.column(0), m.decode_column(lists).cast(pa.string())], ["doc_id", "text"])


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids decode to an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(partial(_decode, shared=shared), "doc_id bigint, text string")
