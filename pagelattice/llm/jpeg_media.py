"""Media columns: baseline JPEG, read down to its DC thumbnail, in numpy.

Reading: markers are parsed, the scan is split at its restart markers, and all restart intervals of all
images of a batch that share tables are Huffman-decoded side by side, one lane each, so that each numpy
call advances thousands of intervals by a symbol. AC coefficients are skipped over; the DC coefficients of
the luminance, dequantised, are the image at an eighth of its size. Kept are the dimensions, the thumbnail
and its hashes.

Storing a payload of bytes: each byte is one 8x8 block whose only coefficient is its DC (quantiser 8), so
the decoded samples of the block, and the thumbnail's pixel, are that byte: the payload is stored without
loss as 8-bit samples, 192 blocks to a row, a restart interval for each row, and a further image for
payloads over ``ROWS`` rows. The feature holds a thumbnail hash of every image, so all of a payload counts.

Baseline images may come in one interleaved scan or in several; the scan that begins with the first component, the
luminance, is decoded, and the others, which hold colour alone, are passed over.

Defined cases: null or broken media (not a JPEG, progressive, truncated) return a null thumbnail and a
reason; a null text counts as empty; repeated rows each return a row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

ACROSS = 192
ROWS = 8191
#: Luminance DC table of the JPEG standard's annex K.3: codes of each length, then the categories in order
#: (fixed values). The AC table has the end-of-block symbol alone.
DC_COUNTS = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0])
DC_VALUES = bytes(range(12))
AC_COUNTS, AC_VALUES = bytes([1] + [0] * 15), bytes([0])
EOB_BITS = 1


def huffman_codes(counts: bytes, values: bytes) -> list[tuple[int, int, int]]:
    """Canonical codes: (symbol, code, length)."""
    out, code, k = [], 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((values[k], code, length))
            code, k = code + 1, k + 1
        code <<= 1
    return out


def huffman_lut(counts: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length by the next 16 bits; length 0 where no code fits."""
    symbol, length = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
    for s, code, n in huffman_codes(counts, values):
        lo = code << (16 - n)
        symbol[lo : lo + (1 << (16 - n))], length[lo : lo + (1 << (16 - n))] = s, n
    return symbol, length


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _head(rows: int) -> bytes:
    return b"".join([
        b"\xff\xd8",
        _segment(0xDB, b"\x00" + bytes([8] + [1] * 63)),
        _segment(0xC0, struct.pack(">BHHB", 8, 8 * rows, 8 * ACROSS, 1) + b"\x01\x11\x00"),
        _segment(0xC4, b"\x00" + DC_COUNTS + DC_VALUES),
        _segment(0xC4, b"\x10" + AC_COUNTS + AC_VALUES),
        _segment(0xDD, struct.pack(">H", ACROSS)),
        _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
    ])


_CODE = np.zeros((12, 2), np.uint32)
for _s, _c, _n in huffman_codes(DC_COUNTS, DC_VALUES):
    _CODE[_s] = _c, _n
_CATEGORY = np.array([int(v).bit_length() for v in range(256)], np.uint32)
_WIDEST = 9 + 8 + EOB_BITS


def _pack_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Huffman-code each row of payload bytes: (bytes of all rows, byte count of each row), 1-padded, unstuffed."""
    level = rows.astype(np.int32) - 128
    diff = np.diff(level, axis=1, prepend=0)
    cat = _CATEGORY[np.abs(diff)]
    extra = np.where(diff < 0, diff + (1 << cat.astype(np.int32)) - 1, diff).astype(np.uint32)
    code = ((_CODE[cat, 0] << cat) | extra) << EOB_BITS  # the end-of-block code is 0
    size = _CODE[cat, 1] + cat + EOB_BITS
    pad = (-size.sum(axis=1, dtype=np.int64)) % 8
    # the last column takes the padding of the row's last byte
    code = np.concatenate([code, ((1 << pad) - 1).astype(np.uint32)[:, None]], axis=1)
    size = np.concatenate([size, pad.astype(np.uint32)[:, None]], axis=1)
    place = np.arange(_WIDEST - 1, -1, -1, dtype=np.uint32)
    bits = ((code.ravel()[:, None] >> place) & 1).astype(np.uint8)
    kept = place < size.ravel()[:, None]
    return np.packbits(bits[kept]), size.sum(axis=1, dtype=np.int64) // 8


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """Payloads (positive multiples of ``ACROSS`` bytes) as JPEG bytes."""
    if not payloads:
        return []
    rows = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, ACROSS)
    packed, sizes = [], []
    for lo in range(0, len(rows), 1024):
        p, s = _pack_rows(rows[lo : lo + 1024])
        packed.append(p)
        sizes.append(s)
    data, size = np.concatenate(packed), np.concatenate(sizes)
    # byte stuffing: a 0 after each 0xFF
    full = data == 0xFF
    at = np.arange(len(data)) + np.concatenate([[0], np.cumsum(full)[:-1]])
    stuffed = np.zeros(len(data) + int(full.sum()), np.uint8)
    stuffed[at] = data
    raw = stuffed.tobytes()
    cuts = np.cumsum(size)
    total = np.concatenate([[0], np.cumsum(full)])
    ends = [0, *(cuts + total[cuts]).tolist()]
    out, row = [], 0
    for p in payloads:
        left, images = len(p) // ACROSS, []
        while left:
            n = min(left, ROWS)
            parts = [_head(n)]
            for k in range(n):
                parts.append(raw[ends[row + k] : ends[row + k + 1]])
                parts.append(bytes((0xFF, 0xD0 + k % 8)) if k < n - 1 else b"\xff\xd9")
            images.append(b"".join(parts))
            row, left = row + n, left - n
        out.append(b"".join(images))
    return out


@dataclass
class Frame:
    width: int = 0
    height: int = 0
    components: list = field(default_factory=list)  # (id, h, v, quantiser)
    quantisers: dict = field(default_factory=dict)
    huffman: dict = field(default_factory=dict)  # class << 4 | id -> counts + values
    interval: int = 0
    scan: list = field(default_factory=list)  # (component's position, dc table, ac table)
    body: bytes = b""
    tables: tuple = ()


def parse(data: bytes) -> list[Frame]:
    """Baseline images of a stream (one after the other); ValueError on anything else."""
    frames, at = [], 0
    while at < len(data):
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError("no start of image")
        at, f = at + 2, Frame()
        while True:
            while data[at : at + 2] == b"\xff\xff":
                at += 1
            if at + 2 > len(data) or data[at] != 0xFF:
                raise ValueError("truncated")
            marker = data[at + 1]
            if marker == 0xD9:
                at += 2
                break
            if at + 4 > len(data):
                raise ValueError("truncated")
            (n,) = struct.unpack(">H", data[at + 2 : at + 4])
            body = data[at + 4 : at + 2 + n]
            if len(body) != n - 2:
                raise ValueError("truncated")
            at += 2 + n
            if marker == 0xDB:
                while body:
                    wide = 2 if body[0] >> 4 else 1
                    f.quantisers[body[0] & 15] = struct.unpack(">H", body[1:3])[0] if wide == 2 else body[1]
                    body = body[1 + 64 * wide :]
            elif marker == 0xC4:
                while body:
                    total = sum(body[1:17])
                    f.huffman[body[0]] = body[1 : 17 + total]
                    body = body[17 + total :]
            elif marker in (0xC0, 0xC1):
                depth, f.height, f.width, many = struct.unpack(">BHHB", body[:6])
                if depth != 8 or not f.width or not f.height:
                    raise ValueError("not a baseline frame")
                f.components = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(many)]
            elif 0xC2 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
                raise ValueError("not a baseline frame")
            elif marker == 0xDD:
                (f.interval,) = struct.unpack(">H", body[:2])
            elif marker == 0xDA:
                ids = [c[0] for c in f.components]
                if not ids or not 1 <= body[0] <= len(ids):
                    raise ValueError("a scan without its components")
                scan = [(ids.index(body[1 + 2 * k]), body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
                end = at
                while True:
                    end = data.find(b"\xff", end)
                    if end < 0 or end + 1 >= len(data):
                        raise ValueError("truncated")
                    if data[end + 1] == 0 or 0xD0 <= data[end + 1] <= 0xD7:
                        end += 2
                    else:
                        break
                if scan[0][0] == 0 and not f.scan:  # the scan that holds the luminance, with the tables as they are now
                    f.scan, f.body, f.tables = scan, data[at:end], (dict(f.huffman), f.interval)
                at = end
        if not f.scan:
            raise ValueError("no scan")
        f.huffman, f.interval = f.tables
        frames.append(f)
    if not frames:
        raise ValueError("no start of image")
    return frames


def _signature(f: Frame) -> tuple:
    return (f.width, tuple(f.components), tuple(f.scan), f.interval, tuple(sorted(f.huffman.items())), tuple(sorted(f.quantisers.items())))


def _layout(f: Frame) -> tuple[list, int, int, int, int]:
    """Blocks of an MCU as (component, dc, ac), MCUs across and down, and luminance blocks of an MCU."""
    hmax, vmax = max(c[1] for c in f.components), max(c[2] for c in f.components)
    if len(f.scan) == 1:  # a scan of one component has one block to an MCU, and no more than the component needs
        comps = [(f.components[0], f.scan[0], 1, 1)]
        wide, high = -(-f.width * f.components[0][1] // hmax), -(-f.height * f.components[0][2] // vmax)
        across, down, h, v = -(-wide // 8), -(-high // 8), 1, 1
    else:
        comps = [(f.components[s[0]], s, f.components[s[0]][1], f.components[s[0]][2]) for s in f.scan]
        across, down = -(-f.width // (8 * hmax)), -(-f.height // (8 * vmax))
        h, v = f.components[0][1], f.components[0][2]
    blocks = [(s[0], s[1], s[2]) for _, s, ch, cv in comps for _ in range(ch * cv)]
    return blocks, across, down, h, v


def dc_planes(frames: list[Frame]) -> list[np.ndarray]:
    """Luminance thumbnails (uint8, one pixel for each 8x8 block) of frames with the same signature."""
    first = frames[0]
    blocks, across, _, h, v = _layout(first)
    marks = [0xD0 + k for k in range(8)]
    bodies = np.frombuffer(b"".join(f.body + b"\xff\xd9" for f in frames), np.uint8)
    pair = (bodies[:-1] == 0xFF) & (bodies[1:] != 0)
    marker = np.flatnonzero(pair & (np.isin(bodies[1:], marks) | (bodies[1:] == 0xD9)))
    drop = np.zeros(len(bodies), bool)
    drop[1:] = (bodies[:-1] == 0xFF) & (bodies[1:] == 0)
    drop[marker] = True
    drop[marker + 1] = True
    kept = np.concatenate([[0], np.cumsum(~drop)])
    data = np.concatenate([bodies[~drop], np.zeros(8, np.uint8)]).astype(np.uint32)
    word = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    ends = kept[marker]
    starts = np.concatenate([[0], ends[:-1]])
    # the intervals of each frame, and how many MCUs each has
    mcus = np.array([across * _layout(f)[2] for f in frames])
    step = np.where(first.interval > 0, first.interval, mcus)
    lanes_of = -(-mcus // step)
    if lanes_of.sum() != len(starts):
        raise ValueError("restart markers are missing")
    last = np.cumsum(lanes_of) - 1
    todo = np.repeat(step, lanes_of)
    todo[last] = mcus - (lanes_of - 1) * step
    luts = {(kind, t): huffman_lut(first.huffman[kind << 4 | t][:16], first.huffman[kind << 4 | t][16:]) for _, d, a in blocks for kind, t in ((0, d), (1, a))}
    position = starts.astype(np.int64) * 8
    limit = ends.astype(np.int64) * 8
    predicted = np.zeros((max(c for c, _, _ in blocks) + 1, len(starts)), np.int32)
    luma = sum(c == blocks[0][0] for c, _, _ in blocks)
    levels = np.zeros((len(starts), int(todo.max()), luma), np.int32)

    def peek(at: np.ndarray) -> np.ndarray:
        return (word[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(16)

    for m in range(int(todo.max())):
        lane = slice(None) if m < todo.min() else np.flatnonzero(todo > m)
        at = position[lane]
        seen = 0
        for comp, dc, ac in blocks:
            symbol, length = luts[0, dc]
            bits = peek(at)
            size, n = symbol[bits], length[bits]
            if (n == 0).any() or (at + n + size > limit[lane]).any():
                raise ValueError("broken scan")
            at = at + n
            value = (peek(at) >> (16 - size).astype(np.uint32)).astype(np.int32)
            value = np.where((size > 0) & (value < (1 << np.maximum(size - 1, 0))), value - (1 << size) + 1, value)
            at = at + size
            predicted[comp, lane] += np.where(size > 0, value, 0)
            if comp == blocks[0][0]:
                levels[lane, m, seen] = predicted[comp, lane]
                seen += 1
            symbol, length = luts[1, ac]
            k = np.ones(len(at), np.int32)
            going = np.arange(len(at))
            while len(going):
                bits = peek(at[going])
                s, n = symbol[bits], length[bits]
                if (n == 0).any():
                    raise ValueError("broken scan")
                at[going] += n + (s & 15)
                k[going] += (s >> 4) + 1
                going = going[(s != 0) & (k[going] < 64)]
            if (at > limit[lane]).any():
                raise ValueError("broken scan")
        position[lane] = at
    quant = first.quantisers[first.components[blocks[0][0]][3]]
    pixels = np.clip(np.floor(levels * quant / 8 + 128.5), 0, 255).astype(np.uint8)
    out, lane = [], 0
    for f, n, total in zip(frames, lanes_of, mcus, strict=True):
        flat = np.concatenate([pixels[lane + k, : todo[lane + k]] for k in range(n)]) if n > 1 and todo[lane] != todo[lane + n - 1] else pixels[lane : lane + n].reshape(-1, luma)[:total]
        down = total // across
        plane = flat.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
        hmax, vmax = max(c[1] for c in f.components), max(c[2] for c in f.components)
        own = f.components[0]
        tall = -(-f.height * own[2] // (8 * vmax)) if len(f.scan) > 1 else plane.shape[0]
        wide = -(-f.width * own[1] // (8 * hmax)) if len(f.scan) > 1 else plane.shape[1]
        out.append(plane[:tall, :wide])
        lane += n
    return out


def thumbnails(media: list[bytes | None]) -> list[tuple]:
    """For each stream: (width, height, images, thumbnails as one uint8 array each, reason); None where broken."""
    parsed, groups, out = [], {}, [None] * len(media)
    for k, data in enumerate(media):
        try:
            frames = parse(data or b"")
        except (ValueError, IndexError, struct.error) as e:
            out[k] = (None, None, None, None, str(e))
            parsed.append(None)
            continue
        parsed.append(frames)
        for j, f in enumerate(frames):
            groups.setdefault(_signature(f), []).append((k, j))
    planes: dict = {}
    for where in groups.values():
        try:
            got = dc_planes([parsed[k][j] for k, j in where])
        except (ValueError, KeyError, IndexError):  # one is broken: each by itself
            got = []
            for k, j in where:
                try:
                    got += dc_planes([parsed[k][j]])
                except (ValueError, KeyError, IndexError) as e:
                    got.append(str(e) or "broken scan")
        planes.update(zip(where, got, strict=True))
    for k, frames in enumerate(parsed):
        if frames is None:
            continue
        own = [planes[k, j] for j in range(len(frames))]
        bad = next((p for p in own if isinstance(p, str)), None)
        out[k] = (None, None, None, None, bad) if bad else (frames[0].width, sum(f.height for f in frames), len(frames), own, None)
    return out


def difference_hash(plane: np.ndarray) -> str:
    """64-bit difference hash of a thumbnail shrunk to 8 x 9 by area."""
    rows = np.linspace(0, plane.shape[0], 9).astype(int)
    cols = np.linspace(0, plane.shape[1], 10).astype(int)
    total = np.zeros((plane.shape[0] + 1, plane.shape[1] + 1), np.int64)
    total[1:, 1:] = plane.astype(np.int64).cumsum(axis=0).cumsum(axis=1)
    lo, hi = np.minimum(rows[:-1], plane.shape[0] - 1), np.maximum(rows[1:], np.minimum(rows[:-1], plane.shape[0] - 1) + 1)
    left, right = np.minimum(cols[:-1], plane.shape[1] - 1), np.maximum(cols[1:], np.minimum(cols[:-1], plane.shape[1] - 1) + 1)
    area = (hi - lo)[:, None] * (right - left)[None, :]
    mean = (total[hi][:, right] - total[lo][:, right] - total[hi][:, left] + total[lo][:, left]) / area
    return np.packbits(mean[:, 1:] > mean[:, :-1]).tobytes().hex()


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        texts = [t or b"" for t in part.column(1).cast(pa.large_binary()).to_pylist()]
        payloads = [t + b" " * (-len(t) % ACROSS or (ACROSS if not t else 0)) for t in texts]
        cols = [part.column(0), pa.array(map(len, texts), pa.int64()), pa.array(encode_payloads(payloads), pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "media"])


def store_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, media)``: each whole text's UTF-8 bytes, padded with spaces, as JPEG."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_store, "doc_id bigint, n_bytes bigint, media binary")


_READ = (
    "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, "
    "media_sha256 string, feature string, width int, height int, reason string"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(c.split()[0] for c in _READ.split(", "))]
    types = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
    for part in chunks(batches, "media"):
        media = part.column(2).to_pylist()
        rows = []
        for doc, n, data, (width, height, images, planes, reason) in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), media, thumbnails(media), strict=True):
            stored = (len(data), hashlib.sha256(data).hexdigest()) if data is not None else (None, None)
            if reason is not None:
                rows.append((doc, n, None, None, None, *stored, None, None, None, reason))
                continue
            payload = b"".join(p.tobytes() for p in planes)
            mean = sum(int(p.sum(dtype=np.int64)) for p in planes) // len(payload)
            feature = f"{width}x{height}/{images} " + "".join(difference_hash(p) for p in planes) + f" {mean}"
            rows.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), *stored, feature, width, height, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read_media(media: DataFrame) -> DataFrame:
    """Dimensions, digests and thumbnail hashes from ``(doc_id, n_bytes, media)``; the payload is what the
    thumbnails hold."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_read, "doc_id bigint, " + _READ)


def store_and_read(docs: DataFrame) -> DataFrame:
    """``read_media`` of ``store_texts`` in one Python step: the images of a few MB of texts are read where they were
    made, instead of going through the JVM, which would gather thousands of them for a second worker of each task."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _read(_store(batches)), "doc_id bigint, " + _READ)
