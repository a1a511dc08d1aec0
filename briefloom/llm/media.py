"""Media columns: PNG images in binary columns, decoded and hashed in numpy."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIGNATURE = b"\x89PNG\r\n\x1a\n"
UNIT = 576
FILTERS = ("none", "sub", "up", "average", "paeth")


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(pixels: np.ndarray, row_filter: str = "none", level: int = 1, idat_bytes: int = 1 << 20) -> bytes:
    """An 8-bit grey PNG of a height x width array; its data in IDAT chunks of bounded size."""
    h, w = pixels.shape
    x = pixels.astype(np.uint8)
    left = np.zeros_like(x)
    left[:, 1:] = x[:, :-1]
    up = np.zeros_like(x)
    up[1:] = x[:-1]
    if row_filter == "sub":
        rows = x - left
    elif row_filter == "up":
        rows = x - up
    elif row_filter == "average":
        rows = x - ((left.astype(np.int32) + up) // 2).astype(np.uint8)
    elif row_filter == "paeth":
        corner = np.zeros_like(x)
        corner[1:, 1:] = x[:-1, :-1]
        rows = x - _paeth(left, up, corner)
    else:
        rows = x
    lines = np.empty((h, w + 1), np.uint8)
    lines[:, 0], lines[:, 1:] = FILTERS.index(row_filter), rows
    body = zlib.compress(lines.tobytes(), level)
    parts = [_chunk(b"IDAT", body[i : i + idat_bytes]) for i in range(0, len(body), idat_bytes)]
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + b"".join(parts) + _chunk(b"IEND", b"")


def _paeth(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    a, b, c = a.astype(np.int32), b.astype(np.int32), c.astype(np.int32)
    p = a + b - c
    pa_, pb, pc_ = abs(p - a), abs(p - b), abs(p - c)
    return np.where((pa_ <= pb) & (pa_ <= pc_), a, np.where(pb <= pc_, b, c)).astype(np.uint8)


def decode_png(data: bytes) -> np.ndarray:
    """The pixels of an 8-bit grey, not interlaced PNG.

    Each chunk's CRC is tested; zlib tests the Adler-32 of the image data.  A
    damaged or unsupported file raises ValueError.
    """
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, head, body, ended = 8, None, [], False
    while at + 12 <= len(data):
        (n,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        part, crc = data[at + 8 : at + 8 + n], data[at + 8 + n : at + 12 + n]
        if len(crc) < 4 or struct.unpack(">I", crc)[0] != zlib.crc32(kind + part):
            raise ValueError(f"checksum of chunk {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        elif kind == b"IEND":
            ended = True
            break
        at += 12 + n
    if head is None or not ended or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("missing chunk or unsupported kind of PNG")
    w, h = head[:2]
    try:
        raw = zlib.decompress(b"".join(body))
    except zlib.error as e:
        raise ValueError(str(e)) from e
    if len(raw) != h * (w + 1):
        raise ValueError("image data of another size")
    lines = np.frombuffer(raw, np.uint8).reshape(h, w + 1)
    return _unfilter(lines[:, 0], lines[:, 1:])


def _unfilter(kinds: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Undo the row filters: whole runs of rows at once for none, sub and up, by
    column for the others, whose bytes need the byte before them."""
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown row filter")
    h, w = lines.shape
    out = np.empty((h, w), np.uint8)
    cuts = np.flatnonzero(np.diff(kinds)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, h], strict=True):
        kind = kinds[lo] if h else 0
        above = out[lo - 1] if lo else np.zeros(w, np.uint8)
        if kind == 0:
            out[lo:hi] = lines[lo:hi]
        elif kind == 1:
            out[lo:hi] = np.cumsum(lines[lo:hi], axis=1, dtype=np.uint8)
        elif kind == 2:
            out[lo:hi] = np.cumsum(np.vstack([above[None], lines[lo:hi]]), axis=0, dtype=np.uint8)[1:]
        else:
            for y in range(lo, hi):
                up = out[y - 1].tolist() if y else [0] * w
                line, left, corner, row = lines[y].tolist(), 0, 0, bytearray(w)
                for i in range(w):
                    b = up[i]
                    if kind == 3:
                        left = (line[i] + (left + b) // 2) & 255
                    else:
                        p = left + b - corner
                        d, e, f = abs(p - left), abs(p - b), abs(p - corner)
                        left = (line[i] + (left if d <= e and d <= f else b if e <= f else corner)) & 255
                        corner = b
                    row[i] = left
                out[y] = np.frombuffer(row, np.uint8)
    return out


def _cosines(n: int, k: int) -> np.ndarray:
    return np.cos(np.pi * (2 * np.arange(n) + 1)[None, :] * np.arange(k)[:, None] / (2 * n))


_DCT = _cosines(32, 8)


def cosine_hash(pixels: np.ndarray) -> str:
    """64 bits: signs, against their median, of the 8 x 8 lowest cosine frequencies of
    the image averaged down to 32 x 32 cells; as 16 hexadecimal digits."""
    h, w = pixels.shape
    rows = np.add.reduceat(pixels, _cells(h), axis=0, dtype=np.int64)
    cells = np.add.reduceat(rows, _cells(w), axis=1).astype(np.float64)
    cells /= _spans(h)[:, None] * _spans(w)[None, :]
    low = (_DCT @ cells @ _DCT.T).round(6).reshape(-1)
    bits = low > np.median(low[1:])
    return np.packbits(bits).tobytes().hex()


def _cells(n: int) -> np.ndarray:
    return np.minimum(np.arange(32) * n // 32, n - 1)


def _spans(n: int) -> np.ndarray:
    return np.maximum(np.diff(np.append(_cells(n), n)), 1)


def store_texts(docs: DataFrame, row_filter: str = "none") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text (null: empty) as UTF-8 bytes, padded
    with 255 to a positive multiple of 576, as a PNG of rows of 576 samples."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                sizes, media = [], []
                for text in part.column(1):
                    raw = text.as_buffer() if text.is_valid else b""
                    n = len(raw)
                    x = np.full(max(1, -(-n // UNIT)) * UNIT, 255, np.uint8)
                    x[:n] = np.frombuffer(raw, np.uint8)
                    sizes.append(n)
                    media.append(encode_png(x.reshape(-1, UNIT), row_filter))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(put, "doc_id long, n_bytes long, media binary")


def describe_media(media: DataFrame) -> DataFrame:
    """Digests and the cosine hash of a binary column ``media``, decoded from its bytes.

    Columns payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256 and
    feature follow doc_id and n_bytes; a damaged image raises, naming the row.
    """

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, m in zip(b.column(0), b.column(2), strict=True):
                data = m.as_py()
                try:
                    pixels = decode_png(data)
                except ValueError as e:
                    raise ValueError(f"row {i}: {e}") from e
                payload = pixels.tobytes()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), cosine_hash(pixels)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(get, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
