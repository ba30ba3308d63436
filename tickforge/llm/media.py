"""Media columns: PNG files in a binary column, and features read back from them.

``encode`` stores bytes as an 8-bit greyscale PNG of 192 samples a row: signature, IHDR, zlib-compressed IDAT chunks of
bounded size and IEND, each with its CRC.  A row takes the cheapest of the filters None, Sub and Up by the sum of absolute
differences.  ``decode`` walks the chunks, tests every checksum, inflates and undoes all five filters with numpy: rows
of None and Sub at once, runs of Up by one cumulative sum, Average and Paeth sample by sample.  ``dct_hash`` shrinks an
image to 32 x 32 by block means, takes the 8 x 8 lowest frequencies of its cosine transform and compares 63 of them (all but the constant)
with their median.

Defined results: a null text is an empty one, whose payload is 192 spaces; equal texts give equal bytes and hashes;
null ids and repeated rows pass through row by row; a damaged file raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

WIDTH = 192
CHUNK = 1 << 18
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def pad(data: bytes, width: int = WIDTH) -> bytes:
    """Spaces up to a positive multiple of ``width``."""
    return data + b" " * (-len(data) % width or (width if not data else 0))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(payload: bytes, width: int = WIDTH, level: int = 1) -> bytes:
    x = np.frombuffer(payload, np.uint8).reshape(-1, width)
    sub, up = x.copy(), x.copy()
    sub[:, 1:] -= x[:, :-1]
    up[1:] -= x[:-1]
    forms = np.stack([x, sub, up])
    cost = np.abs(forms.view(np.int8).astype(np.int16)).sum(axis=2, dtype=np.int32)
    best = cost.argmin(axis=0)
    rows = np.empty((len(x), width + 1), np.uint8)
    rows[:, 0] = best
    rows[:, 1:] = forms[best, np.arange(len(x))]
    body = zlib.compress(rows.tobytes(), level)
    head = struct.pack(">IIBBBBB", width, len(x), 8, 0, 0, 0, 0)
    return b"".join([_SIGNATURE, _chunk(b"IHDR", head), *(_chunk(b"IDAT", body[i : i + CHUNK]) for i in range(0, len(body), CHUNK)), _chunk(b"IEND", b"")])


def _chunks(data: bytes):
    if data[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at = 8
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("a PNG chunk is cut off")
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) < n or data[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(kind + body)):
            raise ValueError(f"checksum of the PNG chunk {kind!r} is wrong")
        yield kind, body
        at += 12 + n


def _unfilter(kind: np.ndarray, rows: np.ndarray, bpp: int) -> np.ndarray:
    """``rows``: what the filters left, uint8 [height, bytes a row]; undone in place."""
    width = rows.shape[1]
    if len(sub := np.flatnonzero(kind == 1)):
        padded = np.zeros((len(sub), -(-width // bpp) * bpp), np.uint8)
        padded[:, :width] = rows[sub]
        rows[sub] = np.add.accumulate(padded.reshape(len(sub), -1, bpp), axis=1, dtype=np.uint8).reshape(len(sub), -1)[:, :width]
    later = np.flatnonzero(kind >= 2)
    i = 0
    while i < len(later):
        y = int(later[i])
        above = rows[y - 1] if y else np.zeros(width, np.uint8)
        if kind[y] == 2:
            j = i
            while j + 1 < len(later) and later[j + 1] == later[j] + 1 and kind[later[j + 1]] == 2:
                j += 1
            end = int(later[j]) + 1
            rows[y] += above
            if end - y > 1:
                rows[y:end] = np.add.accumulate(rows[y:end], axis=0, dtype=np.uint8)
            i = j + 1
            continue
        line, up = rows[y].astype(int).tolist(), above.astype(int).tolist()
        for x in range(width):
            left = line[x - bpp] if x >= bpp else 0
            if kind[y] == 3:
                guess = (left + up[x]) // 2
            else:
                corner = up[x - bpp] if x >= bpp else 0
                p = left + up[x] - corner
                guess = min((abs(p - left), 0, left), (abs(p - up[x]), 1, up[x]), (abs(p - corner), 2, corner))[2]
            line[x] = (line[x] + guess) & 255
        rows[y] = line
        i += 1
    return rows


def decode(data: bytes) -> np.ndarray:
    """Samples, uint8 [height, width, channels], of an 8-bit, not interlaced PNG."""
    head, idat, ended = None, [], False
    for kind, body in _chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            idat.append(body)
        elif kind == b"IEND":
            ended = True
    if head is None or not ended:
        raise ValueError("the PNG file lacks IHDR or IEND")
    width, height, depth, colour, _, _, interlaced = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or channels is None or interlaced:
        raise ValueError("only 8-bit PNG without palette and interlacing is read")
    raw = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8)
    if len(raw) != height * (width * channels + 1):
        raise ValueError("the PNG file has a wrong number of samples")
    raw = raw.reshape(height, -1)
    if raw[:, 0].max(initial=0) > 4:
        raise ValueError("unknown PNG filter")
    return _unfilter(raw[:, 0], raw[:, 1:].copy(), channels).reshape(height, width, channels)


def _cosines(n: int = 32, k: int = 8) -> np.ndarray:
    return np.cos(np.pi * (2 * np.arange(n) + 1) * np.arange(k)[:, None] / (2 * n))


_DCT = _cosines()


def _means(x: np.ndarray, axis: int, n: int = 32) -> np.ndarray:
    """Means of n stretches of an axis; a shorter axis repeats its samples."""
    size = x.shape[axis]
    starts = np.arange(n) * size // n
    if size < n:
        return np.take(x, starts, axis=axis).astype(np.float64)
    lengths = np.diff(np.append(starts, size))
    return np.add.reduceat(x, starts, axis=axis, dtype=np.float64) / (lengths[:, None] if axis == 0 else lengths)


def dct_hash(samples: np.ndarray) -> str:
    grey = samples.mean(axis=2) if samples.shape[2] > 1 else samples[:, :, 0]
    small = _means(_means(grey, 0), 1)
    low = np.round(_DCT @ small @ _DCT.T, 6).ravel()[1:]
    return np.packbits(np.append(False, low > np.median(low))).tobytes().hex()


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media (a PNG file in a binary column)."""

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([encode(pad(t)) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """Reads the files of ``to_media`` back: doc_id, n_bytes, media, payload, feature."""

    def run(batches):
        for batch in batches:
            payloads, features = [], []
            for data in batch.column("media").to_pylist():
                samples = decode(data)
                payloads.append(samples.tobytes())
                features.append(dct_hash(samples))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), batch.column("media"), pa.array(payloads, pa.binary()), pa.array(features, pa.string())], names=["doc_id", "n_bytes", "media", "payload", "feature"])

    return media.mapInArrow(run, "doc_id long, n_bytes long, media binary, payload binary, feature string")


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media_features(to_media(read_table(spark, sf_dir, "documents")))
    return read.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
    )
