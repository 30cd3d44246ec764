"""Image fingerprints in numpy, for the data that Spark's image source decodes."""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

VARIANTS = ("original", "rotate90", "rotate180", "rotate270", "flipx", "flipy", "flipplus", "flipminus")
_DCT64 = np.sqrt(2 / 64) * np.cos(np.pi / 128 * np.arange(1, 17)[:, None] * (2 * np.arange(64)[None, :] + 1))
_DCT32 = np.cos(np.pi / 64 * np.arange(32)[:, None] * (2 * np.arange(32)[None, :] + 1))


def luma(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Grey values of pixels stored as BGR, BGRA or grey."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.float64)
    return x[:, :, 0] if channels == 1 else x[:, :, 2] * 0.299 + x[:, :, 1] * 0.587 + x[:, :, 0] * 0.114


def _box(x: np.ndarray, size: int) -> np.ndarray:
    """Running mean along the first axis."""
    n, before = len(x), (size + 2) // 2 - 1
    sums = np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, 0)])
    high, low = np.minimum(np.arange(n) + before + 1, n), np.maximum(np.arange(n) + before + 1 - size, 0)
    return (sums[high] - sums[low]) / (high - low)[:, None]


def _small(grey: np.ndarray, to: int) -> np.ndarray:
    h, w = grey.shape
    for _ in range(2):
        grey = _box(grey, max(1, (h + 2 * to - 1) // (2 * to)))
        grey = _box(grey.T, max(1, (w + 2 * to - 1) // (2 * to))).T
    return grey[np.ix_(((np.arange(to) + 0.5) * h / to).astype(int), ((np.arange(to) + 0.5) * w / to).astype(int))]


def _hex(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel()[::-1]).tobytes().hex()


def pdq(grey: np.ndarray) -> dict[str, str]:
    """256-bit hash of an image and of its seven rotations and reflections, from one transform."""
    d = _DCT64 @ _small(grey, 64) @ _DCT64.T
    odd = np.arange(16) % 2 == 0  # the first kept frequency is 1
    across, down = np.where(odd, -1, 1)[None, :], np.where(odd, -1, 1)[:, None]
    kinds = (d, d.T * across, d * across * down, d.T * down, d * down, d * across, d.T, d.T * across * down)
    return {name: _hex(k > np.median(k)) for name, k in zip(VARIANTS, kinds, strict=True)}


def phash(grey: np.ndarray) -> str:
    """64-bit hash of the lowest frequencies against their median."""
    d = (_DCT32 @ _small(grey, 32) @ _DCT32.T)[:8, :8]
    return _hex(d > np.median(d.ravel()[1:]))


def hamming(a: str, b: str) -> int:
    return (int(a, 16) ^ int(b, 16)).bit_count()


def dimensions(data: bytes) -> tuple[int, int] | None:
    """(height, width) from the header of a PNG, GIF, BMP or JPEG."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        w, h = struct.unpack(">II", data[16:24])
        return h, w
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        w, h = struct.unpack("<HH", data[6:10])
        return h, w
    if data[:2] == b"BM" and len(data) >= 26:
        w, h = struct.unpack("<ii", data[18:26])
        return abs(h), w
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data) and data[at] == 0xFF:
            if data[at + 1] in (0xC0, 0xC1, 0xC2, 0xC3):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return h, w
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


@F.pandas_udf(StructType().add("height", LongType()).add("width", LongType()).add("size", LongType()))
def measured(payload):
    import pandas as pd

    rows = [(dimensions(p) if p is not None else None) or (None, None) for p in payload]
    return pd.DataFrame([(h, w, h * w if h is not None else None) for h, w in rows], columns=["height", "width", "size"], dtype="Int64")


@F.pandas_udf(StructType().add("phash", StringType()).add("pdq", ArrayType(StringType())))
def fingerprints(image):
    """Hashes of rows of the image source's ``image`` column; null below 150 pixels on a side."""
    import pandas as pd

    rows = []
    for _, r in image.iterrows():
        if min(r["height"], r["width"]) < 150:
            rows.append((None, None))
            continue
        grey = luma(r["data"], r["height"], r["width"], r["nChannels"])
        rows.append((phash(grey), [pdq(grey)[v] for v in VARIANTS]))
    return pd.DataFrame(rows, columns=["phash", "pdq"])


def bands(h, n: int = 8, width: int = 8):
    """Pieces of a hexadecimal hash, for equality joins."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.substr(h, i * width + 1, F.lit(width)))
