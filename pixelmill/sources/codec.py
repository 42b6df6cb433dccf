"""Headers and pixels of encoded images.

Headers (PNG, JPEG, GIF, BMP, TIFF, WebP) are parsed from the first bytes, so a truncated file keeps its size.
Pixels: Pillow where it can be imported; otherwise PNG (8 bits, not interlaced) and BMP (24 or 32 bits) here, and
``bgr``/``channels`` as read by Spark's image source for what only the JVM decodes.
"""

from __future__ import annotations

import struct
import zlib
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER_BYTES = 1 << 16


def header(data: bytes) -> tuple[int, int]:
    """(width, height) or ValueError."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", data[16:24])
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data):
            if data[at] != 0xFF:
                at += 1
                continue
            marker = data[at + 1]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            if marker in (0xFF, 0x01) or 0xD0 <= marker <= 0xD8:
                at += 1 if marker == 0xFF else 2
                continue
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
        raise ValueError("no frame header")
    if data[:6] in (b"GIF87a", b"GIF89a"):
        return struct.unpack("<HH", data[6:10])
    if data[:2] == b"BM":
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h)
    if data[:4] in (b"II*\0", b"MM\0*"):
        e = "<" if data[:2] == b"II" else ">"
        at = struct.unpack(e + "I", data[4:8])[0]
        tags = {}
        for k in range(struct.unpack(e + "H", data[at : at + 2])[0]):
            tag, kind, _, raw = struct.unpack(e + "HHI4s", data[at + 2 + 12 * k : at + 14 + 12 * k])
            tags[tag] = struct.unpack(e + ("H" if kind == 3 else "I"), raw[: 2 if kind == 3 else 4])[0]
        return tags[256], tags[257]
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        if data[12:16] == b"VP8X":
            return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
        if data[12:16] == b"VP8L":
            bits = int.from_bytes(data[21:25], "little")
            return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
        w, h = struct.unpack("<HH", data[26:30])
        return w & 0x3FFF, h & 0x3FFF
    raise ValueError("cannot identify image")


def _png(data: bytes) -> np.ndarray:
    at, body, palette = 8, b"", None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            w, h, depth, color, _, _, interlace = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += part
        at += size + 12
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    if depth != 8 or interlace:
        raise ValueError("unsupported PNG variant")
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * channels)
    out, before = np.empty((h, w * channels), np.uint8), np.zeros(w * channels, np.uint8)
    for y in range(h):
        line, kind = raw[y, 1:].astype(np.int64), int(raw[y, 0])
        if kind == 2:
            line = line + before
        elif kind == 1:
            line = np.cumsum(line.reshape(w, channels), 0).ravel()
        elif kind in (3, 4):
            for x in range(w * channels):
                left = int(line[x - channels]) & 255 if x >= channels else 0
                up, corner = int(before[x]), int(before[x - channels]) if x >= channels else 0
                if kind == 3:
                    line[x] = line[x] + (left + up) // 2
                else:
                    guess = left + up - corner
                    line[x] = line[x] + min((left, up, corner), key=lambda v: abs(guess - v))
                line[x] &= 255
        before = out[y] = (line & 255).astype(np.uint8)
    pixels = out.reshape(h, w, channels)
    if color == 3:
        return palette[pixels[..., 0]]
    return pixels[..., :3] if channels >= 3 else np.repeat(pixels[..., :1], 3, 2)


def _bmp(data: bytes) -> np.ndarray:
    start, w, h = struct.unpack("<I", data[10:14])[0], *struct.unpack("<ii", data[18:26])
    bits = struct.unpack("<H", data[28:30])[0]
    if bits not in (24, 32):
        raise ValueError("unsupported BMP variant")
    step, n = bits // 8, -(-w * bits // 32) * 4
    rows = np.frombuffer(data[start : start + n * abs(h)], np.uint8).reshape(abs(h), n)[:, : w * step].reshape(abs(h), w, step)
    return (rows[::-1] if h > 0 else rows)[..., 2::-1]


def decode(data: bytes) -> np.ndarray:
    """RGB bytes, height x width x 3."""
    try:
        from PIL import Image
    except ImportError:
        if data[:4] == b"\x89PNG":
            return _png(data)
        if data[:2] == b"BM":
            return _bmp(data)
        raise ValueError("cannot decode image") from None
    import io

    return np.asarray(Image.open(io.BytesIO(data)).convert("RGB"))


def open_row(row: dict[str, Any]) -> np.ndarray:
    """The image of a row: raw pixels if it has them, else decoded content."""
    raw, content = row.get("pixels"), row.get("content")
    if isinstance(raw, (bytes, bytearray)):
        h, w = int(row["pixel_height"]), int(row["pixel_width"])
        return np.frombuffer(raw, np.uint8).reshape(h, w, 3)
    if isinstance(content, (bytes, bytearray)):
        return decode(bytes(content))
    raise ValueError("no image data")


HEADER = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("open_error", T.StringType())])


@F.pandas_udf(HEADER)
def image_header(head: pd.Series) -> pd.DataFrame:
    """Size from the first bytes of a file; nulls and the error's text if it is no image."""
    out = []
    for data in head:
        try:
            out.append((*header(bytes(data)), None))
        except Exception as e:
            out.append((None, None, repr(e)))
    return pd.DataFrame(out, columns=["width", "height", "open_error"]).astype({"width": "Int32", "height": "Int32"})
