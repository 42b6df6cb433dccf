"""Image files for tests, written without an imaging library."""

from __future__ import annotations

import struct
from pathlib import Path

import numpy as np

from pixelmill.operators.labeler import png


def solid(path: Path, width: int, height: int, color=(255, 0, 0)) -> Path:
    return save(path, np.full((height, width, 3), color, np.uint8))


def save(path: Path, image: np.ndarray) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(bmp(image) if path.suffix.lower() == ".bmp" else png(image))
    return path


def bmp(image: np.ndarray) -> bytes:
    h, w = image.shape[:2]
    lines = np.zeros((h, -(-w * 3 // 4) * 4), np.uint8)
    lines[:, : w * 3] = image[::-1, :, ::-1].reshape(h, -1)
    body = lines.tobytes()
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body
