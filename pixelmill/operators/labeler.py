"""The vision-model labeler."""

from __future__ import annotations

import base64
import json
import os
import struct
import time
import urllib.request
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np

from pixelmill.functions import kernels
from pixelmill.functions.labels import FIELDS, HEADLESS, NA, VOCABULARY
from pixelmill.operators.base import LabelOperator
from pixelmill.schema import Result, failed, labelled

SYSTEM = "You tag pictures of people. Answer with one valid JSON object and nothing else."
REQUEST = "Give the person attributes of this picture as one JSON object with the fields: " + ", ".join(FIELDS) + "."


def fit_pixels(height: int, width: int, max_pixels: int) -> tuple[int, int]:
    """Size scaled so that there are at most max_pixels (0: no limit), each side cut to whole pixels, one at least."""
    if max_pixels <= 0 or height * width <= max_pixels:
        return height, width
    scale = (max_pixels / (height * width)) ** 0.5
    return max(1, int(height * scale)), max(1, int(width * scale))


def shrink_pixels(image: np.ndarray, max_pixels: int) -> np.ndarray:
    size = fit_pixels(*image.shape[:2], max_pixels)
    return image if size == image.shape[:2] else kernels.resample(image, *size)


def png(image: np.ndarray) -> bytes:
    """8-bit RGB PNG of an image."""
    h, w = image.shape[:2]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, -1)], 1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def data_url(image: np.ndarray) -> str:
    return "data:image/png;base64," + base64.b64encode(png(image)).decode()


def normalise_answer(raw: dict[str, Any], file_name: str) -> dict[str, str]:
    """One answer at a time, for the task that holds it; tables of answers use functions.labels.normalise."""
    text = {f: None if raw.get(f) is None else str(raw[f]).strip() for f in FIELDS}
    ann = {f: (text[f] if text[f] in VOCABULARY[f] else NA) if f in VOCABULARY else (text[f] or NA).split()[0] for f in FIELDS}
    if ann["person_count"] != "1":
        ann.update(dict.fromkeys(FIELDS[1:], NA))
    elif ann["head_visible"] == "no":
        ann.update(dict.fromkeys(HEADLESS, NA), hair_visible="no")
    if ann["hair_visible"] == "no":
        ann["hair_color"] = NA
    return {"file_name": file_name, **ann}


class PersonAttributeLabeler(LabelOperator):
    """Asks a chat endpoint about every image, with retries; ``infer(url) -> text`` can take its place."""

    name = "person_attribute_labeler"

    def __init__(self, base_url: str = "", model_name: str = "", api_key_env: str = "API_KEY", max_retries: int = 3, max_tokens: int = 224, temperature: float = 0.0, max_pixels: int = 589824, infer=None, sleep=time.sleep, **unused):
        self.base_url, self.model, self.key_env = base_url, model_name, api_key_env
        self.retries, self.max_tokens, self.temperature, self.max_pixels = int(max_retries), int(max_tokens), float(temperature), int(max_pixels)
        self.infer, self.sleep, self.ready = infer, sleep, False

    def setup(self) -> None:
        self.key = os.environ.get(self.key_env, "")  # read where the task runs, never part of the plan
        self.ready = True

    def _post(self, url: str) -> str:
        body = {
            "model": self.model, "max_tokens": self.max_tokens, "temperature": self.temperature,
            "messages": [{"role": "system", "content": SYSTEM}, {"role": "user", "content": [{"type": "text", "text": REQUEST}, {"type": "image_url", "image_url": {"url": url}}]}],
        }
        request = urllib.request.Request(f"{self.base_url}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        with urllib.request.urlopen(request) as answer:
            return json.load(answer)["choices"][0]["message"]["content"] or "{}"

    def ask(self, url: str) -> dict[str, Any]:
        for attempt in range(1, self.retries + 1):
            try:
                found = json.loads((self.infer or self._post)(url) or "{}")
                if not isinstance(found, dict):
                    raise ValueError("the answer is no JSON object")
                return found
            except Exception as e:
                last = e
                if attempt < self.retries:
                    self.sleep(attempt)
        raise RuntimeError(f"label inference failed after {self.retries} attempts: {last!r}")

    def label(self, images: Iterator[dict[str, Any]]) -> Iterator[Result]:
        from pixelmill.sources.codec import open_row

        for row in images:
            if not self.ready:
                yield failed("labeler_not_initialized")
                continue
            try:
                image = shrink_pixels(open_row(row), self.max_pixels)
                yield labelled(normalise_answer(self.ask(data_url(image)), row["source_path"].rsplit("/", 1)[-1]))
            except Exception as e:
                yield failed(f"label_inference_failed: {e!r}")
