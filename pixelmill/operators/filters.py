"""Filters of single images."""

from __future__ import annotations

from typing import Any

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from pixelmill.functions import kernels
from pixelmill.operators.base import ColumnOperator, KernelOperator
from pixelmill.schema import ERROR, PASS, REJECT, Result, passed, rejected, result


def _opened(columns: dict[str, Column], own: Column) -> Column:
    """The operator's result unless the header could not be read."""
    broken = result(F.lit(ERROR), F.concat(F.lit("image_open_failed: "), F.coalesce(columns["open_error"], F.lit(""))))
    return F.when(columns["width"].isNull() | columns["height"].isNull(), broken).otherwise(own)


class AspectRatio(ColumnOperator):
    """Rejects images whose longer side is over ``ratio`` times the shorter (from the header alone)."""

    name = "aspect_ratio"

    def __init__(self, ratio: float = 2.0):
        self.ratio = float(ratio)

    def result(self, columns: dict[str, Column]) -> Column:
        w, h = columns["width"], columns["height"]
        sized = (w > 0) & (h > 0)
        value = F.when(sized, F.greatest(w.cast("double") / h, h.cast("double") / w))
        metrics = {"width": w, "height": h, "ratio": F.round(value, 6), "threshold": F.lit(self.ratio)}
        own = (
            F.when(~sized, result(F.lit(ERROR), F.lit("invalid_image_size"), width=w, height=h))
            .when(value > self.ratio, result(F.lit(REJECT), F.lit("aspect_ratio_exceeds_threshold"), **metrics))
            .otherwise(result(F.lit(PASS), F.lit(None), **metrics))
        )
        return _opened(columns, own)


class CompressionQuality(ColumnOperator):
    """Rejects images with too few file bytes for their raw size."""

    name = "compression_quality"

    def __init__(self, min_quality_threshold: float = 0.2):
        self.least = float(min_quality_threshold)

    def result(self, columns: dict[str, Column]) -> Column:
        w, h, size = columns["width"], columns["height"], columns["length"]
        raw = F.greatest(w.cast("long") * h * 3, F.lit(1).cast("long"))
        share = size.cast("double") / raw
        metrics = {"width": w, "height": h, "actual_size": size, "theoretical_size": raw, "compression_ratio": share, "threshold": F.lit(self.least)}
        own = F.when(share < self.least, result(F.lit(REJECT), F.lit("compression_ratio_below_threshold"), **metrics)).otherwise(result(F.lit(PASS), F.lit(None), **metrics))
        return _opened(columns, own)


class GrayStyle(KernelOperator):
    """Rejects images whose channels hardly differ anywhere."""

    name = "gray_style"
    open_error = "image_open_failed: {error}"

    def __init__(self, threshold: float = 1.0, max_side: int = 1600):
        self.threshold, self.max_side = float(threshold), int(max_side)

    def process(self, image: np.ndarray, row: dict[str, Any]) -> Result:
        spread = float(kernels.channel_spread(kernels.shrink(image, self.max_side)))
        metrics = {"max_channel_diff": spread, "threshold": self.threshold}
        return rejected("grayscale_image", metrics) if spread < self.threshold else passed(metrics)


class FrameBox(KernelOperator):
    """Rejects images that are framed on ``sides`` sides."""

    name = "framebox"

    def __init__(self, max_side: int = 1024, sides: int = 3, min_thick: int = 20, max_ratio: float = 0.30, min_std: float = 15.0):
        self.max_side, self.sides, self.min_thick = int(max_side), int(sides), int(min_thick)
        self.max_ratio, self.min_std = float(max_ratio), float(min_std)

    def process(self, image: np.ndarray, row: dict[str, Any]) -> Result:
        gray = kernels.luma(kernels.shrink(image, self.max_side))
        std = float(gray.std())
        if std < self.min_std:  # a flat image has no border to speak of
            return passed({"std": std})
        thick = kernels.borders(gray)
        metrics = {**thick, "std": std}
        height, width = gray.shape
        extent = {"top": height, "bottom": height, "left": width, "right": width}
        if any(thick[s] > extent[s] * self.max_ratio for s in thick):  # a solid background rather than a frame
            return passed(metrics)
        framed = sum(t > self.min_thick for t in thick.values())
        return rejected("bordered_content", metrics) if framed >= self.sides else passed(metrics)


class StitchLine(KernelOperator):
    """Rejects images with one outstanding vertical, else horizontal, gradient line."""

    name = "stitch_v2"

    def __init__(self, max_side: int = 1400, prominence: float = 6.0):
        self.max_side, self.prominence = int(max_side), float(prominence)

    def _line(self, projection: np.ndarray, axis: str) -> tuple[bool, dict[str, Any]]:
        found = kernels.peak(projection)
        if found is None:
            return False, {"axis": axis, "mean": float(projection.mean())}
        _, at, height = found
        return height >= self.prominence, {"axis": axis, "peak_position": at / len(projection), "peak_prominence": height, "threshold": self.prominence}

    def process(self, image: np.ndarray, row: dict[str, Any]) -> Result:
        columns, rows = kernels.projections(kernels.luma(kernels.shrink(image, self.max_side)))
        seen = {}
        for axis, projection in (("vertical", columns), ("horizontal", rows)):
            hit, seen[axis] = self._line(projection, axis)
            if hit:
                return rejected(f"stitch_line_{axis}", seen[axis])
        return passed(seen)


class PersonBlur(KernelOperator):
    """Rejects images whose least sharp face region is too blurred.

    Face boxes come from the row's ``faces`` (up to ten boxes x1, y1, x2, y2) or from ``detector(gray)``; without
    either there is no region, and the image passes.  ``person_thr`` is taken and not used.
    """

    name = "person_blur"

    def __init__(self, max_side: int = 1024, person_thr: float = 120.0, face_thr: float = 90.0, pad_frac: float = 0.08, detector=None):
        self.max_side, self.person_thr, self.face_thr, self.pad, self.detector = int(max_side), float(person_thr), float(face_thr), float(pad_frac), detector

    def process(self, image: np.ndarray, row: dict[str, Any]) -> Result:
        gray = kernels.luma(kernels.shrink(image, self.max_side))
        boxes = row.get("faces")
        boxes = self.detector(gray) if boxes is None and self.detector else boxes
        boxes = [tuple(int(v) for v in (b.values() if isinstance(b, dict) else b)) for b in (() if boxes is None else boxes)][:10]
        if not boxes:
            return passed({"used": "none", "no_roi_kept": True})
        score = kernels.region_blur(gray, boxes, self.pad)
        if score is None:
            return passed({"used": "face", "no_valid_roi_kept": True})
        metrics = {"used": "face", "score": score, "threshold": self.face_thr}
        return rejected("blur_score_below_threshold", metrics) if score < self.face_thr else passed(metrics)
