"""The three kinds of operators, which are also how callers add their own.

- ``ColumnOperator``: the result is a Catalyst expression over the image columns.
- ``KernelOperator``: the result comes from the pixels, one image at a time; neighbouring kernel operators of a
  chain share one pass and one decoded image.
- ``BatchOperator``: the result needs all active images; a DataFrame to DataFrame function.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame

from pixelmill.schema import Result


class ColumnOperator:
    name = "column"

    def result(self, columns: dict[str, Column]) -> Column:
        """A struct (decision, reason, metrics) over the columns width, height, length and others of the image."""
        raise NotImplementedError


class KernelOperator:
    name = "kernel"
    #: Reason of the error when the image does not open; {error} is its text.
    open_error = "image_open_failed"

    def setup(self) -> None:
        """Once per task, before the first image."""

    def process(self, image: np.ndarray, row: dict[str, Any]) -> Result:
        """image: height x width x 3 bytes (RGB); row: the other columns."""
        raise NotImplementedError

    def teardown(self) -> None:
        """Once per task, after the last image, also if one failed."""


class BatchOperator:
    name = "batch"

    def prepare(self, state: DataFrame) -> DataFrame | None:
        """The rows with columns of what the operator needs of each image, made where the image is; ``decide`` then
        gets the active rows without images.  None: ``process_batch`` gets the active images instead."""
        return None

    def process_batch(self, active: DataFrame) -> DataFrame:
        """(sample_id, decision, reason, metrics) of some of the active images; the others pass."""
        raise NotImplementedError


class LabelOperator:
    name = "label"

    def setup(self) -> None:
        """Once per task."""

    def label(self, images: Iterator[dict[str, Any]]) -> Iterator[Result]:
        """A LABEL result with labels, or an ERROR, for every image row (sample_id, source_path, content)."""
        raise NotImplementedError

    def teardown(self) -> None:
        """Once per task, also if an image failed."""
