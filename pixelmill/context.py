"""Where a run keeps its files."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F


def new_run_id() -> str:
    return datetime.now().strftime("%Y%m%d-%H%M%S")


def archive_path(relative: Column, archive_dir: str, run_id: str, layout: str) -> Column:
    """The archive path of an image as an expression over its relative path."""
    if layout == "run_subdir":
        return F.concat_ws("/", F.lit(archive_dir), F.lit(run_id), relative)
    if layout == "flat":
        return F.concat_ws("/", F.lit(archive_dir), F.element_at(F.split(relative, "/"), -1))
    if layout == "preserve_relative":
        return F.concat_ws("/", F.lit(archive_dir), relative)
    raise ValueError(f"Unsupported pass_archive_layout: {layout}")


@dataclass(frozen=True)
class RunContext:
    run_id: str
    run_dir: Path
    archive_dir: str
    layout: str

    manifest = property(lambda self: self.run_dir / "manifest.jsonl")
    summary = property(lambda self: self.run_dir / "summary.json")
    label_summary = property(lambda self: self.run_dir / "label_summary.json")
    snapshot = property(lambda self: self.run_dir / "config.snapshot.yaml")
    annotations = property(lambda self: self.run_dir / "annotations")
    labels = property(lambda self: self.run_dir / "labels.jsonl")
    logs = property(lambda self: self.run_dir / "logs")

    def archive_path(self, relative: Column) -> Column:
        return archive_path(relative, self.archive_dir, self.run_id, self.layout)

    def prepare(self) -> None:
        self.annotations.mkdir(parents=True, exist_ok=True)
        self.logs.mkdir(parents=True, exist_ok=True)
