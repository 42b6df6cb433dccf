"""JSON lines and documents: written by tasks, whole or not at all."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession


def _replace(target: Path, write: Callable[[Any], None]) -> None:
    """A file under a name of its own until it is whole."""
    os.makedirs(target.parent, exist_ok=True)
    part = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
    with open(part, "wb") as out:
        write(out)
    os.replace(part, target)


def write_document(path: Path, data: Any) -> None:
    text = json.dumps(data, indent=2, ensure_ascii=False)
    _replace(Path(path), lambda out: out.write(f"{text}\n".encode()))


def write_rows(rows: DataFrame, order: Column, line: Callable[[dict[str, Any]], str], path: Path) -> int:
    """One line a row, in order; returns how many.

    Tasks sort ranges and write their lines into a folder beside the target; the driver only joins their files.  A
    task that runs twice replaces its own file.
    """
    path = Path(path)
    parts = path.with_name(f".{path.name}.{uuid.uuid4().hex}.parts")
    os.makedirs(parts)
    folder = str(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, n = TaskContext.get().partitionId(), 0

        def write(out) -> None:
            nonlocal n
            for b in batches:
                for row in b.to_pylist():
                    out.write(f"{line(row)}\n".encode())
                    n += 1

        _replace(Path(folder, f"{number:09d}"), write)
        yield pa.record_batch([pa.array([n], pa.int64())], ["n"])

    try:
        written = sum(r["n"] for r in rows.orderBy(order).mapInArrow(run, "n long").collect())  # one row a task

        def join(out) -> None:
            for name in sorted(x for x in os.listdir(folder) if not x.startswith(".")):
                with open(parts / name, "rb") as lines:
                    shutil.copyfileobj(lines, out, 1 << 20)

        _replace(path, join)
    finally:
        shutil.rmtree(parts, ignore_errors=True)
    return written


def write_documents(rows: DataFrame, document: Callable[[dict[str, Any]], tuple[str, Any]]) -> int:
    """A file for every row, written where the row is; document(row) gives its path and content.  Returns how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            for row in b.to_pylist():
                path, data = document(row)
                write_document(Path(path), data)
                n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], ["n"])

    return sum(r["n"] for r in rows.mapInArrow(run, "n long").collect())


def read_lines(path: Path) -> list[dict[str, Any]]:
    """The rows of a file that fits the driver; none if it does not exist.  ``read_table`` reads any size."""
    if not os.path.isfile(path):
        return []
    with open(path, "rb") as lines:
        return list(map(json.loads, filter(bytes.strip, lines)))


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
