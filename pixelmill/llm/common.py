"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from pixelmill.session import checkpoint_dir, cut

__all__ = ["GAP", "checkpoint_dir", "cut", "shuffle_width", "slices", "store", "table"]

_FOLDERS: set[str] = set()

#: Separators of words: space and the controls tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def store(df: DataFrame) -> DataFrame:
    """Write as a compressed table in the shared checkpoint folder and read it back: lineage ends here.

    The tables of a session lie in one folder, which ``clear`` removes; it is called when Python ends.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession) -> str:
    where = f"{checkpoint_dir(spark).rstrip('/')}/pixelmill-{spark.sparkContext.applicationId}"
    if where not in _FOLDERS:
        _FOLDERS.add(where)
        atexit.register(clear, spark)
    return where


def clear(spark: SparkSession) -> None:
    """Removes the session's stored tables; results that still read them must have been written."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Hand memory that is free again back to the system: Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], text: str, rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of at most ``rows`` rows and about ``size`` bytes of text (one row at least).

    Few texts are Python objects at a time, whatever the batch; free memory goes back at the end.
    """
    for b in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo, n = 0, b.num_rows
        while lo < n:
            before = int(sizes[lo - 1]) if lo else 0
            hi = min(lo + rows, n, max(lo + 1, int(np.searchsorted(sizes, before + size, side="right"))))
            yield b.slice(lo, hi - lo)
            lo = hi
    give_back()
