"""Archiving of survivors, manifest rows and summaries."""

from __future__ import annotations

import errno
import hashlib
import os
import shutil
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelmill.functions.paths import order_key
from pixelmill.schema import ERROR, PASS, PENDING, REJECT


def taken(path: Column) -> Column:
    """The error of a target that exists."""
    return F.concat(F.lit("archive_copy_failed: FileExistsError('Archive path already exists: "), path, F.lit("')"))


def resolve_conflicts(state: DataFrame, path: Column, overwrite: bool) -> DataFrame:
    """Which survivor of each archive path is copied, with no file system at hand.

    Without overwrite the first in sample order wins and the others are errors; with it all pass and the
    last is the one to be copied.  Adds archive_path, copies and conflict.
    """
    pending = F.col("status") == PENDING
    state = state.withColumn("archive_path", F.when(pending, path))
    key = order_key(F.col("sample_id"))
    # rows that are not archived would share the null path: their own id keeps them apart
    first = F.row_number().over(Window.partitionBy("archive_path", F.when(~pending, F.col("sample_id"))).orderBy(key.desc() if overwrite else key))
    state = state.withColumn("_n", first)
    return state.withColumns({"copies": pending & (F.col("_n") == 1), "conflict": pending & (F.col("_n") > 1) & F.lit(not overwrite)}).drop("_n")


def close(state: DataFrame, error: Column | None = None) -> DataFrame:
    """PENDING becomes PASS, or an archive ERROR where there is a conflict or the copy failed."""
    error = F.coalesce(error if error is not None else F.lit(None).cast("string"), F.when(F.col("conflict"), taken(F.col("archive_path"))))
    pending = F.col("status") == PENDING
    return state.withColumn("_e", F.when(pending, error)).withColumns({
        "rejected_by": F.when(F.col("_e").isNotNull(), F.lit("archive")).otherwise(F.col("rejected_by")),
        "reject_reason": F.coalesce("_e", "reject_reason"),
        "archive_path": F.when(pending & F.col("_e").isNull(), F.col("archive_path")),
        "status": F.when(F.col("_e").isNotNull(), F.lit(ERROR)).when(pending, F.lit(PASS)).otherwise(F.col("status")),
    }).drop("_e", "conflict", "copies")


def _place(part: str, target: str, overwrite: bool, claims: str) -> None:
    """Moves a finished copy to its target, which must not exist unless it may be overwritten.

    A claim names the file (by its inode) before it is moved, so a task that runs again knows its own work from
    anybody else's, of whatever size and time.
    """
    if overwrite:
        os.replace(part, target)
        return
    claim = os.path.join(claims, hashlib.sha256(target.encode()).hexdigest())
    with open(claim, "a") as out:
        out.write(f"{os.stat(part).st_ino}\n")
    try:
        os.link(part, target)
    except FileExistsError:
        with open(claim) as lines:
            if str(os.stat(target).st_ino) not in lines.read().split():
                raise FileExistsError(f"Archive path already exists: {target}") from None
    except OSError as e:
        if e.errno not in (errno.EPERM, errno.ENOTSUP, errno.EMLINK) or os.path.exists(target):
            raise
        os.replace(part, target)  # a file system without links
        return
    os.unlink(part)


def copy_files(chosen: DataFrame, overwrite: bool, claims: str) -> DataFrame:
    """Copies (sample_id, source_path, archive_path); gives (sample_id, copy_error).

    claims: a folder of this run that all tasks share.  A target that exists is an error unless ``overwrite``.
    """

    def run(batches):
        for b in batches:
            out = []
            for sample, source, target in zip(b["sample_id"], b["source_path"], b["archive_path"]):
                error, part = None, f"{target}.{uuid.uuid4().hex}.part"
                try:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    shutil.copy2(source.removeprefix("file:"), part)
                    _place(part, target, overwrite, claims)
                except Exception as e:
                    error = f"archive_copy_failed: {e!r}"
                    if os.path.exists(part):
                        os.unlink(part)
                out.append((sample, error))
            yield pd.DataFrame(out, columns=["sample_id", "copy_error"])

    return chosen.mapInPandas(run, "sample_id string, copy_error string")


def manifest(closed: DataFrame) -> DataFrame:
    return closed.select("sample_id", "source_path", "relative_path", "archive_path", "status", "rejected_by", "reject_reason", F.col("trace").alias("operator_trace"))


def counts(closed: DataFrame) -> DataFrame:
    """One row: input_total, passed, rejected, errors."""
    return closed.agg(
        F.count("*").alias("input_total"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == REJECT).alias("rejected"),
        F.count_if(F.col("status") == ERROR).alias("errors"),
    )


def reject_by_operator(closed: DataFrame) -> DataFrame:
    """(operator, n) of REJECTs alone; errors do not count."""
    return closed.where(F.col("status") == REJECT).groupBy(F.col("rejected_by").alias("operator")).agg(F.count("*").alias("n"), F.min(order_key(F.col("sample_id"))).alias("_first")).orderBy("_first").select("operator", "n")
