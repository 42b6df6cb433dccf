"""Session helpers: checkpoints in the shared folder, and the package for executors that lack it."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; one of our own only where none is set and all tasks run here (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="pixelmill-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", where)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and forget the lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Give executors this package as an archive, once a session."""
    if spark.conf.get("pixelmill.shipped", None) == "yes":
        return
    top = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("pixelmill", os.path.relpath(path, top)))
    path = os.path.join(tempfile.mkdtemp(prefix="pixelmill-"), "pixelmill.zip")
    with open(path, "wb") as out:
        out.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    spark.conf.set("pixelmill.shipped", "yes")
