"""Images as a stream: new files pass the column and kernel operators as they arrive.

Batch operators depend on the order of the whole collection and stay out; run them over the written manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pixelmill.functions import paths
from pixelmill.operators.base import BatchOperator
from pixelmill.plans.chain import apply_chain
from pixelmill.sources.images import with_header

FILE = "path string, modificationTime timestamp, length long, content binary"


def read_images(spark: SparkSession, root: str, exts, files_per_trigger: int = 1000) -> DataFrame:
    rows = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).load(root)
    base = "/" + root.removeprefix("file:").strip("/") + "/"
    rel = F.substring_index(F.col("path"), base, -1)
    rows = rows.select(rel.alias("sample_id"), F.col("path").alias("source_path"), rel.alias("relative_path"), "length", "content")
    return with_header(rows.where(paths.has_suffix(F.col("relative_path"), exts)))


def start_filter(images: DataFrame, operators: list, out: str, checkpoint: str) -> StreamingQuery:
    """Writes the state of every image under ``out``; what is there when it starts is worked off, then it ends."""
    if any(isinstance(op, BatchOperator) for op in operators):
        raise TypeError("batch operators need the whole collection")

    def write(batch: DataFrame, _: int) -> None:
        apply_chain(batch, operators).drop("content").write.mode("append").parquet(out)

    return images.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
