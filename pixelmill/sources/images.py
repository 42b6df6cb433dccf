"""Image scans.

``scan`` lists with a Python data source: every regular file whose lower-case suffix is wanted, names that start
with a dot or underscore included, in component-wise path order; tasks read the files.  ``scan_remote`` reads through
Spark's binaryFile source, which reaches any store Spark does, and skips such names.
"""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pixelmill.functions import paths
from pixelmill.schema import IMAGE
from pixelmill.sources.codec import HEADER_BYTES, image_header

PER_PARTITION = 256
#: Formats that Spark's image source decodes and tasks without an imaging library do not.
JVM_SUFFIXES = (".jpg", ".jpeg", ".tif", ".tiff", ".gif")


def wanted(name: str, exts: set[str]) -> bool:
    return os.path.splitext(name)[1].lower() in exts


def listing(root: str, recursive: bool, exts) -> list[str]:
    """Relative paths in component-wise order; a missing root has none."""
    exts = {x.lower() for x in exts}
    found = []
    for folder, folders, names in os.walk(root):
        if not recursive:
            folders.clear()
        found += [os.path.relpath(os.path.join(folder, n), root).replace(os.sep, "/") for n in names if wanted(n, exts) and os.path.isfile(os.path.join(folder, n))]
    return sorted(found, key=lambda p: p.split("/"))


class _Chunk(InputPartition):
    def __init__(self, root: str, names: list[str]):
        self.root, self.names = root, names


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.root, self.recursive = options["path"], options.get("recursive", "true") == "true"
        self.exts = options["exts"].split(",")
        self.with_content = options.get("content", "true") == "true"

    def partitions(self):
        names = listing(self.root, self.recursive, self.exts)
        return [_Chunk(self.root, names[k : k + PER_PARTITION]) for k in range(0, len(names), PER_PARTITION)] or [_Chunk(self.root, [])]

    def read(self, partition):
        for name in partition.names:
            path = f"{partition.root.rstrip('/')}/{name}"
            content = None
            if self.with_content:
                with open(path, "rb") as f:
                    content = f.read()
            yield (name, path, name, os.path.getsize(path), content)


class ImageFiles(DataSource):
    """spark.read.format("image_files").option("exts", ".png,.jpg").load(root)"""

    @classmethod
    def name(cls):
        return "image_files"

    def schema(self):
        return IMAGE

    def reader(self, schema):
        return _Reader(self.options)


def scan(spark: SparkSession, root: str, recursive: bool = True, exts=(".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tif", ".tiff"), content: bool = True) -> DataFrame:
    """One row per image: ids, paths, byte length, content and header size."""
    spark.dataSource.register(ImageFiles)
    options = {"recursive": str(bool(recursive)).lower(), "exts": ",".join(exts), "content": str(content).lower()}
    rows = spark.read.format("image_files").options(**options).load(root)
    return with_header(rows) if content else rows


def scan_remote(spark: SparkSession, root: str, recursive: bool = True, exts=(".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tif", ".tiff")) -> DataFrame:
    """The same through binaryFile; the suffix test keeps case aside, and content is read only for what stays."""
    full = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = full.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(full).toString().rstrip("/") + "/"
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.substring(F.col("path"), F.lit(len(base) + 1), F.length("path"))
    rows = rows.withColumn("relative_path", name).where(paths.has_suffix(F.col("relative_path"), exts))
    if not recursive:
        rows = rows.where(paths.depth(F.col("relative_path")) == 1)
    return with_header(rows.select(F.col("relative_path").alias("sample_id"), F.col("path").alias("source_path"), "relative_path", "length", "content"))


def with_header(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_h", image_header(F.substring("content", 1, HEADER_BYTES))).select("*", "_h.*").drop("_h")


def decodes_all() -> bool:
    """Whether tasks can decode every format themselves."""
    return importlib.util.find_spec("PIL") is not None


def with_pixels(rows: DataFrame, spark: SparkSession, root: str) -> DataFrame:
    """Adds pixels as decoded by the JVM, for the formats that tasks cannot decode (JPEG, TIFF, GIF).

    Rows it cannot decode, and all others, keep their content alone; a row with pixels gives its content up, so no image
    is in the join twice.  Folders without such files are not read again.
    """
    kinds = rows.withColumn("_jvm", paths.suffix(F.col("source_path")).isin(*JVM_SUFFIXES))
    bare = lambda c: F.regexp_replace(c, "^file:/*", "/")
    pattern = "*.{" + ",".join(x[1:] + "," + x[1:].upper() for x in JVM_SUFFIXES) + "}"
    seen = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("image.*")
    rgb = seen.select(bare(F.url_decode("origin")).alias("_path"), "data", "nChannels", F.col("height").alias("pixel_height"), F.col("width").alias("pixel_width"))

    def turn(batches):
        import numpy as np

        for b in batches:
            b["pixels"] = [np.repeat(x.reshape(-1, n)[:, :3][:, ::-1], 1 if n >= 3 else 3, 1).tobytes() for x, n in ((np.frombuffer(d, np.uint8), n) for d, n in zip(b["data"], b["nChannels"]))]
            yield b[["_path", "pixels", "pixel_height", "pixel_width"]]

    rgb = rgb.mapInPandas(turn, "_path string, pixels binary, pixel_height int, pixel_width int")
    joined = kinds.where("_jvm").join(rgb, bare(F.col("source_path")) == rgb["_path"], "left").drop("_path")
    joined = joined.withColumn("content", F.when(F.col("pixels").isNull(), F.col("content")))
    plain = kinds.where("not _jvm").withColumns({"pixels": F.lit(None).cast("binary"), "pixel_height": F.lit(None).cast("int"), "pixel_width": F.lit(None).cast("int")})
    return joined.unionByName(plain).drop("_jvm")
