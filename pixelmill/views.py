"""Image-like views over tables without images: deterministic sizes, paths, pixels, boxes and answers.

Every document becomes an image: its path from source and language, its size from length and id, its pixels from all
bytes of its text (folded into 16 x 16 x 3 by sums modulo 256), with structure planted by id so that every branch of
the pixel operators is met.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelmill.config import IMAGE_EXTS
from pixelmill.functions import paths

SIDE = 16
SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tif", ".TIFF", ".txt", ".gif")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the image columns and the text; every fifth document lies at the root."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    name = F.concat(F.lit("doc_"), i.cast("string"), F.element_at(F.array(*map(F.lit, SUFFIXES)), (i % 9 + 1).cast("int")))
    rel = F.when(i % 5 == 0, name).otherwise(F.concat_ws("/", "source", "lang", name))
    width = F.when(i % 97 == 0, F.lit(0)).otherwise(64 + (F.col("n_chars") * 7) % 449).cast("int")
    return d.select(
        "doc_id", rel.alias("sample_id"), F.concat(F.lit("/data/in/"), rel).alias("source_path"), rel.alias("relative_path"),
        F.octet_length("text").cast("long").alias("length"), width.alias("width"), (64 + (i * 31) % 449).cast("int").alias("height"), "text",
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with a wanted suffix."""
    return samples(spark, sf_dir).where(paths.has_suffix(F.col("relative_path"), IMAGE_EXTS))


def fold_bytes(text: str | None) -> np.ndarray:
    """All bytes of a text, repeated to fill a whole number of rasters, summed by place modulo 256."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    n = SIDE * SIDE * 3
    if not len(data):
        return np.zeros((SIDE, SIDE, 3), np.uint8)
    return (np.resize(data, n * -(-len(data) // n)).reshape(-1, n).sum(0, dtype=np.int64) % 256).astype(np.uint8).reshape(SIDE, SIDE, 3)


def plant(image: np.ndarray, doc_id: int) -> np.ndarray:
    """Gray for every fifth id, then by the id modulo 7: flat, framed, too thick, two sides, vertical and horizontal seam."""
    out = image.copy()
    if doc_id % 5 == 0:
        out[:] = out[:, :, :1]
    kind = doc_id % 7
    if kind == 1:
        out[:] = 120
    if kind in (2, 4):
        out[:3] = out[-3:] = 20
    if kind == 2:
        out[:, :3] = 20
    if kind == 3:
        out[:6] = 20
    if kind == 5:
        out[:, :8], out[:, 8:] = 10, 240
    if kind == 6:
        out[:8], out[8:] = 10, 240
    return out


def boxes(doc_id: int) -> list[tuple[int, int, int, int]]:
    """No box, one that is too small, one, or two."""
    return [[], [(5, 5, 15, 15)], [(2, 2, 44, 44)], [(0, 0, 40, 40), (8, 8, 48, 48)]][doc_id % 4]


def with_raster(rows: DataFrame, planted: bool = True, scale: int = 1) -> DataFrame:
    """Pixels (and faces) in the place of the text; scale repeats every pixel."""

    @F.pandas_udf("pixels binary, pixel_height int, pixel_width int, faces array<struct<x1:int,y1:int,x2:int,y2:int>>")
    def raster(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        out = []
        for i, text in zip(ids, texts):
            image = plant(fold_bytes(text), int(i)) if planted else fold_bytes(text)
            out.append((image.repeat(scale, 0).repeat(scale, 1).tobytes(), SIDE * scale, SIDE * scale, [dict(zip(("x1", "y1", "x2", "y2"), x)) for x in boxes(int(i))]))
        return pd.DataFrame(out, columns=["pixels", "pixel_height", "pixel_width", "faces"])

    return rows.withColumn("_raster", raster("doc_id", "text")).select(*[c for c in rows.columns if c != "text"], "_raster.*")


def _pick(values: list[str], by: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


#: Raw answers by field: the value is picked by (doc_id + quality) divided by the step, modulo the list's length.
ANSWERS = {
    "person_count": (1, ["1", "1", "0", " 1 ", "N", "1", "2", "1"]),
    "gender": (2, ["male", "female", "uncertain", "robot"]),
    "head_visible": (3, ["yes", "no", "partial", " no", "maybe"]),
    "shot_type": (1, ["close_up", "half_body", "panorama"]),
    "clothes_visible": (1, ["yes", "no"]),
    "holding_object": (5, ["no", "yes", ""]),
    "obvious_makeup": (1, ["yes", "no", "N/A"]),
    "expression": (1, ["smile", "very happy", " ", "N/A", "calm face"]),
    "hair_visible": (2, ["yes", "no", "partial"]),
    "hair_color": (3, ["dark brown", "red", "N/A", ""]),
    "facial_features_clear": (1, ["yes", "unsure"]),
    "face_direction": (1, ["frontal", "back_view", "up"]),
    "hand_hold_feasible": (7, ["yes", "no"]),
    "person_prominence": (1, ["close", "medium", "far", "near"]),
    "person_size_in_frame": (1, ["large", "medium", "small"]),
}


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, file_name, answer): model answers as JSON text; some are cut off, some are no object, some lack a field."""
    key = F.col("doc_id") + F.col("quality")
    fields = [F.concat(F.lit(f'"{f}": "'), _pick(v, F.floor(key / step)), F.lit('"')) for f, (step, v) in ANSWERS.items()]
    partial = F.when(key % 6 == 0, F.slice(F.array(*fields), 1, 9)).otherwise(F.array(*fields))
    text = (
        F.when(F.col("doc_id") % 11 == 0, F.lit('{"person_count": '))
        .when(F.col("doc_id") % 13 == 0, F.lit("[1, 2]"))
        .otherwise(F.concat(F.lit("{"), F.array_join(partial, ", "), F.lit("}")))
    )
    return table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".png")).alias("file_name"), text.alias("answer"))
