"""Queries over the image views; each goes through the operator it is named after."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelmill import views
from pixelmill.config import IMAGE_EXTS, parse_config
from pixelmill.context import archive_path
from pixelmill.functions import kernels, labels, paths
from pixelmill.operators import duplicate, filters, labeler
from pixelmill.operators.base import BatchOperator
from pixelmill.plans import archive, chain
from pixelmill.plans.runner import label_counts, last_of_stem
from pixelmill.session import ship
from pixelmill.sources.codec import decode

QUERIES = {}


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


def _last(state: DataFrame) -> DataFrame:
    """The last trace entry as columns decision, reason, metrics."""
    e = F.element_at("trace", -1)
    return state.withColumns({"decision": e["decision"], "reason": e["reason"], "metrics": e["metrics"]})


def _metric(name: str, kind: str = "double"):
    return F.get_json_object("metrics", f"$.{name}").cast(kind)


# ---- scan, paths


@query
def scan_extension_filter(spark, sf_dir):
    return views.images(spark, sf_dir).select("sample_id", paths.suffix(F.col("sample_id")).alias("suffix"), "length")


@query
def scan_nonrecursive(spark, sf_dir):
    return views.images(spark, sf_dir).where(paths.depth(F.col("relative_path")) == 1).select("sample_id")


@query
def path_component_order(spark, sf_dir):
    rows = views.samples(spark, sf_dir).select("sample_id")
    return paths.ranked(rows, paths.order_key(F.col("sample_id")), "position").select("sample_id", "position")


# ---- column operators


@query
def aspect_ratio(spark, sf_dir):
    s = _last(chain.apply_chain(views.images(spark, sf_dir), [filters.AspectRatio()]))
    return s.select("sample_id", "decision", "reason", _metric("width", "long").alias("width"), _metric("height", "long").alias("height"), _metric("ratio").alias("ratio"))


@query
def compression_quality(spark, sf_dir):
    s = _last(chain.apply_chain(views.images(spark, sf_dir), [filters.CompressionQuality(0.01)]))
    return s.select("sample_id", "decision", "reason", _metric("theoretical_size", "long").alias("theoretical_size"), F.round(_metric("compression_ratio"), 9).alias("compression_ratio"))


@query
def operator_error_path(spark, sf_dir):
    s = chain.apply_chain(views.images(spark, sf_dir), [filters.AspectRatio(), filters.CompressionQuality(0.01)])
    return s.where("status = 'ERROR'").select("sample_id", "rejected_by", "reject_reason", F.size("trace").cast("long").alias("n_trace"))


# ---- kernels


def _pixels(spark, sf_dir, operators, **how):
    rows = views.with_raster(views.images(spark, sf_dir), **how)
    return _last(chain.apply_chain(rows, operators))


FRAME = filters.FrameBox(min_thick=2)


@query
def gray_style(spark, sf_dir):
    return _pixels(spark, sf_dir, [filters.GrayStyle()]).select("sample_id", "decision", "reason", _metric("max_channel_diff").alias("max_channel_diff"))


@query
def image_std(spark, sf_dir):
    return _pixels(spark, sf_dir, [FRAME]).select("sample_id", F.round(_metric("std"), 6).alias("std"))


@query
def framebox_thickness(spark, sf_dir):
    s = _pixels(spark, sf_dir, [FRAME]).where(_metric("top").isNotNull())
    return s.select("sample_id", *[_metric(x, "long").alias(x) for x in ("top", "bottom", "left", "right")])


@query
def framebox(spark, sf_dir):
    return _pixels(spark, sf_dir, [FRAME]).select("sample_id", "decision", "reason")


def _kernel_rows(spark, sf_dir, f, schema: str, scale: int = 1):
    """Rows that a function makes of (sample_id, gray, doc_id)."""
    from pixelmill.sources.codec import open_row

    def run(batches):
        for b in batches:
            yield pd.DataFrame([x for r in b.to_dict("records") for x in f(r["sample_id"], kernels.luma(open_row(r)), int(r["doc_id"]))], columns=[c.split()[0] for c in schema.split(", ")])

    rows = views.with_raster(views.images(spark, sf_dir), scale=scale)
    return rows.select("sample_id", "doc_id", "pixels", "pixel_height", "pixel_width").mapInPandas(run, schema)


@query
def stitch_projection(spark, sf_dir):
    def lines(sample, gray, _):
        for axis, p in zip(("vertical", "horizontal"), kernels.projections(gray)):
            found = kernels.peak(p)
            yield (sample, axis, None, None) if found is None else (sample, axis, found[1], round(found[2], 6))

    rows = _kernel_rows(spark, sf_dir, lines, "sample_id string, axis string, position double, prominence double")
    return rows.select("sample_id", "axis", F.when(~F.isnan("position"), F.col("position")).cast("long").alias("position"), F.when(~F.isnan("prominence"), F.col("prominence")).alias("prominence"))


@query
def stitch(spark, sf_dir):
    return _pixels(spark, sf_dir, [filters.StitchLine(prominence=3.0)]).select("sample_id", "decision", "reason")


@query
def laplacian_score(spark, sf_dir):
    rows = _kernel_rows(spark, sf_dir, lambda s, gray, _: [(s, kernels.laplacian_variance(gray))], "sample_id string, score double")
    return rows.select("sample_id", F.round("score", 4).alias("score"))


@query
def person_blur(spark, sf_dir):
    s = _pixels(spark, sf_dir, [filters.PersonBlur(face_thr=8000.0)], scale=3)
    return s.select("sample_id", "decision", "reason", F.get_json_object("metrics", "$.used").alias("used"), F.round(_metric("score"), 4).alias("score"))


# ---- duplicates


HASHER = duplicate.Duplicate(threshold=9, hash_size=8, hasher=kernels.block_hash)


def _sized(rows: DataFrame) -> DataFrame:
    return rows.withColumn("length", F.col("length") + (F.col("doc_id") * 13) % 5)


@query
def block_hash(spark, sf_dir):
    rows = views.with_raster(views.images(spark, sf_dir), planted=False)
    return HASHER.hashes(rows).select("sample_id", F.lpad(F.bin(F.col("words")[0]), 64, "0").alias("bits"))


@query
def hamming_pairs(spark, sf_dir):
    def run(batches):
        for b in batches:
            vectors = b.column("embedding")
            n, values = vectors.value_lengths().to_numpy(), vectors.flatten()
            bits, known = kernels.above_median(n, values.fill_null(0.0).to_numpy(), values.is_valid().to_numpy(zero_copy_only=False))
            yield pa.record_batch([b.column("vec_id"), pa.array(n, pa.int32()), pa.array(bits, pa.binary()), pa.array(known, pa.binary())], ["vec_id", "n", "words", "known"])

    rows = views.table(spark, sf_dir, "embeddings").where("embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    signs = rows.mapInArrow(run, "vec_id long, n int, words binary, known binary")
    named = signs.groupBy("n", "words", "known").agg(F.min("vec_id").alias("id"))
    return duplicate.tiled_pairs(named, 16).select(F.col("a").alias("vec_a"), F.col("b").alias("vec_b"), "distance")


def _duplicates(spark, sf_dir):
    rows = _sized(views.with_raster(views.images(spark, sf_dir), planted=False))
    return HASHER.process_batch(rows)


@query
def duplicate_decisions(spark, sf_dir):
    return _duplicates(spark, sf_dir).select("sample_id", "decision", F.get_json_object("metrics", "$.keeper").alias("keeper"), _metric("hamming_distance", "long").alias("distance"))


@query
def duplicate_summary(spark, sf_dir):
    return _duplicates(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("n"))


# ---- chains


def _two(spark, sf_dir):
    return chain.apply_chain(views.images(spark, sf_dir), [filters.AspectRatio(), filters.CompressionQuality(0.01)])


@query
def chain_two_ops(spark, sf_dir):
    return _two(spark, sf_dir).select("sample_id", "status", "rejected_by", "reject_reason", F.size("trace").cast("long").alias("n_trace"))


@query
def chain_full(spark, sf_dir):
    rows = _sized(views.with_raster(views.images(spark, sf_dir)))
    state = chain.apply_chain(rows, [filters.AspectRatio(), filters.GrayStyle(), FRAME, HASHER])
    names = F.array_join(F.transform("trace", lambda t: F.concat(t["name"], F.lit(":"), t["decision"])), ",")
    return state.select("sample_id", "status", "rejected_by", "reject_reason", names.alias("trace"))


@query
def short_circuit_counts(spark, sf_dir):
    rows = views.with_raster(views.images(spark, sf_dir))
    state = chain.apply_chain(rows, [filters.AspectRatio(), filters.GrayStyle(), FRAME])
    t = state.select(F.explode("trace").alias("t")).select("t.*")
    return t.groupBy(F.col("name").alias("operator")).agg(F.count("*").alias("seen"), F.count_if(F.col("decision") == "REJECT").alias("rejected"), F.count_if(F.col("decision") == "ERROR").alias("errors"))


class EveryThird(BatchOperator):
    """Rejects documents whose id is divisible by three and says nothing of the others."""

    name = "every_third"

    def process_batch(self, active: DataFrame) -> DataFrame:
        return active.where(F.col("doc_id") % 3 == 0).select("sample_id", F.lit("REJECT").alias("decision"), F.lit("third").alias("reason"), F.lit("{}").alias("metrics"))


@query
def batch_default_pass(spark, sf_dir):
    state = _last(chain.apply_chain(views.images(spark, sf_dir).drop("text"), [filters.AspectRatio(), EveryThird()]))
    return state.select("sample_id", "status", "decision", F.size("trace").cast("long").alias("n_trace"))


# ---- archive, manifest, summary


def _archived(spark, sf_dir, layout):
    path = archive_path(F.col("relative_path"), "/data/out", "run1", layout)
    return views.images(spark, sf_dir).select("sample_id", path.alias("archive_path"))


for _layout in ("run_subdir", "flat", "preserve_relative"):
    def _f(spark, sf_dir, _layout=_layout):
        return _archived(spark, sf_dir, _layout)

    _f.__name__ = "archive_path_" + _layout.removesuffix("_relative")
    query(_f)


def _closed(spark, sf_dir, overwrite=False):
    state = _two(spark, sf_dir)
    path = F.concat(F.lit("/data/out/doc_"), (F.col("doc_id") % 100).cast("string"))
    return archive.close(archive.resolve_conflicts(state, path, overwrite))


@query
def archive_conflicts(spark, sf_dir):
    return _closed(spark, sf_dir).select("sample_id", "status", "rejected_by", "archive_path")


@query
def archive_overwrite(spark, sf_dir):
    state = _two(spark, sf_dir)
    path = F.concat(F.lit("/data/out/doc_"), (F.col("doc_id") % 100).cast("string"))
    return archive.resolve_conflicts(state, path, True).where("status = 'PENDING'").select("sample_id", "archive_path", "copies")


@query
def manifest_rows(spark, sf_dir):
    m = archive.manifest(_closed(spark, sf_dir))
    names = F.array_join(F.transform("operator_trace", lambda t: F.concat(t["name"], F.lit(":"), t["decision"])), ",")
    return m.withColumn("operator_trace", names)


@query
def run_summary(spark, sf_dir):
    return archive.counts(_closed(spark, sf_dir))


@query
def reject_by_operator(spark, sf_dir):
    return archive.reject_by_operator(_closed(spark, sf_dir))


# ---- labels


def _annotated(spark, sf_dir):
    rows = views.answers(spark, sf_dir).withColumn("raw", labels.parse(F.col("answer")))
    return rows.withColumn("a", F.when(F.col("raw").isNotNull(), labels.normalise(F.col("raw"), F.col("file_name"))))


@query
def label_parse_json(spark, sf_dir):
    a = _annotated(spark, sf_dir)
    return a.select("doc_id", F.col("raw").isNotNull().alias("parsed"), F.try_element_at("raw", F.lit("person_count")).alias("person_count"))


@query
def label_choice(spark, sf_dir):
    a = _annotated(spark, sf_dir).where("raw is not null")
    get = lambda f: F.try_element_at("raw", F.lit(f))
    return a.select("doc_id", *[labels.choice(get(f), labels.VOCABULARY[f]).alias(f) for f in ("person_count", "head_visible", "gender", "holding_object")])


@query
def label_one_word(spark, sf_dir):
    a = _annotated(spark, sf_dir).where("raw is not null")
    get = lambda f: F.try_element_at("raw", F.lit(f))
    return a.select("doc_id", *[labels.one_word(get(f)).alias(f) for f in ("expression", "hair_color")])


@query
def label_normalize(spark, sf_dir):
    return _annotated(spark, sf_dir).where("a is not null").select("doc_id", "a.*")


@query
def label_head_not_visible(spark, sf_dir):
    a = _annotated(spark, sf_dir).where("a.person_count = '1' and a.head_visible = 'no'")
    return a.select("doc_id", *[F.col("a")[f].alias(f) for f in (*labels.HEADLESS, "hair_visible", "gender")])


@query
def label_multi_person(spark, sf_dir):
    a = _annotated(spark, sf_dir).where("a.person_count <> '1'")
    rest = [F.col("a")[f] for f in labels.FIELDS[1:]]
    return a.select("doc_id", F.col("a")["person_count"].alias("person_count"), F.array_join(F.array_distinct(F.array(*rest)), ",").alias("rest"))


@query
def label_summary(spark, sf_dir):
    return label_counts(_annotated(spark, sf_dir).select(F.to_json("a").alias("labels")))


@query
def vocabulary_audit(spark, sf_dir):
    a = _annotated(spark, sf_dir).where("a is not null").select("a.*")
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in labels.FIELDS]))
    return a.select(pairs.alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


# ---- sizes, stems, payloads, configuration


def _resized(spark, sf_dir, fit):
    """Sizes as the operators' own function gives them."""

    @F.pandas_udf("height long, width long")
    def size(h: pd.Series, w: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fit(int(a), int(b)) for a, b in zip(h, w)], columns=["height", "width"])

    rows = views.images(spark, sf_dir).where("width > 0")
    return rows.select("sample_id", size("height", "width").alias("s")).select("sample_id", "s.width", "s.height")


@query
def label_resize_dims(spark, sf_dir):
    return _resized(spark, sf_dir, lambda h, w: labeler.fit_pixels(h, w, 50_000))


@query
def downscale_dims(spark, sf_dir):
    return _resized(spark, sf_dir, lambda h, w: kernels.fit_side(h, w, 256))


@query
def annotation_stem_collisions(spark, sf_dir):
    name = F.concat(F.lit("/data/in/img"), (F.col("doc_id") % 50).cast("string"), F.lit(".x"), paths.suffix(F.col("sample_id")))
    found = last_of_stem(views.images(spark, sf_dir).select("sample_id", name.alias("source_path")))
    return found.select("stem", "n", F.col("sample_id").alias("last_sample"))


@query
def data_url(spark, sf_dir):
    """A text's bytes as one line of pixels, sent as the labeler sends an image and read back by the decoder."""

    @F.pandas_udf("head string, pixels_md5 string")
    def sent(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            data = (text or "").encode()
            data += b" " * (-len(data) % 3 or 3 * (not data))
            head, body = labeler.data_url(np.frombuffer(data, np.uint8).reshape(1, -1, 3)).split(",")
            back = decode(base64.b64decode(body))
            out.append((head, hashlib.md5(back.tobytes()).hexdigest()))
        return pd.DataFrame(out, columns=["head", "pixels_md5"])

    return views.table(spark, sf_dir, "documents").select("doc_id", sent("text").alias("s")).select("doc_id", "s.*")


CONFIG = {
    "input": {"input_dir": "/in", "image_exts": [x.upper() for x in IMAGE_EXTS]},
    "output": {"run_root": "/runs", "pass_archive_dir": "/out"},
    "filter": {"operators": [{"name": "aspect_ratio"}, {"name": "gray_style", "enabled": False}, {"name": "framebox"}, {"name": "duplicate", "params": {"threshold": 9}}]},
    "label": {"operator": {"name": "person_attribute_labeler"}},
}


@query
def config_operator_order(spark, sf_dir):
    ops = parse_config(CONFIG).filter.enabled_operators()
    return spark.createDataFrame([(k, o.name) for k, o in enumerate(ops)], "position long, operator string")
