"""Whole runs: filter, label, all."""

from __future__ import annotations

import json
import shutil
import time
import uuid
from datetime import datetime
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixelmill.config import PipelineConfig
from pixelmill.context import RunContext, new_run_id
from pixelmill.functions.paths import base_name, order_key, stem
from pixelmill.operators.base import ColumnOperator, LabelOperator
from pixelmill.plans import archive, chain
from pixelmill.registry import Registry, default_registry
from pixelmill.schema import LABEL
from pixelmill.session import cut, ship
from pixelmill.sources import images, jsonl


def _now() -> str:
    return datetime.now().astimezone().isoformat(timespec="seconds")


class PipelineRunner:
    """Runs a configuration.  honor_settings: also obey label.enabled, annotation_dir and jsonl_path, which are
    otherwise read and ignored."""

    def __init__(self, spark: SparkSession, config: PipelineConfig, registry: Registry | None = None, run_id: str | None = None, honor_settings: bool = False):
        ship(spark)
        self.spark, self.config, self.registry = spark, config, registry or default_registry()
        self.run_id, self.honor = run_id or new_run_id(), honor_settings
        out = config.output
        self.context = RunContext(self.run_id, Path(out.run_root) / self.run_id, str(out.pass_archive_dir), out.pass_archive_layout)

    def _begin(self) -> tuple[str, float]:
        import yaml

        begun = _now(), time.monotonic()
        self.context.prepare()
        self.context.snapshot.write_text(yaml.safe_dump(self.config.snapshot(), sort_keys=False, allow_unicode=True), encoding="utf-8")
        return begun

    def _finish(self, begun: tuple[str, float], stage: str, found: dict[str, Any], path: Path) -> dict[str, Any]:
        summary = {"run_id": self.run_id, "stage": stage, **found, "started_at": begun[0], "finished_at": _now(), "duration_seconds": round(time.monotonic() - begun[1], 3)}
        jsonl.write_document(path, summary)
        return summary

    def run_filter(self) -> dict[str, Any]:
        begun = self._begin()
        source, out = self.config.input, self.config.output
        operators = [self.registry.create(o.name, o.params) for o in self.config.filter.enabled_operators()]
        found = self._scan(source.input_dir, source.recursive)
        if any(not isinstance(op, ColumnOperator) for op in operators) and not images.decodes_all():
            found = images.with_pixels(found, self.spark, source.input_dir)
        state = chain.without_bytes(chain.apply_chain(found, operators))
        state = cut(archive.resolve_conflicts(state, self.context.archive_path(F.col("relative_path")), out.overwrite))
        claims = self.context.logs / f"claims-{uuid.uuid4().hex}"
        claims.mkdir(parents=True)
        copied = archive.copy_files(state.where("copies").select("sample_id", "source_path", "archive_path"), out.overwrite, str(claims))
        copied = cut(copied.withColumnRenamed("sample_id", "_id"))
        shutil.rmtree(claims, ignore_errors=True)
        closed = cut(archive.close(state.join(copied, state["sample_id"] == copied["_id"], "left"), F.col("copy_error")).drop("_id", "copy_error"))
        jsonl.write_rows(archive.manifest(closed), order_key(F.col("sample_id")), manifest_line, self.context.manifest)
        totals = archive.counts(closed).first().asDict()
        totals["reject_by_operator"] = {r["operator"]: r["n"] for r in archive.reject_by_operator(closed).collect()}
        return self._finish(begun, "filter", totals, self.context.summary)

    def _scan(self, root: str, recursive: bool) -> DataFrame:
        """Listed by the driver and read by tasks; a root with a scheme goes through Spark's own reader."""
        read = images.scan_remote if "://" in root else images.scan
        return read(self.spark, root, recursive, self.config.input.image_exts)

    def _label_root(self) -> str:
        given = self.config.label.input_dir
        return f"{self.config.output.pass_archive_dir}/{self.run_id}" if given == "auto" else given

    def run_label(self) -> dict[str, Any]:
        if self.honor and not self.config.label.enabled:
            return {"run_id": self.run_id, "stage": "label", "input_total": 0, "labeled": 0, "failed": 0}
        begun = self._begin()
        label = self.config.label
        operator = self.registry.create(label.operator.name, label.operator.params)
        if not isinstance(operator, LabelOperator):
            raise TypeError(f"Configured label operator is not a LabelOperator: {label.operator.name}")
        found = self._scan(self._label_root(), True)
        if not images.decodes_all():
            found = images.with_pixels(found, self.spark, self._label_root())
        labels = cut(label_images(found, operator))
        folder = label.annotation_dir if self.honor and label.annotation_dir != "auto" else str(self.context.annotations)
        lines = Path(label.jsonl_path) if self.honor and label.jsonl_path != "auto" else self.context.labels
        done, name = labels.where("labels is not null"), operator.name

        def document(row: dict[str, Any]) -> tuple[str, Any]:
            return f"{folder}/{row['stem']}.json", {"meta": {"operator": name, "input_image": row["file"]}, "annotation": json.loads(row["labels"])}

        jsonl.write_documents(last_of_stem(done).select("stem", "file", "labels"), document)
        n = jsonl.write_rows(done.select("sample_id", "labels"), order_key(F.col("sample_id")), lambda row: row["labels"], lines)
        total = labels.count()
        return self._finish(begun, "label", {"input_total": total, "labeled": n, "failed": total - n}, self.context.label_summary)

    def run_all(self) -> dict[str, Any]:
        return {"filter": self.run_filter(), "label": self.run_label()}


def manifest_line(row: dict[str, Any]) -> str:
    trace = [{**t, "metrics": json.loads(t["metrics"])} for t in row["operator_trace"]]
    return json.dumps({**row, "operator_trace": trace}, ensure_ascii=False)


def last_of_stem(labels: DataFrame) -> DataFrame:
    """Images of one stem share an annotation file: of each the last in sample order, with file, stem and how many (n)."""
    file = base_name(F.col("source_path"))
    one = Window.partitionBy("stem")
    rows = labels.withColumn("file", file).withColumn("stem", stem(F.col("file")))
    rows = rows.withColumn("n", F.count("*").over(one)).withColumn("_r", F.row_number().over(one.orderBy(order_key(F.col("sample_id")).desc())))
    return rows.where("_r = 1").drop("_r")


def label_images(found: DataFrame, operator: LabelOperator) -> DataFrame:
    """(sample_id, source_path, decision, reason, labels): labels as JSON where the decision is LABEL.

    A task has its own operator, so the number of partitions bounds the requests that run at a time.
    """

    def run(batches):
        operator.setup()
        try:
            for b in batches:
                rows = b.to_dict("records")
                out = [(r["sample_id"], r["source_path"], x.decision, x.reason, json.dumps(x.labels, ensure_ascii=False) if x.decision == LABEL and x.labels is not None else None) for r, x in zip(rows, operator.label(iter(rows)))]
                yield pd.DataFrame(out, columns=["sample_id", "source_path", "decision", "reason", "labels"])
        finally:
            operator.teardown()

    keep = [c for c in ("sample_id", "source_path", "content", "pixels", "pixel_height", "pixel_width") if c in found.columns]
    return found.select(*keep).mapInPandas(run, "sample_id string, source_path string, decision string, reason string, labels string")


def label_counts(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count("*").alias("input_total"), F.count("labels").alias("labeled"), F.count_if(F.col("labels").isNull()).alias("failed"))
