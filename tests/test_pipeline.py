"""Runs over image files: scan, chain, archive, manifest, labels, stream, configuration."""

from __future__ import annotations

import json

import numpy as np
import pytest

from pixelmill import cli
from pixelmill.config import load_config, parse_config
from pixelmill.operators.base import KernelOperator, LabelOperator
from pixelmill.plans.runner import PipelineRunner
from pixelmill.registry import Registry, default_registry
from pixelmill.schema import failed, labelled, passed, rejected
from pixelmill.sources import images, jsonl
from tests.images import save, solid


def config(tmp_path, operators, **output):
    return {
        "input": {"input_dir": str(tmp_path / "in")},
        "output": {"run_root": str(tmp_path / "runs"), "pass_archive_dir": str(tmp_path / "out"), **output},
        "filter": {"operators": operators},
        "label": {"operator": {"name": "constant"}},
    }


class RejectName(KernelOperator):
    name = "reject_name"

    def __init__(self, part="bad"):
        self.part = part

    def process(self, image, row):
        return rejected("name", {"part": self.part}) if self.part in row["sample_id"] else passed()


class Fails(KernelOperator):
    name = "fails"

    def process(self, image, row):
        raise RuntimeError("boom")


class Constant(LabelOperator):
    name = "constant"

    def label(self, rows):
        for row in rows:
            yield failed("no") if "c" in row["sample_id"] else labelled({"file_name": row["source_path"].rsplit("/", 1)[-1], "kind": "é"})


def registry():
    r = default_registry()
    for c in (RejectName, Fails, Constant):
        r.register(c.name, c)
    return r


def test_registry_names():
    assert default_registry().names() == ["aspect_ratio", "compression_quality", "duplicate", "framebox", "gray_style", "person_attribute_labeler", "person_blur", "stitch_v2"]
    with pytest.raises(KeyError, match="nothing"):
        Registry().create("nothing")
    with pytest.raises(TypeError):
        default_registry().create("gray_style", {"odd": 1})


def test_config_defaults_and_errors(tmp_path):
    c = parse_config(config(tmp_path, [{"name": "a"}, {"name": "b", "enabled": False}]))
    assert [o.name for o in c.filter.enabled_operators()] == ["a"] and c.input.recursive and ".webp" in c.input.image_exts
    with pytest.raises(ValueError, match="input.input_dir"):
        parse_config({"output": {}})
    bare = parse_config({k: v for k, v in config(tmp_path, []).items() if k not in ("filter", "label")})
    assert bare.filter.operators == [] and bare.label.operator.name == "person_attribute_labeler" and bare.label.enabled
    assert list(bare.snapshot()) == ["input", "output", "filter", "label"] and type(bare.snapshot()["label"]) is dict
    for key in ("run_root", "pass_archive_dir"):
        with pytest.raises(ValueError, match=f"output.{key}"):
            parse_config({**(c := config(tmp_path, [])), "output": {k: v for k, v in c["output"].items() if k != key}})
    with pytest.raises(ValueError, match="layout"):
        parse_config(config(tmp_path, [], pass_archive_layout="odd"))


def test_scan_order_and_hidden_files(spark, tmp_path):
    for name in ("a/z.png", "a-x/z.png", "a.PNG", ".hid.png", "_under.png", "sp ace.bmp"):
        solid(tmp_path / name, 4, 3)
    (tmp_path / ".png").write_bytes(b"")
    (tmp_path / "notes.txt").write_text("x")
    rows = images.scan(spark, str(tmp_path), exts=[".png", ".bmp"]).collect()
    assert [r["sample_id"] for r in rows] == [".hid.png", "_under.png", "a/z.png", "a-x/z.png", "a.PNG", "sp ace.bmp"]
    assert {(r["width"], r["height"]) for r in rows} == {(4, 3)}
    flat = images.scan(spark, str(tmp_path), recursive=False, exts=[".png"])
    assert [r["sample_id"] for r in flat.collect()] == [".hid.png", "_under.png", "a.PNG"]
    assert images.scan(spark, str(tmp_path / "none")).count() == 0
    assert {r["sample_id"] for r in images.scan_remote(spark, str(tmp_path), exts=[".png"]).collect()} == {"a/z.png", "a-x/z.png", "a.PNG"}


def test_filter_run(spark, tmp_path):
    solid(tmp_path / "in/good.png", 100, 80)
    solid(tmp_path / "in/wide.png", 300, 50)
    solid(tmp_path / "in/sub/bad.png", 40, 40)
    (tmp_path / "in/junk.jpg").write_bytes(b"junk")
    runner = PipelineRunner(spark, parse_config(config(tmp_path, [{"name": "aspect_ratio"}, {"name": "reject_name"}, {"name": "gray_style"}])), registry(), "r1")
    summary = runner.run_filter()
    assert {k: summary[k] for k in ("input_total", "passed", "rejected", "errors", "reject_by_operator")} == {"input_total": 4, "passed": 1, "rejected": 2, "errors": 1, "reject_by_operator": {"reject_name": 1, "aspect_ratio": 1}}
    rows = {r["sample_id"]: r for r in jsonl.read_lines(tmp_path / "runs/r1/manifest.jsonl")}
    assert list(rows) == ["good.png", "junk.jpg", "sub/bad.png", "wide.png"]
    assert [t["name"] for t in rows["good.png"]["operator_trace"]] == ["aspect_ratio", "reject_name", "gray_style"]
    assert rows["good.png"]["archive_path"] == str(tmp_path / "out/r1/good.png") and (tmp_path / "out/r1/good.png").exists()
    assert [t["name"] for t in rows["sub/bad.png"]["operator_trace"]] == ["aspect_ratio", "reject_name"] and rows["sub/bad.png"]["archive_path"] is None
    assert rows["junk.jpg"]["status"] == "ERROR" and rows["junk.jpg"]["reject_reason"].startswith("image_open_failed")
    assert rows["wide.png"]["operator_trace"][0]["metrics"] == {"width": 300, "height": 50, "ratio": 6.0, "threshold": 2.0}
    assert (tmp_path / "runs/r1/config.snapshot.yaml").exists() and json.loads((tmp_path / "runs/r1/summary.json").read_text()) == summary


def test_operator_exception_is_an_error(spark, tmp_path):
    solid(tmp_path / "in/a.png", 10, 10)
    runner = PipelineRunner(spark, parse_config(config(tmp_path, [{"name": "fails"}, {"name": "gray_style"}])), registry(), "r1")
    assert runner.run_filter()["errors"] == 1
    assert jsonl.read_lines(tmp_path / "runs/r1/manifest.jsonl")[0]["reject_reason"].startswith("operator_exception")


def test_flat_layout_conflict_and_second_run(spark, tmp_path):
    for name in ("a/x.png", "b/x.png"):
        solid(tmp_path / "in" / name, 10, 10)
    c = config(tmp_path, [], pass_archive_layout="flat")
    assert PipelineRunner(spark, parse_config(c), registry(), "r1").run_filter()["errors"] == 1
    rows = jsonl.read_lines(tmp_path / "runs/r1/manifest.jsonl")
    assert [(r["sample_id"], r["status"]) for r in rows] == [("a/x.png", "PASS"), ("b/x.png", "ERROR")]
    over = config(tmp_path, [], pass_archive_layout="flat", overwrite=True)
    assert PipelineRunner(spark, parse_config(over), registry(), "r2").run_filter()["passed"] == 2


def test_duplicates_in_a_run(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (64, 64, 3)).astype(np.uint8)
    for name, image in (("a.png", x), ("b.png", x), ("c.png", rng.integers(0, 256, (64, 64, 3)).astype(np.uint8))):
        save(tmp_path / "in" / name, image)
    summary = PipelineRunner(spark, parse_config(config(tmp_path, [{"name": "duplicate"}])), registry(), "r1").run_filter()
    assert summary["reject_by_operator"] == {"duplicate": 1} and summary["passed"] == 2


def test_label_and_all(spark, tmp_path):
    for name in ("a.png", "b.png", "c.png"):
        solid(tmp_path / "in" / name, 10, 10)
    found = PipelineRunner(spark, parse_config(config(tmp_path, [])), registry(), "r1").run_all()
    assert found["filter"]["passed"] == 3
    assert {k: found["label"][k] for k in ("input_total", "labeled", "failed")} == {"input_total": 3, "labeled": 2, "failed": 1}
    assert json.loads((tmp_path / "runs/r1/annotations/a.json").read_text()) == {"meta": {"operator": "constant", "input_image": "a.png"}, "annotation": {"file_name": "a.png", "kind": "é"}}
    assert [r["file_name"] for r in jsonl.read_lines(tmp_path / "runs/r1/labels.jsonl")] == ["a.png", "b.png"]
    odd = config(tmp_path, [])
    odd["label"]["operator"]["name"] = "gray_style"
    with pytest.raises(TypeError):
        PipelineRunner(spark, parse_config(odd), registry(), "r2").run_label()


def test_cli(spark, tmp_path, capsys):
    import yaml

    solid(tmp_path / "in/good.png", 100, 100)
    solid(tmp_path / "in/bad.png", 300, 50)
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(config(tmp_path, [{"name": "aspect_ratio", "params": {"ratio": 2.0}}])))
    assert load_config(tmp_path / "c.yaml").filter.operators[0].params == {"ratio": 2.0}
    assert cli.main(["run", "--stage", "filter", "--config", str(tmp_path / "c.yaml"), "--run-id", "r"], spark) == 0
    assert "'passed': 1" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.parse_args(["run", "--stage", "odd", "--config", "x"])


def test_stream(spark, tmp_path):
    from pixelmill.operators.duplicate import Duplicate
    from pixelmill.operators.filters import AspectRatio, GrayStyle
    from pixelmill.streaming import ingest

    solid(tmp_path / "in/good.png", 100, 80)
    solid(tmp_path / "in/sub/wide.png", 300, 50)
    rows = ingest.read_images(spark, str(tmp_path / "in"), [".png"])
    ingest.start_filter(rows, [AspectRatio(), GrayStyle()], str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    assert {(r["sample_id"], r["status"]) for r in spark.read.parquet(str(tmp_path / "state")).collect()} == {("good.png", "PENDING"), ("sub/wide.png", "REJECT")}
    with pytest.raises(TypeError):
        ingest.start_filter(rows, [Duplicate()], "x", "y")


def jpeg(spark, path, image):
    """Written by the JVM's own encoder."""
    path.parent.mkdir(parents=True, exist_ok=True)
    jvm = spark._jvm
    h, w = image.shape[:2]
    out = jvm.java.awt.image.BufferedImage(w, h, 1)
    for y in range(h):
        for x in range(w):
            r, g, b = (int(v) for v in image[y, x])
            out.setRGB(x, y, r << 16 | g << 8 | b)
    assert jvm.javax.imageio.ImageIO.write(out, "jpg", jvm.java.io.File(str(path)))


class Counted(KernelOperator):
    """Leaves a file for every call."""

    name = "counted"

    def __init__(self, folder):
        self.folder = folder

    def process(self, image, row):
        import os
        import uuid

        open(os.path.join(self.folder, uuid.uuid4().hex), "w").close()
        return passed({"height": image.shape[0]})


def test_jpeg_run_with_duplicates_opens_every_image_once(spark, tmp_path):
    rng = np.random.default_rng(1)
    grid = np.kron(rng.integers(0, 256, (4, 4, 3)), np.ones((6, 8, 1))).astype(np.uint8)
    jpeg(spark, tmp_path / "in/a.jpg", grid)
    jpeg(spark, tmp_path / "in/sub/b c.JPEG", grid)
    jpeg(spark, tmp_path / "in/gray.jpg", np.full((24, 32, 3), 120, np.uint8))
    save(tmp_path / "in/c.png", rng.integers(0, 256, (24, 32, 3)).astype(np.uint8))
    (tmp_path / "calls").mkdir()
    r = registry()
    r.register("counted", Counted)
    steps = [{"name": "counted", "params": {"folder": str(tmp_path / "calls")}}, {"name": "gray_style"}, {"name": "duplicate"}, {"name": "reject_name"}, {"name": "aspect_ratio"}]
    summary = PipelineRunner(spark, parse_config(config(tmp_path, steps)), r, "r1").run_filter()
    assert {k: summary[k] for k in ("passed", "rejected", "errors")} == {"passed": 2, "rejected": 2, "errors": 0}
    assert summary["reject_by_operator"] == {"duplicate": 1, "gray_style": 1}
    assert len(list((tmp_path / "calls").iterdir())) == 4


def test_second_run_and_foreign_targets_are_conflicts(spark, tmp_path):
    import shutil

    solid(tmp_path / "in/a.png", 10, 10)
    solid(tmp_path / "in/b.png", 10, 10)
    c = parse_config(config(tmp_path, []))
    assert PipelineRunner(spark, c, registry(), "r1").run_filter()["passed"] == 2
    assert PipelineRunner(spark, c, registry(), "r1").run_filter()["errors"] == 2
    rows = jsonl.read_lines(tmp_path / "runs/r1/manifest.jsonl")
    want = f"archive_copy_failed: {FileExistsError(f'Archive path already exists: {tmp_path}/out/r1/a.png')!r}"
    assert rows[0]["reject_reason"] == want and rows[0]["rejected_by"] == "archive"
    # a target of the same size and time that somebody else put there
    (tmp_path / "out/r2").mkdir(parents=True)
    shutil.copy2(tmp_path / "in/b.png", tmp_path / "out/r2/b.png")
    found = PipelineRunner(spark, c, registry(), "r2").run_filter()
    assert (found["passed"], found["errors"]) == (1, 1)
    assert not [p for p in (tmp_path / "out").rglob("*.part")] and not [p for p in (tmp_path / "runs").rglob("*claims*")]


def test_copy_knows_its_own_work_when_it_runs_again(spark, tmp_path):
    from pixelmill.plans import archive

    solid(tmp_path / "a.png", 10, 10)
    (tmp_path / "claims").mkdir()
    rows = spark.createDataFrame([("a.png", str(tmp_path / "a.png"), str(tmp_path / "out/a.png"))], "sample_id string, source_path string, archive_path string")
    copy = archive.copy_files(rows, False, str(tmp_path / "claims"))
    assert [r["copy_error"] for r in copy.collect()] == [None]
    assert [r["copy_error"] for r in copy.collect()] == [None]
    (tmp_path / "again").mkdir()
    assert "already exists" in archive.copy_files(rows, False, str(tmp_path / "again")).first()["copy_error"]


def test_remote_root_in_a_run(spark, tmp_path):
    solid(tmp_path / "in/a.png", 10, 10)
    c = config(tmp_path, [{"name": "aspect_ratio"}])
    c["input"]["input_dir"] = f"file://{tmp_path}/in"
    assert PipelineRunner(spark, parse_config(c), registry(), "r1").run_filter()["passed"] == 1


def test_lines_and_documents(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.range(500).select(F.col("id"), F.lit(None).cast("string").alias("none")).repartition(5)
    n = jsonl.write_rows(rows, F.col("id"), lambda r: json.dumps(r), tmp_path / "x/rows.jsonl")
    assert n == 500 and jsonl.read_lines(tmp_path / "x/rows.jsonl") == [{"id": k, "none": None} for k in range(500)]
    assert [p.name for p in (tmp_path / "x").iterdir()] == ["rows.jsonl"]
    assert jsonl.write_rows(rows.where("false"), F.col("id"), lambda r: "", tmp_path / "x/none.jsonl") == 0 and jsonl.read_lines(tmp_path / "x/none.jsonl") == []
    assert jsonl.read_lines(tmp_path / "missing") == []
    assert jsonl.read_table(spark, str(tmp_path / "x/rows.jsonl"), "id long").count() == 500
