"""Kernels, filters and the labeler on small arrays."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest

from pixelmill.functions import kernels
from pixelmill.operators import duplicate, filters, labeler
from pixelmill.sources import codec
from tests.images import bmp


def gray_image(h=80, w=80, value=120):
    return np.full((h, w, 3), value, np.uint8)


def test_gray_style_at_and_below_threshold():
    op = filters.GrayStyle(threshold=1.0)
    assert op.process(gray_image(), {}).decision == "REJECT"
    off = gray_image()
    off[3, 3, 0] = 121
    assert op.process(off, {}).decision == "PASS"


def framed(sides: str, thick: int = 25):
    x = np.random.default_rng(1).integers(0, 256, (200, 200, 3)).astype(np.uint8)
    at = {"t": np.s_[:thick], "b": np.s_[-thick:], "l": np.s_[:, :thick], "r": np.s_[:, -thick:]}
    for s in sides:
        x[at[s]] = 255
    return x


@pytest.mark.parametrize("sides, thick, decision", [("tbl", 25, "REJECT"), ("tblr", 25, "REJECT"), ("tb", 25, "PASS"), ("tbl", 20, "PASS"), ("tbl", 70, "PASS"), ("", 25, "PASS")])
def test_framebox_branches(sides, thick, decision):
    assert filters.FrameBox().process(framed(sides, thick), {}).decision == decision


def test_framebox_flat_has_only_std():
    assert filters.FrameBox().process(gray_image(), {}).metrics == {"std": 0.0}


def test_stitch_axes():
    v, h = gray_image(), gray_image()
    v[:, :40] = 10
    h[:40] = 10
    assert filters.StitchLine().process(v, {}).reason == "stitch_line_vertical"
    assert filters.StitchLine().process(h, {}).reason == "stitch_line_horizontal"
    flat = filters.StitchLine().process(gray_image(), {})
    assert flat.decision == "PASS" and flat.metrics["vertical"] == {"axis": "vertical", "mean": 0.0}


def test_blur_branches():
    sharp = np.random.default_rng(2).integers(0, 256, (100, 100, 3)).astype(np.uint8)
    op = filters.PersonBlur()
    assert op.process(sharp, {}).metrics == {"used": "none", "no_roi_kept": True}
    assert op.process(sharp, {"faces": [(1, 1, 9, 9)]}).metrics == {"used": "face", "no_valid_roi_kept": True}
    assert op.process(sharp, {"faces": [(10, 10, 80, 80)]}).decision == "PASS"
    assert op.process(gray_image(), {"faces": [(10, 10, 80, 80)]}).reason == "blur_score_below_threshold"


def test_resample_keeps_flat_images_and_rounds_sizes():
    assert (kernels.resample(gray_image(50, 70), 20, 30) == 120).all()
    assert kernels.fit_side(5, 2000, 1600) == (4, 1600)


def test_phash_is_stable_under_small_noise():
    rng = np.random.default_rng(3)
    x = kernels.resample(rng.integers(0, 256, (8, 8, 3)).astype(np.uint8), 128, 128)
    y = np.clip(x.astype(int) + rng.integers(-2, 3, x.shape), 0, 255).astype(np.uint8)
    assert (kernels.phash(x) != kernels.phash(y)).sum() <= 4


def plain_fold(rows, t):
    """The sequential fold over everything, written down independently."""
    kept, seen = [], {}
    for r in rows:
        hit = None
        for k in kept:
            if bin(r[3] ^ k[3]).count("1") <= t:
                hit = k
                break
        if hit is None:
            kept.append(r)
            seen[r[0]] = ("PASS", None)
        elif (r[2], ) > (hit[2], ) or (r[2] == hit[2] and r[1] < hit[1]):
            kept = [k for k in kept if k is not hit] + [r]
            seen[r[0]], seen[hit[0]] = ("PASS", None), ("REJECT", r[0])
        else:
            seen[r[0]] = ("REJECT", hit[0])
    return seen


def test_duplicate_matches_the_sequential_fold(spark):
    rnd = random.Random(5)
    rows, base = [], [rnd.getrandbits(64) for _ in range(25)]
    for k in range(160):
        h = rnd.choice(base)
        for _ in range(rnd.randrange(0, 8)):
            h ^= 1 << rnd.randrange(64)
        rows.append((f"{rnd.choice('ab')}/{k:03d}.png", f"/in/{k:03d}.png", rnd.randrange(5), h))
    rows.sort(key=lambda r: r[0].split("/"))
    want = plain_fold(rows, 9)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    df = spark.createDataFrame([(i, p, s, [signed(h)], None) for i, p, s, h in rows] + [("z", "/z", 1, None, "bad")], "sample_id string, source_path string, size long, words array<long>, error string")
    got = {r["sample_id"]: (r["decision"], json.loads(r["metrics"]).get("keeper")) for r in duplicate.Duplicate().decide(df).collect()}
    assert got.pop("z") == ("ERROR", None)
    assert got == want


def test_labeler_retries_and_normalises():
    from pixelmill.operators.labeler import PersonAttributeLabeler

    said, slept = iter(["nonsense", "[1]", '{"person_count": 1, "gender": " male ", "hair_color": "dark brown", "head_visible": "no"}']), []
    op = PersonAttributeLabeler(infer=lambda url: next(said), sleep=slept.append, workers=8)
    row = {"sample_id": "a", "source_path": "/x/a.png", "content": labeler.png(gray_image(4, 4))}
    assert next(op.label(iter([row]))).reason == "labeler_not_initialized"
    op.setup()
    found = next(op.label(iter([row])))
    assert found.decision == "LABEL" and slept == [1, 2]
    assert found.labels["gender"] == "male" and found.labels["hair_color"] == "N/A" and found.labels["hair_visible"] == "no"


def test_labeler_gives_up():
    op = labeler.PersonAttributeLabeler(infer=lambda url: "x", sleep=lambda s: None)
    op.setup()
    row = {"sample_id": "a", "source_path": "/x/a.png", "content": labeler.png(gray_image(4, 4))}
    assert next(op.label(iter([row]))).reason.startswith("label_inference_failed")


def test_shrink_pixels_floors():
    assert labeler.shrink_pixels(gray_image(100, 200), 5000).shape[:2] == (50, 100)
    assert labeler.shrink_pixels(gray_image(100, 200), 0).shape[:2] == (100, 200)


def test_codecs_and_headers():
    x = np.random.default_rng(4).integers(0, 256, (13, 7, 3)).astype(np.uint8)
    for data in (labeler.png(x), bmp(x)):
        assert codec.header(data) == (7, 13)
        assert (codec.decode(data) == x).all()
    assert codec.header(labeler.png(x)[:40]) == (7, 13)
    with pytest.raises(ValueError):
        codec.header(b"junk")
    assert codec.header(b"GIF89a" + bytes([5, 0, 6, 0])) == (5, 6)
    assert codec.header(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x0a\x00\x14") == (20, 10)
