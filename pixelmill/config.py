"""Run configuration: one table of settings, and a reader that checks a mapping against it."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, NamedTuple

#: Suffixes of images, and how an archive may be laid out.
IMAGE_EXTS = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tif", ".tiff")
LAYOUTS = ("run_subdir", "flat", "preserve_relative")


class Section(dict):
    """Settings by name, as items and as attributes."""

    __getattr__ = dict.__getitem__

    def enabled_operators(self) -> list[Section]:
        return [o for o in self["operators"] if o.enabled]


class Setting(NamedTuple):
    section: str
    key: str
    read: Callable[[Any, str], Any]
    default: Any = None
    required: bool = False


def _kind(kind: type) -> Callable[[Any, str], Any]:
    return lambda value, _: kind(value)


def _suffixes(value: Any, _: str) -> list[str]:
    return [str(x).lower() for x in value]


def _layout(value: Any, where: str) -> str:
    if value not in LAYOUTS:
        raise ValueError(f"{where} is {value!r}, not one of the archive layouts {', '.join(LAYOUTS)}")
    return value


def _operator(value: Any, where: str) -> Section:
    if not isinstance(value, dict) or "name" not in value:
        raise ValueError(f"{where}: an operator is a mapping with a name")
    return Section(name=str(value["name"]), enabled=bool(value.get("enabled", True)), params=dict(value.get("params") or {}))


def _operators(value: Any, where: str) -> list[Section]:
    return [_operator(x, where) for x in value or ()]


#: All settings in the order of a snapshot, with their defaults.  ``filter.short_circuit`` is kept but
#: not acted on: the chain always stops at the first REJECT or ERROR.
SETTINGS = (
    Setting("input", "input_dir", _kind(str), required=True),
    Setting("input", "recursive", _kind(bool), True),
    Setting("input", "image_exts", _suffixes, IMAGE_EXTS),
    Setting("output", "run_root", _kind(str), required=True),
    Setting("output", "pass_archive_dir", _kind(str), required=True),
    Setting("output", "pass_archive_layout", _layout, "run_subdir"),
    Setting("output", "overwrite", _kind(bool), False),
    Setting("filter", "short_circuit", _kind(bool), True),
    Setting("filter", "operators", _operators, ()),
    Setting("label", "enabled", _kind(bool), True),
    Setting("label", "input_dir", _kind(str), "auto"),
    Setting("label", "annotation_dir", _kind(str), "auto"),
    Setting("label", "jsonl_path", _kind(str), "auto"),
    Setting("label", "operator", _operator, {"name": "person_attribute_labeler"}),
)


class PipelineConfig(Section):
    """The four sections; sections without a required setting may be left out."""

    def snapshot(self) -> dict[str, Any]:
        """Plain mappings and lists, defaults filled in."""

        def plain(x: Any) -> Any:
            return {k: plain(v) for k, v in x.items()} if isinstance(x, dict) else [plain(v) for v in x] if isinstance(x, list) else x

        return plain(self)


def parse_config(raw: dict[str, Any]) -> PipelineConfig:
    found = PipelineConfig()
    for s in SETTINGS:
        given, where = raw.get(s.section), f"{s.section}.{s.key}"
        if not isinstance(given, dict):
            if given:
                raise ValueError(f"{s.section} is not a mapping of settings")
            given = {}
        if s.required and s.key not in given:
            raise ValueError(f"{where} is required and missing")
        found.setdefault(s.section, Section())[s.key] = s.read(given.get(s.key, s.default), where)
    return found


def load_config(path: Any) -> PipelineConfig:
    import yaml

    with open(path, "rb") as text:
        return parse_config(yaml.safe_load(text) or {})
