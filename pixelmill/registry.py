"""Operators by name."""

from __future__ import annotations

from typing import Any


class Registry:
    def __init__(self):
        self._known: dict[str, type] = {}

    def register(self, name: str, cls: type) -> None:
        self._known[name] = cls

    def create(self, name: str, params: dict[str, Any] | None = None):
        if name not in self._known:
            raise KeyError(f"Unknown operator: {name}. Available: {', '.join(sorted(self._known))}")
        return self._known[name](**(params or {}))

    def names(self) -> list[str]:
        return sorted(self._known)


def default_registry() -> Registry:
    from pixelmill.operators import duplicate, filters, labeler

    r = Registry()
    for cls in (filters.AspectRatio, filters.GrayStyle, filters.CompressionQuality, filters.FrameBox, filters.StitchLine, filters.PersonBlur, duplicate.Duplicate, labeler.PersonAttributeLabeler):
        r.register(cls.name, cls)
    return r
