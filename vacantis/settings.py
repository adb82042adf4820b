"""Settings of a run: a mapping from YAML with defaults, frozen on the driver; plans take them as literals."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType
from typing import Any


def load_settings(path: str, defaults: Mapping[str, Any] | None = None, required: tuple[str, ...] = ()) -> Mapping[str, Any]:
    """The settings in a YAML file over the defaults; of a key given twice the later counts. Raises where a required one is missing."""
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - the library is optional
        raise RuntimeError("reading settings needs a YAML library") from e
    with open(path, encoding="utf-8") as f:
        found = {**(defaults or {}), **(yaml.safe_load(f) or {})}
    missing = [k for k in required if found.get(k) in (None, "")]
    if missing:
        raise ValueError(f"settings are missing: {', '.join(missing)}")
    return MappingProxyType(found)
