"""Layered settings: command line, then preset, then configuration file, then default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pagelens.constants import DEFAULT_MAX_PIXELS

#: Settings that hold where no file says otherwise.
DEFAULTS: dict[str, Any] = {
    "curation": {"include_silver": True, "max_silver": None, "crop_images": True, "page_sft": True, "val_fraction": 0.15, "seed": 42},
    "inference": {"detector_confidence": 0.25, "detector_iou": 0.5, "region_max_new_tokens": 192, "page_max_new_tokens": 2048, "max_pixels": DEFAULT_MAX_PIXELS, "batch_size": 1},
    "training": {"eval_fraction": 0.1, "eval_steps": 50, "max_pixels": 401408},
}


def load_config(path: str | None = None) -> dict[str, Any]:
    """DEFAULTS overlaid by a YAML (if a parser is installed) or JSON file."""
    if not path:
        return DEFAULTS
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        own = yaml.safe_load(text) or {}
    except ImportError:
        import json

        own = json.loads(text)
    return {k: {**DEFAULTS.get(k, {}), **v} if isinstance(v, dict) else v for k, v in {**DEFAULTS, **own}.items()}


def parse_env(text: str) -> dict[str, str]:
    """KEY=VALUE lines; comments, ``export`` and one pair of quotes around a value are dropped."""
    out = {}
    for line in map(str.strip, text.splitlines()):
        if line.startswith("#"):
            continue
        key, eq, value = line.removeprefix("export ").partition("=")
        key, value = key.strip(), value.strip()
        if eq and key:
            quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "'\""
            out[key] = value[1:-1] if quoted else value
    return out


def load_env(path: str = ".env", override: bool = False) -> dict[str, str]:
    """Put a file's settings into the environment; what is set there stays unless ``override``."""
    file = Path(path)
    found = parse_env(file.read_text(encoding="utf-8")) if file.exists() else {}
    for k, v in found.items():
        if override or k not in os.environ:
            os.environ[k] = v
    return found


def load_preset(path: str | None, name: str | None) -> dict[str, Any]:
    """The named entry below ``presets`` of a YAML or JSON file; empty without a name, an error for an unknown one."""
    if not name:
        return {}
    known = (load_config(path).get("presets") if path else None) or {}
    if name not in known:
        raise ValueError(f"unknown preset {name!r}; there are: {', '.join(sorted(known)) or 'none'}")
    return known[name] or {}


def dig(config: Any, *keys: str, default: Any = None) -> Any:
    """A nested setting; the default where a step is missing."""
    for k in keys:
        if not isinstance(config, Mapping) or k not in config:
            return default
        config = config[k]
    return config


def resolve(own: Any, preset: Mapping[str, Any], config: Mapping[str, Any], name: str, path: tuple[str, ...], default: Any = None) -> Any:
    """The first that is given: the caller's value, the preset's, the configuration's (not null), the default."""
    if own is not None:
        return own
    if name in preset:
        return preset[name]
    found = dig(config, *path)
    return default if found is None else found


def pixel_budget(max_pixels: int | None = None, size: Mapping[str, Any] | None = None, own_max: Any = None, own_min: Any = None) -> tuple[int, int]:
    """(max, min) pixels: the override with a quarter as minimum, else what the processor names, else the default."""

    def positive(v: Any) -> int | None:
        try:
            return n if (n := int(v)) > 0 else None
        except (TypeError, ValueError):
            return None

    if max_pixels is not None:
        size = {"longest_edge": max_pixels, "shortest_edge": max_pixels // 4}
        own_max, own_min = max_pixels, max_pixels // 4
    size = size or {}
    most = positive(size.get("longest_edge")) or positive(own_max) or DEFAULT_MAX_PIXELS
    return most, positive(size.get("shortest_edge")) or positive(own_min) or most // 4


def checkpoint_in(folder: str) -> str:
    """The detector checkpoint of a folder: the best, else the last, else the first ``.pt`` below it."""
    root = Path(folder)
    for name in ("weights/best.pt", "best.pt", "weights/last.pt", "last.pt"):
        if (root / name).exists():
            return str(root / name)
    found = sorted(map(str, root.rglob("*.pt")))
    if not found:
        raise FileNotFoundError(f"no checkpoint under {folder}")
    return found[0]


def resolve_repo(own: str | None, variables: list[str], template: str, config: Mapping[str, Any], keys: list[str], default: str | None = None, namespace: str = "HF_NAMESPACE") -> str | None:
    """A repository's id: the caller's, else the first set variable, else the template in the namespace, else the configuration's, else the default."""
    space = os.environ.get(namespace)
    return (
        own
        or next((os.environ[v] for v in variables if os.environ.get(v)), None)
        or (template.format(namespace=space) if space else None)
        or next((config[k] for k in keys if config.get(k)), None)
        or default
    )
