"""Markdown cards of datasets, adapters and detectors."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Row

from pagelens.constants import QUALITY_WEIGHTS

_TABLES = {
    "metadata": "normalised pages with their regions", "regions": "one row a region", "vlm_sft": "training rows of crops",
    "page_sft": "training rows of pages, regions as JSON", "page_text_sft": "training rows of pages, text lines", "yolo": "detector images, labels and split assignments",
}
_SCHEMA = '[{"bbox": [10, 20, 300, 80], "type": "handwritten", "language": "uk", "text": "..."}]'


def _front(values: Mapping[str, Any]) -> list[str]:
    out = ["---"]
    for k, v in values.items():
        out += [f"{k}:", *[f"- {x}" for x in v]] if isinstance(v, list) else [f"{k}: {v}"]
    return [*out, "---", ""]


def _shown(v: Any) -> str:
    return "not recorded" if v is None else str(v)


def dataset_card(stats: Row, sources: DataFrame, types: DataFrame, name: str = "Curated pages", licence: str = "unknown", source: str | None = None) -> str:
    """Card of a curated dataset from its counts (tables of a row a source and a row a type)."""
    counts = stats.asDict()
    lines = _front({"license": licence, "task_categories": ["object-detection", "image-to-text"], "language": ["uk"]})
    lines += [f"# {name}", "", "## Tables", "", *[f"- `{k}`: {v}" for k, v in _TABLES.items()]]
    lines += ["", "## Size", "", "| Table | Rows |", "| --- | --- |", *[f"| {k.replace('_', ' ')} | {v} |" for k, v in counts.items()]]
    for title, df, count in (("Sources", sources, "pages"), ("Region types", types, "regions")):
        key = next(c for c in df.columns if c != count)
        lines += ["", f"## {title}", "", *[f"- `{r[key]}`: {r[count]}" for r in df.orderBy(key).collect()]]
    lines += ["", "## Quality weights", "", *[f"- `{k}`: {v}" for k, v in QUALITY_WEIGHTS.items()], "", "Other annotation sources weigh 0.5."]
    lines += ["", "## Licence", "", licence + (f", inherited from `{source}`" if source else "") + "."]
    return "\n".join(lines) + "\n"


def adapter_card(settings: Mapping[str, Any], repo: str | None = None, dataset: str | None = None) -> str:
    """Card of a fine-tuned adapter from its training settings; settings that are missing are ``not recorded``."""
    base = settings.get("base_model")
    batch, steps = settings.get("batch_size"), settings.get("grad_accum_steps")
    shown = {
        "LoRA rank": settings.get("lora_r"), "LoRA alpha": settings.get("lora_alpha"), "Max steps": settings.get("max_steps"), "Learning rate": settings.get("learning_rate"),
        "Batch size": batch, "Gradient accumulation steps": steps, "Effective batch size": batch * steps if batch is not None and steps is not None else None,
        "Max length": settings.get("max_length"), "Max image pixels": settings.get("max_pixels"), "Least quality weight": settings.get("min_quality_weight"),
        "Weighted sampling": settings.get("weighted_sampling"), "Training examples": settings.get("train_examples"), "Evaluation examples": settings.get("eval_examples"),
    }
    lines = _front({"base_model": _shown(base), "library_name": "peft", "pipeline_tag": "image-text-to-text", "language": ["uk"]} | ({"datasets": [dataset]} if dataset else {}))
    lines += [f"# {repo or 'Page adapter'}", "", f"An adapter of `{_shown(base)}` that reads a page image and answers with its regions.", "", "## Training", "", *[f"- {k}: `{_shown(v)}`" for k, v in shown.items()]]
    return "\n".join([*lines, "", "## Output", "", "```json", _SCHEMA, "```"]) + "\n"


def detector_card(repo: str | None = None, variant: str | None = None, dataset: str | None = None) -> str:
    """Card of a layout detector."""
    lines = _front({"library_name": "ultralytics", "pipeline_tag": "object-detection", "language": ["uk"]} | ({"datasets": [dataset]} if dataset else {}))
    lines += [f"# {repo or 'Layout detector'}", "", f"A {variant or 'layout'} detector of text regions on page images.  It finds boxes and reads nothing.", "", "## Output", "", "```json", _SCHEMA, "```"]
    return "\n".join(lines) + "\n"
