"""Inference pipelines around pluggable models.

Models are interfaces only: a stage is a picklable factory that is called once in each task and returns a function
over a batch of pages.  Everything around it (fallbacks, clamping, merging, order) is native.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.constants import DEFAULT_IOU, REGION_STRUCT, TRANSCRIBED_TYPES
from pagelens.functions.jsonrepair import extract_array, regions_from_items, text_lines
from pagelens.operators.match import _with_text, assign_lines, band_regions, finalize_regions, merge_regions

MODES = ["empty", "detector-vlm", "page-vlm", "page-text-vlm", "detector-page-text", "ensemble"]
TOKENS, RETRY_TOKENS = 1024, 2048


class BatchModel(Protocol):
    """Answers, as text, for a batch of (image_path, prompt) with a budget of new tokens."""

    def __call__(self, images: list[str], prompts: list[str], max_new_tokens: int) -> list[str]: ...


class BatchDetector(Protocol):
    """Region lists for a batch of images."""

    def __call__(self, images: list[str]) -> list[list[dict]]: ...


Factory = Callable[[], BatchModel]


def empty_model() -> BatchModel:
    """A model that answers nothing."""
    return lambda images, prompts, max_new_tokens: [""] * len(images)


def empty_detector() -> BatchDetector:
    """A detector that finds nothing."""
    return lambda images: [[] for _ in images]


def retry_budget(tokens: int) -> int | None:
    """Tokens for the second try of pages whose first answer was unusable; None if there is no room for more."""
    return min(2 * tokens, RETRY_TOKENS) if tokens < RETRY_TOKENS else None


def answers(image: Column, prompt: Column, factory: Factory, tokens: int = TOKENS, usable: Callable[[str], bool] | None = None, batch_size: int | None = None) -> Column:
    """The model's answers, ``batch_size`` rows at a time (None: an Arrow batch); only unusable ones are asked again with the larger budget."""

    def asked(model: BatchModel, a: list[str], b: list[str], budget: int) -> list[str]:
        size = batch_size or max(1, len(a))
        return [t for i in range(0, len(a), size) for t in model(a[i : i + size], b[i : i + size], budget)]

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = factory()
        for images, prompts in batches:
            a, b = images.fillna("").tolist(), prompts.fillna("").tolist()
            out = asked(model, a, b, tokens)
            more = retry_budget(tokens)
            again = [i for i, t in enumerate(out) if usable is not None and not usable(t)] if more else []
            if again:
                for i, t in zip(again, asked(model, [a[i] for i in again], [b[i] for i in again], more)):
                    out[i] = t
            yield pd.Series(out)

    return run(image, prompt)


def detections(image: Column, factory: Callable[[], BatchDetector], confidence: float = 0.0) -> Column:
    """Detected regions of at least the confidence (null confidence passes)."""
    import json

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for images in batches:
            yield pd.Series([json.dumps(r, ensure_ascii=False) for r in model(images.fillna("").tolist())])

    found = F.from_json(run(image), f"array<{REGION_STRUCT}>")
    return F.filter(found, lambda r: F.coalesce(r["confidence"] >= confidence, F.lit(True)))


def transcribe_empty(pages: DataFrame, regions: str, factory: Factory, tokens: int = 192) -> DataFrame:
    """``pages`` with the texts of transcribable regions without one filled by the model."""
    from pagelens.functions.prompts import region_prompt

    flat = pages.select("image", "image_path", "source", F.posexplode(regions).alias("i", "r"))
    need = flat.where((F.col("r.text") == "") & F.col("r.type").isin(TRANSCRIBED_TYPES))
    asked = need.select("image", "i", answers(F.concat_ws("#", "image_path", F.to_json("r.bbox")), region_prompt(F.col("source"), F.col("r.type")), factory, tokens).alias("text"))
    texts = asked.groupBy("image").agg(F.map_from_entries(F.collect_list(F.struct("i", F.coalesce("text", F.lit(""))))).alias("__texts"))
    filled = F.transform(regions, lambda r, i: F.when((r["text"] == "") & r["type"].isin(TRANSCRIBED_TYPES), _with_text(r, F.coalesce(F.try_element_at("__texts", i), F.lit("")))).otherwise(r))
    return pages.join(texts, "image", "left").withColumn(regions, filled).drop("__texts")


def run_inference(
    pages: DataFrame,
    mode: str = "empty",
    detector: Callable[[], BatchDetector] = empty_detector,
    page_model: Factory = empty_model,
    region_model: Factory | None = None,
    threshold: float = DEFAULT_IOU,
    confidence: float = 0.0,
    page_tokens: int = TOKENS,
    region_tokens: int = 192,
    batch_size: int | None = None,
) -> DataFrame:
    """(image, regions): final regions of every page; the mode alone decides which models are asked.

    ``pages`` are normalised pages with image_path.
    """
    from pagelens.functions.prompts import page_lines_prompt, page_regions_prompt

    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    w, h, path = F.col("image_width"), F.col("image_height"), F.col("image_path")
    none = F.array().cast(f"array<{REGION_STRUCT}>")
    p = pages.withColumn("image", F.col("image_name"))
    found = detections(path, detector, confidence) if mode in ("detector-vlm", "detector-page-text", "ensemble") else none
    p = p.withColumn("__d", F.coalesce(found, none))
    if mode in ("page-vlm", "ensemble"):
        p = p.withColumn("__a", answers(path, page_regions_prompt(F.col("source")), page_model, page_tokens, lambda t: "{" in t, batch_size))
        p = p.withColumn("__p", F.transform(regions_from_items(extract_array(F.col("__a"))["items"], w, h), lambda r: r.cast(REGION_STRUCT)))
    if mode in ("page-text-vlm", "detector-page-text"):
        p = p.withColumn("__l", text_lines(answers(path, page_lines_prompt(F.col("source")), page_model, page_tokens, None, batch_size)))
    regions = {
        "empty": none,
        "detector-vlm": F.col("__d"),
        "page-vlm": F.col("__p") if mode == "page-vlm" else none,
        "ensemble": merge_regions(F.col("__p"), F.col("__d"), threshold) if mode == "ensemble" else none,
        "page-text-vlm": band_regions(F.col("__l"), w, h) if mode == "page-text-vlm" else none,
        "detector-page-text": assign_lines(F.col("__d"), F.col("__l"), w, h) if mode == "detector-page-text" else none,
    }[mode]
    p = p.withColumn("regions", finalize_regions(regions, w, h))
    if region_model is not None:
        p = transcribe_empty(p, "regions", region_model, region_tokens)
    return p.select("image", "regions")


def empty_pages(results: DataFrame) -> DataFrame:
    """One row: how many pages came out without regions."""
    return results.agg(F.count_if(F.size("regions") == 0).alias("empty_pages"))


