"""Curation: cleaned pages to flat regions, training tables, labels, counts and splits."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.constants import REGION_TYPES, TRANSCRIBED_TYPES
from pagelens.functions.geometry import in_reading_order, yolo_bbox
from pagelens.functions.prompts import lookup, page_lines_prompt, page_regions_prompt, region_prompt
from pagelens.functions.text import stem, strip
from pagelens.operators.ordinal import row_numbers
from pagelens.operators.pages import clean_regions, full, quality_weight


def curate_pages(pages: DataFrame) -> DataFrame:
    """Normalised pages with cleaned regions and their quality weight."""
    cleaned = clean_regions(F.col("regions"), F.col("image_width"), F.col("image_height"))
    return pages.withColumn("regions", cleaned).withColumn("quality_weight", quality_weight(F.col("annotation_source")))


def region_rows(curated: DataFrame, crop_images: bool = True) -> DataFrame:
    """Flat regions, numbered densely in each page; ``crop`` names the crop where one is to be made."""
    c = curated.select("*", F.posexplode("regions").alias("idx", "r"))
    name = stem(F.col("image_name"))
    crop = F.format_string("crops/%s/%s_%04d.jpg", "split", name, "idx")
    cropped = F.lit(crop_images) & F.col("image_path").isNotNull() & F.col("r.type").isin(TRANSCRIBED_TYPES)
    keep = [c for c in ("page_id",) if c in curated.columns]
    return c.select(
        *keep,
        F.format_string("%s:%s:%04d", "split", name, "idx").alias("region_id"),
        F.col("image_name").alias("image"),
        F.col("file_name").alias("page_file_name"),
        "split", "source", "annotation_source", "quality_weight",
        F.col("r.bbox").alias("bbox"), F.col("r.type").alias("type"), F.col("r.language").alias("language"), F.col("r.legibility").alias("legibility"), F.col("r.text").alias("text"),
        F.when(cropped, crop).alias("crop"),
    )


def crop_sft_rows(regions: DataFrame) -> DataFrame:
    """Training rows of crops with legible, non-empty text, of any language and split."""
    r = regions.where((F.col("crop").isNotNull()) & (F.col("text") != "") & (F.col("legibility") == "legible"))
    return r.select(
        F.col("region_id").alias("id"), F.col("crop").alias("image"), F.lit("transcribe_region").alias("task"), F.col("type").alias("region_type"),
        "source", "quality_weight", region_prompt(F.col("source"), F.col("type")).alias("prompt"), F.col("text").alias("answer"),
    )


def page_text_lines(regions: Column) -> Column:
    """Legible Ukrainian texts of transcribable regions in reading order, stripped, empty ones dropped."""
    ok = lambda r: r["type"].isin(TRANSCRIBED_TYPES) & (r["language"] == "uk") & (r["legibility"] == "legible")
    return F.filter(F.transform(F.filter(in_reading_order(regions), ok), lambda r: strip(r["text"])), lambda t: t != "")


def _page_sft(curated: DataFrame, kind: str, task: str, prompt: Column, answer: Column) -> DataFrame:
    p = curated.where(F.col("split").isin("train", "silver") & F.col("image_path").isNotNull() & (F.size("regions") > 0))
    keep = [c for c in ("page_id",) if c in curated.columns]
    return p.select(
        *keep,
        F.concat("split", F.lit(":"), stem(F.col("image_name")), F.lit(f":{kind}")).alias("id"),
        F.concat(F.lit("images/"), "split", F.lit("/"), "image_name").alias("image"),
        F.lit(task).alias("task"), "source", "annotation_source", "quality_weight", prompt.alias("prompt"), answer.alias("answer"),
    )


def submission_regions(regions: Column) -> Column:
    """Regions reduced to box, type and text."""
    return F.transform(regions, lambda r: F.struct(r["bbox"].alias("bbox"), r["type"].alias("type"), r["text"].alias("text")))


def page_sft_rows(curated: DataFrame) -> DataFrame:
    """Training rows of whole pages: all regions in reading order."""
    return _page_sft(curated, "page", "page_to_regions_json", page_regions_prompt(F.col("source")), submission_regions(in_reading_order(F.col("regions"))))


def page_text_sft_rows(curated: DataFrame) -> DataFrame:
    """Training rows of whole pages: text lines in reading order, for pages that have any."""
    rows = _page_sft(curated, "page_text", "page_to_text_lines_json", page_lines_prompt(F.col("source")), page_text_lines(F.col("regions")))
    return rows.where("size(answer) > 0")


def serialize_answers(rows: DataFrame) -> DataFrame:
    """Training rows with the answer as text: answers that are JSON (lists, objects) in its spaced form, and a prompt where none is given.

    ``rows`` has ``answer`` as text: a plain one, or the JSON text of a nested one.
    """
    @F.pandas_udf("string")
    def spaced(s: pd.Series) -> pd.Series:
        return s.map(lambda t: json.dumps(json.loads(t), ensure_ascii=False))

    nested = F.col("answer").rlike(r"^[\[{]") & F.try_parse_json("answer").isNotNull()
    kind = F.col("region_type") if "region_type" in rows.columns else F.lit(None).cast("string")
    prompt = full(F.col("prompt")) if "prompt" in rows.columns else F.lit(None).cast("string")
    out = rows.withColumn("prompt", F.coalesce(prompt, region_prompt(F.col("source"), kind)))
    return out.withColumn("answer", F.when(nested, spaced(F.when(nested, F.col("answer")).otherwise("null"))).otherwise(F.col("answer")))


def source_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy(F.coalesce(full(F.col("source")), F.lit("unknown")).alias("source")).agg(F.count("*").alias("pages"))


def region_type_counts(curated: DataFrame) -> DataFrame:
    return curated.select(F.explode("regions.type").alias("type")).groupBy("type").agg(F.count("*").alias("regions"))


def curation_stats(curated: DataFrame, crop_images: bool = True) -> DataFrame:
    """One row of counts over the curated tables, in one pass over the pages."""
    legible = lambda r: r["type"].isin(TRANSCRIBED_TYPES) & (r["text"] != "") & (r["legibility"] == "legible")
    crops = F.size(F.filter("regions", legible)) if crop_images else F.lit(0)
    has_image = F.col("image_path").isNotNull()
    page = F.col("split").isin("train", "silver") & has_image & (F.size("regions") > 0)
    return curated.agg(
        F.count("*").alias("pages"),
        F.coalesce(F.sum(F.size("regions")), F.lit(0)).alias("regions"),
        F.coalesce(F.sum(F.when(has_image, crops)), F.lit(0)).alias("vlm_examples"),
        F.count_if(page).alias("page_sft_examples"),
        F.count_if(page & (F.size(page_text_lines(F.col("regions"))) > 0)).alias("page_text_sft_examples"),
    )


def yolo_lines(regions: Column, width: Column, height: Column) -> Column:
    """Label lines ``class cx cy w h`` with eight decimals, ties to even."""
    known = F.filter(regions, lambda r: r["type"].isin(REGION_TYPES))
    eight = lambda v: F.bround(v.cast("decimal(38,20)"), 8).cast("decimal(20,8)").cast("string")
    number = {t: str(i) for i, t in enumerate(REGION_TYPES)}

    def line(r: Column) -> Column:
        b = yolo_bbox(r["bbox"], width, height)
        return F.concat_ws(" ", lookup(number, r["type"]), *[eight(b[c]) for c in ("cx", "cy", "bw", "bh")])

    return F.transform(known, line)


def data_yaml(root: str) -> str:
    """Text of the detector's data file."""
    names = "\n".join(f"  {i}: {t}" for i, t in enumerate(REGION_TYPES))
    return f"path: {root}\ntrain: images/train\nval: images/val\nnames:\n{names}\n"


def hash_order(seed: int, key: Column) -> Column:
    """A key to order by at random but reproducibly: md5 of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def stratified_split(rows: DataFrame, key: str, fraction: float, seed: int, held: str = "val", rest: str = "train") -> DataFrame:
    """(key, source, split): per source the first ``max(1, round(n * fraction))`` keys by hash are held out.

    Rounding is half to even; a source of a single key holds nothing out.  Null and empty sources are ``unknown``.
    Equal keys of a source get the same split.
    """
    source = F.coalesce(full(F.col("source")), F.lit("unknown"))
    r = rows.select(F.col(key), source.alias("source")).distinct()
    n = r.groupBy("source").agg(F.count("*").alias("__n"))
    some = F.greatest(F.lit(1), F.rint(F.col("__n") * F.lit(fraction)).cast("bigint"))
    size = n.select("source", F.when(F.col("__n") > 1, some).otherwise(0).alias("__held"))
    ranked = row_numbers(r, ["source"], [hash_order(seed, F.col(key)), F.col(key).cast("string")], "__rn")
    return ranked.join(size, "source").select(key, "source", F.when(F.col("__rn") <= F.col("__held"), held).otherwise(rest).alias("split"))


def split_assignments(curated: DataFrame, fraction: float = 0.15, seed: int = 42) -> DataFrame:
    """(file_name, image, split) of the detector export: pages of train and silver that have regions.

    A file name of several sources has the split that the last of its sources by name gives it.
    """
    p = curated.where(F.col("split").isin("train", "silver") & (F.size("regions") > 0))
    s = stratified_split(p, "file_name", fraction, seed).groupBy("file_name").agg(F.max_by("split", "source").alias("split"))
    return p.select("file_name", F.col("image_name").alias("image")).distinct().join(s, "file_name")


def train_eval_split(rows: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """(key, source, split) of training rows; without a positive fraction everything is training."""
    if fraction <= 0:
        return rows.select(key, F.coalesce(full(F.col("source")), F.lit("unknown")).alias("source"), F.lit("train").alias("split"))
    return stratified_split(rows, key, fraction, seed, held="eval", rest="train")


def sft_filter(rows: DataFrame, min_weight: float | None = None, limit: int | None = None, order: str = "_ord") -> DataFrame:
    """Rows with an image, an answer and enough weight (null weighs 1); the first ``limit`` by ``order``."""
    ok = (F.col("image") != "") & F.col("answer").isNotNull()
    if min_weight is not None:
        ok &= F.coalesce("quality_weight", F.lit(1.0)) >= min_weight
    kept = rows.where(ok)
    return kept.orderBy(order).limit(limit) if limit is not None else kept
