"""Matching of region sets: overlap join, greedy one-to-one matching, merging and positional assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.constants import DEFAULT_IOU, EMPTY_TEXT_TYPES, REGION_STRUCT, TRANSCRIBED_TYPES
from pagelens.functions.binding import let
from pagelens.functions.geometry import bbox_iou, in_reading_order, iou
from pagelens.functions.text import base_name
from pagelens.operators.pages import last_wins

_MATCH = "array<struct<p:int,t:int>>"


def explode_boxes(pages: DataFrame, key: str, regions: str = "regions") -> DataFrame:
    """(key, idx, x1, y1, x2, y2) of every region with four coordinates, as bigint columns for joins."""
    e = pages.select(key, F.posexplode(regions).alias("idx", "r"))
    e = e.where((F.size("r.bbox") == 4) & ~F.exists("r.bbox", lambda v: v.isNull()))
    return e.select(key, "idx", *[F.col("r.bbox")[k].cast("bigint").alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))], F.col("r.type").alias("type"))


def iou_pairs(pred: DataFrame, truth: DataFrame, key: str, threshold: float = DEFAULT_IOU) -> DataFrame:
    """(key, pred_idx, truth_idx, iou): pairs on one page that overlap by at least the threshold.

    An equi-join on the page with the overlap of the boxes as residual, so disjoint boxes are never divided.
    For a threshold of 0 disjoint pairs count too.
    """
    p = pred.select(key, *[F.col(c).alias(f"p_{c}") for c in ("idx", "x1", "y1", "x2", "y2")])
    t = truth.select(key, *[F.col(c).alias(f"t_{c}") for c in ("idx", "x1", "y1", "x2", "y2")])
    j = p.join(t, key)
    if threshold > 0:
        j = j.where("p_x1 < t_x2 AND t_x1 < p_x2 AND p_y1 < t_y2 AND t_y1 < p_y2")
    score = iou(*[F.col(f"{s}_{c}") for s in "pt" for c in ("x1", "y1", "x2", "y2")])
    return j.select(key, F.col("p_idx").alias("pred_idx"), F.col("t_idx").alias("truth_idx"), score.alias("iou")).where(F.col("iou") >= threshold)


def greedy_match(pred: Column, truth: Column, threshold: float = DEFAULT_IOU) -> Column:
    """array<struct<p, t>>: one-to-one matches by descending (overlap, place in pred, place in truth).

    Both region lists lie in one row, so no pair leaves it.
    """
    one = lambda p, i: F.filter(
        F.transform(truth, lambda t, j: F.struct(bbox_iou(p["bbox"], t["bbox"]).alias("s"), i.alias("p"), j.alias("t"))), lambda c: c["s"] >= threshold
    )
    ranked = F.sort_array(F.flatten(F.transform(pred, one)), asc=False)
    free = lambda acc, c: ~F.exists(acc, lambda m: (m["p"] == c["p"]) | (m["t"] == c["t"]))
    fold = F.aggregate(ranked, F.array().cast(_MATCH), lambda acc, c: F.when(free(acc, c), F.concat(acc, F.array(F.struct(c["p"].alias("p"), c["t"].alias("t"))))).otherwise(acc))
    return F.coalesce(fold, F.array().cast(_MATCH))


def merge_regions(page: Column, detector: Column, threshold: float = DEFAULT_IOU) -> Column:
    """Page regions completed by the detector's, then the detector's regions that matched none.

    Each page region, in order, takes the best unused detector region of its type that overlaps enough; the last
    of equally good ones.  Empty text, and a confidence that is null or 0, come from the detector.
    """

    def step(acc: Column, r: Column) -> Column:
        options = F.filter(
            F.transform(detector, lambda d, i: F.struct(bbox_iou(r["bbox"], d["bbox"]).alias("s"), i.alias("i"), d["type"].alias("type"))),
            lambda o: (o["s"] >= threshold) & (o["type"] == r["type"]) & ~F.array_contains(acc["used"], o["i"]),
        )
        best = F.array_max(F.transform(options, lambda o: F.struct(o["s"].alias("s"), o["i"].alias("i"))))["i"]
        return let(F.struct(best.alias("i"), F.get(detector, best).alias("d")), lambda m: taken(acc, r, m))

    def taken(acc: Column, r: Column, m: Column) -> Column:
        found, d = m["i"].isNotNull(), m["d"]
        merged = F.struct(
            r["bbox"].alias("bbox"), r["type"].alias("type"),
            F.when(found & (F.coalesce(r["text"], F.lit("")) == ""), d["text"]).otherwise(r["text"]).alias("text"),
            r["language"].alias("language"), r["legibility"].alias("legibility"),
            F.when(found & (F.coalesce(r["confidence"], F.lit(0.0)) == 0.0), d["confidence"]).otherwise(r["confidence"]).alias("confidence"),
        ).cast(REGION_STRUCT)
        used = F.when(found, F.concat(acc["used"], F.array(m["i"]))).otherwise(acc["used"])
        return F.struct(used.alias("used"), F.concat(acc["out"], F.array(merged)).alias("out"))

    def completed(f: Column) -> Column:
        rest = F.filter(F.transform(detector, lambda d, i: F.struct(i.alias("i"), d.alias("d"))), lambda x: ~F.array_contains(f["used"], x["i"]))
        return F.concat(f["out"], F.transform(rest, lambda x: x["d"]))

    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast(f"array<{REGION_STRUCT}>").alias("out"))
    return let(F.aggregate(page, start, step), completed)


def band_regions(lines: Column, width: Column, height: Column) -> Column:
    """A region for each text line on a page without boxes: bands of equal height, the last to the bottom."""
    n = F.size(lines)
    band = F.greatest(F.lit(1), F.floor(height / F.greatest(F.lit(1), n))).cast("int")

    def one(line: Column, i: Column) -> Column:
        y1 = F.least(height - 1, i * band)
        y2 = F.when(i == n - 1, height).otherwise(F.least(height, y1 + band))
        return F.struct(
            F.array(F.lit(0), y1, width, F.greatest(y2, y1 + 1)).cast("array<int>").alias("bbox"), F.lit("handwritten").alias("type"), line.alias("text"),
            F.lit("uk").alias("language"), F.lit("legible").alias("legibility"), F.lit(None).cast("double").alias("confidence"),
        ).cast(REGION_STRUCT)

    return F.transform(lines, one)


def _with_text(r: Column, text: Column) -> Column:
    return F.struct(r["bbox"].alias("bbox"), r["type"].alias("type"), text.alias("text"), r["language"].alias("language"), r["legibility"].alias("legibility"), r["confidence"].alias("confidence")).cast(REGION_STRUCT)


def assign_lines(regions: Column, lines: Column, width: Column, height: Column) -> Column:
    """The i-th text line to the i-th transcribable region in reading order.

    Regions without a line keep their text; lines without a region become bands counted from the page's top;
    images and graphs get empty text.  The result is in reading order.
    """
    structural = F.transform(F.filter(regions, lambda r: r["type"].isin(EMPTY_TEXT_TYPES)), lambda r: _with_text(r, F.lit("")))

    def zipped(ordered: Column) -> Column:
        with_lines = F.transform(ordered, lambda r, i: _with_text(r, F.when(i < F.size(lines), F.get(lines, i)).otherwise(r["text"])))
        n, k = F.size(ordered), F.size(lines)
        left = F.when(k > n, F.slice(lines, n + 1, F.greatest(k - n, F.lit(0)))).otherwise(F.array().cast("array<string>"))
        return F.concat(with_lines, let(left, lambda x: band_regions(x, width, height)), structural)

    ordered = in_reading_order(F.filter(regions, lambda r: r["type"].isin(TRANSCRIBED_TYPES)))
    return in_reading_order(let(ordered, zipped))


def finalize_regions(regions: Column, width: Column, height: Column) -> Column:
    """Regions cut to the page, images and graphs without text, in reading order; degenerate ones dropped."""
    from pagelens.functions.geometry import clamp_bbox

    def one(r: Column) -> Column:
        return F.struct(
            clamp_bbox(r["bbox"], width, height).alias("bbox"), r["type"].alias("type"), F.when(r["type"].isin(EMPTY_TEXT_TYPES), "").otherwise(r["text"]).alias("text"),
            r["language"].alias("language"), r["legibility"].alias("legibility"), r["confidence"].alias("confidence"),
        )

    return in_reading_order(F.filter(F.transform(regions, one), lambda r: r["bbox"].isNotNull()))


def latest_predictions(predictions: DataFrame, order: str = "_ord") -> DataFrame:
    """(image, regions): one row for each base name, of repeated ones the last."""
    p = predictions.select(base_name(F.col("image")).alias("image"), F.col(order).alias("_ord"), "regions")
    return last_wins(p, "image", "_ord").select("image", "regions")


def submission(sample: DataFrame, predictions: DataFrame) -> DataFrame:
    """The sample's rows with the predicted regions as JSON, ``[]`` where there are none."""
    from pagelens.operators.curate import submission_regions

    p = latest_predictions(predictions).select(F.col("image").alias("__image"), F.to_json(submission_regions(F.col("regions")), {"ignoreNullFields": "false"}).alias("__json"))
    joined = sample.join(p, base_name(sample["image"]) == F.col("__image"), "left")
    return joined.select(*[F.coalesce("__json", F.lit("[]")).alias("regions") if c == "regions" else sample[c] for c in sample.columns])
