"""Boxes as arrays [x1, y1, x2, y2]: clamping, overlap, normalised form and reading order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.constants import READING_ORDER_ROW_BAND


def clamp_bbox(box: Column, width: Column, height: Column) -> Column:
    """The box cut to the page; null if it isn't four numbers or nothing is left.

    Coordinates are truncated toward zero first.  Null sizes give null.
    """
    part = lambda k, most: F.greatest(F.lit(0), F.least(most.cast("int"), box[k].cast("int")))
    cut = F.array(part(0, width), part(1, height), part(2, width), part(3, height))
    ok = (F.size(box) == 4) & ~F.exists(box, lambda v: v.isNull()) & width.isNotNull() & height.isNotNull() & (cut[2] > cut[0]) & (cut[3] > cut[1])
    return F.when(ok, cut)


def bbox_iou(a: Column, b: Column) -> Column:
    """Intersection over union, 0.0 for boxes that don't overlap; areas in bigint, one division."""
    a, b = F.transform(a, lambda v: v.cast("bigint")), F.transform(b, lambda v: v.cast("bigint"))
    return iou(a[0], a[1], a[2], a[3], b[0], b[1], b[2], b[3])


def iou(ax1: Column, ay1: Column, ax2: Column, ay2: Column, bx1: Column, by1: Column, bx2: Column, by2: Column) -> Column:
    """The same over eight bigint columns."""
    zero = F.lit(0).cast("bigint")
    inter = F.greatest(zero, F.least(ax2, bx2) - F.greatest(ax1, bx1)) * F.greatest(zero, F.least(ay2, by2) - F.greatest(ay1, by1))
    area = lambda x1, y1, x2, y2: F.greatest(zero, x2 - x1) * F.greatest(zero, y2 - y1)
    union = area(ax1, ay1, ax2, ay2) + area(bx1, by1, bx2, by2) - inter
    return F.when((inter == 0) | (union == 0), F.lit(0.0)).otherwise(inter.cast("double") / union.cast("double"))


def yolo_bbox(box: Column, width: Column, height: Column) -> Column:
    """Centre and size as parts of the page, struct<cx, cy, bw, bh>; null for a page without size."""
    w, h = F.when(width > 0, width).cast("double"), F.when(height > 0, height).cast("double")
    return F.struct(
        ((box[0] + box[2]) / F.lit(2.0) / w).alias("cx"),
        ((box[1] + box[3]) / F.lit(2.0) / h).alias("cy"),
        ((box[2] - box[0]) / w).alias("bw"),
        ((box[3] - box[1]) / h).alias("bh"),
    )


def reading_band(box: Column) -> Column:
    """Row band of the box's centre; floor division also below zero."""
    return F.floor(F.floor((box[1] + box[3]) / F.lit(2)) / F.lit(READING_ORDER_ROW_BAND))


def in_reading_order(regions: Column) -> Column:
    """Regions by row band and left edge; ties keep the list's order.  Regions need four coordinates."""
    keyed = F.transform(regions, lambda r, i: F.struct(reading_band(r["bbox"]).alias("b"), r["bbox"][0].alias("x"), i.alias("i"), r.alias("r")))
    # The place in the list comes before the region, so regions themselves are never compared.
    return F.transform(F.sort_array(keyed), lambda k: k["r"])


def fitted_size(width: Column, height: Column, most: int, least: int | None = None, factor: int = 32) -> Column:
    """struct<width, height> of an image for a model: sides in multiples of ``factor``, between ``least`` and ``most`` pixels, about the same shape.

    ``least`` is a quarter of ``most`` if it isn't given.  Null for sides that aren't positive or differ more than 200 times.
    """
    least = least or most // 4
    w, h, f = width.cast("double"), height.cast("double"), F.lit(float(factor))
    near = lambda x: F.greatest(f, F.rint(x / f) * f)
    area = near(w) * near(h)
    shrink, grow = F.sqrt(w * h / F.lit(float(most))), F.sqrt(F.lit(float(least)) / (w * h))

    def side(x: Column) -> Column:
        smaller, larger = F.greatest(f, F.floor(x / shrink / f) * f), F.ceil(x * grow / f) * f
        return F.when(area > most, smaller).when(area < least, larger).otherwise(near(x)).cast("int")

    fits = (w > 0) & (h > 0) & (F.greatest(w, h) / F.least(w, h) <= 200)
    return F.when(fits, F.struct(side(w).alias("width"), side(h).alias("height")))
