"""Page and region normalisation, quality weights and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelens.constants import DEFAULT_QUALITY_WEIGHT, QUALITY_WEIGHTS, REGION_STRUCT, REGION_TYPES
from pagelens.functions.geometry import clamp_bbox
from pagelens.functions.prompts import lookup
from pagelens.functions.text import base_name


def full(c: Column) -> Column:
    """The value, with empty text as null."""
    return F.when(c != "", c)


def normalize_regions(regions: Column) -> Column:
    """Regions with truncated integer boxes and defaults; null entries dropped, null list as empty.

    Null language and legibility become ``uk`` and ``legible``, null text and type empty, a null box empty.
    """
    one = lambda r: F.struct(
        F.coalesce(F.transform(r["bbox"], lambda v: v.cast("int")), F.array().cast("array<int>")).alias("bbox"),
        F.coalesce(r["type"], F.lit("")).alias("type"),
        F.coalesce(r["text"], F.lit("")).alias("text"),
        F.coalesce(r["language"], F.lit("uk")).alias("language"),
        F.coalesce(r["legibility"], F.lit("legible")).alias("legibility"),
        r["confidence"].cast("double").alias("confidence"),
    )
    return F.coalesce(F.transform(F.filter(regions, lambda r: r.isNotNull()), one), F.array().cast(f"array<{REGION_STRUCT}>"))


def page_file_name(file_name: Column, path: Column, src: Column) -> Column:
    """Name under ``images/`` from the first of file_name, image.path and image.src that is given; empty without any."""
    name = F.coalesce(full(file_name), full(path), base_name(src), F.lit(""))
    return F.when((name == "") | name.startswith("images/"), name).otherwise(F.concat(F.lit("images/"), base_name(name)))


def page_size(own: Column, image: Column) -> Column:
    """A page's width or height: its own, the image's, or 0; 0 counts as missing."""
    some = lambda c: F.when(c != 0, c)
    return F.coalesce(some(own), some(image), F.lit(0)).cast("int")


def normalize_pages(pages: DataFrame, split: str | Column = "split", image_root: Column | None = None) -> DataFrame:
    """Pages in the engine's form, with ``image_name`` and ``image_path``.

    ``image_path`` is file_name under ``image_root``, null without one.  Optional columns that are missing are null.
    """
    has = lambda c: F.col(f"`{c}`") if c in pages.columns else F.lit(None)
    name = page_file_name(has("file_name"), F.col("image.path"), F.col("image.src"))
    out = pages.select(
        *[c for c in pages.columns if c.startswith("_")],
        *([F.col("page_id")] if "page_id" in pages.columns else []),
        name.alias("file_name"),
        base_name(name).alias("image_name"),
        page_size(has("image_width").cast("int"), F.col("image.width").cast("int")).alias("image_width"),
        page_size(has("image_height").cast("int"), F.col("image.height").cast("int")).alias("image_height"),
        F.coalesce(has("source").cast("string"), F.lit("")).alias("source"),
        (F.col(split) if isinstance(split, str) else split).alias("split"),
        *[has(c).cast(t).alias(c) for c, t in (("annotation_source", "string"), ("year", "int"), ("fund", "string"), ("content_type", "string"), ("grade", "int"), ("subject", "string"))],
        (has("group") if "group" in pages.columns else has("page_group")).cast("string").alias("group"),
        normalize_regions(F.col("regions")).alias("regions"),
    )
    return out.withColumn("image_path", F.when(F.col("file_name") != "", F.concat(image_root, F.lit("/"), "file_name")) if image_root is not None else F.lit(None).cast("string"))


def quality_weight(annotation_source: Column) -> Column:
    """Weight of a page's annotations; unknown and null sources weigh 0.5."""
    return F.coalesce(lookup(QUALITY_WEIGHTS, annotation_source), F.lit(DEFAULT_QUALITY_WEIGHT))


def region_type(kind: Column) -> Column:
    """One of the seven types; anything else is ``handwritten``."""
    return F.when(kind.isin(REGION_TYPES), kind).otherwise("handwritten")


def clean_regions(regions: Column, width: Column, height: Column) -> Column:
    """Normalised regions cut to the page, known types, defaults for empty language and legibility; degenerate ones dropped."""
    one = lambda r: F.struct(
        clamp_bbox(r["bbox"], width, height).alias("bbox"),
        region_type(r["type"]).alias("type"),
        r["text"].alias("text"),
        F.coalesce(full(r["language"]), F.lit("uk")).alias("language"),
        F.coalesce(full(r["legibility"]), F.lit("legible")).alias("legibility"),
        r["confidence"].alias("confidence"),
    )
    return F.filter(F.transform(regions, one), lambda r: r["bbox"].isNotNull())


def boxed(regions: Column) -> Column:
    """Regions with four coordinates, none null; the others can't be scored and are rejected."""
    return F.filter(regions, lambda r: (F.size(r["bbox"]) == 4) & ~F.exists(r["bbox"], lambda v: v.isNull()))


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Of rows with the same key the last by ``order``, which must be unique inside a key; null keys are left out.

    The last order of each key is found over these columns alone and the rows are filtered by it, so columns that
    the query doesn't need are neither read nor shuffled.
    """
    o = F.struct(*[F.col(c) for c in order])
    top = df.groupBy(key).agg(F.max(o).alias("__last"))
    return df.withColumn("__last", o).join(top, [key, "__last"], "left_semi").drop("__last")


def last_wins(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Of rows with the same key the last by ``order`` (nulls first; ties: one of them, by a hash of the row); null keys count as one key.

    Each task keeps its own last row of a key before rows are shuffled, once.
    """
    kinds = dict(df.dtypes)
    tie = F.xxhash64(*[F.col(c) for c in df.columns if "map" not in kinds[c] and "variant" not in kinds[c]])
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order], tie.desc()))
    return df.withColumn("__r", rank).where("__r = 1").drop("__r")
