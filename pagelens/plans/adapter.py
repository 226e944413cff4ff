"""The driver's tables in the engine's page model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.constants import REGION_STRUCT
from pagelens.operators.pages import latest, normalize_pages
from pagelens.session import prepare, table

ROOT = "raw"


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_records, of a page delivered again the last delivery."""
    return latest(table(prepare(spark), sf_dir, "page_records"), "page_id", "ingested_at", "row_id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised pages with page_id and image_path."""
    return normalize_pages(raw_pages(spark, sf_dir), "split", F.lit(ROOT))


def predicted(regions: Column, page_id: Column) -> Column:
    """Deterministic predictions from the truth: some regions missed, boxes shifted, texts changed, duplicates added."""

    def shifted(r: Column, dx: Column, dy: Column, text: Column, kind: Column) -> Column:
        b = r["bbox"]
        return F.struct(
            F.array(b[0] + dx, b[1] + dy, b[2] + dx, b[3] + dy).cast("array<int>").alias("bbox"), kind.alias("type"), text.alias("text"),
            r["language"].alias("language"), r["legibility"].alias("legibility"), r["confidence"].alias("confidence"),
        ).cast(REGION_STRUCT)

    def one(r: Column, i: Column) -> Column:
        h = (page_id * 31 + i * 17) % 10
        text = F.translate(r["text"], "ае", "еа")
        main = shifted(r, (h % 4).cast("int"), (h % 3).cast("int"), text, F.when(h == 7, "printed").otherwise(r["type"]))
        again = shifted(r, F.lit(1), F.lit(1), r["text"], r["type"])
        none = F.array().cast(f"array<{REGION_STRUCT}>")
        return F.concat(F.when(h != 0, F.array(main)).otherwise(none), F.when((page_id + i) % 8 == 0, F.array(again)).otherwise(none))

    return F.flatten(F.transform(regions, one))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, source, annotation_source, regions) with one row for each page."""
    p = pages(spark, sf_dir)
    return p.select(F.col("page_id").cast("string").alias("image"), "page_id", "source", "annotation_source", "image_width", "image_height", "regions")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, regions) of the pages; those whose id is divisible by 23 have none."""
    from pagelens.operators.pages import boxed

    t = truth(spark, sf_dir).where("page_id % 23 <> 0")
    return t.select("image", predicted(boxed(F.col("regions")), F.col("page_id")).alias("regions"))
