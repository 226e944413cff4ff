"""Incremental reading of page metadata: an addition of this engine, for folders that keep filling.

The page model is the batch one, so every column function works on a stream unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagelens.constants import RAW_PAGE
from pagelens.operators.curate import curate_pages, region_rows
from pagelens.operators.pages import normalize_pages


def stream_pages(spark: SparkSession, folder: str, split: str, max_files: int = 1000) -> DataFrame:
    """Normalised pages of JSONL files as they arrive in a folder."""
    raw = spark.readStream.schema(RAW_PAGE).option("maxFilesPerTrigger", max_files).json(folder)
    return normalize_pages(raw, F.lit(split), F.lit(folder))


def stream_regions(pages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append curated region rows to a Parquet folder; ends when all files that are there are read."""
    rows = region_rows(curate_pages(pages))
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
