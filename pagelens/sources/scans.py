"""Scans: JSONL splits, predictions, submission CSV and file listings."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.constants import RAW_PAGE, RAW_REGION
from pagelens.operators.pages import last_wins, normalize_pages, normalize_regions
from pagelens.functions.text import base_name
from pagelens.session import stage

_ORDER = "struct<file: string, block: bigint, line: bigint>"
PREDICTIONS = f"image string, regions array<{RAW_REGION}>"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def in_order(df: DataFrame) -> DataFrame:
    """``df`` with ``_ord``, the place of each row in reading order: by file, by block of the file, by line.

    Scans number their rows by split, and splits are planned by size; so rows are ordered by where they were read.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return df.withColumn("_ord", at)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Rows of a JSONL file or folder, with ``_ord``, their place in reading order.

    Blank lines are skipped; a malformed line fails the query, or without ``strict`` gives a row whose
    ``_corrupt_record`` holds it.
    """
    reader = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    df = reader.schema(schema if strict else f"{schema}, _corrupt_record string").json(path)
    return in_order(df)


def read_split(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Normalised pages of ``root/split/metadata.jsonl``; no rows if there is no such file."""
    path = f"{root}/{split}/metadata.jsonl"
    raw = read_jsonl(spark, path, RAW_PAGE) if exists(spark, path) else spark.createDataFrame([], f"{RAW_PAGE}, _ord {_ORDER}")
    return normalize_pages(raw, F.lit(split), F.lit(f"{root}/{split}"))


def read_available(spark: SparkSession, root: str, include_silver: bool = False, max_silver: int | None = None) -> DataFrame:
    """Pages of train, then silver (its first ``max_silver``), then test, with ``_part`` for that order."""
    parts = [read_split(spark, root, "train")]
    if include_silver:
        silver = read_split(spark, root, "silver")
        parts.append(silver.orderBy("_ord").limit(max_silver) if max_silver is not None else silver)
    parts.append(read_split(spark, root, "test"))
    out = parts[0].withColumn("_part", F.lit(0))
    for k, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("_part", F.lit(k)))
    return out


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(image, regions): predictions by base name, of repeated ones the last; regions normalised."""
    p = read_jsonl(spark, path, PREDICTIONS).select(base_name(F.col("image")).alias("image"), "_ord", normalize_regions(F.col("regions")).alias("regions"))
    return last_wins(p, "image", "_ord").select("image", "regions")


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a submission CSV with its own header, and ``_ord``; cells may hold quoted JSON and line ends."""
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return in_order(df)


#: Entries of a folder in one batch of a listing.
LISTED = 10_000


def _lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for uri in batch.column(0).to_pylist():
            system, root = fs.FileSystem.from_uri(uri)
            entries = system.get_file_info(fs.FileSelector(root))
            for a in range(0, len(entries), LISTED):
                part = entries[a : a + LISTED]
                paths = [f"{uri}/{e.base_name}" for e in part]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([e.size for e in part], pa.int64()), pa.array([e.type == fs.FileType.Directory for e in part], pa.bool_())], names=["path", "size_bytes", "folder"])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size_bytes) of all files below a folder URI, empty ones too; contents aren't read.

    Folders are listed level by level, those of a level by all tasks.
    """
    found, level = None, spark.createDataFrame([(root,)], "path string")
    while not level.isEmpty():
        entries = stage(level.repartition("path").mapInArrow(_lister, "path string, size_bytes bigint, folder boolean"), "listing")
        files = entries.where("NOT folder").select("path", "size_bytes")
        found = files if found is None else found.union(files)
        level = entries.where("folder").select("path")
    return found


def val_pages(pages: DataFrame, assignments: DataFrame) -> DataFrame:
    """Curated pages whose image is assigned to validation."""
    return pages.join(assignments.where("split = 'val'").select(F.col("image").alias("image_name")), "image_name", "left_semi")
