"""Sinks: JSONL, submission CSV, label files and image copies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.functions.text import stem
from pagelens.operators.curate import yolo_lines


# Suffixes of image files.
IMAGE_SUFFIXES = [".avif", ".bmp", ".dng", ".heic", ".heif", ".jp2", ".jpeg", ".jpeg2000", ".jpg", ".mpo", ".png", ".tif", ".tiff", ".webp"]


def write_jsonl(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a folder of JSONL: compact, UTF-8, null fields left out; ``_`` columns aren't written.

    ``single_file`` is for small exports only.
    """
    out = df.select(*[c for c in df.columns if not c.startswith("_")])
    (out.coalesce(1) if single_file else out).write.mode("overwrite").json(path)


def write_submission(rows: DataFrame, path: str) -> None:
    """Submission rows in the sample's order (``_ord``) as one CSV folder, quotes doubled."""
    ordered = rows.orderBy("_ord").drop("_ord")
    ordered.coalesce(1).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def label_files(pages: DataFrame, assignments: DataFrame) -> DataFrame:
    """(path, content): a label file for each assigned page with an image."""
    p = pages.where(F.col("image_path").isNotNull()).join(assignments.select("file_name", F.col("split").alias("part")), "file_name")
    lines = F.array_join(F.transform(yolo_lines(F.col("regions"), F.col("image_width"), F.col("image_height")), lambda x: F.concat(x, F.lit("\n"))), "")
    return p.select(F.concat(F.lit("labels/"), "part", F.lit("/"), stem(F.col("image_name")), F.lit(".txt")).alias("path"), lines.alias("content"))


def _put(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        dst, root = fs.FileSystem.from_uri(target)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                full = f"{root}/{path}"
                dst.create_dir(full.rsplit("/", 1)[0], recursive=True)
                with dst.open_output_stream(full) as out:
                    out.write((content or "").encode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([True] * batch.num_rows)], names=["path", "written"])

    return run


def put_texts(files: DataFrame, target: str) -> DataFrame:
    """Write (path, content) rows as files below a folder URI; returns (path, written) when evaluated."""
    return files.select("path", "content").mapInArrow(_put(target), "path string, written boolean")


def _copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        done = []
        for src, dst in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, source = fs.FileSystem.from_uri(src)
            b, target = fs.FileSystem.from_uri(dst)
            found = a.get_file_info(source).type == fs.FileType.File
            if found and (type(a), source) != (type(b), target):
                b.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with a.open_input_stream(source) as x, b.open_output_stream(target) as y:
                    while chunk := x.read(1 << 20):
                        y.write(chunk)
            done.append(found)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(done, pa.bool_())], names=["src", "dst", "copied"])


def copy_images(tasks: DataFrame) -> DataFrame:
    """Copy (src, dst) URIs; a missing source is reported as ``copied`` false, it fails nothing."""
    return tasks.select("src", "dst").mapInArrow(_copy, "src string, dst string, copied boolean")


def has_image_suffix(name: Column) -> Column:
    """Whether a file name has one of the image suffixes, in any case."""
    return F.lower(F.regexp_extract(name, r"(\.[^./]+)$", 1)).isin(IMAGE_SUFFIXES)


def page_copies(pages: DataFrame, assignments: DataFrame, target: str) -> DataFrame:
    """(src, dst) of the image copies of a curated dataset: each page under its split, and assigned pages for the detector."""
    p = pages.where(F.col("image_path").isNotNull())
    own = p.select(F.col("image_path").alias("src"), F.concat(F.lit(f"{target}/images/"), "split", F.lit("/"), "image_name").alias("dst"))
    part = assignments.select("file_name", F.col("split").alias("part")).distinct()
    detector = p.join(part, "file_name").select(F.col("image_path").alias("src"), F.concat(F.lit(f"{target}/yolo/images/"), "part", F.lit("/"), "image_name").alias("dst"))
    return own.union(detector).distinct()


def crop_tasks(regions: DataFrame, target: str) -> DataFrame:
    """(src, dst, bbox) of the crops that flat region rows with their page's ``image_path`` name."""
    r = regions.where(F.col("crop").isNotNull())
    return r.select(F.col("image_path").alias("src"), F.concat(F.lit(f"{target}/"), "crop").alias("dst"), "bbox")


def crop_images(tasks: DataFrame, codec: Callable[[], Callable[[bytes, list[int]], bytes]]) -> DataFrame:
    """Cut (src, dst, bbox) tasks out of their images; a missing source is reported as ``cropped`` false.

    ``codec`` is called once in each task and returns a function from image bytes and box to the crop's bytes; no image
    codec is bundled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        cut = codec()
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                a, source = fs.FileSystem.from_uri(row["src"])
                b, target = fs.FileSystem.from_uri(row["dst"])
                found = a.get_file_info(source).type == fs.FileType.File
                if found:
                    b.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    with a.open_input_stream(source) as x, b.open_output_stream(target) as y:
                        y.write(cut(x.read(), row["bbox"]))
                done.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("dst"), pa.array(done, pa.bool_())], names=["dst", "cropped"])

    return tasks.select("src", "dst", "bbox").mapInArrow(run, "dst string, cropped boolean")


def check_detector_images(files: DataFrame) -> None:
    """Raise unless a listing (path) of a detector's training folder has a loose image; packed shards are named as the cause."""
    name = F.element_at(F.split("path", "/"), -1)
    n = files.agg(F.count_if(has_image_suffix(name)).alias("images"), F.count_if(name.rlike(r"^shard-.*\.tar$")).alias("shards")).first()
    if not n.images:
        raise ValueError("the training images are packed in shards: unpack them first" if n.shards else "there are no training images")
