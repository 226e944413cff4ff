"""Plans of a publication: what to clear, how to send, how long to wait.  Sending itself is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.operators.compaction import folder_stats, top_level_paths

# Size of a folder that is sent in parts, tries, and the bounds of a wait in seconds.
LARGE_BYTES = 1_000_000_000
TRIES = 6
WAIT, LONGEST_WAIT = 30, 300


def clear_plan(paths: DataFrame, path: str = "path") -> DataFrame:
    """(name, is_folder, step): deletions that empty a repository: one for each top folder, one for all files beside them."""
    top = top_level_paths(paths, path)
    folders = top.where("is_folder").select("name").distinct().withColumn("is_folder", F.lit(True)).withColumn("step", F.concat(F.lit("folder:"), "name"))
    loose = top.where("NOT is_folder").select("name").distinct().withColumn("is_folder", F.lit(False)).withColumn("step", F.lit("files"))
    return folders.unionByName(loose)


def upload_plan(files: DataFrame) -> dict:
    """Number and bytes of a folder's files (path, size_bytes) and whether it goes in parts."""
    s = folder_stats(files).first()
    return {"files": s.files, "size_bytes": s.size_bytes, "in_parts": s.size_bytes >= LARGE_BYTES}


def wait_before_retry(attempt: int, retry_after: int | None = None, tries: int = TRIES) -> int | None:
    """Seconds to wait after the failed try number ``attempt`` (from 0) that met a rate limit; None: give up."""
    if attempt >= tries - 1:
        return None
    return retry_after if retry_after else min(LONGEST_WAIT, WAIT * (attempt + 1))
