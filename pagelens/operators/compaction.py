"""Consolidation of far too many small files into well-filled shards.

``plan_shards`` assigns files to a fixed number of output groups, longest first, each to the least
loaded group that has room (a heap).  ``consolidate`` streams every group through pyarrow into one
shard, reads the written shards again, compares names, sizes and checksums with what went in, audits the
members against the listing and publishes the manifest by a single rename only if each distinct file is
exactly one member.  ``audit_packing`` is the same audit for a packing that others recorded.

Defined results: a file is known by (export, plain dir, name); listed repeatedly it counts once, with
its latest size (nulls first; ties: the greater size); shard files among the loose ones are no loose files;
null sizes weigh nothing; rows with a null export or name are left out, a null dir is the top dir ``''``;
empty listings give empty plans.
"""

from __future__ import annotations

import heapq
import json
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.operators.ordinal import row_numbers
from pagelens.session import require, stage

#: Files of one dir that one task schedules, about.
BUCKET_FILES = 100_000
#: Bytes read into memory at a time while a shard is written.
WRITE_BYTES = 8 << 20
SHARD_PATTERN = r"^shard-.*\.tar$"
_FILE_KEY = ["export_id", "dir", "file_name"]


def plain_dir(col: Column | str) -> Column:
    """A dir in plain form: ``/`` between parts, no empty or ``.`` parts."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\\", "/"), "/")
    return F.array_join(F.filter(parts, lambda p: (p != "") & (p != ".")), "/")


def is_shard_name(col: Column | str) -> Column:
    """Whether a file name is a shard's."""
    return (F.col(col) if isinstance(col, str) else col).rlike(SHARD_PATTERN)


def loose_files(listing: DataFrame) -> DataFrame:
    """(export_id, dir, file_name, size_bytes): the distinct loose files of a listing."""
    f = require(listing, "export_id", "dir", "file_name", "size_bytes", "listed_at")
    f = f.where("export_id IS NOT NULL AND file_name IS NOT NULL").where(~is_shard_name("file_name"))
    last = F.max(F.struct("listed_at", "size_bytes")).alias("x")
    return f.withColumn("dir", plain_dir("dir")).groupBy(_FILE_KEY).agg(last).select(*_FILE_KEY, F.col("x.size_bytes").alias("size_bytes"))


def newest_manifest(manifest: DataFrame) -> DataFrame:
    """(export_id, max_files_per_shard, packed_dirs): the newest manifest of each export (ties: one of them)."""
    m = require(manifest, "export_id", "version", "max_files_per_shard", "packed_dirs", "written_at").where("export_id IS NOT NULL")
    last = F.max(F.struct("written_at", "version", "packed_dirs", "max_files_per_shard")).alias("x")
    return m.groupBy("export_id").agg(last).select("export_id", "x.max_files_per_shard", "x.packed_dirs")


def named_shards(manifest: DataFrame) -> DataFrame:
    """(export_id, dir, shard): the shards that each export's newest manifest names, once each."""
    dirs = newest_manifest(manifest).select("export_id", F.explode("packed_dirs").alias("d"))
    return dirs.select("export_id", plain_dir("d.dir").alias("dir"), F.explode("d.shards").alias("shard")).distinct()


def audit_packing(listing: DataFrame, members: DataFrame, manifest: DataFrame) -> DataFrame:
    """(export_id, dir, file_name, held): loose files that aren't exactly one member of the named shards.

    ``held`` is the number of members with the file's name: 0 lost, 2 and more held repeatedly.  A member
    is known by its shard and number; repeated rows of it count once (the latest).
    """
    m = require(members, "export_id", "dir", "shard", "member_no", "member_name", "packed_at").withColumn("dir", plain_dir("dir"))
    m = m.groupBy("export_id", "dir", "shard", "member_no").agg(F.max(F.struct("packed_at", "member_name")).alias("x"))
    m = m.select("export_id", "dir", "shard", F.col("x.member_name").alias("file_name"))
    held = m.join(named_shards(manifest), ["export_id", "dir", "shard"], "left_semi").groupBy(_FILE_KEY).agg(F.count("*").alias("held"))
    files = loose_files(listing).select(*_FILE_KEY)
    return files.join(held, _FILE_KEY, "left").withColumn("held", F.coalesce("held", F.lit(0))).where("held <> 1")


def schedule(sizes: list[int], groups: int, room: int) -> list[int]:
    """Group of each file: longest first, to the least loaded group that has room for another file."""
    heap = [(0, g) for g in range(groups)]
    left = [room] * groups
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, g = heapq.heappop(heap)
        out[i] = g
        left[g] -= 1
        if left[g]:
            heapq.heappush(heap, (load + sizes[i], g))
    return out


def plan_shards(files: DataFrame, limits: DataFrame, bucket_files: int = BUCKET_FILES) -> DataFrame:
    """(export_id, dir, file_name, size_bytes, shard): a shard of at most max_files_per_shard files for each file.

    ``limits`` has (export_id, max_files_per_shard); exports without a positive limit use the default 2000.
    A dir of n files gets ceil(n / limit) shards.  A dir is scheduled in buckets of a whole number of shards, about
    ``bucket_files`` files each, by the order of a hash of the names, so no task schedules more; load is
    balanced inside a bucket.
    """
    f = require(files, "export_id", "dir", "file_name", "size_bytes")
    lim = require(limits, "export_id", "max_files_per_shard").groupBy("export_id").agg(F.max("max_files_per_shard").alias("room"))
    # Ranks by hash are exact in dirs of any size, so every bucket but a dir's last is full.
    f = row_numbers(f, ["export_id", "dir"], [F.xxhash64("file_name"), F.col("file_name")]).join(lim, "export_id", "left")
    f = f.withColumn("room", F.when(F.col("room") > 0, F.col("room")).otherwise(2000).cast("bigint"))
    f = f.withColumn("groups", F.greatest(F.lit(1), F.floor(F.lit(bucket_files) / F.col("room"))))
    f = f.withColumn("bucket", F.floor((F.col("rn") - 1) / (F.col("groups") * F.col("room"))))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("file_name", kind="stable").reset_index(drop=True)
        room, first = int(pdf["room"].iloc[0]), int(pdf["bucket"].iloc[0]) * int(pdf["groups"].iloc[0])
        g = schedule(pdf["size_bytes"].fillna(0).clip(lower=0).astype("int64").tolist(), -(-len(pdf) // room), room)
        pdf["shard"] = [f"shard-{first + x:05d}.tar" for x in g]
        return pdf[["export_id", "dir", "file_name", "size_bytes", "shard"]]

    return f.groupBy("export_id", "dir", "bucket").applyInPandas(one, "export_id bigint, dir string, file_name string, size_bytes bigint, shard string")


def repack(listing: DataFrame, manifest: DataFrame, bucket_files: int = BUCKET_FILES) -> DataFrame:
    """The plan for a recorded export: each distinct loose file in exactly one well-filled shard."""
    return plan_shards(loose_files(listing), newest_manifest(manifest).select("export_id", "max_files_per_shard"), bucket_files)


_MEMBER = pa.schema([("export_id", pa.int64()), ("dir", pa.string()), ("shard", pa.string()), ("member_no", pa.int32()), ("member_name", pa.string()), ("size_bytes", pa.int64()), ("crc", pa.int64())])
_MEMBER_DDL = "export_id bigint, dir string, shard string, member_no int, member_name string, size_bytes bigint, crc bigint"
MANIFEST = "_pack_manifest.json"
MANIFEST_DDL = "export_id bigint, version int, max_files_per_shard int, packed_dirs array<struct<dir:string,shards:array<string>,file_count:bigint>>, written_at timestamp"


def _place(root: str, export_id: int, folder: str, flat: bool) -> str:
    return "/".join(x for x in (root, "" if flat else str(export_id), folder) if x)


class _Summed:
    """A stream that keeps the checksum and the number of the bytes read through it."""

    def __init__(self, data):  # noqa: ANN001
        self.data, self.crc, self.size = data, 0, 0

    def read(self, n: int = -1) -> bytes:
        part = self.data.read(n)
        self.crc, self.size = zlib.crc32(part, self.crc), self.size + len(part)
        return part


def _writer(source: str, target: str, flat: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        src, src_root = fs.FileSystem.from_uri(source)
        dst, dst_root = fs.FileSystem.from_uri(target)
        for batch in batches:
            done = {k: [] for k in _MEMBER.names}
            for row in batch.to_pylist():
                place = _place(dst_root, row["export_id"], row["dir"], flat)
                dst.create_dir(place, recursive=True)
                temporary = f"{place}/.{row['shard']}.{uuid.uuid4().hex}"
                with dst.open_output_stream(temporary) as out, tarfile.open(fileobj=out, mode="w|") as tar:
                    for k, name in enumerate(sorted(row["names"])):
                        path = f"{_place(src_root, row['export_id'], row['dir'], flat)}/{name}"
                        info = tarfile.TarInfo(name)
                        info.size = src.get_file_info(path).size
                        with src.open_input_stream(path, buffer_size=WRITE_BYTES) as data:
                            summed = _Summed(data)
                            tar.addfile(info, summed)
                        for c, v in zip(done, (row["export_id"], row["dir"], row["shard"], k, name, summed.size, summed.crc)):
                            done[c].append(v)
                dst.move(temporary, f"{place}/{row['shard']}")  # a second attempt replaces an equal file
            yield pa.RecordBatch.from_pydict(done, schema=_MEMBER)

    return write


def _reader(target: str, flat: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        dst, root = fs.FileSystem.from_uri(target)
        for batch in batches:
            for row in batch.to_pylist():
                found = {k: [] for k in _MEMBER.names}
                with dst.open_input_stream(f"{_place(root, row['export_id'], row['dir'], flat)}/{row['shard']}") as data, tarfile.open(fileobj=data, mode="r|") as tar:
                    for k, member in enumerate(tar):
                        content = _Summed(tar.extractfile(member))
                        while content.read(WRITE_BYTES):
                            pass
                        for c, v in zip(found, (row["export_id"], row["dir"], row["shard"], k, member.name, content.size, content.crc)):
                            found[c].append(v)
                yield pa.RecordBatch.from_pydict(found, schema=_MEMBER)

    return read


def read_members(shards: DataFrame, target: str, flat: bool = False) -> DataFrame:
    """What (export_id, dir, shard) shards below ``target`` hold, by reading them: member_no, member_name, size_bytes and crc.

    A missing or cut-off shard fails the query.
    """
    return shards.select("export_id", "dir", "shard").mapInArrow(_reader(target, flat), _MEMBER_DDL)


def _remover(root_uri: str, flat: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(root_uri)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{_place(root, row['export_id'], row['dir'], flat)}/{row['name']}"
                if system.get_file_info(path).type == fs.FileType.File:
                    system.delete_file(path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return run


def read_manifest(spark: SparkSession, target: str) -> DataFrame | None:
    """The manifest published below ``target``, a row an export; None if there is none."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(target)
    if system.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.File:
        return None
    with system.open_input_stream(f"{root}/{MANIFEST}") as f:
        lines = f.read().decode().splitlines()
    return spark.createDataFrame([(x,) for x in lines], "j string").select(F.from_json("j", MANIFEST_DDL).alias("m")).select("m.*")


def _publish(manifest: DataFrame, target: str) -> None:
    from pyarrow import fs

    dst, root = fs.FileSystem.from_uri(target)
    dst.create_dir(root, recursive=True)
    temporary = f"{root}/.{MANIFEST}.{uuid.uuid4().hex}"
    with dst.open_output_stream(temporary) as out:
        for row in manifest.select(F.to_json(F.struct(*manifest.columns)).alias("j")).toLocalIterator():
            out.write((json.dumps(json.loads(row.j), ensure_ascii=False) + "\n").encode())
    dst.move(temporary, f"{root}/{MANIFEST}")


def verify_shards(logged: DataFrame, found: DataFrame) -> DataFrame:
    """Members whose name, size or checksum differ between what was written and what the shards hold."""
    key = [c for c in _MEMBER.names]
    return logged.select(*key).exceptAll(found.select(*key)).unionAll(found.select(*key).exceptAll(logged.select(*key)))


def consolidate(listing: DataFrame, limits: DataFrame, source: str, target: str, flat: bool = False, force: bool = False, remove_loose: bool = False) -> DataFrame:
    """Write the shards of ``listing``'s files from ``source`` to ``target`` and publish the manifest.

    Files are at ``source/export/dir/name`` and shards at ``target/export/dir/shard`` (folder URIs that all executors
    reach); with ``flat`` there is no folder for the export.  Returns the manifest (export_id, version, max_files_per_shard,
    packed_dirs, written_at).

    Nothing is published unless the shards, read again, hold what went in and every distinct file is exactly one member, of
    the listed size where one is listed.  An earlier manifest below ``target`` is kept and added to: files that its shards
    hold with the listed size are done, new ones get shards of their own, so a second run changes nothing.  A file that an
    earlier shard holds in another size is an error, unless ``force`` packs its dir anew and removes the earlier shards.
    ``remove_loose`` deletes the loose files after publication.
    """
    spark = listing.sparkSession
    files, key = stage(loose_files(listing), "loose-files"), _FILE_KEY
    earlier, version = read_manifest(spark, target), 1
    stale = todo = None
    if earlier is not None:
        earlier = stage(earlier, "earlier-manifest")
        version = (earlier.agg(F.max("version")).first()[0] or 0) + 1
        held = read_members(named_shards(earlier), target, flat).select("export_id", "dir", F.col("member_name").alias("file_name"), F.col("size_bytes").alias("held_size"))
        both = files.join(held.groupBy(*key).agg(F.min("held_size").alias("low"), F.max("held_size").alias("high")), key, "left")
        both = stage(both.withColumn("state", F.when(F.col("low").isNull(), "new").when((F.col("low") == F.col("high")) & (F.coalesce("size_bytes", "low") == F.col("low")), "done").otherwise("other")), "pack-states")
        if force:
            dirs = both.where("state <> 'done'").select("export_id", "dir").distinct()
            todo, stale = both.join(dirs, ["export_id", "dir"], "left_semi").select(*key, "size_bytes"), stage(named_shards(earlier).join(dirs, ["export_id", "dir"], "left_semi"), "stale-shards")
        elif clash := both.where("state = 'other'").first():
            raise RuntimeError(f"{clash.dir}/{clash.file_name} is packed already with another size")
        else:
            todo = both.where("state = 'new'").select(*key, "size_bytes")
        if todo.isEmpty():
            return earlier
    plan = plan_shards(files if todo is None else todo, limits)
    if version > 1:
        plan = plan.withColumn("shard", F.regexp_replace("shard", "^shard-", f"shard-v{version}-"))
    plan = stage(plan, "shard-plan")
    groups = plan.groupBy("export_id", "dir", "shard").agg(F.collect_list("file_name").alias("names"))  # at most a shard's files
    logged = stage(groups.mapInArrow(_writer(source, target, flat), _MEMBER_DDL), "shard-log")
    members = stage(read_members(plan.select("export_id", "dir", "shard").distinct(), target, flat), "shard-members")
    if not verify_shards(logged, members).isEmpty():
        raise RuntimeError("a shard doesn't hold what was written; nothing was published")
    dirs = members.groupBy("export_id", "dir").agg(F.sort_array(F.collect_set("shard")).alias("shards"), F.count("*").alias("file_count"))
    if earlier is not None:
        before = earlier.select("export_id", F.explode("packed_dirs").alias("d")).select("export_id", "d.*")
        before = before.join(stale, ["export_id", "dir"], "left_anti") if stale is not None else before
        dirs = before.unionByName(dirs).groupBy("export_id", "dir").agg(F.sort_array(F.flatten(F.collect_list("shards"))).alias("shards"), F.sum("file_count").alias("file_count"))
    manifest = dirs.groupBy("export_id").agg(F.sort_array(F.collect_list(F.struct("dir", "shards", "file_count"))).alias("packed_dirs"))
    room = require(limits, "export_id", "max_files_per_shard").groupBy("export_id").agg(F.max("max_files_per_shard").alias("max_files_per_shard"))
    if earlier is not None:
        room = room.unionByName(earlier.select("export_id", "max_files_per_shard").join(room, "export_id", "left_anti"))
    manifest = manifest.join(room, "export_id", "left").select("export_id", F.lit(version).alias("version"), "max_files_per_shard", "packed_dirs", F.current_timestamp().alias("written_at"))
    manifest = stage(manifest, "shard-manifest")
    wrong = audit_packing(plan.withColumn("listed_at", F.current_timestamp()), members.withColumn("packed_at", F.current_timestamp()), manifest)
    sizes = plan.join(members.select("export_id", "dir", F.col("member_name").alias("file_name"), F.col("size_bytes").alias("packed")), key).where("size_bytes <> packed")
    if not wrong.isEmpty() or not sizes.isEmpty():
        raise RuntimeError("the packing isn't exact; nothing was published")
    _publish(manifest, target)
    if stale is not None:
        stale.withColumnRenamed("shard", "name").mapInArrow(_remover(target, flat), "n bigint").agg(F.sum("n")).collect()
    if remove_loose:
        files.withColumnRenamed("file_name", "name").mapInArrow(_remover(source, flat), "n bigint").agg(F.sum("n")).collect()
    return manifest


def shard_plan(files: DataFrame, limit: int) -> DataFrame:
    """(dir, file_name, shard): files of a dir in order of names, ``limit`` to a shard, numbered from 0.

    ``files`` has distinct (dir, file_name).  Dirs may be of any size; numbering needs no task that sees a whole dir.
    """
    numbered = row_numbers(require(files, "dir", "file_name"), ["dir"], [F.col("file_name")])
    shard = F.floor((F.col("rn") - 1) / F.lit(limit)).cast("int")
    return numbered.select("dir", "file_name", F.format_string("shard-%05d.tar", shard).alias("shard"))


def dir_counts(files: DataFrame) -> DataFrame:
    """(dir, files): files directly in each dir, ``.`` for the top."""
    d = F.when(F.col("dir") == "", ".").otherwise(F.col("dir"))
    return files.groupBy(d.alias("dir")).agg(F.count("*").alias("files"))


def overfull_dirs(files: DataFrame, limit: int = 9000) -> DataFrame:
    """(dir, files): dirs with more files than the limit."""
    return dir_counts(files).where(F.col("files") > limit)


def check_layout(files: DataFrame, limit: int = 9000) -> None:
    """Raise if a dir is overfull, naming the fullest (ties: the first by name)."""
    worst = overfull_dirs(files, limit).orderBy(F.col("files").desc(), "dir").first()
    if worst:
        raise ValueError(f"{worst.dir!r} contains {worst.files} files (limit {limit})")


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """(export_id, dirs, shards, files): totals of each export's newest manifest."""
    d = newest_manifest(manifest).select("export_id", F.explode("packed_dirs").alias("d"))
    return d.groupBy("export_id").agg(F.count("*").alias("dirs"), F.sum(F.size("d.shards")).alias("shards"), F.sum("d.file_count").alias("files"))


def folder_stats(files: DataFrame) -> DataFrame:
    """One row: number of files and their bytes."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"))


def top_level_paths(files: DataFrame, path: str = "path") -> DataFrame:
    """(name, is_folder): distinct first parts of paths, ``.gitattributes`` left out."""
    p = F.col(path)
    return files.where(p != ".gitattributes").select(F.split(p, "/")[0].alias("name"), p.contains("/").alias("is_folder")).distinct()


def _unpacker(source: str, target: str, flat: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        src, src_root = fs.FileSystem.from_uri(source)
        dst, dst_root = fs.FileSystem.from_uri(target)
        for batch in batches:
            out = {"export_id": [], "dir": [], "file_name": [], "size_bytes": []}
            for row in batch.to_pylist():
                with src.open_input_stream(f"{_place(src_root, row['export_id'], row['dir'], flat)}/{row['shard']}") as data, tarfile.open(fileobj=data, mode="r|") as tar:
                    for member in tar:
                        if not member.isfile() or member.name.startswith("/") or ".." in member.name.split("/"):
                            raise ValueError(f"unsafe member {member.name!r} in {row['shard']}")
                        full = f"{_place(dst_root, row['export_id'], row['dir'], flat)}/{member.name}"
                        dst.create_dir(full.rsplit("/", 1)[0], recursive=True)
                        content = tar.extractfile(member)
                        with dst.open_output_stream(full) as f:
                            while chunk := content.read(WRITE_BYTES):
                                f.write(chunk)
                        for c, v in zip(out, (row["export_id"], row["dir"], member.name, member.size)):
                            out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("export_id", pa.int64()), ("dir", pa.string()), ("file_name", pa.string()), ("size_bytes", pa.int64())]))

    return run


def unpack(manifest: DataFrame, source: str, target: str, flat: bool = False) -> DataFrame:
    """(export_id, dir, file_name, size_bytes): files restored from the shards that the manifest names, a task a shard.

    A missing shard fails the query.
    """
    return named_shards(manifest).mapInArrow(_unpacker(source, target, flat), "export_id bigint, dir string, file_name string, size_bytes bigint")
