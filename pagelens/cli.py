"""Command line: the verbs of the page pipeline.

Verbs that need a remote hub, a competition site or a trained model are refused with a message; the engine offers
their interfaces (``pagelens.operators.infer``) and leaves the effect to the caller.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.config import checkpoint_in, load_config, load_env, load_preset, resolve
from pagelens.operators.infer import MODES
from pagelens.session import discard, local_session

EXTERNAL = {
    "download": "fetches a dataset", "download-curated": "fetches a dataset", "download-detector": "fetches a model", "download-vlm": "fetches a model",
    "train-detector": "trains a model", "upload-dataset": "sends a dataset to a hub", "upload-model": "sends a model to a hub", "submit-kaggle": "sends a submission to a site",
}


def _uri(path: str) -> str:
    from pathlib import Path

    return path if "://" in path else f"file://{Path(path).expanduser().resolve()}"


def _named(place: str):  # noqa: ANN202
    """The object that ``module:name`` means; the module's own functions are sent to the executors along with it."""
    path, _, name = place.partition(":")
    module = importlib.import_module(path)
    cloudpickle.register_pickle_by_value(module)
    return getattr(module, name)


def _setting(a: argparse.Namespace, config: dict, name: str, *path: str, default=None):  # noqa: ANN001, ANN202
    """A verb's setting: the command line's (0 counts), the preset's, the configuration's, the default."""
    preset = load_preset(getattr(a, "presets", None), getattr(a, "preset", None))
    return resolve(getattr(a, name, None), preset, config, name, path, default)


def curate(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    """Write the curated tables, image copies and crops, the detector's labels and split assignments; returns the counts.

    Crops are cut by ``--codec module:factory``; without one the crops' names are written and the cutting is left to the caller.
    """
    from pagelens.operators import curate as C
    from pagelens.session import stage
    from pagelens.sources.cards import dataset_card
    from pagelens.sources.scans import read_available
    from pagelens.sources.sinks import copy_images, crop_images, crop_tasks, label_files, page_copies, put_texts, write_jsonl

    raw, out = _uri(a.raw_dir), _uri(a.output_dir)
    silver = _setting(a, config, "include_silver", "curation", "include_silver")
    crops = _setting(a, config, "crop_images", "curation", "crop_images")
    pages = stage(C.curate_pages(read_available(spark, raw, silver, _setting(a, config, "max_silver", "curation", "max_silver"))), "curated")
    regions = stage(C.region_rows(pages, crops), "regions")
    tables: dict[str, DataFrame] = {"metadata": pages, "regions": regions, "vlm_sft": C.crop_sft_rows(regions)}
    if _setting(a, config, "page_sft", "curation", "page_sft", default=True):
        tables |= {"page_sft": C.page_sft_rows(pages), "page_text_sft": C.page_text_sft_rows(pages)}
    for name, df in tables.items():
        write_jsonl(df, f"{out}/{name}.jsonl")
    fraction, seed = _setting(a, config, "val_fraction", "curation", "val_fraction"), _setting(a, config, "seed", "curation", "seed")
    assigned = stage(C.split_assignments(pages.where("split <> 'test'"), fraction, seed), "assignments")
    write_jsonl(assigned, f"{out}/yolo/split_assignments.jsonl")
    put_texts(label_files(pages, assigned), f"{out}/yolo").write.format("noop").mode("overwrite").save()
    put_texts(spark.createDataFrame([("data.yaml", C.data_yaml(f"{out}/yolo"))], "path string, content string"), f"{out}/yolo").write.format("noop").mode("overwrite").save()
    copied = copy_images(page_copies(pages, assigned, out)).agg(F.count_if("copied").alias("n")).first().n
    cut = 0
    if crops and a.codec:
        tasks = crop_tasks(regions.join(pages.select(F.col("file_name").alias("page_file_name"), "split", "image_path"), ["page_file_name", "split"]), out)
        cut = crop_images(tasks, _named(a.codec)).agg(F.count_if("cropped").alias("n")).first().n
    stats = C.curation_stats(pages, crops).first()
    card = dataset_card(stats, C.source_counts(pages), C.region_type_counts(pages))
    put_texts(spark.createDataFrame([(f, card) for f in ("README.md", "dataset_card/README.md")], "path string, content string"), out).write.format("noop").mode("overwrite").save()
    return stats.asDict() | {"copied_images": copied, "cropped_regions": cut}


def evaluate(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    """Scores of predictions against a split, or against the curated validation pages (``yolo_val``), with groups."""
    from pagelens.operators import metrics as S
    from pagelens.operators.pages import last_wins, normalize_pages
    from pagelens.session import stage
    from pagelens.constants import RAW_PAGE
    from pagelens.sources.scans import read_jsonl, read_predictions, read_split, val_pages

    if a.split == "yolo_val":
        if not a.curated_dir:
            raise ValueError("yolo_val needs --curated-dir")
        curated = _uri(a.curated_dir)
        assigned = read_jsonl(spark, f"{curated}/yolo/split_assignments.jsonl", "file_name string, image string, split string")
        truth = val_pages(normalize_pages(read_jsonl(spark, f"{curated}/metadata.jsonl", RAW_PAGE), F.lit("train")), assigned)
    else:
        if not a.raw_dir:
            raise ValueError("a split of the raw pages needs --raw-dir")
        truth = read_split(spark, _uri(a.raw_dir), a.split)
    t = truth.select(F.col("image_name").alias("image"), "source", "annotation_source", "regions", "_ord")
    counters = stage(S.page_counters(last_wins(t, "image", "_ord"), read_predictions(spark, _uri(a.predictions)), a.iou_threshold), "counters")
    wanted = ["overall"] + ["source"] * a.by_source + ["annotation_source"] * a.by_annotation_source
    groups = S.grouped(counters).where(F.col("grouping").isin(wanted)).orderBy("grouping", "key").collect()  # a row a source
    own = S.overall(counters).first().asDict()
    return own | {f"by_{g}": {r.key: r.asDict() for r in groups if r.grouping == g} for g in wanted[1:]}


def infer(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    """Predictions of the test split by models whose factories are named as ``module:factory``; without one a model answers nothing."""
    from pagelens.operators.infer import empty_detector, empty_model, empty_pages, run_inference
    from pagelens.session import stage
    from pagelens.sources.scans import read_split
    from pagelens.sources.sinks import write_jsonl

    models = {k: _named(v) for k, v in (("detector", a.detector_model), ("page_model", a.vlm_model), ("region_model", a.region_model)) if v}
    number = lambda n: _setting(a, config, n, "inference", n)
    found = stage(
        run_inference(
            read_split(spark, _uri(a.raw_dir), "test"), a.mode, models.get("detector", empty_detector), models.get("page_model", empty_model), models.get("region_model"),
            a.ensemble_iou_threshold, number("detector_confidence"), number("page_max_new_tokens"), number("region_max_new_tokens"), number("batch_size"),
        ),
        "predictions",
    )
    write_jsonl(found, _uri(a.output))
    return {"pages": found.count(), "empty_pages": empty_pages(found).first()[0]}


def make_submission(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    """A submission from predictions and the sample."""
    from pagelens.operators.match import submission
    from pagelens.sources.scans import read_predictions, read_submission
    from pagelens.sources.sinks import write_submission

    rows = submission(read_submission(spark, _uri(a.sample)), read_predictions(spark, _uri(a.predictions)).withColumn("_ord", F.lit(0)))
    write_submission(rows, _uri(a.output))
    return {"rows": rows.count()}


def _listing(spark: SparkSession, root: str) -> DataFrame:
    from pagelens.sources.scans import list_files

    parts = F.split(F.col("path").substr(F.lit(len(root) + 2), F.lit(1 << 20)), "/")
    folder = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    f = list_files(spark, root).select(F.lit(0).cast("bigint").alias("export_id"), folder.alias("dir"), F.element_at(parts, -1).alias("file_name"), "size_bytes", F.lit(None).cast("timestamp").alias("listed_at"))
    return f.where(~F.col("file_name").startswith(".") & (F.col("file_name") != "_pack_manifest.json"))


def pack(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    """Consolidate the loose files of the packable folders below ``source`` into shards below ``target``, by default in place."""
    from pagelens.operators.compaction import check_layout, consolidate, loose_files, manifest_totals
    from pagelens.session import stage

    source, target = _uri(a.source), _uri(a.target or a.source)
    listing = _listing(spark, source)
    if a.dirs:
        listing = listing.where(F.col("dir").isin(a.dirs))
    elif not a.target:  # beside packed folders stand tables and cards
        listing = listing.where("dir <> ''")
    listing = stage(listing, "listing")
    limits = spark.createDataFrame([(0, a.max_files)], "export_id bigint, max_files_per_shard int")
    m = consolidate(listing, limits, source, target, flat=True, force=a.force, remove_loose=not a.target)
    check_layout(loose_files(_listing(spark, target)).select("dir", "file_name"))
    return {"exports": [r.asDict() for r in manifest_totals(m).collect()]}


def unpack(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    """Restore the files of the shards that the published manifest names."""
    from pagelens.operators.compaction import read_manifest
    from pagelens.operators.compaction import unpack as restore

    m = read_manifest(spark, _uri(a.source))
    if m is None:
        raise FileNotFoundError(f"no manifest below {a.source}")
    return {"restored_files": restore(m, _uri(a.source), _uri(a.target), flat=True).count()}


def sft_rows(spark: SparkSession, a: argparse.Namespace, config: dict) -> dict:
    """The rows a training run would see: filtered, split by source; training itself is left to the caller."""
    from pagelens.constants import SFT_ROW
    from pagelens.operators.curate import serialize_answers, sft_filter, train_eval_split
    from pagelens.session import stage
    from pagelens.sources.scans import read_jsonl
    from pagelens.sources.sinks import write_jsonl

    least, most = _setting(a, config, "min_quality_weight", "training", "min_quality_weight"), _setting(a, config, "sample_limit", "training", "sample_limit")
    rows = read_jsonl(spark, _uri(a.train_jsonl), SFT_ROW)
    kept = stage(serialize_answers(sft_filter(rows, least, most)), "sft")
    parts = stage(train_eval_split(kept, "id", _setting(a, config, "eval_fraction", "training", "eval_fraction"), a.seed).select("id", "split"), "sft-split")
    for name in ("train", "eval"):
        write_jsonl(kept.join(parts.where(F.col("split") == name), "id").drop("split"), f"{_uri(a.output_dir)}/{name}.jsonl")
    return {r.split: r["count"] for r in parts.groupBy("split").count().collect()}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pagelens")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, run, *required: str, **options) -> None:  # noqa: ANN001
        v = sub.add_parser(name, help=(run.__doc__ or "").split(".")[0])
        v.set_defaults(run=run)
        for r in required:
            v.add_argument(f"--{r}", required=True)
        for k, kw in options.items():
            v.add_argument(f"--{k.replace('_', '-')}", **kw)

    flag, yes_no = {"action": "store_true"}, {"action": argparse.BooleanOptionalAction, "default": None}
    verb("curate", curate, "raw-dir", "output-dir", include_silver=yes_no, crop_images=yes_no, page_sft=yes_no, codec={}, max_silver={"type": int}, val_fraction={"type": float}, seed={"type": int})
    verb("evaluate", evaluate, "predictions", raw_dir={}, curated_dir={}, split={"default": "train"}, iou_threshold={"type": float, "default": 0.5}, by_source=flag, by_annotation_source=flag)
    models = {"detector_model": {}, "vlm_model": {}, "region_model": {}, "detector_confidence": {"type": float}, "ensemble_iou_threshold": {"type": float, "default": 0.5}}
    numbers = {n: {"type": int} for n in ("region_max_new_tokens", "page_max_new_tokens", "batch_size")}
    verb("infer", infer, "raw-dir", "output", mode={"default": "empty", "choices": MODES}, **models, **numbers)
    verb("make-submission", make_submission, "sample", "predictions", "output")
    verb("pack-curated", pack, "source", target={}, max_files={"type": int, "default": 2000}, dirs={"nargs": "*"}, force=flag)
    verb("unpack-curated", unpack, "source", "target")
    verb("train-vlm-qlora", sft_rows, "train-jsonl", "output-dir", min_quality_weight={"type": float}, sample_limit={"type": int}, eval_fraction={"type": float}, preset={}, presets={}, seed={"type": int, "default": 42})
    for name, what in EXTERNAL.items():
        v = sub.add_parser(name, help=f"{what}: not done here")
        v.add_argument("rest", nargs="*")
        v.set_defaults(run=None)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    load_env()
    if a.run is None:
        print(f"{a.verb} {EXTERNAL[a.verb]}, which this engine leaves to the caller", file=sys.stderr)
        return 2
    spark = local_session()
    try:
        print(json.dumps(a.run(spark, a, load_config(a.config)), ensure_ascii=False, default=str))
    finally:
        discard(spark)
    return 0


__all__ = ["checkpoint_in", "main", "parser"]

if __name__ == "__main__":
    sys.exit(main())
