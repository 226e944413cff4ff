"""Queries over the driver's tables, by name, with equivalent SQL where there is one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.functions import geometry as G
from pagelens.functions import prompts as P
from pagelens.functions import text as T
from pagelens.operators import compaction, curate, match, metrics, nested, sample
from pagelens.operators import pages as pg
from pagelens.plans import adapter as A
from pagelens.plans import oracle
from pagelens.session import prepare, shared_folder, table
from pagelens.sources import scans, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def _curated(spark: SparkSession, d: str) -> DataFrame:
    return curate.curate_pages(A.pages(spark, d))


def _box(b: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(b.cast("array<string>"), ","), F.lit("]"))


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Problems of the core.


def _nested(spark: SparkSession, d: str, *fields: str) -> DataFrame:
    return nested.flatten(table(prepare(spark), d, "page_raw"), fields=fields)


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Each region object of the pages of page_raw by page and path."""
    return nested.region_table(_nested(spark, d)).select("page_id", "region_path")


@query
def p1_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages of page_raw."""
    return nested.page_table(_nested(spark, d, "file_name", "image_width", "image_height", "source", "annotation_source", "year", "fund", "content_type", "grade", "subject", "group"))


@query
def p1_images(spark: SparkSession, d: str) -> DataFrame:
    """Image objects with their page."""
    return nested.image_table(_nested(spark, d, "path", "src", "width", "height"))


@query
def p1_regions(spark: SparkSession, d: str) -> DataFrame:
    """Regions at any depth with page and parent region."""
    return nested.region_table(_nested(spark, d, "type", "text", "language", "legibility", "confidence"))


@query
def p1_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes with page and region."""
    return nested.bbox_table(_nested(spark, d, "bbox"))


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Loose files that the recorded packing loses or holds more than once."""
    prepare(spark)
    t = lambda n: table(spark, d, n)
    return compaction.audit_packing(t("pack_files"), t("shard_members"), t("pack_manifest")).drop("held")


@query
def p5_plan(spark: SparkSession, d: str) -> DataFrame:
    """The new packing: each distinct loose file with its shard."""
    prepare(spark)
    return compaction.repack(table(spark, d, "pack_files"), table(spark, d, "pack_manifest"))


# Pages and regions.


@query
def normalize_pages(spark: SparkSession, d: str) -> DataFrame:
    """Normalised pages."""
    return A.pages(spark, d).select("page_id", "file_name", "image_name", "image_width", "image_height", "source", "split", F.size("regions").alias("n_regions"))


@query
def predictions_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Of page rows with one base name the last."""
    name = F.coalesce(pg.full(F.col("file_name")), pg.full(F.col("image.path")), F.col("image.src"))
    rows = table(prepare(spark), d, "page_records").select(T.base_name(name).alias("image"), "row_id", "page_id").where("image IS NOT NULL")
    return pg.last_wins(rows, "image", "row_id")


@query
def quality_weight(spark: SparkSession, d: str) -> DataFrame:
    """Pages by annotation source with its weight."""
    p = A.pages(spark, d).select("annotation_source", pg.quality_weight(F.col("annotation_source")).alias("quality_weight"))
    return p.groupBy("annotation_source", "quality_weight").agg(F.count("*").alias("pages"))


@query
def normalize_region_type(spark: SparkSession, d: str) -> DataFrame:
    """Regions by raw and normalised type."""
    r = A.pages(spark, d).select(F.explode("regions.type").alias("raw_type")).withColumn("type", pg.region_type(F.col("raw_type")))
    return r.groupBy("raw_type", "type").agg(F.count("*").alias("regions"))


@query
def clamp_regions(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned regions with their boxes cut to the page."""
    r = _curated(spark, d).select("page_id", F.posexplode("regions").alias("idx", "r"))
    return r.select("page_id", "idx", *[F.col("r.bbox")[k].alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))], "r.type", "r.language", "r.legibility")


@query
def rejected_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Pages with the number of regions that cleaning drops."""
    p = A.pages(spark, d)
    kept = F.size(pg.clean_regions(F.col("regions"), F.col("image_width"), F.col("image_height")))
    return p.select("page_id", (F.size("regions") - kept).cast("bigint").alias("rejected")).where("rejected > 0")


@query
def region_rows(spark: SparkSession, d: str) -> DataFrame:
    """Flat curated regions."""
    return curate.region_rows(_curated(spark, d)).withColumn("bbox", _box(F.col("bbox")))


@query
def crop_sft_rows(spark: SparkSession, d: str) -> DataFrame:
    """Training rows of crops."""
    # Two pages may have files of one name, so page_id goes along inside the id.
    keyed = curate.region_rows(_curated(spark, d)).withColumn("region_id", F.struct("region_id", "page_id"))
    return curate.crop_sft_rows(keyed).select(F.col("id.page_id").alias("page_id"), F.col("id.region_id").alias("id"), "image", "task", "region_type", "source", "quality_weight", "prompt", "answer")


@query
def page_sft_rows(spark: SparkSession, d: str) -> DataFrame:
    """Training rows of pages, answers flattened to text."""
    rows = curate.page_sft_rows(_curated(spark, d))
    flat = F.array_join(F.transform("answer", lambda a: F.concat_ws("|", _box(a["bbox"]), a["type"], a["text"])), "\n")
    return rows.withColumn("answer", flat)


@query
def page_text_sft_rows(spark: SparkSession, d: str) -> DataFrame:
    """Training rows of page texts, answers joined by line ends."""
    return curate.page_text_sft_rows(_curated(spark, d)).withColumn("answer", F.array_join("answer", "\n"))


@query
def page_text_lines(spark: SparkSession, d: str) -> DataFrame:
    """Text lines of pages that have any."""
    lines = curate.page_text_lines(F.col("regions"))
    return _curated(spark, d).select("page_id", lines.alias("l")).where("size(l) > 0").select("page_id", F.array_join("l", "\n").alias("lines"), F.size("l").cast("bigint").alias("n"))


@query
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    """Each region's place in reading order."""
    indexed = F.transform("regions", lambda r, i: F.struct(r["bbox"].alias("bbox"), i.alias("idx")))
    return _curated(spark, d).select("page_id", F.posexplode(G.in_reading_order(indexed)).alias("place", "r")).select("page_id", F.col("r.idx").alias("idx"), "place")


@query
def source_counts(spark: SparkSession, d: str) -> DataFrame:
    """Pages by source."""
    return curate.source_counts(A.pages(spark, d))


@query
def region_type_counts(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned regions by type."""
    return curate.region_type_counts(_curated(spark, d))


@query
def curation_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counts over the curated tables."""
    return curate.curation_stats(_curated(spark, d))


@query
def yolo_labels(spark: SparkSession, d: str) -> DataFrame:
    """Label lines of pages that aren't test pages."""
    c = _curated(spark, d).where("split <> 'test' AND size(regions) > 0")
    return c.select("page_id", F.array_join(curate.yolo_lines(F.col("regions"), F.col("image_width"), F.col("image_height")), "\n").alias("label"))


@query
def prompts(spark: SparkSession, d: str) -> DataFrame:
    """Prompts of all sources and region types that occur."""
    kinds = _curated(spark, d).select("source", F.explode("regions.type").alias("type")).distinct()
    s = F.col("source")
    return kinds.select("source", "type", P.region_prompt(s, F.col("type")).alias("region_prompt"), P.page_regions_prompt(s).alias("page_prompt"), P.page_lines_prompt(s).alias("lines_prompt"))


@query
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    """Detector export split by source."""
    p = _curated(spark, d).where(F.col("split").isin("train", "silver") & (F.size("regions") > 0))
    return curate.stratified_split(p, "file_name", 0.15, 42)


@query
def train_eval_split(spark: SparkSession, d: str) -> DataFrame:
    """Training rows by split and source."""
    rows = curate.crop_sft_rows(curate.region_rows(_curated(spark, d)))
    return curate.train_eval_split(rows, "id", 0.1, 42).groupBy("source", "split").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query
def val_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Pages whose image is assigned to validation."""
    c = _curated(spark, d)
    val = curate.split_assignments(c).where("split = 'val'").select(F.col("image").alias("image_name"))
    return c.join(val, "image_name", "left_semi").select("page_id", "image_name")


@query
def sft_filter(spark: SparkSession, d: str) -> DataFrame:
    """Training rows of enough weight, counted by type and source."""
    rows = curate.sft_filter(curate.crop_sft_rows(curate.region_rows(_curated(spark, d))), 0.75)
    return rows.groupBy("region_type", "source").agg(F.count("*").alias("n"), F.sum(F.length("answer")).alias("chars"))


@query
def sample_weights(spark: SparkSession, d: str) -> DataFrame:
    """Sampling weight of each flat region."""
    r = pg.last_wins(table(prepare(spark), d, "region_rows").select("region_key", "exported_at", "quality_weight"), "region_key", "exported_at")
    return r.select("region_key", sample.sample_weight(F.col("quality_weight")).alias("weight"))


@query
def weighted_sample(spark: SparkSession, d: str) -> DataFrame:
    """Draws with replacement by weight, as many as regions."""
    r = table(prepare(spark), d, "region_rows").groupBy("region_key").agg(F.max("quality_weight").alias("quality_weight"))
    return sample.weighted_sample(r, "region_key", "quality_weight", 7)


@query
def fitted_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of page images for a model with few and with many pixels."""
    p = A.pages(spark, d).where("image_width > 0 AND image_height > 0").select("image_width", "image_height").distinct()
    few, many = (G.fitted_size(F.col("image_width"), F.col("image_height"), n) for n in (262144, 16777216))
    return p.select("image_width", "image_height", few["width"].alias("few_w"), few["height"].alias("few_h"), many["width"].alias("many_w"), many["height"].alias("many_h"))


# Matching and scores.


def _both(spark: SparkSession, d: str) -> DataFrame:
    t = A.truth(spark, d).repartition("image").select("image", "page_id", pg.boxed(F.col("regions")).alias("t"))
    return t.join(A.predictions(spark, d).repartition("image").withColumnRenamed("regions", "p"), "image")


@query
def iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping pairs of predicted and true regions."""
    t = A.truth(spark, d).select("page_id", pg.boxed(F.col("regions")).alias("regions"))
    p = A.predictions(spark, d).select(F.col("image").cast("bigint").alias("page_id"), "regions")
    return _round(match.iou_pairs(match.explode_boxes(p, "page_id"), match.explode_boxes(t, "page_id"), "page_id"), "iou")


@query
def greedy_match(spark: SparkSession, d: str) -> DataFrame:
    """Greedy one-to-one matches."""
    m = _both(spark, d).select("page_id", F.explode(match.greedy_match(F.col("p"), F.col("t"))).alias("m"))
    return m.select("page_id", F.col("m.p").alias("pred_idx"), F.col("m.t").alias("truth_idx"))


def _counters(spark: SparkSession, d: str) -> DataFrame:
    return metrics.page_counters(A.truth(spark, d), A.predictions(spark, d))


@query
def page_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of each page."""
    c = _round(_counters(spark, d), "cer_sum", "page_cer")
    return c.select(F.col("image").cast("bigint").alias("page_id"), *[x for x in c.columns if x != "image"])


@query
def page_cer(spark: SparkSession, d: str) -> DataFrame:
    """Edit-distance rate of each page's text."""
    return _counters(spark, d).select(F.col("image").cast("bigint").alias("page_id"), F.round("page_cer", 6).alias("page_cer"))


_RATES = ["precision", "recall", "f1", "class_acc", "cer", "page_cer", "score", "proxy_score"]


@query
def score_overall(spark: SparkSession, d: str) -> DataFrame:
    """Scores over all pages."""
    return _round(metrics.overall(_counters(spark, d)), *_RATES)


@query
def score_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """Scores overall, by source and by annotation source."""
    return _round(metrics.grouped(_counters(spark, d)), *_RATES)


@query
def score_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Scores by source."""
    return score_grouping_sets(spark, d).where("grouping = 'source'")


@query
def score_by_annotation_source(spark: SparkSession, d: str) -> DataFrame:
    """Scores by annotation source."""
    return score_grouping_sets(spark, d).where("grouping = 'annotation_source'")


@query
def score_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Scores with texts in their normalised form."""
    return _round(metrics.grouped(metrics.page_counters(A.truth(spark, d), A.predictions(spark, d))), *_RATES)


@query
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    """Normalised texts of flat regions, with pieces added that need every step."""
    t = F.col("text")
    k = F.length(F.coalesce(t, F.lit(""))) % 7
    made = (
        F.when(k == 0, F.concat(t, F.lit(" \\mathrm{\\mathbf{x}}²")))
        .when(k == 1, F.concat(t, F.lit("~~a~~{b} «c» x²³ 2² \\top")))
        .when(k == 2, F.concat(t, F.lit("  \\overset{a}{b}\\big( y_{12} z^{3} \\sin x")))
        .when(k == 3, F.concat(t, F.lit(" \\xrightarrow[a]{b}\u00a0\x1cH₂O ''")))
        .otherwise(t)
    )
    rows = table(prepare(spark), d, "region_rows").select("text").distinct().select(made.alias("text"))
    return rows.select("text", T.normalize_text(F.col("text")).alias("normalized"))


# Merging, assignment, model output.


def _predicted_lines(spark: SparkSession, d: str) -> DataFrame:
    """Curated pages with text lines: some pages lack their first line, some have more lines than regions."""
    own = curate.page_text_lines(F.col("regions"))
    extra = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda e: F.when(F.col("page_id") % 3 >= e, F.concat(F.lit("extra "), e.cast("string"))))
    lines = F.concat(F.when((F.col("page_id") % 5 == 0) & (F.size(own) > 0), F.slice(own, 2, F.greatest(F.size(own) - 1, F.lit(0)))).otherwise(own), F.array_compact(extra))
    return _curated(spark, d).withColumn("lines", lines)


def _places(df: DataFrame, regions: Column) -> DataFrame:
    r = df.select("page_id", F.posexplode(regions).alias("place", "r"))
    return r.select("page_id", "place", *[F.col("r.bbox")[k].alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))], "r.type", "r.text")


@query
def assign_text_lines(spark: SparkSession, d: str) -> DataFrame:
    """Text lines given to regions in reading order."""
    p = _predicted_lines(spark, d)
    return _places(p, match.assign_lines(F.col("regions"), F.col("lines"), F.col("image_width"), F.col("image_height")))


@query
def synthetic_bands(spark: SparkSession, d: str) -> DataFrame:
    """Bands for the text lines of pages without boxes."""
    p = _predicted_lines(spark, d).where("size(lines) > 0")
    return _places(p, match.band_regions(F.col("lines"), F.col("image_width"), F.col("image_height"))).drop("type")


@query
def finalize_regions(spark: SparkSession, d: str) -> DataFrame:
    """Regions after a model: cut, blanked and ordered."""
    p = A.pages(spark, d)
    r = p.select("page_id", F.posexplode(match.finalize_regions(F.col("regions"), F.col("image_width"), F.col("image_height"))).alias("place", "r"))
    return r.select("page_id", "place", _box(F.col("r.bbox")).alias("bbox"), "r.type", "r.text")


@query
def ensemble_merge(spark: SparkSession, d: str) -> DataFrame:
    """Predictions completed by the truth as the detector's regions."""
    merged = match.merge_regions(F.col("p"), F.col("t"))
    return _places(_both(spark, d), merged)


@query
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    """Arrays found in raw payloads, taken as model output."""
    from pagelens.functions.jsonrepair import extract_array

    e = table(prepare(spark), d, "page_raw").select("raw_id", extract_array(F.col("payload")).alias("e"))
    return e.select("raw_id", F.size("e.items").alias("items"), "e.ok", "e.error")


@query
def text_lines(spark: SparkSession, d: str) -> DataFrame:
    """Text lines of raw payloads, taken as model output."""
    from pagelens.functions.jsonrepair import text_lines as lines

    return table(prepare(spark), d, "page_raw").select("raw_id", F.array_join(lines(F.col("payload")), "\n").alias("lines"))


#: Answers of page models as they come: fenced, talked around, cut off, malformed.
MODEL_OUTPUTS = [
    '[{"bbox":[0,0,10,10],"type":"printed","text":"а"}]',
    '```json\n[{"bbox":[0,0,10,10],"text":"б]"},{"bbox":[5,5,500,20],"type":"stamp"}]\n```',
    'Ось відповідь: [{"text":"в"}] і ще [1]',
    '[{"bbox":[1,2,3,4],"text":"г"},{"bbox":[1,2,3',
    '[{"text":"ґ"} {"text":"д"}]',
    '["рядок", " ", 7, null, {"text":null}]',
    "[]", "перший\n\n другий ", "", "```\nлише текст\n```", '{"a":[1,2]}', "[1,", "[x]",
]


@query
def model_outputs(spark: SparkSession, d: str) -> DataFrame:
    """What is read from answers of page models: items, status, text lines and regions on a page of 100 by 50."""
    from pagelens.functions.jsonrepair import extract_array, regions_from_items
    from pagelens.functions.jsonrepair import text_lines as lines

    t = prepare(spark).createDataFrame(list(enumerate(MODEL_OUTPUTS)), "case_id int, answer string")
    e = t.select("case_id", extract_array(F.col("answer")).alias("e"), lines(F.col("answer")).alias("lines"))
    regions = F.transform(regions_from_items(F.col("e.items"), F.lit(100), F.lit(50)), lambda r: F.concat_ws(" ", _box(r["bbox"]), r["type"], r["text"], r["language"], r["legibility"]))
    return e.select("case_id", F.size("e.items").alias("items"), "e.ok", "e.error", F.array_join("lines", "|").alias("lines"), F.array_join(regions, "|").alias("regions"))


@query
def submission_join(spark: SparkSession, d: str) -> DataFrame:
    """Submission rows of the test pages."""
    c = _curated(spark, d)
    sample_rows = c.where("split = 'test'").select("page_id", F.col("image_name").alias("image"), F.lit("").alias("regions"))
    return match.submission(sample_rows, c.where("page_id % 7 <> 0").select(F.col("file_name").alias("image"), "regions", F.col("page_id").alias("_ord")))


def _seeing_detector():
    """Stand-in detector: an image is the JSON text of the page's own regions."""
    import json

    return lambda images: [json.loads(x) for x in images]


def _seeing_model():
    """Stand-in page model: it writes the regions of its image in a fence, after some talk."""
    return lambda images, prompts, tokens: [f"```json\nfound: {x}\n```" for x in images]


def _reading_model():
    """Stand-in text model: the texts of its image's regions, in their order; nothing where there are none."""
    import json

    def answer(image: str) -> str:
        texts = [r["text"] for r in json.loads(image)]
        return json.dumps(texts, ensure_ascii=False) if texts else ""

    return lambda images, prompts, tokens: [answer(x) for x in images]


def _inferred(spark: SparkSession, d: str) -> DataFrame:
    """(mode, image, regions) of all pages by stand-in models; image is the page's id."""
    from pagelens.operators.infer import run_inference

    p = A.pages(spark, d).withColumn("image_name", F.col("page_id").cast("string")).withColumn("image_path", F.to_json("regions"))
    out = None
    for m in ("empty", "detector-vlm", "page-vlm", "page-text-vlm"):
        one = run_inference(p, m, _seeing_detector, _reading_model if m == "page-text-vlm" else _seeing_model).withColumn("mode", F.lit(m))
        out = one if out is None else out.unionByName(one)
    return out


@query
def inference_regions(spark: SparkSession, d: str) -> DataFrame:
    """Final regions of stand-in models, by mode."""
    r = _inferred(spark, d).select("mode", F.col("image").cast("bigint").alias("page_id"), F.posexplode("regions").alias("place", "r"))
    return r.select("mode", "page_id", "place", _box(F.col("r.bbox")).alias("bbox"), "r.type", "r.text")


@query
def inference_modes(spark: SparkSession, d: str) -> DataFrame:
    """Pages without regions after inference with stand-in models, by mode."""
    return _inferred(spark, d).groupBy("mode").agg(F.count_if(F.size("regions") == 0).alias("empty_pages"))


# Files: each query writes its table through a sink and reads it again through the scan.


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(prepare(spark))}/files-{uuid.uuid4().hex[:12]}"


@query
def scan_available(spark: SparkSession, d: str) -> DataFrame:
    """Pages of the train, silver and test files of a raw dataset."""
    root, raw = _scratch(spark), A.raw_pages(spark, d)
    for split in ("train", "silver", "test"):
        sinks.write_jsonl(raw.where(F.col("split") == split).drop("row_id", "page_id", "split", "captured_at", "ingested_at"), f"{root}/{split}/metadata.jsonl")
    p = scans.read_available(spark, root, include_silver=True)
    return p.select("file_name", "image_name", "image_width", "image_height", "source", "split", F.size("regions").alias("n_regions"))


@query
def scan_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Predictions written with folders before the names, read by base name."""
    path = f"{_scratch(spark)}/predictions.jsonl"
    sinks.write_jsonl(A.predictions(spark, d).withColumn("image", F.concat(F.lit("some/where/"), "image")), path)
    p = scans.read_predictions(spark, path)
    chars = F.aggregate("regions", F.lit(0), lambda a, r: a + F.length(r["text"]))
    return p.select(F.col("image").cast("bigint").alias("page_id"), F.size("regions").alias("n_regions"), chars.alias("chars"))


@query
def scan_submission(spark: SparkSession, d: str) -> DataFrame:
    """Submission rows written as CSV and read again."""
    path = f"{_scratch(spark)}/submission.csv"
    sinks.write_submission(submission_join(spark, d).withColumn("_ord", F.col("page_id")), path)
    return scans.read_submission(spark, path).select(F.col("page_id").cast("bigint").alias("page_id"), "image", "regions")


@query
def scan_listing(spark: SparkSession, d: str) -> DataFrame:
    """Files of label lines, written a page each and listed."""
    root = _scratch(spark)
    labels = yolo_labels(spark, d).select(F.concat_ws("/", (F.col("page_id") % 5).cast("string"), (F.col("page_id") % 3).cast("string"), F.concat(F.col("page_id").cast("string"), F.lit(".txt"))).alias("path"), F.col("label").alias("content"))
    sinks.put_texts(labels, root).write.format("noop").mode("overwrite").save()
    return scans.list_files(spark, root).select(F.col("path").substr(F.lit(len(root) + 2), F.lit(1 << 20)).alias("path"), "size_bytes")


@query
def val_assignments(spark: SparkSession, d: str) -> DataFrame:
    """Split of each detector image by name."""
    return curate.split_assignments(_curated(spark, d))


# Packing and listings.


def _files(spark: SparkSession, d: str) -> DataFrame:
    f = compaction.loose_files(table(prepare(spark), d, "pack_files"))
    return f.withColumn("export_dir", F.concat_ws("/", F.col("export_id").cast("string"), "dir"))


@query
def shard_plan(spark: SparkSession, d: str) -> DataFrame:
    """Shards of 100 files in order of names."""
    return compaction.shard_plan(_files(spark, d).select(F.col("export_dir").alias("dir"), "file_name").distinct(), 100)


@query
def shard_files(spark: SparkSession, d: str) -> DataFrame:
    """Files and shards of the new packing by export and dir."""
    return p5_plan(spark, d).groupBy("export_id", "dir").agg(F.count("*").alias("files"), F.count_distinct("shard").alias("shards"))


@query
def dir_counts_guard(spark: SparkSession, d: str) -> DataFrame:
    """Dirs with more than 100 files."""
    return compaction.overfull_dirs(_files(spark, d).select(F.col("export_dir").alias("dir"), "file_name"), 100)


@query
def manifest_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of the newest manifests."""
    return compaction.manifest_totals(table(prepare(spark), d, "pack_manifest"))


@query
def folder_stats(spark: SparkSession, d: str) -> DataFrame:
    """Number and bytes of listed files."""
    return compaction.folder_stats(table(prepare(spark), d, "pack_files"))


@query
def format_bytes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes for people."""
    n = table(prepare(spark), d, "pack_files").where("size_bytes IS NOT NULL").select((F.col("size_bytes") * 100000).alias("n")).distinct()
    return n.select("n", T.format_bytes(F.col("n")).alias("text"))


@query
def top_level_paths(spark: SparkSession, d: str) -> DataFrame:
    """First parts of all paths."""
    p = F.when(F.col("dir") == "", F.col("file_name")).otherwise(F.concat_ws("/", "dir", "file_name"))
    return compaction.top_level_paths(_files(spark, d).select(p.alias("path")))


def _ids(page: Column) -> Column:
    return F.transform(F.sequence(F.lit(1).cast("bigint"), page % 9 + 1), lambda x: (page * x) % 5)


@query
def label_mask(spark: SparkSession, d: str) -> DataFrame:
    """Token ids with prompt and padding masked."""
    p = F.col("page_id")
    return A.pages(spark, d).select("page_id", F.array_join(T.mask_labels(_ids(p), p % 4, F.lit(0)).cast("array<string>"), ",").alias("labels"))


@query
def right_truncate(spark: SparkSession, d: str) -> DataFrame:
    """Token ids cut to six."""
    return A.pages(spark, d).select("page_id", F.array_join(T.truncate_right(_ids(F.col("page_id")), 6, F.lit(False)).cast("array<string>"), ",").alias("ids"))


P5_FOUND_SQL = """
WITH plain AS (
  SELECT DISTINCT export_id, trim(regexp_replace(regexp_replace(replace(coalesce(dir, ''), chr(92), '/'), '(^|/)([.](/|$))+', '/', 'g'), '/+', '/', 'g'), '/') AS dir, file_name
  FROM pack_files WHERE export_id IS NOT NULL AND file_name IS NOT NULL AND NOT regexp_matches(file_name, '^shard-.*[.]tar$')
), newest AS (
  SELECT * FROM pack_manifest QUALIFY row_number() OVER (PARTITION BY export_id ORDER BY written_at DESC) = 1
), dirs AS (SELECT export_id, unnest(packed_dirs) AS d FROM newest),
named AS (SELECT DISTINCT export_id, d.dir AS dir, unnest(d.shards) AS shard FROM dirs),
members AS (SELECT DISTINCT export_id, dir, shard, member_no, member_name FROM shard_members),
held AS (
  SELECT export_id, dir, member_name, count(*) AS n FROM members SEMI JOIN named USING (export_id, dir, shard) GROUP BY ALL
)
SELECT p.export_id, p.dir, p.file_name FROM plain p
LEFT JOIN held h ON h.export_id = p.export_id AND h.dir = p.dir AND h.member_name = p.file_name
WHERE coalesce(h.n, 0) <> 1
"""


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The query of the driver's smoke check."""
    return score_grouping_sets(spark, d)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_FOUND_SQL} | oracle.oracle_sql()
