"""Curation, splits, sampling, numbering, scans, sinks, packing and nested records."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagelens.constants import RAW_PAGE
from pagelens.operators import compaction as K
from pagelens.operators import curate as C
from pagelens.operators import nested as N
from pagelens.operators.infer import run_inference
from pagelens.operators.ordinal import row_numbers, running
from pagelens.operators.pages import last_wins
from pagelens.operators.sample import sample_weight, weighted_sample
from pagelens.sources import cards, scans, sinks


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "train").mkdir()
    (tmp_path / "test").mkdir()
    page = {"file_name": "page-1.jpg", "image_width": 200, "image_height": 100, "source": "dictation", "annotation_source": "annotator",
            "regions": [{"bbox": [10, 20, 110, 50], "type": "handwritten", "text": "Тест", "language": "uk", "legibility": "legible"}, {"bbox": [1.5]}, None]}
    (tmp_path / "train/metadata.jsonl").write_text(json.dumps(page, ensure_ascii=False) + "\n\n", encoding="utf-8")
    (tmp_path / "test/metadata.jsonl").write_text(json.dumps({"image": {"src": "http://x/y/test-1.jpg", "width": 50, "height": 40}, "regions": None}) + "\n", encoding="utf-8")
    return f"file://{tmp_path}"


def test_curate_end_to_end(spark, raw):
    pages = scans.read_available(spark, raw, include_silver=True, max_silver=1)
    c = C.curate_pages(pages)
    s = C.curation_stats(c).first()
    assert (s.pages, s.regions, s.vlm_examples, s.page_sft_examples, s.page_text_sft_examples) == (2, 1, 1, 1, 1)
    assert [tuple(a) for a in C.page_sft_rows(c).first().answer] == [([10, 20, 110, 50], "handwritten", "Тест")]
    assert C.page_text_sft_rows(c).first().answer == ["Тест"]
    r = C.region_rows(c).first()
    assert (r.region_id, r.crop, r.page_file_name) == ("train:page-1:0000", "crops/train/page-1_0000.jpg", "images/page-1.jpg")
    assert C.crop_sft_rows(C.region_rows(c)).count() == 1 and C.crop_sft_rows(C.region_rows(c, crop_images=False)).count() == 0
    test = c.where("split = 'test'").first()
    assert (test.file_name, test.image_width, test.image_height, test.regions) == ("images/test-1.jpg", 50, 40, [])


def test_scans_and_sinks(spark, raw, tmp_path):
    assert scans.read_split(spark, raw, "silver").count() == 0
    (tmp_path / "bad.jsonl").write_text('{"file_name": "a"}\n{broken\n')
    with pytest.raises(Exception, match="[Mm]alformed|MALFORMED"):
        scans.read_jsonl(spark, f"file://{tmp_path}/bad.jsonl", RAW_PAGE).collect()
    lenient = scans.read_jsonl(spark, f"file://{tmp_path}/bad.jsonl", RAW_PAGE, strict=False).select("file_name", "_corrupt_record").collect()
    assert [tuple(r) for r in lenient] == [("a", None), (None, "{broken")]
    (tmp_path / "p.jsonl").write_text('{"image":"x/a.jpg","regions":[{"bbox":[1,2,3,4],"text":"1"}]}\n{"image":"a.jpg","regions":null}\n')
    assert [tuple(r) for r in scans.read_predictions(spark, f"file://{tmp_path}/p.jsonl").collect()] == [("a.jpg", [])]
    (tmp_path / "s.csv").write_text('image,regions\r\ntest-1.jpg,"[{""a"": 1}]"\r\n', newline="")
    sub = scans.read_submission(spark, f"file://{tmp_path}/s.csv")
    assert sub.first().regions == '[{"a": 1}]'
    sinks.write_submission(sub, f"file://{tmp_path}/out.csv")
    assert scans.read_submission(spark, f"file://{tmp_path}/out.csv").first().regions == '[{"a": 1}]'
    c = C.curate_pages(scans.read_available(spark, raw))
    a = C.split_assignments(c)
    assert [tuple(r) for r in a.select("file_name", "image", "split").collect()] == [("images/page-1.jpg", "page-1.jpg", "train")]
    done = sinks.put_texts(sinks.label_files(c, a), f"file://{tmp_path}/yolo").collect()
    assert [r.path for r in done] == ["labels/train/page-1.txt"]
    assert (tmp_path / "yolo/labels/train/page-1.txt").read_text() == "0 0.30000000 0.35000000 0.50000000 0.30000000\n"
    tasks = spark.createDataFrame([(f"file://{tmp_path}/p.jsonl", f"file://{tmp_path}/copy/p"), (f"file://{tmp_path}/none", f"file://{tmp_path}/copy/q")], "src string, dst string")
    assert sorted(r.copied for r in sinks.copy_images(tasks).collect()) == [False, True]
    sinks.write_jsonl(c.select("file_name", F.lit(None).cast("int").alias("x"), F.lit(1).alias("_hidden")), f"file://{tmp_path}/j", single_file=True)
    lines = [x for p in (tmp_path / "j").glob("*.json") for x in p.read_text().splitlines()]
    assert sorted(lines) == ['{"file_name":"images/page-1.jpg"}', '{"file_name":"images/test-1.jpg"}']
    assert scans.list_files(spark, raw).count() >= 2


def test_crops_and_detector_folder(spark, raw, tmp_path):
    c = C.curate_pages(scans.read_available(spark, raw))
    (tmp_path / "train/images").mkdir()
    (tmp_path / "train/images/page-1.jpg").write_bytes(b"image")
    tasks = sinks.crop_tasks(C.region_rows(c).join(c.select(F.col("file_name").alias("page_file_name"), "image_path"), "page_file_name"), f"file://{tmp_path}/out")
    both = tasks.union(tasks.select(F.lit(f"{raw}/none"), F.lit(f"{raw}/x"), "bbox"))
    got = sinks.crop_images(both, lambda: lambda data, box: data + str(box).encode()).collect()
    assert sorted(r.cropped for r in got) == [False, True]
    assert (tmp_path / "out/crops/train/page-1_0000.jpg").read_bytes() == b"image[10, 20, 110, 50]"
    files = lambda *names: spark.createDataFrame([(f"d/{n}",) for n in names], "path string")
    sinks.check_detector_images(files("a.JPG", "shard-00000.tar"))
    with pytest.raises(ValueError, match="unpack"):
        sinks.check_detector_images(files("shard-00000.tar"))
    with pytest.raises(ValueError, match="no training images"):
        sinks.check_detector_images(files("a.txt"))
    card = cards.dataset_card(C.curation_stats(c).first(), C.source_counts(c), C.region_type_counts(c))
    assert "| pages | 2 |" in card and "- `unknown`: 1" in card and "- `handwritten`: 1" in card


@pytest.mark.parametrize(("n", "fraction", "held"), [(1, 0.5, 0), (2, 0.0, 1), (10, 0.25, 2), (14, 0.25, 4)])
def test_split_counts(spark, n, fraction, held):
    df = spark.createDataFrame([(f"f{i}", None if i % 2 else "") for i in range(n)] * 2, "k string, source string")
    got = C.stratified_split(df, "k", fraction, 1).collect()
    assert len(got) == n and sum(r.split == "val" for r in got) == held and {r.source for r in got} == {"unknown"}


def test_sft_filter_and_eval_split(spark):
    rows = spark.createDataFrame([(0, "a", "x", 1.0, "s"), (1, "b", "y", 0.35, "s"), (2, "", "z", 1.0, "s"), (3, "c", None, 1.0, "s"), (4, "d", "w", None, None)], "_ord int, image string, answer string, quality_weight double, source string")
    assert [r._ord for r in C.sft_filter(rows, 0.75).collect()] == [0, 4]
    assert [r._ord for r in C.sft_filter(rows, limit=1).collect()] == [0]
    assert {r.split for r in C.train_eval_split(rows, "_ord", 0.0, 1).collect()} == {"train"}


def test_running_sums_over_groups_of_any_size(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, "hot", "hot", "x"]), i, rng.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, i int, v int")
    got = {r.i: r.s for r in running(df, ["g"], [F.col("i")], F.col("v"), "s").collect()}
    sums, want = Counter(), {}
    for g, i, v in data:
        sums[g] += v
        want[i] = sums[g]
    assert got == want
    assert row_numbers(df.limit(0), ["g"], [F.col("i")]).count() == 0


def test_weighted_sample(spark):
    rows = spark.createDataFrame([(i, w) for i, w in enumerate([1.0, 0.0, None, 50.0, -3.0, 1.0])], "k int, w double")
    assert [round(r[0], 2) for r in rows.select(sample_weight(F.col("w"))).collect()] == [1.0, 0.01, 1.0, 50.0, 0.01, 1.0]
    got = {r.k: r.draws for r in weighted_sample(rows, "k", "w", 3, 5000).collect()}
    assert sum(got.values()) == 5000 and abs(got[3] / 5000 - 50 / 53.02) < 0.02
    assert weighted_sample(rows.limit(0), "k", "w", 3).count() == 0


def test_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), (None, 1, "n")], "k string, o int, v string")
    assert {(r.k, r.v) for r in last_wins(df, "k", "o").collect()} == {("a", "y"), (None, "n")}


def listing(spark, files):
    return spark.createDataFrame([(1, d, f, s, None) for d, f, s in files], "export_id bigint, dir string, file_name string, size_bytes bigint, listed_at timestamp")


def test_plan_and_guard(spark):
    files = listing(spark, [("a", f"f{i}", i) for i in range(5)] + [("b", f"g{i}", None) for i in range(3)] + [("./a//", "f0", 9), ("a", "shard-00000.tar", 1), ("a", None, 1)])
    limits = spark.createDataFrame([(1, 2, "extra")], "export_id bigint, max_files_per_shard int, room string")
    p = K.plan_shards(K.loose_files(files), limits).collect()
    assert len(p) == 8 and len({(r.dir, r.shard) for r in p}) == 5 and max(Counter((r.dir, r.shard) for r in p).values()) <= 2
    cut = K.plan_shards(K.loose_files(files), limits, bucket_files=2).collect()
    assert len({(r.dir, r.file_name) for r in cut}) == 8 and max(Counter((r.dir, r.shard) for r in cut).values()) <= 2
    s = K.shard_plan(K.loose_files(files).select("dir", "file_name"), 2).orderBy("dir", "file_name").collect()
    assert [r.shard[-5] for r in s if r.dir == "a"] == ["0", "0", "1", "1", "2"]
    with pytest.raises(ValueError, match="'a' contains 5 files"):
        K.check_layout(K.loose_files(files), 4)
    assert K.plan_shards(K.loose_files(files.limit(0)), limits).count() == 0


def test_schedule_is_balanced():
    sizes = [50, 40, 30, 20, 10, 9, 8, 7]
    g = K.schedule(sizes, 3, 3)
    loads = [sum(s for s, x in zip(sizes, g) if x == k) for k in range(3)]
    assert max(Counter(g).values()) <= 3 and max(loads) - min(loads) <= 20


def test_consolidate_round_trip(spark, tmp_path):
    content = {}
    for d in ("crops/train", ""):
        for i in range(7):
            p = tmp_path / "in/1" / d / f"f{i}.txt"
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(content.setdefault(f"{d}/f{i}.txt".strip("/"), f"{d}{i}" * i))
    size = {k: len(v) for k, v in content.items()}
    rows = [(d, f"f{i}.txt", size[f"{d or ''}/f{i}.txt".strip("/")]) for d in ("crops/train", None) for i in range(7)] * 2
    files = listing(spark, rows)
    limits = spark.createDataFrame([(1, 3)], "export_id bigint, max_files_per_shard int")
    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    m = K.consolidate(files, limits, source, target)
    t = K.manifest_totals(m).first()
    assert (t.dirs, t.shards, t.files) == (2, 6, 14)
    back = K.unpack(m, target, f"file://{tmp_path}/back").collect()
    assert len(back) == 14 and {str(p.relative_to(tmp_path / "back/1")): p.read_text() for p in (tmp_path / "back").rglob("*.txt")} == content
    # A second run changes nothing; a new file gets a shard of its own; a changed one needs force.
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*")}
    K.consolidate(files, limits, source, target).collect()
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*")} == before
    (tmp_path / "in/1/new.txt").write_text("new")
    m = K.consolidate(listing(spark, [*rows, ("", "new.txt", 3)]), limits, source, target)
    t = K.manifest_totals(m).first()
    assert (t.dirs, t.shards, t.files) == (2, 7, 15) and m.first().version == 2
    (tmp_path / "in/1/f3.txt").write_text("changed")
    changed = listing(spark, [*[r for r in rows if r[:2] != (None, "f3.txt")], ("", "new.txt", 3), ("", "f3.txt", 7)])
    with pytest.raises(RuntimeError, match="f3.txt"):
        K.consolidate(changed, limits, source, target)
    m = K.consolidate(changed, limits, source, target, force=True)
    assert K.manifest_totals(m).first().files == 15 and len(list((tmp_path / "out/1").glob("*.tar"))) == 3
    K.unpack(m, target, f"file://{tmp_path}/again").collect()
    assert (tmp_path / "again/1/f3.txt").read_text() == "changed"
    # Missing files, and sizes that aren't the listed ones, publish nothing.
    (tmp_path / "in/1/f0.txt").unlink()
    for rows_ in (rows, [("crops/train", "f1.txt", 1)]):
        with pytest.raises(Exception):  # noqa: B017, PT011
            K.consolidate(listing(spark, rows_), limits, source, f"file://{tmp_path}/never")
    assert not (tmp_path / "never/_pack_manifest.json").exists()


def test_damaged_shards_are_not_published(spark, tmp_path, monkeypatch):
    for i in range(4):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/f{i}").write_bytes(bytes([65 + i]) * 700)
    files = listing(spark, [("", f"f{i}", 700) for i in range(4)])
    limits = spark.createDataFrame([(1, 2)], "export_id bigint, max_files_per_shard int")
    read = K.read_members

    def damaged(shards, target, flat=False):
        for p in (tmp_path / "out").rglob("*.tar"):
            data = bytearray(p.read_bytes())
            data[600] ^= 1  # in the first member's content
            p.write_bytes(data)
        return read(shards, target, flat)

    monkeypatch.setattr(K, "read_members", damaged)
    with pytest.raises(RuntimeError, match="nothing was published"):
        K.consolidate(files, limits, f"file://{tmp_path}/in", f"file://{tmp_path}/out", flat=True)
    assert not (tmp_path / "out/_pack_manifest.json").exists()


def test_big_dirs_get_no_more_shards(spark):
    rows = [("d", f"f{i:04d}", i % 13) for i in range(2003)] + [("e", "x", None)]
    limits = spark.createDataFrame([(1, 100)], "export_id bigint, max_files_per_shard int")
    for bucket in (100_000, 500, 30):
        plan = K.plan_shards(K.loose_files(listing(spark, rows)), limits, bucket).groupBy("dir", "shard").count().collect()
        assert sorted(r["count"] for r in plan if r.dir == "d") and len([r for r in plan if r.dir == "d"]) == 21 and max(r["count"] for r in plan) <= 100
        assert sum(r["count"] for r in plan) == 2004


def test_publication_plans(spark):
    from pagelens.operators import publish

    paths = spark.createDataFrame([(".gitattributes",), ("README.md",), ("a/b/c.jpg",), ("a/d.jpg",), ("z.json",)], "path string")
    assert sorted(map(tuple, publish.clear_plan(paths).collect())) == [("README.md", False, "files"), ("a", True, "folder:a"), ("z.json", False, "files")]
    files = spark.createDataFrame([("a", 999_999_999), ("b", 1)], "path string, size_bytes bigint")
    assert publish.upload_plan(files) == {"files": 2, "size_bytes": 1_000_000_000, "in_parts": True}
    assert [publish.wait_before_retry(k) for k in range(6)] == [30, 60, 90, 120, 150, None]
    assert publish.wait_before_retry(1, 7) == 7 and publish.wait_before_retry(50, tries=99) == 300


def test_cards():
    card = cards.adapter_card({"base_model": "base/x", "batch_size": 2, "grad_accum_steps": 8}, "me/adapter")
    assert card.startswith("---\nbase_model: base/x") and "Effective batch size: `16`" in card and "LoRA rank: `not recorded`" in card
    assert "# me/det" in cards.detector_card("me/det", "nano", "me/data") and "- me/data" in cards.detector_card(dataset="me/data")


def test_serialized_answers(spark):
    rows = spark.createDataFrame([("a", "[1,{\"т\":null}]", "p", "s", "table"), ("b", "[не JSON", "", "s", "table"), ("c", "текст", None, None, None)], "id string, answer string, prompt string, source string, region_type string")
    got = {r.id: (r.answer, r.prompt) for r in C.serialize_answers(rows).collect()}
    assert got["a"] == ('[1, {"т": null}]', "p") and got["b"][0] == "[не JSON" and got["c"][0] == "текст" and got["b"][1] and got["c"][1]


def test_audit(spark):
    files = listing(spark, [("a", f"f{i}", 1) for i in range(5)] + [("a\\", "f0", 1)])
    members = spark.createDataFrame([(1, "a", "s0", 0, "f0"), (1, "a", "s0", 0, "f0"), (1, "a", "s0", 1, "f1"), (1, "a", "s1", 0, "f1"), (1, "a", "s9", 0, "f2"), (1, "a", "s0", 2, "f3"), (1, "a", "s0", 3, "gone")], "export_id bigint, dir string, shard string, member_no int, member_name string")
    members = members.withColumn("packed_at", F.lit(None).cast("timestamp"))
    m = spark.createDataFrame([(1, 1, 2, [("a", ["s9"], 3)], None)], "export_id bigint, version int, max_files_per_shard int, packed_dirs array<struct<dir:string,shards:array<string>,file_count:bigint>>, written_at timestamp")
    newer = spark.createDataFrame([(1, 1, 2, [("a", ["s0", "s1"], 3), ("b", None, 1)])], "export_id bigint, version int, max_files_per_shard int, packed_dirs array<struct<dir:string,shards:array<string>,file_count:bigint>>").withColumn("written_at", F.current_timestamp())
    got = {(r.file_name, r.held) for r in K.audit_packing(files, members, m.union(newer)).collect()}
    assert got == {("f1", 2), ("f2", 0), ("f4", 0)}


def brute_paths(payload):
    try:
        v = json.loads(payload)
    except (ValueError, TypeError):
        return None
    if not isinstance(v, dict):
        return None
    page, out = v["page"] if isinstance(v.get("page"), dict) else v, set()

    def walk(regions, prefix):
        if isinstance(regions, str):
            try:
                regions = json.loads(regions)
            except ValueError:
                return
        for i, r in enumerate(regions if isinstance(regions, list) else []):
            if isinstance(r, dict):
                out.add(prefix + str(i))
                walk(r.get("regions"), f"{prefix}{i}/")

    walk(page.get("regions"), "")
    return out


PAYLOADS = [
    '{"regions":[{"a":1},[{"b":2}],{"regions":"[{\\"regions\\":[1,{}]}]"}]}', '{"a":1}{"b":2}', '[{"regions":[{}]}]', '{"regions":[{}],"regions":[{},{}]}', '{"regions":[{}],}',
    '{"x":"a\\\\","regions":[{"t":"\\\\\\""}]}', '{"a" 1}', '{"a":01}', '{"a":[1 2]}', '{"a":{"b":1,"regions":[{}]},"regions":[{"regions":null},{"regions":{"x":{}}}]}', '{"re\\u0067ions":[{}]}', "{}",
    ' {"regions":[ ] } ', '{"a":]}', '{"page":{"regions":[{}]},"regions":[{},{}]}', '{"page":5,"regions":[{},{}]}', '{"a":tru}', '{"a","b"}', "{:1}", "[]", '"x"', "", "   ", None, '{"regions":[{}]} x', '{"regions":[{"regions":[{}]}',
    '{"k":"\\q"}', '{"k":"\\u12"}', '{"a":1,,"b":2}', '{"a":[,1]}', '{"a":[1,]}', '{"a":1]', '\\"{"a":1}', '{"a":"\n"}', "{\"regions\":[{\"text\":\"" + "ї" * 50000 + "\"}]}",
]


def test_nested_against_brute_force(spark):
    rows = [(i, i, p, None, "x") for i, p in enumerate(PAYLOADS)] + [(900, None, '{"regions":[{}]}', None, "x")]
    raw = spark.createDataFrame(rows, "raw_id bigint, page_id bigint, payload string, received_at timestamp, kind string")
    flat = N.flatten(raw)
    got = {}
    for r in N.region_table(flat).collect():
        got.setdefault(r.page_id, set()).add(r.region_path)
    pages = {r.page_id for r in N.page_table(flat).collect()}
    want = {i: brute_paths(p) for i, p in enumerate(PAYLOADS)}
    assert pages == {i for i, w in want.items() if w is not None}
    assert got == {i: w for i, w in want.items() if w}
    assert N.flatten(raw.limit(0)).count() == 0


def test_nested_tables_are_linked(spark):
    page = {"file_name": "a.jpg", "image": {"path": "p", "width": 5}, "image_width": "12", "regions": [{"bbox": [1, "2", 3, 4.5], "text": "т\\n"}, 5, {"bbox": {"x1": 1, "y1": 2, "x2": 3, "y2": 4}, "regions": [{"bbox": [1, 2]}, {"bbox": None, "confidence": 0.5}]}]}
    rows = [(1, 7, '{"regions":[{},{},{},{},{}]}', "2024-01-01"), (2, 7, json.dumps(page), "2024-01-02"), (3, 7, json.dumps(page), "2024-01-02"), (4, 7, "{cut", "2024-01-03")]
    raw = spark.createDataFrame(rows, "raw_id bigint, page_id bigint, payload string, t string").withColumn("received_at", F.col("t").cast("timestamp"))
    flat = N.flatten(raw)
    assert [(r.page_id, r.raw_id, r.file_name, r.image_width) for r in N.page_table(flat).collect()] == [(7, 3, "a.jpg", 12)]
    assert [tuple(r) for r in N.image_table(flat).collect()] == [(7, "p", None, 5, None)]
    regions = {r.region_path: (r.parent_path, r.place, r.depth, r.text, r.confidence) for r in N.region_table(flat).collect()}
    assert regions == {"0": (None, 0, 1, "т\\n", None), "2": (None, 2, 1, None, None), "2/0": ("2", 0, 2, None, None), "2/1": ("2", 1, 2, None, 0.5)}
    assert {r.region_path: (r.x1, r.y2) for r in N.bbox_table(flat).collect()} == {"0": (1.0, 4.5), "2": (1.0, 4.0)}


def test_inference_modes(spark, raw):
    pages = scans.read_split(spark, raw, "train")
    box = {"bbox": [0, 0, 500, 50], "type": "printed", "text": "", "language": "uk", "legibility": "legible", "confidence": 0.9}

    def model():
        return lambda images, prompts, tokens: ['[{"bbox":[0,0,50,50],"type":"printed","text":"vlm"}]' if tokens > 1024 or "lines" in p else "" for p in prompts]

    detector = lambda: lambda images: [[box]] * len(images)
    read = lambda mode, **kw: [(r.bbox, r.text) for r in run_inference(pages, mode, detector, model, **kw).first().regions]
    assert read("empty") == []
    assert read("detector-vlm") == [([0, 0, 200, 50], "")]
    assert read("page-vlm") == [([0, 0, 50, 50], "vlm")]  # the second try has the larger budget
    assert read("page-text-vlm") == [([0, 0, 200, 100], "vlm")]
    assert read("detector-page-text") == [([0, 0, 200, 50], "vlm")]
    assert len(read("ensemble")) == 2
    assert read("detector-vlm", region_model=lambda: lambda images, prompts, tokens: ["read"] * len(images)) == [([0, 0, 200, 50], "read")]
    with pytest.raises(ValueError, match="mode"):
        run_inference(pages, "other")


def test_stream(spark, tmp_path):
    from pagelens.streaming.pages import stream_pages, stream_regions

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"file_name":"a.jpg","image_width":9,"image_height":9,"regions":[{"bbox":[1,1,5,5],"text":"x"}]}\n')
    q = stream_regions(stream_pages(spark, f"file://{tmp_path}/in", "train"), f"file://{tmp_path}/out", f"file://{tmp_path}/cp")
    q.awaitTermination(60)
    assert spark.read.parquet(f"file://{tmp_path}/out").first().region_id == "train:a:0000"
