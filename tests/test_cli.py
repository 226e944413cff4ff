"""The verbs, end to end on small folders."""

import json

import pytest

from pagelens import cli


def detector():
    return lambda images: [[{"bbox": [0, 0, 50, 50], "type": "handwritten", "text": "", "confidence": 0.9}, {"bbox": [0, 60, 50, 90], "type": "handwritten", "text": "", "confidence": 0.1}] for _ in images]


def codec():
    return lambda data, box: bytes(box)


def run(capsys, *argv):
    assert cli.main(list(argv)) == 0
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_pipeline(spark, tmp_path, capsys):
    raw, out = tmp_path / "raw", tmp_path / "out"
    page = {"file_name": "p1.jpg", "image_width": 200, "image_height": 100, "source": "dictation", "annotation_source": "annotator", "regions": [{"bbox": [10, 20, 110, 50], "type": "handwritten", "text": "Тест"}]}
    for split in ("train", "test"):
        (raw / split).mkdir(parents=True)
        (raw / split / "metadata.jsonl").write_text(json.dumps(page | {"file_name": f"{split}.jpg"}, ensure_ascii=False) + "\n")
        (raw / split / "images").mkdir()
        (raw / split / f"images/{split}.jpg").write_bytes(b"image")
    done = run(capsys, "curate", "--raw-dir", str(raw), "--output-dir", str(out), "--codec", "test_cli:codec")
    assert (done["pages"], done["copied_images"], done["cropped_regions"]) == (2, 3, 2)
    assert (out / "images/test/test.jpg").read_bytes() == b"image" and (out / "yolo/images/train/train.jpg").exists() and (out / "crops/train/train_0000.jpg").read_bytes() == bytes([10, 20, 110, 50])
    slim = run(capsys, "curate", "--raw-dir", str(raw), "--output-dir", str(tmp_path / "slim"), "--no-page-sft", "--val-fraction", "0")
    assert slim["pages"] == 2 and not (tmp_path / "slim/page_sft.jsonl").exists()
    assert list((out / "vlm_sft.jsonl").glob("part-*")) and (out / "yolo/labels/train/train.txt").exists() and (out / "yolo/data.yaml").exists()
    (tmp_path / "pred.jsonl").write_text(json.dumps({"image": "train.jpg", "regions": page["regions"]}, ensure_ascii=False) + "\n")
    m = run(capsys, "evaluate", "--raw-dir", str(raw), "--predictions", str(tmp_path / "pred.jsonl"), "--by-source")
    assert m["score"] == 1.0 and m["by_source"]["dictation"]["pages"] == 1
    (out / "yolo/split_assignments.jsonl").rename(out / "yolo/old")
    (out / "yolo/split_assignments.jsonl").write_text(json.dumps({"file_name": "images/train.jpg", "image": "train.jpg", "split": "val"}) + "\n")
    m = run(capsys, "evaluate", "--split", "yolo_val", "--curated-dir", str(out), "--predictions", str(tmp_path / "pred.jsonl"))
    assert m["score"] == 1.0 and m["matched_regions"] == 1
    found = run(capsys, "infer", "--raw-dir", str(raw), "--output", str(tmp_path / "found.jsonl"), "--mode", "detector-vlm", "--detector-model", "test_cli:detector", "--batch-size", "1")
    assert found == {"pages": 1, "empty_pages": 0} and '"bbox":[0,0,50,50]' in "".join(p.read_text() for p in (tmp_path / "found.jsonl").glob("part-*")).replace(" ", "")
    assert run(capsys, "infer", "--raw-dir", str(raw), "--output", str(tmp_path / "empty.jsonl")) == {"pages": 1, "empty_pages": 1}
    (tmp_path / "sample.csv").write_text("image,regions\ntest.jpg,[]\n")
    assert run(capsys, "make-submission", "--sample", str(tmp_path / "sample.csv"), "--predictions", str(tmp_path / "empty.jsonl"), "--output", str(tmp_path / "sub.csv")) == {"rows": 1}
    n = run(capsys, "train-vlm-qlora", "--train-jsonl", str(out / "vlm_sft.jsonl"), "--output-dir", str(tmp_path / "sft"))
    assert sum(n.values()) == 2
    (tmp_path / "presets.json").write_text(json.dumps({"presets": {"strict": {"min_quality_weight": 2.0}}}))
    assert run(capsys, "train-vlm-qlora", "--train-jsonl", str(out / "vlm_sft.jsonl"), "--output-dir", str(tmp_path / "none"), "--presets", str(tmp_path / "presets.json"), "--preset", "strict") == {}
    with pytest.raises(ValueError, match="strict"):
        cli.main(["train-vlm-qlora", "--train-jsonl", "x", "--output-dir", "y", "--presets", str(tmp_path / "presets.json"), "--preset", "other"])


def test_pack_and_unpack(spark, tmp_path, capsys):
    def make(folder, n, first=0):
        for i in range(first, n):
            p = tmp_path / "in" / folder / f"f{i}.jpg"
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_bytes(bytes([i]) * i)

    make("crops/train", 5)
    make("images/test", 3)
    (tmp_path / "in/metadata.jsonl").write_text("{}")
    src = str(tmp_path / "in")
    t = run(capsys, "pack-curated", "--source", src, "--target", str(tmp_path / "out"), "--max-files", "2")
    assert t["exports"][0]["shards"] == 6 and t["exports"][0]["files"] == 9
    assert run(capsys, "unpack-curated", "--source", str(tmp_path / "out"), "--target", str(tmp_path / "back")) == {"restored_files": 9}
    assert (tmp_path / "back/crops/train/f3.jpg").read_bytes() == b"\x03\x03\x03"
    # In place: loose files go, a second run changes nothing, later files are added.
    for _ in range(2):
        assert run(capsys, "pack-curated", "--source", src, "--max-files", "2")["exports"][0]["files"] == 8
        assert not list((tmp_path / "in").rglob("*.jpg")) and (tmp_path / "in/metadata.jsonl").exists()
    make("crops/train", 7, 5)
    assert run(capsys, "pack-curated", "--source", src, "--max-files", "2")["exports"][0]["files"] == 10
    assert run(capsys, "unpack-curated", "--source", src, "--target", str(tmp_path / "again")) == {"restored_files": 10}


def test_external_verbs_are_refused(capsys):
    assert cli.main(["upload-model"]) == 2 and "caller" in capsys.readouterr().err
