"""Matching, merging, assignment and scores."""

import random

import pytest
from pyspark.sql import functions as F

from pagelens.constants import REGION_STRUCT
from pagelens.operators import match as M
from pagelens.operators import metrics as S

R = f"array<{REGION_STRUCT}>"


def region(box, kind="handwritten", text="", confidence=None, language="uk", legibility="legible"):
    return (box, kind, text, language, legibility, confidence)


def one(spark, pred, truth, f):
    return spark.createDataFrame([(pred, truth)], f"p {R}, t {R}").select(f(F.col("p"), F.col("t"))).first()[0]


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(0, w) * max(0, h)
    return inter / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter) if inter else 0.0


def brute(pred, truth, threshold):
    ranked = sorted(((overlap(p[0], t[0]), i, j) for i, p in enumerate(pred) for j, t in enumerate(truth)), reverse=True)
    out = []
    for s, i, j in ranked:
        if s >= threshold and all(i != a and j != b for a, b in out):
            out.append((i, j))
    return out


def test_greedy_ties_and_random(spark):
    same = [region([0, 0, 10, 10]), region([0, 0, 10, 10])]
    assert [tuple(m) for m in one(spark, same, same, lambda p, t: M.greedy_match(p, t))] == [(1, 1), (0, 0)]
    assert one(spark, [], same, lambda p, t: M.greedy_match(p, t)) == []
    rng = random.Random(5)
    rows = []
    for _ in range(40):
        boxes = lambda: [region([x, y, x + rng.randrange(3, 12), y + rng.randrange(3, 12)]) for x, y in ((rng.randrange(15), rng.randrange(15)) for _ in range(rng.randrange(6)))]
        rows.append((boxes(), boxes()))
    got = spark.createDataFrame(rows, f"p {R}, t {R}").select(M.greedy_match(F.col("p"), F.col("t"), 0.2).alias("m")).collect()
    assert [[tuple(m) for m in g.m] for g in got] == [brute(p, t, 0.2) for p, t in rows]


def test_iou_join_keeps_disjoint_at_zero(spark):
    df = spark.createDataFrame([("a", [region([0, 0, 2, 2]), region([5, 5, 6, 6]), region([1], "x")])], f"image string, regions {R}")
    e = M.explode_boxes(df, "image")
    assert M.iou_pairs(e, e, "image", 0.0).count() == 4 and M.iou_pairs(e, e, "image", 0.5).count() == 2


def test_merge(spark):
    page = [region([10, 10, 50, 50], text="page text", confidence=0.0)]
    det = [region([12, 12, 48, 48], text="d", confidence=0.7), region([100, 10, 150, 50], "printed")]
    got = one(spark, page, det, lambda p, t: M.merge_regions(p, t, 0.5))
    assert [(g.bbox, g.text, g.confidence) for g in got] == [([10, 10, 50, 50], "page text", 0.7), ([100, 10, 150, 50], "", None)]
    # The last of equally good ones, of the same type only; empty text is filled.
    page = [region([0, 0, 10, 10])]
    det = [region([0, 0, 10, 10], text="first"), region([0, 0, 10, 10], text="last"), region([0, 0, 10, 10], "table", text="other")]
    assert [g.text for g in one(spark, page, det, lambda p, t: M.merge_regions(p, t))] == ["last", "first", "other"]
    assert one(spark, [], [], lambda p, t: M.merge_regions(p, t)) == []


def test_merge_against_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(40):
        boxes = lambda n: [region([x, y, x + 9, y + 9], rng.choice(["printed", "table"]), rng.choice(["", f"{n}{k}"]), rng.choice([None, 0.0, 0.5])) for k, (x, y) in enumerate((rng.randrange(6), rng.randrange(6)) for _ in range(rng.randrange(5)))]
        rows.append((boxes("p"), boxes("d")))

    def merged(page, det):
        used, out = set(), []
        for r in page:
            options = [(overlap(r[0], d[0]), j) for j, d in enumerate(det) if j not in used and d[1] == r[1] and overlap(r[0], d[0]) >= 0.5]
            if options:
                j = max(options)[1]
                used.add(j)
                out.append((r[0], r[1], r[2] or det[j][2], r[5] or det[j][5]))
            else:
                out.append((r[0], r[1], r[2], r[5]))
        return out + [(d[0], d[1], d[2], d[5]) for j, d in enumerate(det) if j not in used]

    got = spark.createDataFrame(rows, f"p {R}, t {R}").select(M.merge_regions(F.col("p"), F.col("t")).alias("m")).collect()
    assert [[(r.bbox, r.type, r.text, r.confidence) for r in g.m] for g in got] == [merged(*r) for r in rows]


def lines(spark, regions, texts, w=200, h=100):
    df = spark.createDataFrame([(regions, texts)], f"r {R}, l array<string>")
    return df.select(M.assign_lines(F.col("r"), F.col("l"), F.lit(w), F.lit(h))).first()[0]


def test_assign_lines(spark):
    boxes = [region([10, 20, 110, 50]), region([10, 55, 110, 80])]
    assert [r.text for r in lines(spark, boxes, ["Перший", "Другий"])] == ["Перший", "Другий"]
    assert [r.text for r in lines(spark, [region([10, 20, 110, 50], text="own"), region([10, 55, 110, 80], text="kept")], ["new"])] == ["new", "kept"]
    more = lines(spark, boxes[:1] + [region([0, 90, 5, 99], "image", "drop")], ["a", "b", "c"])
    assert [(r.bbox, r.text) for r in more] == [([0, 0, 200, 50], "b"), ([10, 20, 110, 50], "a"), ([0, 50, 200, 100], "c"), ([0, 90, 5, 99], "")]
    assert lines(spark, [], []) == []


def scores(spark, pages, preds):
    t = spark.createDataFrame(pages, f"image string, source string, annotation_source string, regions {R}")
    p = spark.createDataFrame(preds, f"image string, regions {R}")
    return S.page_counters(t, p)


def test_perfect_prediction(spark):
    r = [region([10, 20, 110, 50], text="Тест")]
    m = S.overall(scores(spark, [("a", "s", None, r)], [("a", r), ("unknown", r)])).first()
    assert (m.f1, m.class_acc, m.score, m.cer, m.page_cer, m.matched_regions) == (1.0, 1.0, 1.0, 0.0, 0.0, 1)


def test_rates_above_one_groups_and_empty_pages(spark):
    truth, pred = [region([0, 0, 9, 9], text="а")], [region([0, 0, 9, 9], text="абвгд")]
    c = scores(spark, [("a", "", None, truth), ("b", None, "x", []), ("c", "s", "x", None)], [("a", pred), ("b", [region([1], text="bad box")])])
    by = {r.image: r for r in c.collect()}
    assert by["a"].page_cer == 4.0 and by["b"].page_cer == 0.0 and by["c"].tp == 0
    m = S.overall(c).first()
    assert m.pages == 3 and m.cer == 4.0 and m.page_cer == pytest.approx(4 / 3) and m.proxy_score == 0.0
    groups = {(r.grouping, r.key): r.pages for r in S.grouped(c).collect()}
    assert groups == {("overall", "overall"): 3, ("source", "unknown"): 2, ("source", "s"): 1, ("annotation_source", "unknown"): 1, ("annotation_source", "x"): 2}


def test_no_pages_gives_zeros(spark):
    m = S.overall(scores(spark, [], [])).first()
    assert (m.pages, m.matched_regions, m.f1, m.class_acc, m.page_cer) == (0, 0, 0.0, 0.0, 0.0)


def test_submission_and_last_wins(spark):
    sample = spark.createDataFrame([("d/test-1.jpg", "old", 0), ("x.jpg", "", 1)], "image string, regions string, _ord int")
    preds = spark.createDataFrame([("a/test-1.jpg", [region([1, 2, 3, 4], text="перший")], 0), ("b/test-1.jpg", [region([1, 2, 3, 4], text='д"')], 1)], f"image string, regions {R}, _ord int")
    got = {r.image: r.regions for r in M.submission(sample, preds).collect()}
    assert got == {"d/test-1.jpg": '[{"bbox":[1,2,3,4],"type":"handwritten","text":"д\\""}]', "x.jpg": "[]"}
