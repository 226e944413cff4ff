"""Column functions: geometry, text, prompts and JSON repair."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelens.functions import geometry as G
from pagelens.functions import jsonrepair as J
from pagelens.functions import prompts as P
from pagelens.functions import text as T


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_clamp(spark):
    rows = [([-5.0, 0.0, 250.0, 120.0], 200, 100), ([0.0, 0.0, 0.0, 0.0], 200, 100), ([1.9, -1.9, 3.2, 4.0], 200, 100), ([1.0, 2.0], 200, 100), (None, 200, 100), ([1.0, 2.0, 3.0, None], 9, 9), ([1.0, 1.0, 2.0, 2.0], None, 9)]
    got = values(spark, rows, "b array<double>, w int, h int", G.clamp_bbox(F.col("b"), F.col("w"), F.col("h")))
    assert [g[0] for g in got] == [[0, 0, 200, 100], None, [1, 0, 3, 4], None, None, None, None]


def test_iou_and_order(spark):
    rows = [([0, 0, 10, 10], [0, 0, 10, 10]), ([0, 0, 10, 10], [10, 0, 20, 10]), ([0, 0, 10, 10], [5, 0, 15, 10])]
    assert [g[0] for g in values(spark, rows, "a array<int>, b array<int>", G.bbox_iou(F.col("a"), F.col("b")))] == [1.0, 0.0, pytest.approx(1 / 3)]
    big = [([0, 0, 100_000, 100_000], [0, 0, 100_000, 100_000])]
    assert values(spark, big, "a array<int>, b array<int>", G.bbox_iou(F.col("a"), F.col("b"))) == [(1.0,)]
    assert values(spark, [([0, -31, 5, -30],)], "b array<int>", G.reading_band(F.col("b"))) == [(-3,)]
    regions = [[([50, 0, 60, 10], "b"), ([50, 2, 60, 8], "tie"), ([5, 0, 60, 12], "a"), ([0, 100, 5, 110], "last")]]
    ordered = G.in_reading_order(F.col("r"))
    assert values(spark, [(r,) for r in regions], "r array<struct<bbox:array<int>,text:string>>", F.transform(ordered, lambda r: r["text"])) == [(["a", "b", "tie", "last"],)]


def test_yolo(spark):
    b = G.yolo_bbox(F.col("b"), F.col("w"), F.col("h"))
    assert values(spark, [([10, 20, 110, 50], 200, 100), ([1, 1, 2, 2], 0, 100)], "b array<int>, w int, h int", b["cx"], b["bh"]) == [(0.3, 0.3), (None, 0.01)]


CASES = [
    (None, ""),
    ("~~old~~{new} ~~gone~~", "new gоne"),
    (r"a\xrightarrow[t]{b}c \xleftarrow{x}", "a→с ←"),
    (r"\mathrm{\mathbf{\mathrm {AB}}}", r"\mathrm{AB}"),  # each command is done with when the next one begins
    (r"\mathrm{a\mathrm{b\mathrm {d}}}\cancel{e}", "abde"),
    (r"\overset{a}{b} \underset{q}{w}", "b w"),
    (r"\big( \Bigg) \bigx", r"( ) \bigх"),
    (r"\hline\cline{1-2}\phantom{zz}k", "k"),
    (r"\alpha\cdot\top\setminus", "α·→р\\"),
    (r"\sin x", "sin х"),
    ("x_{12} y^{ab} _{3}", "х_12 y^ab _{3}"),
    ("x²³ 2² H₂O ж₁₀", "х^23 2² H_2O ж_10"),
    ("a''b", "a'b"),
    ("— – « » “ ” copx COPX", "- - \" \" \" \" сорх COPX"),
    ("  a \x1c\tb \n", "a b"),
]


def test_normalize_text(spark):
    got = values(spark, [(a,) for a, _ in CASES], "t string", T.normalize_text(F.col("t")))
    assert [g[0] for g in got] == [b for _, b in CASES]


def test_rates_and_names(spark):
    assert values(spark, [("abcd", "a"), ("", ""), ("Те", "")], "p string, t string", T.cer(F.col("p"), F.col("t"))) == [(3.0,), (0.0,), (2.0,)]
    names = ["images/a.b.jpg", ".hidden", "x", "a.", "d/.x.y"]
    assert [g[0] for g in values(spark, [(n,) for n in names], "n string", T.stem(T.base_name(F.col("n"))))] == ["a.b", ".hidden", "x", "a.", ".x"]
    assert [g[0] for g in values(spark, [(0,), (1_500,), (2_500_000,), (7_250_000_000,)], "n bigint", T.format_bytes(F.col("n")))] == ["0.0 KB", "1.5 KB", "2.5 MB", "7.25 GB"]
    assert values(spark, [("  a b\x1f\n",)], "t string", T.strip(F.col("t"))) == [("a b",)]


def test_labels(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 0], 3, 0), ([1, 2], 0, None)], "i array<int>, n int, p int")
    assert [r[0] for r in df.select(T.mask_labels(F.col("i"), F.col("n"), F.col("p"))).collect()] == [[-100, -100, -100, 4, -100], [1, 2]]
    assert df.select(T.truncate_right(F.col("i"), 3, F.lit(False))).first()[0] == [1, 2, 3]
    with pytest.raises(Exception, match="vision"):
        df.select(T.truncate_right(F.col("i"), 3, F.lit(True))).collect()


def test_prompts(spark):
    rows = spark.createDataFrame([("math", "formula"), ("table", None), ("school", "x"), (None, None)], "s string, t string")
    s = F.col("s")
    got = rows.select(P.region_prompt(s, F.col("t")), P.page_regions_prompt(s), P.page_lines_prompt(s)).collect()
    assert "mathematical notation" in got[0][0] and "LaTeX notation" in got[0][0] and "tables" in got[1][1] and "homework" in got[2][2]
    assert got[3][0] == P.REGION


GOOD = '[{"bbox":[1,2,3,4],"type":"printed","text":"x"}]'


@pytest.mark.parametrize(
    ("text", "items", "ok", "error"),
    [
        (f"```json\n{GOOD}\n```", 1, True, None), ("not json at all", 0, False, "json_array_not_found"), (None, 0, False, "json_array_not_found"),
        ('[{"text":"first"},{"text":"bro', 1, True, "salvaged_partial_array"), (f"see {GOOD} there", 1, True, None), ("[1, 2", 0, False, "json_array_truncated"),
        ('["a" "b"]', 0, False, "json_decode_error"), ('[{"a":"]\\""}]', 1, True, None), ('[{"a":1} x]', 1, True, "salvaged_partial_array"), ("[]", 0, True, None), ('["unclosed \\', 0, False, "json_array_truncated"),
    ],
)
def test_parse_array(text, items, ok, error):
    got = J.parse_array(text)
    assert (len(got[0]), got[1], got[2]) == (items, ok, error)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.dictionaries(st.text(max_size=5), st.one_of(st.text(max_size=8), st.integers(), st.none(), st.lists(st.integers(), max_size=3)), max_size=3), max_size=4), st.text(alphabet="abc {}\"'", max_size=6), st.integers(0, 60))
def test_parse_array_round_trip(items, prose, cut):
    whole = json.dumps(items, ensure_ascii=False)
    assert J.parse_array(prose + whole + prose)[0] == items
    part = J.parse_array(whole[: len(whole) - cut])[0] if cut < len(whole) else []
    assert part == items[: len(part)]


def test_lines_and_regions(spark):
    assert J.lines_of('["А", {"text":"Б"}, 5, " "]') == ["А", "Б", "5"]
    assert J.lines_of("А\n\nБ В") == ["А", "Б", "В"]
    assert J.lines_of("[]") == ["[]"]
    assert J.lines_of(None) == []
    raw = '[{"bbox":[-5,0,250,120],"type":"unknown_type","text":"Hi","language":null},{"bbox":[0,0,0,0]},7,{"text":"no box"}]'
    df = spark.createDataFrame([(raw,), (None,)], "t string")
    got = df.select(J.regions_from_items(J.extract_array(F.col("t"))["items"], F.lit(200), F.lit(100))).collect()
    assert [tuple(r) for r in got[0][0]] == [([0, 0, 200, 100], "handwritten", "Hi", "uk", "legible", None)] and got[1][0] == []
    assert [r[0] for r in df.select(J.text_lines(F.col("t"))).collect()][1] == []
