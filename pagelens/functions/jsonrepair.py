"""JSON arrays out of model output: fenced, surrounded by prose, truncated or malformed.

Whole, well-formed arrays of region objects are read by Spark's own parser; what it can't read, and arrays of
other things, go through an Arrow-batched function.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.constants import REGION_TYPES
from pagelens.functions.geometry import clamp_bbox

_STEP = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|"(?:[^"\\]|\\.)*\\?\Z|[\[\]]', re.DOTALL)
_BETWEEN = re.compile(r"[ \t\n\r,]*")
_FENCE = "```"
PARSED = "struct<items: array<string>, ok: boolean, error: string>"


def unfenced(text: str) -> str:
    """The text without a Markdown fence around it."""
    t = text.strip()
    if t.startswith(_FENCE):
        t = t[3:]
        t = (t[4:] if t[:4].lower() == "json" else t).strip()
        t = t.removesuffix(_FENCE).strip()
    return t


def parse_array(text: str | None) -> tuple[list, bool, str | None]:
    """(items, ok, error) of the first array in the text.

    error: json_array_not_found, json_array_truncated, json_decode_error, or with ok salvaged_partial_array if
    only the leading objects could be read.
    """
    t = unfenced(text or "")
    start = t.find("[")
    if start < 0:
        return [], False, "json_array_not_found"
    depth, end = 0, None
    for m in _STEP.finditer(t, start):
        depth += {"[": 1, "]": -1}.get(m[0], 0)
        if not depth:
            end = m.end()
            break
    if end is not None:
        try:
            return json.loads(t[start:end]), True, None
        except (ValueError, RecursionError):
            pass
    read, at, items = json.JSONDecoder().raw_decode, start + 1, []
    while t.startswith("{", at := _BETWEEN.match(t, at).end()):
        try:
            item, at = read(t, at)
        except (ValueError, RecursionError):
            break
        items.append(item)
    if items:
        return items, True, "salvaged_partial_array"
    return [], False, "json_array_truncated" if end is None else "json_decode_error"


def lines_of(text: str | None) -> list[str]:
    """Text lines of model output: of the array's items, or where it has none of the raw text."""
    items, _, _ = parse_array(text)
    if items:
        words = (x if isinstance(x, str) else str(x.get("text") or "") if isinstance(x, dict) else str(x) for x in items)
    else:
        words = unfenced(text or "").splitlines()
    return [w.strip() for w in words if w.strip()]


def extract_array(text: Column) -> Column:
    """struct<items, ok, error> with every item as JSON text; null text as empty text."""

    @F.pandas_udf(PARSED)
    def run(s: pd.Series) -> pd.DataFrame:
        rows = [parse_array(x) for x in s]
        dump = lambda v: json.dumps(v, ensure_ascii=False, separators=(",", ":"))
        return pd.DataFrame({"items": [[dump(v) for v in i] for i, _, _ in rows], "ok": [o for _, o, _ in rows], "error": [e for _, _, e in rows]})

    return run(text)


def text_lines(text: Column) -> Column:
    """array<string> of the text lines in model output."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lines_of)

    return run(text)


def regions_from_items(items: Column, width: Column, height: Column) -> Column:
    """Regions of parsed items (JSON texts): objects with a box on the page, with defaults for what is missing.

    Coordinates that are no numbers drop the region, as a box of another length does.
    """
    full = lambda c, d: F.when(c != "", c).otherwise(F.lit(d))
    schema = "bbox array<double>, type string, text string, language string, legibility string, confidence double"

    def one(x: Column) -> Column:
        o = F.from_json(x, schema)
        kind = full(o["type"], "handwritten")
        return F.struct(
            clamp_bbox(o["bbox"], width, height).alias("bbox"),
            F.when(kind.isin(REGION_TYPES), kind).otherwise("handwritten").alias("type"),
            F.coalesce(o["text"], F.lit("")).alias("text"),
            full(o["language"], "uk").alias("language"),
            full(o["legibility"], "legible").alias("legibility"),
            o["confidence"].alias("confidence"),
        )

    objects = F.filter(items, lambda x: x.startswith("{"))
    return F.filter(F.transform(objects, one), lambda r: r["bbox"].isNotNull())
