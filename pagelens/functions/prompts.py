"""Prompts of the training tables.  The wordings are fixed values."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base prompts.
REGION = (
    "Transcribe this Ukrainian document region exactly. Most text is Ukrainian; prefer Ukrainian Cyrillic letters for ambiguous handwriting, "
    "including і, ї, є, and ґ. Preserve punctuation, correction markers, and LaTeX where applicable."
)
PAGE_REGIONS = (
    "Return a JSON array of document regions for this page. Each item must contain bbox [x1,y1,x2,y2], type, and text. "
    "Most text is Ukrainian; prefer Ukrainian Cyrillic letters for ambiguous handwriting. "
    "Use exact transcription. Use empty text for image and graph regions."
)
PAGE_LINES = (
    "Return only a JSON array of transcribed text lines for this page in reading order. "
    "Do not include bounding boxes, explanations, markdown, or extra keys. "
    "Most text is Ukrainian; prefer Ukrainian Cyrillic letters for ambiguous handwriting, including і, ї, є, and ґ. "
    "Preserve Ukrainian text, punctuation, corrections, formulas, and table cell text exactly."
)
# Hints by source and by region type.
REGION_SOURCE_HINTS = {
    "dictation": "This is dictated handwritten text; preserve spoken punctuation and corrections.",
    "document_fragment": "This is a document fragment; preserve layout-sensitive punctuation.",
    "math": "This page contains mathematical notation; preserve LaTeX and formula symbols.",
    "table": "This region is part of a table; preserve cell structure and separators.",
    "graph": "Transcribe labels or legends; leave non-text graphical content empty if needed.",
    "drawing": "Transcribe captions or labels; preserve sketch annotations exactly.",
}
REGION_TYPE_HINTS = {
    "formula": "Preserve LaTeX notation and mathematical symbols exactly.",
    "table": "Preserve row/column structure using consistent separators.",
    "printed": "Preserve printed punctuation and capitalization exactly.",
    "annotation": "Preserve marginal notes and correction markers.",
}
PAGE_SOURCE_HINTS = {
    "dictation": "The page is dictated handwriting; preserve correction markers and punctuation.",
    "document_fragment": "The page is a document fragment; detect all text blocks including marginalia.",
    "math": "The page contains formulas; preserve LaTeX and use type formula where needed.",
    "table": "The page contains tables; use type table for tabular regions and preserve cells.",
    "graph": "The page contains graphs; use type graph with empty text for chart-only areas.",
    "drawing": "The page contains drawings; use type image or annotation for non-text sketches.",
}
LINE_SOURCE_HINTS = {
    "dictation": "This is a national dictation page; keep the dictated prose in natural line order.",
    "archive": "This may contain historical Ukrainian orthography, stamps, and printed headers; transcribe visible textual content.",
    "university": "This may contain formulas, chemistry, tables, and prose; keep each visual line as one item.",
    "school": "This may contain homework, formulas, teacher annotations, and tables; keep each visual line as one item.",
    "math": "This page contains formulas; preserve LaTeX-like notation and symbols.",
    "table": "This page contains tables; preserve rows in reading order and use spaces or separators inside a row.",
}


def lookup(values: Mapping[str, object], key: Column) -> Column:
    """Value of a literal table; null for null and unknown keys."""
    return F.try_element_at(F.create_map(*map(F.lit, chain.from_iterable(values.items()))), key)


def region_prompt(source: Column, region_type: Column) -> Column:
    return F.concat_ws(" ", F.lit(REGION), lookup(REGION_SOURCE_HINTS, source), lookup(REGION_TYPE_HINTS, region_type))


def page_regions_prompt(source: Column) -> Column:
    return F.concat_ws(" ", F.lit(PAGE_REGIONS), lookup(PAGE_SOURCE_HINTS, source))


def page_lines_prompt(source: Column) -> Column:
    return F.concat_ws(" ", F.lit(PAGE_LINES), lookup(LINE_SOURCE_HINTS, source))
