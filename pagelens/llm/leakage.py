"""Evaluation passages inside corpus documents, by a positional inverted index.

The corpus is indexed in *segments* (a few MB of text each).  A segment holds, for every term that
occurs in some evaluation text, the sorted list of its positions; positions run over the documents of
the segment with a gap between two documents.  Segments are stored as a table, so the corpus is
tokenized once, and a segment is matched where it is read: nothing is shuffled but one row of
statistics per term and the matches.

Matching: each evaluation text is cut into blocks of three words.  A block's rarest term (by document
frequency over the whole corpus) opens its position list; the lists of the other two terms are
intersected with it at their offsets.  A passage of twelve words with at most two slips has three whole
blocks inside or more, or leaves one of them untouched, so it always opens.  Each opened alignment is then
verified over the item's whole length.

Words are compared without case, punctuation, spacing, hyphenation at line ends, quotation marks at
line starts, and in a form in which equal-looking letters are equal.

Defined results: null, empty and blank texts, on either side, match nothing; an item shorter than the
passage length matches where its whole text stands; rows with a null id are left out; repeated rows give
each pair once; empty tables give an empty table.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.arrow import text_runs
from pagelens.llm.confusables import SHAPES, _GENERAL
from pagelens.session import require, stage

#: Bytes of text in a segment, at most, unless one text alone is longer.
SEGMENT_BYTES = 4 << 20
#: Words in a row that make a passage, and how many of so many may have a slip.
PASSAGE = 12
SLIPS = 2
#: Words in a block; PASSAGE words with SLIPS slips hold one untouched block for any cut into blocks.
BLOCK = 3
#: Positions that are expanded at a time, unless one term alone has more in a segment.
EXPANDED = 1 << 20
#: Words of items that are broadcast at a time; more items go in several rounds.
ROUND_WORDS = 2_000_000


def _word_table() -> dict[int, str | None]:
    """Characters to the form used for comparison of words, applied after lower()."""
    out: dict[int, str | None] = {o: (v if v is None or v in " \n" else v.lower()) for o, v in _GENERAL.items()}
    for c in "'’ʼ‘`´ʹ":
        out[ord(c)] = "'"
    for c in "-\u2010\u2011\u00ad":
        out[ord(c)] = "-"
    for o in range(0x300, 0x370):
        out[o] = None
    # Letters that share a shape in either case are one letter here.
    for s in SHAPES:
        to = s[0].lower()
        for c in s:
            if c.lower() != to:
                out[ord(c.lower())] = to
    for o, v in list(out.items()):
        if v and len(v) == 1 and ord(v) in out and out[ord(v)] and v not in " \n-'":
            out[o] = out[ord(v)]
    return out


_TABLE = _word_table()
_INSIDE = re.compile(r"(?:-[ \t]*\n[ \t>|]*|[-'])(?=\w)")
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """The words of a text in the form in which they are compared."""
    if text.isascii():
        t = text.lower()
        if "\r" in t:
            t = t.replace("\r\n", "\n").replace("\r", "\n")
    else:
        t = unicodedata.normalize("NFC", text).lower().replace("\r\n", "\n").replace("\r", "\n").translate(_TABLE)
    if "-" in t or "'" in t:
        t = _INSIDE.sub("", t)
    return _WORD.findall(t)


_SEGMENT = pa.schema([
    ("docs", pa.list_(pa.int64())),
    ("starts", pa.list_(pa.int32())),
    ("terms", pa.list_(pa.int32())),
    ("df", pa.list_(pa.int32())),
    ("ends", pa.list_(pa.int32())),
    ("positions", pa.list_(pa.int32())),
])


def _indexer(vocabulary):  # a Broadcast of word -> term
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term_of = vocabulary.value
        get = term_of.get
        for batch in batches:
            for first, buf, offsets in text_runs(batch, SEGMENT_BYTES):
                ids = batch.column(0).slice(first, len(offsets) - 1)
                data = buf.tobytes()
                texts = (data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
                lists = [np.fromiter((get(w, -1) for w in words(t)), np.int32) if t else np.zeros(0, np.int32) for t in texts]
                sizes = np.array([len(x) + 1 for x in lists], np.int64)
                starts = np.concatenate([[0], np.cumsum(sizes)])
                line = np.full(starts[-1], -1, np.int32)
                for x, s in zip(lists, starts):
                    line[s : s + len(x)] = x
                at = np.flatnonzero(line >= 0).astype(np.int32)
                order = np.argsort(line[at], kind="stable")
                at = at[order]
                of = line[at]
                terms, begin = np.unique(of, return_index=True)
                doc = np.searchsorted(starts, at, side="right")
                new = np.ones(len(at), bool)
                new[1:] = (of[1:] != of[:-1]) | (doc[1:] != doc[:-1])
                df = np.add.reduceat(new, begin).astype(np.int32) if len(begin) else np.zeros(0, np.int32)
                wrap = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.cast(pa.int64())),
                    wrap(starts.astype(np.int32), pa.int32()),
                    wrap(terms, pa.int32()),
                    wrap(df, pa.int32()),
                    wrap(np.append(begin[1:], len(at)).astype(np.int32) if len(begin) else begin.astype(np.int32), pa.int32()),
                    wrap(at, pa.int32()),
                ], schema=_SEGMENT)

    return run


def build_index(docs: DataFrame, vocabulary: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of the positional index of ``docs`` over the terms of ``vocabulary``, as a stage table."""
    spark = docs.sparkSession
    slim = require(docs, id_col, text_col).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    slim = slim.where("doc_id IS NOT NULL AND text IS NOT NULL")
    schema = "docs array<bigint>, starts array<int>, terms array<int>, df array<int>, ends array<int>, positions array<int>"
    return stage(slim.mapInArrow(_indexer(spark.sparkContext.broadcast(vocabulary)), schema), "leak-index")


class Query:
    """Blocks of a round of items, their terms in order of rarity."""

    def __init__(self, items: list[tuple[int, list[int]]], df: dict[int, int]):
        self.ids = np.array([i for i, _ in items], np.int64)
        self.terms = [np.array(t, np.int32) for _, t in items]
        item, start, rare, offset = [], [], [], []
        for k, t in enumerate(self.terms):
            for a in range(0, max(1, len(t) - BLOCK + 1), BLOCK):
                block = t[a : a + BLOCK]
                j = min(range(len(block)), key=lambda x: df.get(int(block[x]), 0))
                item.append(k), start.append(a), rare.append(int(block[j])), offset.append(a + j)
        self.item, self.start = np.array(item, np.int64), np.array(start, np.int64)
        self.rare, self.offset = np.array(rare, np.int32), np.array(offset, np.int64)
        pad = lambda k: np.array([self.terms[i][a + k] if a + k < len(self.terms[i]) else -9 for i, a in zip(item, start)], np.int32)
        self.block = [pad(k) for k in range(BLOCK)]


def passages(query: Query, row: dict[str, np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(place of the document in the segment, place of the item, equal words of its best window)."""
    starts, terms, ends, positions = row["starts"], row["terms"], row["ends"], row["positions"]
    if not len(terms):
        return
    line = np.full(int(starts[-1]) + BLOCK, -1, np.int32)
    line[positions] = np.repeat(terms, np.diff(np.concatenate([[0], ends])))
    at = np.searchsorted(terms, query.rare)
    known = (at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == query.rare)
    q = np.flatnonzero(known)
    first = np.concatenate([[0], ends])[at[q]]
    count = (ends[at[q]] - first).astype(np.int64)
    found = []
    part = np.cumsum(count) // EXPANDED  # blocks whose lists are expanded together
    for low, high in zip(*_runs(part)):
        found.append(_alignments(query, line, positions, int(starts[-1]), q[low:high], first[low:high], count[low:high]))
    if not found:
        return
    item, base, shift = (np.concatenate(x) for x in zip(*found))
    doc = np.searchsorted(starts, base, side="right") - 1
    seen = np.unique(np.stack([item, doc, shift], 1), axis=0)
    for i, d, s in seen.tolist():
        want = query.terms[i]
        # Only the words of the item that lie over the document.
        lo, hi = max(0, int(starts[d]) - s), min(len(want), int(starts[d + 1]) - 1 - s)
        w = min(PASSAGE, len(want))
        if hi - lo < w:
            continue
        total = np.zeros(hi - lo + 1, np.int32)
        np.cumsum(line[s + lo : s + hi] == want[lo:hi], out=total[1:])
        yield d, i, int((total[w:] - total[:-w]).max())


def _runs(x: np.ndarray) -> tuple[list[int], list[int]]:
    """Bounds of the runs of equal values."""
    if not len(x):
        return [], []
    edges = np.flatnonzero(x[1:] != x[:-1]) + 1
    return [0, *edges.tolist()], [*edges.tolist(), len(x)]


def _alignments(query: Query, line: np.ndarray, positions: np.ndarray, size: int, q: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, where the block stands, where the item would begin) of the blocks ``q`` whose words all stand at their offsets."""
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    shift = positions[np.repeat(first, count) + inner].astype(np.int64)
    q = np.repeat(q, count)
    shift -= query.offset[q]
    base = shift + query.start[q]
    ok = (base >= 0) & (base < size)
    q, shift, base = q[ok], shift[ok], base[ok]
    for k in range(BLOCK):
        want = query.block[k][q]
        ok = (want == -9) | (line[base + k] == want)
        q, shift, base = q[ok], shift[ok], base[ok]
    return query.item[q], base, shift


def slips_allowed(width: int) -> int:
    """Slips in a window: two in twelve words, fewer in shorter items."""
    return SLIPS if width >= PASSAGE else width // 6


def _matcher(query):  # a Broadcast of Query
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = query.value
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("docs", "starts", "terms", "ends", "positions")}
                for d, k, equal in passages(q, row):
                    w = min(PASSAGE, len(q.terms[k]))
                    if equal >= w - slips_allowed(w):
                        found.add((int(row["docs"][d]), int(q.ids[k])))
            pairs = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["doc_id", "item_id"])

    return run


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id): documents with the items whose text, or a passage of PASSAGE words of it, they hold.

    The items are the stated query set.  They go in rounds of at most ROUND_WORDS words, each with a vocabulary and
    an index of its own, so what is broadcast has a bound whatever their number; a usual evaluation set is one round.
    """
    slim = require(items, item_id, item_text).select(F.col(item_id).cast("bigint"), F.col(item_text).cast("string")).where(f"`{item_id}` IS NOT NULL AND `{item_text}` IS NOT NULL").distinct()
    out = None
    for part in _rounds(slim.toLocalIterator()):
        found = _leaked_round(docs, part, doc_id, doc_text)
        out = found if out is None else stage(out, "leak-found").unionByName(stage(found, "leak-found"))
    return out.distinct()


def _rounds(rows: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, list[str]]]]:
    """Items as words, in lists of at most ROUND_WORDS words or a single item; at least one list."""
    part, size = [], 0
    for i, text in rows:
        t = words(text)
        if part and size + len(t) > ROUND_WORDS:
            yield part
            part, size = [], 0
        if t:
            part.append((i, t))
            size += len(t)
    yield part


def _leaked_round(docs: DataFrame, items: list[tuple[int, list[str]]], doc_id: str, doc_text: str) -> DataFrame:
    context = docs.sparkSession.sparkContext
    vocabulary: dict[str, int] = {}
    coded = [(i, [vocabulary.setdefault(w, len(vocabulary)) for w in t]) for i, t in items]
    index = build_index(docs, vocabulary, doc_id, doc_text)
    counts = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("n"))
    df = {r.term: r.n for r in counts.collect()}  # a row for each word of the round's items
    query = context.broadcast(Query(coded, df))
    return index.select("docs", "starts", "terms", "ends", "positions").mapInArrow(_matcher(query), "doc_id bigint, item_id bigint")
