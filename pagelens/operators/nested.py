"""Deeply nested records to related flat tables, by vectorised structural indexing.

Raw JSON payloads are indexed a few MB at a time with array operations only: bitmaps of the quotes
that aren't escaped, of the brackets and of the delimiters outside strings; nesting depth by prefix
sums; the container of every token from its depth.  From the index come the spans of the values, and
from the spans linked rows: each names its page and, for regions at any depth, its parent region.

``flatten`` gives one stage table of rows of all kinds; ``page_table``, ``image_table``,
``region_table`` and ``bbox_table`` project it to typed flat tables.

Defined results: payloads that are null, blank, cut off, no JSON or no JSON object give no row; the page
may lie under a ``page`` key; ``regions`` may be null, missing, or JSON text of a list; entries that aren't
objects give no row but count for the places; of a page's whole payloads the latest counts (ties: the
greater raw id); a repeated key's last value counts; rows with a null page id are left out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.arrow import slices, text_runs
from pagelens.session import require, stage

RUN_BYTES = 4 << 20
_OPEN, _CLOSE, _COLON, _COMMA, _STRING, _SCALAR = 1, 2, 3, 4, 5, 6
_SCALAR_FORM = re.compile(rb"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|NaN|-?Infinity")
_ESCAPE = np.isin(np.arange(256), np.frombuffer(b'"\\/bfnrtu', np.uint8))
_HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdefABCDEF", np.uint8))
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\r", np.uint8))


class Index:
    """Structural index of texts that lie one after the other in ``buf``.

    Tokens are brackets, colons, commas, strings and other scalars in order.  For token ``t``:
    ``at[t]``/``end[t]`` its span (of an opening bracket: to its closing one), ``kind[t]``, ``byte[t]``,
    ``doc[t]``, ``box[t]`` the token that opens the container it lies in (-1: none), ``place[t]`` the commas
    before it in that container, ``key[t]`` the token of its key (-1: none).  ``whole[d]`` tells whether
    text ``d`` is one well-formed JSON value.
    """

    def __init__(self, buf: np.ndarray, starts: np.ndarray):
        n, docs = len(buf), len(starts) - 1
        self.buf, self.bytes, self.whole = buf, buf.tobytes(), np.zeros(docs, bool)
        where = np.arange(n)
        # Backslashes: a byte is escaped if an odd run of them ends before it.
        slash = buf == 0x5C
        last = np.maximum.accumulate(np.where(slash, -1, where)) if n else where
        fence = np.zeros(n, np.int64)  # first byte of the text
        if n:
            first = starts[:-1][starts[:-1] < starts[1:]]
            fence[first] = first
            fence = np.maximum.accumulate(fence)
        run = np.zeros(n, np.int64)
        run[1:] = np.where(slash[:-1], where[:-1] - np.maximum(last[:-1], fence[1:] - 1), 0)
        run = np.minimum(run, where - fence)
        escaped = run % 2 == 1
        quote = (buf == 0x22) & ~escaped
        count = np.concatenate([[0], np.cumsum(quote)])
        inside = (count[1:] - count[fence] if n else count[1:]) % 2 == 1  # from an opening quote to before its closing one
        odd = (count[starts[1:]] - count[starts[:-1]]) % 2 == 1
        opening, closing = quote & inside, quote & ~inside
        string = inside | closing
        bad = np.zeros(docs, bool)
        bad |= odd

        def blame(positions: np.ndarray) -> None:
            bad[np.searchsorted(starts, positions, side="right") - 1] = True

        blame(np.flatnonzero(inside & (buf < 0x20)))
        blame(np.flatnonzero(slash & ~string))
        blame(np.flatnonzero(inside & escaped & ~_ESCAPE[buf]))
        code = np.flatnonzero(inside & escaped & (buf == 0x75))
        if len(code):
            digits = np.append(buf, np.zeros(4, np.uint8))
            blame(code[~np.logical_and.reduce([_HEX[digits[code + k]] for k in range(1, 5)])])
        out = ~string
        up = out & ((buf == 0x7B) | (buf == 0x5B))
        down = out & ((buf == 0x7D) | (buf == 0x5D))
        colon, comma = out & (buf == 0x3A), out & (buf == 0x2C)
        plain = out & ~(up | down | colon | comma | _SPACE[buf])
        begins = plain.copy()
        begins[1:] &= ~plain[:-1] | (fence[1:] == where[1:])
        kind = np.zeros(n, np.int8)
        for mask, k in ((up, _OPEN), (down, _CLOSE), (colon, _COLON), (comma, _COMMA), (opening, _STRING), (begins, _SCALAR)):
            kind[mask] = k
        at = np.flatnonzero(kind)
        kind = kind[at]
        byte = buf[at]
        doc = np.searchsorted(starts, at, side="right") - 1
        m = len(at)
        # Ends of strings and scalars.
        end = at + 1
        close_at = np.flatnonzero(closing)
        s = kind == _STRING
        if m:
            e = np.searchsorted(close_at, at[s])
            end[s] = np.where(e < len(close_at), close_at[np.minimum(e, max(0, len(close_at) - 1))] + 1 if len(close_at) else at[s] + 1, at[s] + 1)
            v = kind == _SCALAR
            stops = np.flatnonzero(~plain)
            e = np.searchsorted(stops, at[v])
            end[v] = np.minimum(np.where(e < len(stops), stops[np.minimum(e, max(0, len(stops) - 1))] if len(stops) else n, n), starts[doc[v] + 1])
        # Depth: brackets carry the depth inside them.
        delta = (kind == _OPEN).astype(np.int64) - (kind == _CLOSE)
        total = np.cumsum(delta)
        base = np.concatenate([[0], total])[np.searchsorted(at, starts[:-1])]
        level = total - base[doc] + (kind == _CLOSE) if m else total
        final = np.concatenate([[0], total])[np.searchsorted(at, starts[1:])] - base
        bad |= final != 0
        if m:
            bad[doc[level < (kind == _CLOSE)]] = True
        # Containers: in the order (text, level, position) the nearest opening bracket before a token.
        order = np.lexsort((np.arange(m), level, doc))
        is_open = kind[order] == _OPEN
        near = np.maximum.accumulate(np.where(is_open, np.arange(m), -1)) if m else np.zeros(0, np.int64)
        same = near >= 0
        same[same] &= (doc[order][near[same]] == doc[order][same]) & (level[order][near[same]] == level[order][same])
        holder = np.full(m, -1, np.int64)
        holder[order] = np.where(same, order[np.maximum(near, 0)], -1)
        commas = np.cumsum(kind[order] == _COMMA)
        place = np.zeros(m, np.int64)
        place[order] = commas - commas[np.maximum(near, 0)]
        # Brackets themselves lie in the container one level up: the holder of the nearest token before them on that level.
        box, pos = holder.copy(), place
        opens = np.flatnonzero(kind == _OPEN)
        if len(opens):
            # Stack by levels: search (text, level - 1, position) among the sorted tokens.
            width = m + 1
            rank = (doc.astype(np.int64) * (int(level.max(initial=0)) + 2) + level) * width + np.arange(m)
            sorted_rank = rank[order]
            want = (doc[opens].astype(np.int64) * (int(level.max(initial=0)) + 2) + level[opens] - 1) * width + opens
            j = np.searchsorted(sorted_rank, want) - 1
            ok = (j >= 0) & (level[opens] > 1)
            jj = order[np.maximum(j, 0)]
            ok &= (doc[jj] == doc[opens]) & (level[jj] == level[opens] - 1)
            box[opens] = np.where(ok, holder[jj], -1)
            pos = place.copy()
            pos[opens] = np.where(ok, place[jj], 0)
        closes = np.flatnonzero(kind == _CLOSE)
        if len(closes):
            mate = holder[closes]
            ok = mate >= 0
            bad[doc[closes[~ok]]] = True
            good = closes[ok]
            bad[doc[good[byte[mate[ok]] + 2 != byte[good]]]] = True  # { } and [ ] are two apart
            end[mate[ok]] = at[good] + 1
        # Grammar of neighbours.
        before = np.zeros(m, np.int8)
        before[1:] = np.where(doc[1:] == doc[:-1], kind[:-1], 0)
        after = np.zeros(m, np.int8)
        after[:-1] = np.where(doc[1:] == doc[:-1], kind[1:], 0)
        in_object = (holder >= 0) & (byte[np.maximum(holder, 0)] == 0x7B)
        prev_open_object = np.zeros(m, bool)
        prev_comma_object = np.zeros(m, bool)
        prev_open_object[1:] = (before[1:] == _OPEN) & (byte[:-1] == 0x7B)
        prev_comma_object[1:] = (before[1:] == _COMMA) & in_object[:-1]
        is_key = (kind == _STRING) & (prev_open_object | prev_comma_object)
        prev_key = np.zeros(m, bool)
        prev_key[1:] = is_key[:-1] & (before[1:] != 0)
        value_end = np.isin(before, (_STRING, _SCALAR, _CLOSE)) & ~prev_key
        starts_value = np.isin(kind, (_STRING, _SCALAR, _OPEN))
        fits = np.select(
            [kind == _COLON, kind == _COMMA, kind == _CLOSE, starts_value],
            [prev_key, value_end & (holder >= 0), value_end | (before == _OPEN), is_key | (before == _COLON) | (before == 0) | ((before == _OPEN) & ~prev_open_object) | ((before == _COMMA) & ~prev_comma_object)],
            False,
        )
        fits &= ~is_key | (after == _COLON)
        bad[doc[~fits]] = True
        # A text is one value: nothing at level 0 but its first token.
        outer = (before != 0) & ((box == -1) & starts_value | (level <= 0))
        bad[doc[outer]] = True
        v = np.flatnonzero(kind == _SCALAR)
        if len(v):
            coded = slices(buf, at[v], end[v]).dictionary_encode()
            wrong = np.array([not _SCALAR_FORM.fullmatch(x) for x in coded.dictionary.to_pylist()])
            bad[doc[v[wrong[coded.indices.to_numpy()]]]] = True
        has = np.zeros(docs, bool)
        has[doc] = True
        self.whole = has & ~bad
        key = np.full(m, -1, np.int64)
        named = np.flatnonzero(before == _COLON)
        key[named] = named - 2
        self.at, self.end, self.kind, self.byte, self.doc, self.box, self.place, self.key = at, end, kind, byte, doc, box, pos, key
        self.value = starts_value & ~is_key
        self._spans = list(zip(at.tolist(), end.tolist(), kind.tolist()))

    def names(self) -> np.ndarray:
        """For every token the name of its key, as an object array (None: no key)."""
        out = np.full(len(self.at), None, object)
        has = np.flatnonzero(self.value & (self.key >= 0))
        if len(has):
            k = self.key[has]
            coded = slices(self.buf, self.at[k], self.end[k]).dictionary_encode()
            words = np.array([_unquote(x) for x in coded.dictionary.to_pylist()] + [None], object)[:-1]
            out[has] = words[coded.indices.to_numpy()]
        return out

    def field(self, t: int) -> str | None:
        """A value as text: strings decoded, null as None, everything else as it stands."""
        a, b, kind = self._spans[t]
        raw = self.bytes[a:b]
        if kind == _STRING:
            return _unquote(raw)
        return None if raw == b"null" else raw.decode("utf-8", "replace")


def _unquote(raw: bytes) -> str:
    if b"\\" not in raw:
        return raw[1:-1].decode("utf-8", "replace")
    try:
        return json.loads(raw)
    except ValueError:
        return raw[1:-1].decode("utf-8", "replace")


_ROW = pa.schema([
    ("raw_id", pa.int64()), ("page_id", pa.int64()), ("at", pa.int64()), ("kind", pa.string()),
    ("region_path", pa.string()), ("parent_path", pa.string()), ("place", pa.int32()), ("depth", pa.int32()),
    ("fields", pa.map_(pa.string(), pa.string())),
])
ROW_DDL = "raw_id bigint, page_id bigint, at bigint, kind string, region_path string, parent_path string, place int, depth int, fields map<string,string>"


class _Rows:
    def __init__(self) -> None:
        self.columns: list[list] = [[] for _ in _ROW]

    def add(self, *row) -> None:  # noqa: ANN002
        for c, v in zip(self.columns, row):
            c.append(v)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(self.columns, _ROW)], schema=_ROW)


#: Names that link rows; they are followed whatever fields are wanted.
_LINKS = frozenset(("page", "image", "regions"))


def _members(ix: Index, names: np.ndarray, boxes: np.ndarray, wanted: frozenset | None) -> dict[int, dict[str, int]]:
    """For each object (its opening token): name to value token, the last of a repeated name; of ``wanted`` names and links only."""
    of = np.flatnonzero(ix.value & (ix.key >= 0) & np.isin(ix.box, boxes))
    out: dict[int, dict[str, int]] = {int(b): {} for b in boxes}
    keep = None if wanted is None else wanted | _LINKS
    for t, b, name in zip(of.tolist(), ix.box[of].tolist(), names[of].tolist()):
        if keep is None or name in keep:
            out[b][name] = t
    return out


def _emit_regions(ix: Index, names: np.ndarray, frontier: dict[int, tuple], rows: _Rows, texts: list, wanted: frozenset | None) -> None:
    """Rows of the regions in the lists of ``frontier`` (opening token to (owner, path, depth)), level by level.

    Lists that come as JSON text are put on ``texts``.
    """
    while frontier:
        lists = np.fromiter(frontier, np.int64, len(frontier))
        objects = np.flatnonzero((ix.kind == _OPEN) & (ix.byte == 0x7B) & np.isin(ix.box, lists))
        members = _members(ix, names, objects, wanted)
        following: dict[int, tuple] = {}
        for t, b, place in zip(objects.tolist(), ix.box[objects].tolist(), ix.place[objects].tolist()):
            owner, parent, depth = frontier[b]
            path = f"{parent}/{place}" if parent is not None else str(place)
            own = members[t]
            fields = [(k, ix.field(v)) for k, v in own.items() if k != "regions" and (wanted is None or k in wanted)]
            rows.add(*owner, "region", path, parent, place, depth, fields)
            inner = own.get("regions")
            if inner is not None:
                _queue(ix, inner, (owner, path, depth + 1), following, texts)
        frontier = following


def _queue(ix: Index, t: int, where: tuple, lists: dict[int, tuple], texts: list) -> None:
    if ix.kind[t] == _OPEN and ix.byte[t] == 0x5B:
        lists[int(t)] = where
    elif ix.kind[t] == _STRING:
        texts.append((ix.field(t), where))


def _flattener(wanted: frozenset | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _flatten(batches, wanted)

    return run


def _flatten(batches: Iterator[pa.RecordBatch], wanted: frozenset | None = None) -> Iterator[pa.RecordBatch]:
    some = lambda n: wanted is None or n in wanted
    for batch in batches:
        ids = [batch.column(k).to_pylist() for k in (0, 2, 3)]
        for first, buf, starts in text_runs(batch, RUN_BYTES):
            rows, texts = _Rows(), []
            ix = Index(buf, starts)
            names = ix.names()
            # The page: the outermost object, or the object under its key "page".
            roots = np.flatnonzero((ix.kind == _OPEN) & (ix.byte == 0x7B) & (ix.box == -1))
            roots = roots[ix.whole[ix.doc[roots]]]
            members = _members(ix, names, roots, wanted)
            page_of = {}
            for r in roots.tolist():
                p = members[r].get("page")
                page_of[r] = p if p is not None and ix.kind[p] == _OPEN and ix.byte[p] == 0x7B else r
            members |= _members(ix, names, np.array([p for r, p in page_of.items() if p != r], np.int64), wanted)
            pictures = {p: t for p in page_of.values() if (t := members[p].get("image")) is not None and ix.kind[t] == _OPEN and ix.byte[t] == 0x7B}
            inner = _members(ix, names, np.fromiter(pictures.values(), np.int64, len(pictures)), wanted)
            frontier: dict[int, tuple] = {}
            for r, p in page_of.items():
                k = first + int(ix.doc[r])
                owner = tuple(col[k] for col in ids)
                own = members[p]
                rows.add(*owner, "page", None, None, None, 0, [(n, ix.field(v)) for n, v in own.items() if n not in ("regions", "image") and some(n)])
                if p in pictures:
                    rows.add(*owner, "image", None, None, None, 0, [(n, ix.field(v)) for n, v in inner[pictures[p]].items() if some(n)])
                if "regions" in own:
                    _queue(ix, own["regions"], (owner, None, 1), frontier, texts)
            _emit_regions(ix, names, frontier, rows, texts, wanted)
            while texts:  # lists that came as JSON text are indexed in turn
                raw = [t.encode("utf-8", "surrogatepass") for t, _ in texts]
                ends = np.cumsum([0] + [len(x) for x in raw])
                sub = Index(np.frombuffer(b"".join(raw), np.uint8), ends)
                lists = np.flatnonzero((sub.kind == _OPEN) & (sub.byte == 0x5B) & (sub.box == -1))
                frontier = {int(t): texts[sub.doc[t]][1] for t in lists if sub.whole[sub.doc[t]]}
                texts = []
                _emit_regions(sub, sub.names(), frontier, rows, texts, wanted)
            yield rows.batch()


def flatten(raw: DataFrame, raw_id: str = "raw_id", page_id: str = "page_id", payload: str = "payload", received: str = "received_at", fields: Iterable[str] | None = None) -> DataFrame:
    """Linked rows of each page's latest whole payload, as a stage table (columns: ROW_DDL), with the named ``fields`` or all."""
    slim = require(raw, raw_id, page_id, payload, received).select(
        F.col(raw_id).cast("bigint").alias("raw_id"),
        F.col(payload).cast("string").alias("payload"),
        F.col(page_id).cast("bigint").alias("page_id"),
        F.unix_micros(F.col(received).cast("timestamp_ltz")).alias("at"),
    )
    rows = stage(slim.where("page_id IS NOT NULL AND payload IS NOT NULL").mapInArrow(_flattener(None if fields is None else frozenset(fields)), ROW_DDL), "nested-rows")
    order = F.struct(F.coalesce("at", F.lit(-(1 << 62))), F.coalesce("raw_id", F.lit(-(1 << 62))))
    latest = rows.where("kind = 'page'").groupBy("page_id").agg(F.max(order).alias("o"))
    return rows.withColumn("o", order).join(latest, ["page_id", "o"], "left_semi").drop("o")


def _typed(*columns: str) -> list:
    """Columns from fields; ``name:type`` casts (a value that can't be cast is null)."""
    out = []
    for c in columns:
        name, _, kind = c.partition(":")
        v = F.col("fields")[name]
        out.append((v.try_cast(kind) if kind else v).alias(name))
    return out


def page_table(rows: DataFrame) -> DataFrame:
    """One row for each page."""
    return rows.where("kind = 'page'").dropDuplicates(["page_id"]).select(
        "page_id", "raw_id", *_typed("file_name", "image_width:int", "image_height:int", "source", "annotation_source", "year:int", "fund", "content_type", "grade:int", "subject", "group"))


def image_table(rows: DataFrame) -> DataFrame:
    """One row for each image object, with its page."""
    return rows.where("kind = 'image'").dropDuplicates(["page_id"]).select("page_id", *_typed("path", "src", "width:int", "height:int"))


def region_table(rows: DataFrame) -> DataFrame:
    """One row for each region object at any depth, with its page and its parent region (null: the page)."""
    return rows.where("kind = 'region'").dropDuplicates(["page_id", "region_path"]).select(
        "page_id", "region_path", "parent_path", "place", "depth", *_typed("type", "text", "language", "legibility", "confidence:double"))


def bbox_table(rows: DataFrame) -> DataFrame:
    """One row for each region with four readable coordinates, given as a list or by name."""
    raw = F.col("fields")["bbox"]
    listed = F.transform(F.from_json(raw, "array<string>"), lambda x: x.try_cast("double"))
    by_name = F.from_json(raw, "map<string,string>")
    named = F.array(*[by_name[c].try_cast("double") for c in ("x1", "y1", "x2", "y2")])
    box = F.when(raw.startswith("["), listed).when(raw.startswith("{"), named)
    b = rows.where("kind = 'region'").dropDuplicates(["page_id", "region_path"]).select("page_id", "region_path", box.alias("b")).where("size(b) = 4 AND NOT exists(b, x -> x IS NULL)")
    return b.select("page_id", "region_path", *[F.col("b")[k].alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))])
