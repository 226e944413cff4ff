"""Encoding of a whole corpus with a public byte-level BPE, by content-defined chunk reuse.

1. Every text is cut into chunks.  Cuts depend on content only: a rolling hash over the last WINDOW bytes decides
   at which characters a text is cut, so equal passages give equal chunks wherever they stand.
2. Chunks of one segment (a few MB of texts) are kept once.  Hashes of the chunks, not the chunks, are counted over the
   corpus.  A chunk that stands in several segments is encoded in the first of them alone, and its ids go to the others;
   all other chunks are encoded where they stand.  So each distinct chunk is encoded once, and what is shuffled is
   a hash a chunk and the ids of shared chunks.  Segments wait in a table bucketed by the part of a task that wrote them,
   so marks and ids join them without moving a text.
3. Ids are laid out by the byte at which each begins.  Most cuts fall into words, so joins are repaired: the stretch
   around a cut, from the safe place before it to the next one, is encoded as a piece of its own (once a segment) and
   takes the place of the ids that begin in it.  A place is safe before white space that follows a non-space, since
   no pre-token crosses it.  Both sides must agree that a token begins at either end of the stretch; a disagreement
   fails the query.

A chunk of very many segments is joined under SALTS keys, so no key of a join has all of its segments.

Defined results: empty text and null text give the empty list; strings that look like special tokens
are ordinary text; rows with a null doc_id are kept; repeated rows come out as often as they came in;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.arrow import slices, text_runs
from pagelens.session import require, stage, stage_bucketed

#: Bytes of text in a segment, at most, unless one text alone is longer.
SEGMENT_BYTES = 4 << 20
#: Bytes under the rolling hash, a power of two.
WINDOW = 16
#: Characters of a chunk on average.
MEAN = 256
#: Keys under which a shared chunk is joined, at most.
SALTS = 32
#: Parts among which a task deals its segments, so that few big input splits still give work to all cores.
SPREAD = 4
#: Buckets that a table may have.
MOST_BUCKETS = 100_000

_INT = pa.list_(pa.int32())
_SEGMENT = pa.schema([
    ("seg", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", _INT), ("starts", _INT), ("refs", _INT),
    ("from_", _INT), ("to_", _INT), ("repairs", _INT), ("pieces", pa.list_(pa.binary())), ("hashes", pa.list_(pa.int64())), ("part", pa.int64()),
])
_SEGMENT_DDL = "seg bigint, doc_ids array<bigint>, doc_starts array<int>, starts array<int>, refs array<int>, from_ array<int>, to_ array<int>, repairs array<int>, pieces array<binary>, hashes array<bigint>, part bigint"


def gear_table() -> np.ndarray:
    """The 256 mixing words of the rolling hash, from a fixed linear generator."""
    x, out = 0x9E3779B9, []
    for _ in range(256):
        x = (x * 1664525 + 1013904223) & 0xFFFFFFFF
        out.append(x ^ (x >> 15))
    return np.array(out, dtype=np.uint32)


def rolling_hash(buf: np.ndarray) -> np.ndarray:
    """For each byte the hash of the WINDOW bytes before it: each one's mixing word, shifted by its distance."""
    h = np.zeros(len(buf), np.uint32)
    h[1:] = gear_table()[buf[:-1]]
    width = 1
    while width < WINDOW:  # the hash of twice the width is that of the last half and, shifted, of the half before
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, 2 * width
    return h


def cuts(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk starts in ``buf`` (UTF-8 bytes of all texts, one after the other; texts begin at ``starts``).

    Returns the sorted starts and the ends of the stretches around those of them that aren't safe.
    """
    n = len(buf)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    begin = np.zeros(n, bool)
    begin[starts[starts < n]] = True
    cut = begin | (rolling_hash(buf) < np.uint32((1 << 32) // MEAN)) & ((buf & 0xC0) != 0x80)
    prev, before = np.zeros_like(buf), np.zeros_like(buf)
    prev[1:], before[2:] = buf[:-1], buf[:-2]
    solid = (prev > 0x20) & (prev < 0x7F) | (before >= 0xD0) & (before <= 0xD3) & (prev >= 0x80) & (prev < 0xC0)
    safe = np.flatnonzero(((buf == 0x20) | (buf == 0x0A)) & solid | begin)
    at = np.flatnonzero(cut)
    gap = np.searchsorted(safe, at, side="right") - 1
    gap = np.unique(gap[safe[gap] != at])
    return at, safe[gap], np.append(safe, n)[gap + 1]


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to segment rows; ``refs`` and ``repairs`` are places in ``pieces``, chunks come first there and have ``hashes``."""
    import xxhash
    from pyspark import TaskContext

    number, task = 0, TaskContext.get().partitionId()
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for first, buf, offsets in text_runs(batch, SEGMENT_BYTES):
            ids = batch.column(0).slice(first, len(offsets) - 1)
            at, a, b = cuts(buf, offsets[:-1])
            chunks = slices(buf, at, np.append(at[1:], len(buf)) if len(at) else at).dictionary_encode()
            repairs = slices(buf, a, b).dictionary_encode()
            hashes = np.fromiter((digest(x) for x in chunks.dictionary.to_pylist()), np.uint64, len(chunks.dictionary)).view(np.int64)
            places = chunks.indices.to_numpy(zero_copy_only=False), repairs.indices.to_numpy(zero_copy_only=False) + len(hashes)
            wrap = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(t) if isinstance(x, pa.Array) else pa.array(x, t))
            numbers = [wrap(x.astype(np.int32), pa.int32()) for x in (offsets, at, places[0], a, b, places[1])]
            pieces = pa.concat_arrays([chunks.dictionary, repairs.dictionary])
            part = task * SPREAD + number % SPREAD
            row = [pa.array([part << 32 | number], pa.int64()), wrap(ids, pa.int64()), *numbers, wrap(pieces, pa.binary()), wrap(hashes, pa.int64()), pa.array([part], pa.int64())]
            yield pa.RecordBatch.from_arrays(row, schema=_SEGMENT)
            number += 1


def vocabulary_of(path: str) -> tuple[bytes, str]:
    """A ``.tiktoken`` rank file and the pattern of pre-tokens, as they are sent to the executors."""
    import public_tokenizers

    with open(path, "rb") as f:
        return f.read(), public_tokenizers.PATTERN


class Tokenizer:
    """The tokenizer of a rank file: ids of ordinary text, and the bytes of each id."""

    def __init__(self, ranks: bytes, pattern: str):
        import base64

        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        self._encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.lengths = np.zeros(max(table.values()) + 1, np.int64)
        for token, i in table.items():
            self.lengths[i] = len(token)
        self.packed = np.dtype("<u2" if len(self.lengths) <= 1 << 16 else "<i4")

    def encode(self, piece: bytes) -> np.ndarray:
        """Packed ids of a piece; there are no special tokens, so all of it is ordinary text."""
        return self._encoding.encode_to_numpy(piece.decode(), disallowed_special=()).astype(self.packed)


_loaded: dict[int, Tokenizer] = {}


def _tokenizer(shipped) -> Tokenizer:  # noqa: ANN001  a Broadcast of vocabulary_of; read once in a Python worker
    ranks, pattern = shipped.value
    key = hash((ranks, pattern))
    if key not in _loaded:
        _loaded[key] = Tokenizer(ranks, pattern)
    return _loaded[key]


def _list(row: dict, column: str) -> np.ndarray:
    return row[column].values.to_numpy(zero_copy_only=False)


def _owner(shipped):  # noqa: ANN001
    """Shared chunks to their ids, in the segment that owns them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(shipped)
        for batch in batches:
            for pieces, marks in zip(batch.column("pieces"), batch.column("marks")):
                m = marks.values.flatten()
                slots, hashes, salts = m[0], m[1], m[2]
                ids = [t.encode(x).tobytes() for x in pieces.values.take(slots).to_pylist()]
                yield pa.RecordBatch.from_arrays([hashes, salts, pa.array(ids, pa.binary())], names=["h", "salts", "ids"])

    return run


def _assembler(shipped):  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(shipped)
        for batch in batches:
            for i in range(batch.num_rows):
                yield assemble({c: batch.column(c)[i] for c in batch.schema.names}, t)

    return run


def _byte_starts(ids: np.ndarray, counts: np.ndarray, bases: np.ndarray, t: Tokenizer) -> np.ndarray:
    """The byte of the segment at which each id begins, for runs of ``counts`` ids that begin at ``bases``."""
    size = t.lengths[ids]
    end = np.cumsum(size)
    first = np.cumsum(counts) - counts
    before = np.concatenate([[0], end])[first]
    return end - size + np.repeat(bases - before, counts)


def assemble(row: dict, t: Tokenizer) -> pa.RecordBatch:
    """One segment's (doc_id, ids) rows: its pieces encoded but for those whose ids came from elsewhere, laid out and repaired."""
    pieces = row["pieces"].values
    ids: list[np.ndarray | None] = [None] * len(pieces)
    if row["coded"].values is not None:
        slots, given = row["coded"].values.flatten()
        for k, x in zip(slots.to_pylist(), given.to_pylist()):
            ids[k] = np.frombuffer(x, t.packed)
    for k, x in enumerate(pieces.to_pylist()):
        if ids[k] is None:
            ids[k] = t.encode(x)
    counts = np.array([len(x) for x in ids], np.int64)
    starts, refs, a, b, repairs = (_list(row, c) for c in ("starts", "refs", "from_", "to_", "repairs"))
    doc_starts = _list(row, "doc_starts")
    run = lambda of: np.concatenate([ids[k] for k in of.tolist()] or [np.zeros(0, t.packed)])
    flat = run(refs)
    at = _byte_starts(flat, counts[refs], starts.astype(np.int64), t)
    if len(repairs):
        k = np.searchsorted(a, at, side="right") - 1
        inside = (k >= 0) & (at < b[np.maximum(k, 0)])
        if not (np.isin(a, at).all() and np.isin(b[b < doc_starts[-1]], at).all()):
            raise RuntimeError("a chunk and the stretch that repairs it don't agree on their ends")
        mended = run(repairs)
        flat, at = np.concatenate([flat[~inside], mended]), np.concatenate([at[~inside], _byte_starts(mended, counts[repairs], a.astype(np.int64), t)])
        order = np.argsort(at, kind="stable")
        flat, at = flat[order], at[order]
    ends = np.searchsorted(at, doc_starts, side="left")
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32)))
    return pa.RecordBatch.from_arrays([row["doc_ids"].values, lists], names=["doc_id", "ids"])


def _buckets(docs: DataFrame) -> int:
    """Buckets of segments: about as many as the input has splits."""
    return min(max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions()), MOST_BUCKETS)


def encode_corpus(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row of ``docs``; ``vocabulary`` is the path of a ``.tiktoken`` rank file, read by the driver alone."""
    docs = require(docs, id_col, text_col).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary_of(vocabulary))  # a fixed size
    seg = stage_bucketed(docs.mapInArrow(segments, _SEGMENT_DDL), "encode-segments", "part", _buckets(docs))
    salt = F.pmod("seg", F.lit(SALTS)).cast("int")
    chunks = seg.select("seg", F.posexplode("hashes").alias("slot", "h"))
    counted = chunks.groupBy("h").agg(F.count("*").alias("n"), F.min("seg").alias("owner"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), salt)).alias("bits"))
    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda k: F.col("bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), k)) != 0)
    shared = counted.where("n > 1").select("h", "owner", salts.alias("salts"))
    keyed = shared.select("h", "owner", "salts", F.explode("salts").alias("salt"))
    marks = stage(chunks.withColumn("salt", salt).join(keyed, ["h", "salt"]), "encode-marks")
    of_part = F.shiftright("seg", 32).alias("part")
    own = marks.where("seg = owner").groupBy(of_part).agg(F.collect_list(F.struct("seg", "slot", "h", "salts")).alias("all"))
    mine = lambda *names: F.transform(F.filter("all", lambda m: m["seg"] == F.col("seg")), lambda m: F.struct(*[m[x].alias(x) for x in names]))
    owned = seg.select("seg", "part", "pieces").join(own.hint("shuffle_hash"), "part").select("pieces", mine("slot", "h", "salts").alias("marks"))
    coded = owned.mapInArrow(_owner(shipped), "h bigint, salts array<int>, ids binary").select("h", F.explode("salts").alias("salt"), "ids")
    back = marks.select("seg", "slot", "h", "salt").join(coded, ["h", "salt"]).groupBy(of_part).agg(F.collect_list(F.struct("seg", "slot", "ids")).alias("all"))
    whole = seg.drop("hashes").join(back.hint("shuffle_hash"), "part", "left")
    columns = [c for c in seg.columns if c not in ("seg", "part", "hashes")]
    return whole.select(*columns, mine("slot", "ids").alias("coded")).mapInArrow(_assembler(shipped), "doc_id bigint, ids array<int>")
