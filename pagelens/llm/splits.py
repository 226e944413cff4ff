"""Splits that keep related pages together.

Pages are related through keys: the number of their writer and their book (source and book number).
``components`` joins keys that occur on one page: parallel hooking and shortcutting over a parent table.
In each round every root hooks onto its least neighbour if that is less than itself, pointer jumping
flattens the trees, and the edges are contracted to the new roots; only edges between different roots
stay, so rounds shrink quickly and are logarithmic in number.

``assign_splits`` gives whole families to splits by subset sums over the size multiplicities (bitsets), so that the
totals are as close to the proportions as the sizes allow.  Of each size a proportional number is taken beforehand, so
that splits resemble each other; where the rest can't reach the target exactly, half of what was taken is given back
and the sums are made again, in the end over all multiplicities.

Defined results: a page without a writer number and book is a family of its own; a page delivered again
counts once and has all keys and sides of its rows; splits other than the four count as no side; null page ids
are left out; empty tables give empty tables.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelens.llm.pages import base_name, book_number, file_name_of, side, source_of, writer_number
from pagelens.session import require, stage

#: Bits of a subset-sum bitset at most; a rest beyond it is counted in units of several pages.
BITS = 1 << 22
#: Families of one size that one task ranks; more are cut by a hash.
RANKED = 100_000


def page_keys(pages: DataFrame) -> DataFrame:
    """(page_id, key, side): a row for each key of a page; key null for a page row without keys."""
    p = require(pages, "page_id", "file_name", "image", "source", "split", "writer_ref").where("page_id IS NOT NULL")
    book = book_number(base_name(file_name_of()))
    keys = F.array_compact(F.array(F.concat(F.lit("w:"), writer_number()), F.concat(F.lit("b:"), book, F.lit(":"), source_of())))
    return p.select(F.col("page_id").cast("bigint").alias("page_id"), keys.alias("keys"), side().alias("side"))


def _jump(parents: DataFrame) -> DataFrame:
    """Shortcutting: parents of parents until nothing changes.  ``parents`` has (v, p), p < v, p maybe no v."""
    while True:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("q"))
        parents = stage(parents.join(up, "p", "left").select("v", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")), "cc-jump")
        moved = not parents.where("moved").limit(1).isEmpty()
        parents = parents.select("v", "p")
        if not moved:
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(v, root): for each end of an edge (a, b) the least end of its component.

    Ends may be of any ordered type; loops, repeated edges and nulls are allowed (nulls are left out).
    """
    e = require(edges, "a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = stage(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    vertices = both.select(F.col("a").alias("v")).union(both.select(F.col("b").alias("v"))).distinct()
    live = both.where("a < b")
    label = stage(vertices.select("v", F.col("v").alias("root")), "cc-label")
    while not live.limit(1).isEmpty():
        # Hooking: a < b holds for every edge, so each b hooks onto its least neighbour below.
        parents = _jump(stage(live.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")), "cc-hook"))
        to = lambda c: parents.select(F.col("v").alias(c), F.col("p").alias(f"{c}_to"))
        moved = live.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
        live = stage(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
        label = stage(label.join(to("root"), "root", "left").select("v", F.coalesce("root_to", "root").alias("root")), "cc-label")
    return label


def families(pages: DataFrame) -> DataFrame:
    """(page_id, family, side): each page row's family; rows of a page share it."""
    k = stage(page_keys(pages), "family-keys")
    own = F.concat(F.lit("p:"), F.col("page_id").cast("string"))
    first = F.coalesce(F.try_element_at("keys", F.lit(1)), own)
    # Keys of a page row hang together, and rows of a page through the page.
    linked = k.select(first.alias("a"), F.explode("keys").alias("b"))
    again = k.groupBy("page_id").agg(F.min(first).alias("a"), F.max(first).alias("b")).where("a <> b")
    several = k.join(again.select("page_id", F.col("a").alias("least")), "page_id").select(F.col("least").alias("a"), first.alias("b"))
    root = components(linked.union(several))
    at = k.select("page_id", first.alias("v"), "side")
    return at.join(root, "v", "left").select("page_id", F.coalesce("root", "v").alias("family"), "side")


def split_families(pages: DataFrame) -> DataFrame:
    """(page_id): pages whose family lies on more than one side."""
    f = stage(families(pages), "families")
    torn = f.groupBy("family").agg(F.min("side").alias("x"), F.max("side").alias("y")).where("x < y").select("family")
    return f.join(torn, "family", "left_semi").select("page_id").distinct()


def _reach(sums: int, weight: int, count: int, mask: int) -> int:
    """The bitset of sums with up to ``count`` more of ``weight``, multiplicities in powers of two."""
    step = 1
    while count > 0:
        k = min(step, count)
        sums |= (sums << (k * weight)) & mask
        count, step = count - k, step * 2
    return sums


def closest_sum(items: list[tuple[int, int]], goal: int) -> list[int]:
    """How many of each (weight, count) to take so that the sum comes closest to ``goal`` (ties: the lower sum).

    Only about every sqrt(n)-th bitset is kept; those between are made again on the way back.
    """
    limit = goal + max((w for w, _ in items), default=0)
    mask = (1 << (limit + 1)) - 1
    block = max(1, math.isqrt(len(items)))
    sums, kept = 1, []
    for k, (w, n) in enumerate(items):
        if k % block == 0:
            kept.append(sums)
        sums = _reach(sums, w, min(n, limit // w), mask)
    lower = (sums & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = sums >> (goal + 1)
    upper = goal + 1 + ((above & -above).bit_length() - 1) if above else None
    x = upper if upper is not None and upper - goal < goal - lower else lower
    taken = [0] * len(items)
    for first in range((len(items) - 1) // block * block if items else -1, -1, -block):
        part, inner, sums = items[first : first + block], [], kept.pop()
        for w, n in part:
            inner.append(sums.to_bytes(limit // 8 + 1, "little"))
            sums = _reach(sums, w, min(n, limit // w), mask)
        for k in range(len(part) - 1, -1, -1):
            while not inner[k][x >> 3] >> (x & 7) & 1:
                x -= part[k][0]
                taken[first + k] += 1
    return taken


def choose(counts: Mapping[int, int], target: int, share: float) -> dict[int, int]:
    """How many families of each size to take so that their pages come closest to ``target`` (ties: the fewer pages).

    ``counts`` is the number of families by size.  Of each size ``share``, rounded down, is fixed at first; while the others
    don't reach the target exactly, less is fixed, and in the end nothing.  The result is exact as long as a rest without
    anything fixed has at most BITS pages; a rest beyond that, which so many families of few sizes usually reach exactly,
    is summed in units of several pages.
    """
    fixed = {s: min(c, int(c * share)) for s, c in counts.items()}
    best: dict[int, int] = dict.fromkeys(counts, 0)
    while True:
        rest = target - sum(s * k for s, k in fixed.items())
        if rest >= 0:
            unit = max(1, -(-rest // BITS))
            sizes = sorted((s for s in counts if counts[s] > fixed[s]), reverse=True)
            more = closest_sum([(max(1, round(s / unit)), counts[s] - fixed[s]) for s in sizes], rest // unit)
            taken = fixed | {s: fixed[s] + k for s, k in zip(sizes, more)}
            total, ahead = (sum(s * k for s, k in t.items()) for t in (taken, best))
            if (abs(total - target), total) < (abs(ahead - target), ahead):
                best = taken
            if total == target:
                return best
        if not any(fixed.values()):
            return best
        fixed = {s: k // 2 for s, k in fixed.items()}


def assign_splits(pages: DataFrame, proportions: Mapping[str, float], seed: int = 0) -> DataFrame:
    """(page_id, family, split): every page's split by family, close to the given proportions.

    The first name of ``proportions`` takes what the others leave.  Which families of a size go where
    depends on a hash of family and seed alone.
    """
    f = stage(families(pages).select("page_id", "family").distinct(), "families")
    sizes = stage(f.groupBy("family").agg(F.count("*").alias("size")), "family-sizes")
    counts = {r.size: r.n for r in sizes.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most sqrt(2 pages) sizes
    total = sum(s * n for s, n in counts.items())
    names = list(proportions)
    left, taken = dict(counts), {}
    remaining = 1.0
    for name in names[1:]:
        share = proportions[name] / remaining if remaining > 0 else 0.0
        taken[name] = choose(left, round(total * proportions[name]), min(1.0, share))
        left = {s: n - taken[name].get(s, 0) for s, n in left.items()}
        remaining -= proportions[name]
    bounds, at = [], dict.fromkeys(counts, 0)
    for name in names[1:]:
        for s in counts:
            k = taken[name].get(s, 0)
            if k:
                bounds.append((s, at[s], at[s] + k, name))
            at[s] += k
    spark = pages.sparkSession
    table = spark.createDataFrame(bounds, "size bigint, lo bigint, hi bigint, split string")
    # Rank of each family among those of its size, by a hash, in buckets of a bounded number.
    h = F.xxhash64("family", F.lit(seed))
    many = sizes.groupBy("size").agg(F.ceil(F.count("*") / F.lit(RANKED)).cast("bigint").alias("buckets"))
    keyed = sizes.join(many, "size").select("family", "size", h.alias("h")).join(many, "size").withColumn("bucket", F.pmod("h", "buckets"))
    offset = keyed.groupBy("size", "bucket").agg(F.count("*").alias("n"))
    offset = offset.select("size", "bucket", (F.sum("n").over(Window.partitionBy("size").orderBy("bucket")) - F.col("n")).alias("before"))
    inner = F.row_number().over(Window.partitionBy("size", "bucket").orderBy("h", "family"))
    ranked = keyed.withColumn("r", inner).join(offset, ["size", "bucket"]).select("family", "size", (F.col("before") + F.col("r") - 1).alias("rank"))
    hit = (ranked["size"] == table["size"]) & (ranked["rank"] >= table["lo"]) & (ranked["rank"] < table["hi"])
    family_split = ranked.join(table, hit, "left").select(ranked["family"], F.coalesce("split", F.lit(names[0])).alias("split"))
    return f.join(family_split, "family").select("page_id", "family", "split")
