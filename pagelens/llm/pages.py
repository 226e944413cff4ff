"""What the page operators read off a page: its base name, book, writer number and side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name_of() -> Column:
    """file_name, or where that is null or empty image.path, then image.src."""
    full = lambda c: F.when(c != "", c)
    return F.coalesce(full(F.col("file_name")), full(F.col("image.path")), full(F.col("image.src")))


def base_name(name: Column) -> Column:
    """The part after the last folder; null if nothing is left."""
    b = F.element_at(F.split(name, r"[/\\]"), -1)
    return F.when(b != "", b)


def book_number(base: Column) -> Column:
    """Number after the mark ``nb``, without leading zeros; percent codes are read as characters."""
    plain = F.lower(F.coalesce(F.try_url_decode(base), base))
    n = F.regexp_extract(plain, r"(?<![\p{L}])nb[^0-9\p{L}]*0*([0-9]+)", 1)
    return F.when(n != "", n)


def source_of() -> Column:
    return F.coalesce(F.when(F.col("source") != "", F.col("source")), F.lit("unknown"))


def writer_number() -> Column:
    n = F.regexp_extract(F.coalesce("writer_ref", F.lit("")), r"0*([0-9]+)", 1)
    return F.when(n != "", n)


def side(split: Column | str = "split") -> Column:
    """1 training (train, silver), 2 val, 3 test; null for anything else."""
    s = F.lower(F.col(split) if isinstance(split, str) else split)
    return F.when(s.isin("train", "silver"), 1).when(s == "val", 2).when(s == "test", 3)
