"""Visually identical text with different characters: one consistent form.

A token's letters each have a *resolved script set*: the scripts that have a letter of that shape.
The intersection over the token names the scripts in which the whole token could be written; from it
the consistent spelling is selected (in the order of PREFERENCE).  A token whose intersection
is empty has no spelling in one script and is spelled letter by letter in the same order.  Since script
sets depend on the shape only, equal-looking tokens always get the same spelling.

What a reader can see is kept: case, stress marks, raised digits, the numero sign, other signs, the
number of spaces.  What a reader can't see goes: full-width forms, kinds of spaces, order and form of
combining marks, zero-width and formatting characters, spaces at the ends.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.session import require, stage

# Letters of one shape in usual type, small ones first; the first of a script is the one that is written.
SHAPES = (
    "aаɑ cсϲ dԁ eе gɡց hһ iі jјϳ lӏ nո oоοօ pрρ qԛզ sѕ uս vνѵ wԝ xх yуү "
    "AАΑᎪ BВΒᏴ CСϹᏟ DᎠ EЕΕᎬ GԌᏀ HНΗᎻ IІΙӀ JЈͿᎫ KКΚᏦ LᏞ MМΜᎷϺ NΝ OОΟՕ PРΡᏢ QԚ RᎡ SЅՏᏚ TТΤᎢ UՍ VѴᏙ WԜᎳ XХΧ YҮΥ ZΖᏃ ГΓ ПΠ ФΦ"
).split()
#: Scripts by the first word of a letter's name, in the order of preference for spelling.
PREFERENCE = ("CYRILLIC", "LATIN", "GREEK", "ARMENIAN", "CHEROKEE")


# Cyrillic letters of shared shapes that texts in the corpus' languages hardly have; a spelling without them is preferred.
_RARE = re.compile("[ԁԍһјӏԛѕѵԝүЅЈӀԌѴԜҮԚ]")


def _script(c: str) -> str | None:
    """The letter's script; None for marks, signs and other scripts."""
    if c not in _script_of:
        first = unicodedata.name(c, "").split(" ", 1)[0]
        _script_of[c] = first if first in PREFERENCE else None
    return _script_of[c]


_script_of: dict[str, str | None] = {}


def _written(shape: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for c in shape:
        out.setdefault(_script(c), c)
    return out


#: For each letter of a shared shape: the letter of that shape by script.
TWINS = {c: _written(s) for s in SHAPES for c in s}

# Characters without a visible form beside category Cf.
_BLANK = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0}
ZWJ = "\u200d"

_TOKEN = re.compile(r"[^\W\d_]+(?:[\u0300-\u036f]+[^\W\d_]*)*")
_JOINED = re.compile("(?<=[^\u0000-\u2fff])\u200d(?=[^\u0000-\u2fff])")
#: Texts of these characters only are in the consistent form, unless they begin or end with a space.
_PLAIN = re.compile(r"(?:[^\W\d_a-zA-Zª-ϿѠ-\U0010ffffЅЈѕј]|[0-9 !-/:-@\[-`{-~№])*")


def _general() -> dict[int, str | None]:
    """Character table for all that doesn't depend on the token: spaces, wide, narrow and styled forms, Roman numerals, invisible characters."""
    out: dict[int, str | None] = {}
    # Only these blocks have such characters.
    for o in [o for a, b in ((0, 0x3200), (0xFE00, 0x10000), (0x110B0, 0x110D0), (0x13430, 0x13460), (0x1BCA0, 0x1BCB0), (0x1D100, 0x1D800), (0xE0000, 0xE0200)) for o in range(a, b)]:
        c = chr(o)
        kind = unicodedata.category(c)
        form = unicodedata.decomposition(c).split(" ", 1)[0]
        if kind == "Zs" or c == "\t":
            out[o] = " "
        elif o in (0x2010, 0x2011):  # hyphens drawn as the usual one
            out[o] = "-"
        elif kind in ("Zl", "Zp") or c in "\x0b\x0c\x85":
            out[o] = "\n"
        elif kind == "Cf" and c != ZWJ or o in _BLANK:
            out[o] = None
        elif o >= 0xFF00 and form in ("<wide>", "<narrow>") or 0x1D400 <= o < 0x1D800 and form == "<font>" or 0x2160 <= o < 0x2180 and form == "<compat>":
            out[o] = unicodedata.normalize("NFKC", c)
    return out


_GENERAL = _general()


def resolved(token: str) -> tuple[set[str], frozenset[str] | None, bool]:
    """The scripts of a token's letters, the scripts in which all of it could be written (None: no letter), and whether any shape is shared."""
    used, common, shared = set(), None, False
    for c in token:
        k = _script(c)
        if k is None:
            continue
        used.add(k)
        twins = TWINS.get(c)
        could = frozenset(twins) if twins else frozenset((k,))
        shared |= len(could) > 1
        common = could if common is None else common & could
    return used, common, shared


def _spelled(token: str) -> str:
    _, common, shared = resolved(token)
    if not shared:
        return token
    whole = [k for k in PREFERENCE if k in (common or ())]
    spellings = ["".join(TWINS[c][k] if c in TWINS else c for c in token) for k in whole] or ["".join(_letter(c) for c in token)]
    return next((x for x in spellings if not _RARE.search(x)), spellings[0])


def _letter(c: str) -> str:
    """A letter of a token that no script can write whole: the first of its shape that is usual."""
    twins = [TWINS[c][k] for k in PREFERENCE if k in TWINS[c]] if c in TWINS else [c]
    return next((x for x in twins if not _RARE.search(x)), twins[0])


def token_kind(token: str) -> str:
    """single, mixed (letters of several scripts) or whole (all of it could be of another script)."""
    used, common, _ = resolved(unicodedata.normalize("NFD", token))
    return "mixed" if len(used) > 1 else "whole" if common and len(common) > 1 else "single"


def _plain(text: str) -> str:
    """The text without what doesn't depend on the token, decomposed."""
    t = text.replace("\r\n", "\n").replace("\r", "\n").translate(_GENERAL)
    if ZWJ in t:  # visible only where it joins pictographs
        t = _JOINED.sub("\x00", t).replace(ZWJ, "").replace("\x00", ZWJ)
    return unicodedata.normalize("NFD", t)


def consistent(text: str | None) -> str | None:
    """The consistent form of a text; null stays null."""
    if text is None or _PLAIN.fullmatch(text):
        return text.strip(" ") if text else text
    t = _TOKEN.sub(lambda m: _spelled(m[0]), _plain(text))
    return unicodedata.normalize("NFC", t).strip(" \n")


def consistent_text(col: Column | str) -> Column:
    """Column with the consistent form of a text column."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(consistent, na_action="ignore")

    return run(F.col(col) if isinstance(col, str) else col)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    digest = xxhash.xxh3_128_digest
    for batch in batches:
        texts = batch.column(1).to_pylist()
        looks, chars = [], []
        for t in texts:
            c = consistent(t)
            ok = bool(c)
            looks.append(digest(c.encode("utf-8", "surrogatepass")) if ok else None)
            chars.append(digest(t.encode("utf-8", "surrogatepass")) if ok else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(looks, pa.binary()), pa.array(chars, pa.binary()), batch.column(2)], names=["k", "look", "chars", "at"])


def look_digests(rows: DataFrame, key: str, text: str, version: str | None = None) -> DataFrame:
    """(k, look, chars): 128-bit digests of the consistent form and of the characters, one row per key.

    Of rows with the same key the one with the latest ``version`` counts (nulls first; ties: any one
    of the tied rows, by greatest digest).  Null keys, null texts and texts without a visible
    character are left out.
    """
    cols = [key, text] + ([version] if version else [])
    rows = require(rows, *cols).select(
        F.col(key).cast("bigint").alias("k"),
        F.col(text).cast("string").alias("text"),
        (F.unix_micros(F.col(version).cast("timestamp_ltz")) if version else F.lit(0).cast("bigint")).alias("at"),
    ).where("k IS NOT NULL")
    d = rows.mapInArrow(_digests, "k bigint, look binary, chars binary, at bigint")
    last = d.groupBy("k").agg(F.max(F.struct("at", "look", "chars")).alias("x"))
    return last.select("k", "x.look", "x.chars").where("look IS NOT NULL")


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen, n = {}, Counter()
        for t in batch.column(0).to_pylist():
            for token in _TOKEN.findall(_plain(t)):
                if token not in seen:
                    seen[token] = token_kind(token)
                n[seen[token]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["kind", "tokens"])


def token_kinds(rows: DataFrame, text: str = "text") -> DataFrame:
    """(kind, tokens): how many tokens of a text column are mixed, whole or single by ``token_kind``; nulls have none."""
    t = require(rows, text).where(F.col(text).isNotNull()).select(F.col(text).cast("string"))
    return t.mapInArrow(_kinds, "kind string, tokens bigint").groupBy("kind").agg(F.sum("tokens").alias("tokens"))


def look_alike_pairs(digests: DataFrame) -> DataFrame:
    """(a, b): all pairs of keys, a < b, whose texts look the same but have different characters.

    Copies of one text are grouped first, so only classes with at least two spellings are joined.
    """
    d = stage(digests, "looks")
    spelled = d.groupBy("look").agg(F.min("chars").alias("x"), F.max("chars").alias("y")).where("x <> y").select("look")
    members = stage(d.join(spelled, "look", "left_semi"), "look-members")
    spellings = members.select("look", "chars").distinct()
    other = spellings.select("look", F.col("chars").alias("other"))
    couples = spellings.join(other, "look").where("chars < other")
    left = couples.join(members.withColumnRenamed("k", "p"), ["look", "chars"])
    right = members.select("look", F.col("chars").alias("other"), F.col("k").alias("q"))
    pairs = left.join(right, ["look", "other"])
    return pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def look_alike_classes(digests: DataFrame) -> DataFrame:
    """(k, class_id, links): each key's class of equal looks and its number of partners of other characters."""
    d = stage(digests, "looks")
    per = d.groupBy("look", "chars").agg(F.count("*").alias("n"), F.min("k").alias("first"))
    total = per.groupBy("look").agg(F.sum("n").alias("all"), F.min("first").alias("class_id"))
    sizes = per.join(total, "look").select("look", "chars", "class_id", (F.col("all") - F.col("n")).alias("links"))
    return d.join(sizes, ["look", "chars"]).select("k", "class_id", "links")
