"""Template residue, filler, error pages and script notices in place of content.

Labelled exemplars of residue are kept in an inverted index from term to exemplar.  Each document is cut
into passage windows: a sentence, a line where no sentence ends, and inside it each run of terms that gives a message
in full and in order.  A window retrieves the exemplars that share terms with it.  An exemplar counts as held where
the window contains it by TF-IDF weight (``HOLD``); the window counts as residue where held exemplars, at least
one of them a full message, cover its own TF-IDF weight (``COVER``).  So a sentence that only mentions "error 503"
holds an exemplar but isn't covered.

An unfilled template field is a term too, found by its syntax, and an exemplar of one term; its window is the field
itself, since fields stand in the middle of real sentences.  One that is quoted, is code or is part of a formula is
not a field.  Some exemplars are labelled as mentions: neither a field nor a run inside a sentence that holds one of them, and no
run in a sentence with quotation marks, counts.

Weights are inverse document frequencies over all documents.  A term outside all exemplars weighs as
one that stands in a single document; therefore a window whose share of exemplar terms is under COVER
can't reach COVER by weight and is left out before the weights are known, without loss.

Defined results: null, empty and blank texts, transcript marks, formulas and runs of signs are no
residue; null ids are left out; repeated rows give their id once; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelens.llm.exemplars import labelled
from pagelens.llm.leakage import words
from pagelens.session import require, stage

#: Share of an exemplar's weight that a window must contain, and of the window's weight to be covered.
HOLD, COVER = 0.8, 0.75
#: Different words of a filler vocabulary that a window must contain.
FILLER_WORDS = 3

# Syntax of template fields.
_NAME = r"[^\W\d][\w.\- ]*[^\W_]"
FIELD = re.compile(
    rf"""
      \{{\{{\s*{_NAME}\s*(?:\|[^{{}}\n]*)?\}}\}}(?![_^])      # {{{{ name }}}} or {{{{ name | filter }}}}
    | \$\{{\s*{_NAME}\s*\}}
    | <%[=-]?\s*{_NAME}\s*-?%>
    | \{{%-?\s*{_NAME}\s*-?%\}}
    | \[\[\s*{_NAME}\s*\]\]
    | @@{_NAME}@@ | %%{_NAME}%% | (?<!\w)__[^\W\d_](?:\w*[^\W_])?__(?!\w)
    | %\({_NAME}\)s
    | \[\s*(?:INSERT|ВСТАВТЕ|ВСТАВИТИ|тут\ вкажіть|вкажіть|вставьте)\b[^\]\n]{{1,60}}\]
    | <\s*(?:your\b[^<>\n]{{1,60}}\bhere|(?:вставити|вставьте|insert)\s*:[^<>\n]{{1,60}})>
    | \[(?:(?:Your|Company|Full|First|Last|Phone|Street|Project|Client|Product)\s)*(?:Name|Date|Title|Address|Number|Email|Phone|Company|City|Author|Subject|Year)\]
    | \bTODO:\s*{_NAME.replace(" ", "")}
    """,
    re.VERBOSE,
)
_CODE = re.compile(r"`[^`\n]*`")
_QUOTES = "«\"“„'‘`"
_BREAK = re.compile(r"(?<=[.!?…])\s+|[\n\r\x0b\x0c\x85\u2028\u2029]+")
_NUMBER = re.compile(r"\d[\w]*|[0-9a-f]{8,}")
_HINT = re.compile(r"[{$<\[@%_]|TODO")
#: Terms of a template field (a word that the text itself can hardly have) and of a number.
MARK, NUMBER = "fieldmark\u0a72field", "#"
_QUOTED = re.compile("[«»“”„\"`]")


def terms(passage: str) -> list[str]:
    """Terms of a passage: compared words, NUMBER for anything that begins with a digit or is a hex id."""
    return [NUMBER if w[0].isdigit() or _NUMBER.fullmatch(w) else w for w in words(passage)]


def mark_fields(text: str) -> str:
    """The text without code spans and with MARK in place of each template field."""
    if not _HINT.search(text):
        return text
    if "`" in text:
        text = _CODE.sub(" ", text)

    def one(m: re.Match) -> str:
        before, after = text[: m.start()][-1:], text[m.end() : m.end() + 1]
        if m[0].startswith("{{") and (before in "}" and before or re.search(r"\\\w+\{?$", text[max(0, m.start() - 40) : m.start()])):
            return m[0]
        if before and before in _QUOTES and after and after in "»\"”“'’`":
            return " "
        return f" {MARK} "

    return FIELD.sub(one, text)


class Exemplars:
    """Inverted index of the labelled exemplars from term to exemplar, and the messages by their first term."""

    def __init__(self) -> None:
        self.all: list[tuple[int, frozenset[str]]] = [(2, frozenset((MARK,)))]
        self.messages: dict[str, set[tuple[str, ...]]] = defaultdict(set)
        seen = set()
        for kind, text in labelled():
            t = terms(text)
            e = (kind, frozenset(t))
            if e not in seen:
                seen.add(e)
                self.all.append(e)
            if kind == 2 and len(t) > 1:
                self.messages[t[0]].add(tuple(t))
        self.by_term: dict[str, list[int]] = defaultdict(list)
        for k, (_, e) in enumerate(self.all):
            for t in e:
                self.by_term[t].append(k)
        self.vocabulary = frozenset(self.by_term)

    def runs(self, passage: list[str]) -> list[list[str]]:
        """The messages that stand in the passage in full and in order."""
        found = []
        for i, t in enumerate(passage):
            for m in self.messages.get(t, ()):
                if tuple(passage[i : i + len(m)]) == m:
                    found.append(list(m))
        return found

    def is_residue(self, passage: list[str], weight: dict[str, float], unknown: float) -> bool:
        """Whether held exemplars cover the passage, a message or a filler among them."""
        have = set(passage)
        w = lambda t: weight.get(t, unknown)
        held: set[str] = set()
        full = False
        for k in {k for t in have if t != NUMBER for k in self.by_term.get(t, ())}:
            kind, e = self.all[k]
            both = e & have
            if kind == 3:
                continue
            if len(both) >= FILLER_WORDS if not kind else sum(map(w, both)) >= HOLD * sum(map(w, e)):
                held |= both
                full |= kind != 1
        return full and sum(w(t) for t in passage if t in held) >= COVER * sum(map(w, passage))

    def is_mention(self, known: list[str]) -> bool:
        """Whether the terms hold a mention; its two or three terms weigh much alike, so all must be there."""
        have = set(known)
        return any(self.all[k][0] == 3 and self.all[k][1] <= have for t in have for k in self.by_term.get(t, ()))


def windows(text: str, exemplars: Exemplars) -> tuple[list[list[str]], set[str]]:
    """Passages of a text that may be residue, and the exemplars' terms in it."""
    vocabulary, out, seen = exemplars.vocabulary, [], set()
    for unit in _BREAK.split(mark_fields(text)):
        t = terms(unit)
        known = [x for x in t if x in vocabulary]
        if not known:
            continue
        seen.update(known)
        if MARK in known and not exemplars.is_mention(known):
            out.append([MARK])
        if len(known) < 2 and known[0] == NUMBER:
            continue
        if len(known) >= COVER * len(t):
            if any(x != NUMBER for x in known):
                out.append(t)
        elif len(known) > 1 and not _QUOTED.search(unit) and (runs := exemplars.runs(t)) and not exemplars.is_mention(known):
            out += runs
    return out, seen


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to windows that may be residue, and statistics: term, documents with it (null term: all)."""
    exemplars = Exemplars()
    for batch in batches:
        ids, passages, df = [], [], Counter()
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            df[None] += 1
            if text:
                found, seen = windows(text, exemplars)
                ids += [i] * len(found)
                passages += found
                df.update(seen)
        n = len(ids)
        yield pa.RecordBatch.from_arrays([
            pa.array(ids + [None] * len(df), pa.int64()),
            pa.array(passages + [None] * len(df), pa.list_(pa.string())),
            pa.array([None] * n + list(df), pa.string()),
            pa.array([None] * n + list(df.values()), pa.int64()),
        ], names=["doc_id", "passage", "term", "n"])


def _scorer(weights):  # a Broadcast of (weights, weight of other terms)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exemplars = Exemplars()
        weight, unknown = weights.value
        for batch in batches:
            found = set()
            for i, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i not in found and exemplars.is_residue(p, weight, unknown):
                    found.add(i)
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["doc_id"])

    return run


def residue_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id): documents with residue, be it the whole text or a piece between content."""
    spark = docs.sparkSession
    slim = require(docs, id_col, text_col).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id IS NOT NULL")
    scanned = stage(slim.mapInArrow(_scan, "doc_id bigint, passage array<string>, term string, n bigint"), "residue-scan")
    # One row for each term of the exemplars, a fixed number.
    stats = {r.term: r.n for r in scanned.where("n IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    total = stats.pop(None, 0)
    unknown = math.log(1 + total)
    weight = {t: math.log(1 + total / max(1, n)) for t, n in stats.items()} | {NUMBER: 0.5}
    windows = scanned.where("doc_id IS NOT NULL").select("doc_id", "passage")
    return windows.mapInArrow(_scorer(spark.sparkContext.broadcast((weight, unknown))), "doc_id bigint").distinct()


def without_residue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold residue."""
    bad = residue_documents(docs, id_col, text_col).select(F.col("doc_id").alias("__residue_id"))
    return docs.join(bad, docs[id_col] == F.col("__residue_id"), "left_anti")
