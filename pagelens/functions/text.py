"""Text normalisation for scoring, edit-distance rates and other scalar text functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.functions.binding import let

# Wrappers that are removed around their content, in this order.
WRAPPERS = ["mathrm", "mathbf", "mathit", "mathbb", "mathcal", "mathfrak", "operatorname", "boldsymbol", "underline", "cancel"]
# Symbols, replaced one after the other in this order.
SYMBOLS = [
    (r"\alpha", "α"), (r"\beta", "β"), (r"\gamma", "γ"), (r"\delta", "δ"), (r"\epsilon", "ε"), (r"\theta", "θ"),
    (r"\lambda", "λ"), (r"\mu", "μ"), (r"\pi", "π"), (r"\sigma", "σ"), (r"\phi", "φ"), (r"\omega", "ω"),
    (r"\cdot", "·"), (r"\times", "×"), (r"\div", "÷"), (r"\pm", "±"), (r"\leq", "≤"), (r"\geq", "≥"), (r"\neq", "≠"),
    (r"\rightarrow", "→"), (r"\to", "→"), (r"\leftarrow", "←"), (r"\uparrow", "↑"), (r"\downarrow", "↓"),
    (r"\vee", "∨"), (r"\wedge", "∧"), (r"\setminus", "\\"), (r"\mid", "|"), (r"\lvert", "|"), (r"\rvert", "|"),
    (r"\lfloor", "⌊"), (r"\rfloor", "⌋"), (r"\lceil", "⌈"), (r"\rceil", "⌉"), (r"\male", "♂"), (r"\female", "♀"),
]
# Size commands, function names, letters that carry indices, digits, folded signs and letters.
SIZES = "big|Big|bigg|Bigg|bigl|bigr|Bigl|Bigr|biggl|biggr|Biggl|Biggr"
FUNCTIONS = "sin|cos|tan|log|ln|lim|arcsin|arccos|arctan|sinh|cosh|tanh"
LETTERS = "A-Za-zА-Яа-яІіЇїЄєҐґ"
SUPERSCRIPTS, SUBSCRIPTS, DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹", "₀₁₂₃₄₅₆₇₈₉", "0123456789"
FOLDED, FOLD = "—–«»“”copx", '--""""сорх'
_ON, _OFF = "\x01", "\x02"


def _indices(t: Column, digits: str, mark: str) -> Column:
    """Runs of raised or lowered digits after a letter as plain digits behind ``mark``."""
    marked = F.regexp_replace(t, f"([{LETTERS}])([{digits}]+)", f"$1{mark}{_ON}$2{_OFF}")

    def plain(piece: Column) -> Column:
        at = F.instr(piece, _OFF)
        return F.when(at == 0, piece).otherwise(F.concat(F.translate(F.substr(piece, F.lit(1), at - 1), digits, DIGITS), F.substr(piece, at + 1)))

    return F.array_join(F.transform(F.split(marked, _ON), plain), "")


def _unwrap(t: Column, command: str) -> Column:
    """Without a wrapper's command and braces, until none is left: a pass removes one or more, so their number bounds the passes."""
    pattern = rf"\\{command}(?U)\s*(?-U)\{{([^{{}}]*)\}}"
    passes = lambda x: F.sequence(F.lit(1), F.regexp_count(x, F.lit(rf"\\{command}")))
    return let(t, lambda x: F.when(F.contains(x, F.lit(f"\\{command}")), F.aggregate(passes(x), x, lambda a, _: F.regexp_replace(a, pattern, "$1"))).otherwise(x))


def _latex(t: Column) -> Column:
    t = F.regexp_replace(t, r"\\xrightarrow(?:\[[^\]]*\])?\{[^{}]*\}", "→")
    t = F.regexp_replace(t, r"\\xleftarrow(?:\[[^\]]*\])?\{[^{}]*\}", "←")
    t = reduce(_unwrap, WRAPPERS, t)
    t = F.regexp_replace(t, r"\\(?:over|under)set\{[^{}]*\}\{([^{}]*)\}", "$1")
    t = F.regexp_replace(t, rf"(?U)\\(?:{SIZES})\b", "")
    t = F.regexp_replace(t, r"\\(?:hline|cline\{[^{}]*\}|phantom\{[^{}]*\})", "")
    t = reduce(lambda a, s: F.replace(a, F.lit(s[0]), F.lit(s[1])), SYMBOLS, t)
    return F.regexp_replace(t, rf"(?U)\\({FUNCTIONS})\b", "$1 ")


def normalize_text(text: Column) -> Column:
    """The form of a text in which transcriptions are compared; null as empty.

    Struck-out readings go, LaTeX is reduced to its signs, indices become plain digits, dashes, quotes and
    look-alike small letters are folded and white space is collapsed.  Texts without a backslash skip the
    LaTeX steps.
    """
    t = F.coalesce(text.cast("string"), F.lit(""))
    t = F.regexp_replace(t, r"(?d)~~.*?~~\{(.*?)\}", "$1")
    t = F.regexp_replace(t, r"(?d)~~(.*?)~~", "$1")
    t = let(t, lambda x: F.when(F.contains(x, F.lit("\\")), _latex(x)).otherwise(x))
    t = F.regexp_replace(t, rf"([{LETTERS}0-9])_\{{([^{{}}]+)\}}", "$1_$2")
    t = F.regexp_replace(t, rf"([{LETTERS}0-9])\^\{{([^{{}}]+)\}}", "$1^$2")
    t = let(t, lambda x: F.when(x.rlike(f"[{SUPERSCRIPTS}{SUBSCRIPTS}]"), _indices(_indices(x, SUPERSCRIPTS, "^"), SUBSCRIPTS, "_")).otherwise(x))
    t = F.replace(t, F.lit("''"), F.lit("'"))
    t = F.translate(t, FOLDED, FOLD)
    return F.trim(F.regexp_replace(t, r"(?U)[\s\x1c-\x1f]+", " "))


def strip(text: Column) -> Column:
    """The text without white space at its ends, of any kind."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def cer(pred: Column, truth: Column) -> Column:
    """Edit distance over the truth's length, both in characters; may exceed 1."""
    return F.levenshtein(pred, truth).cast("double") / F.greatest(F.lit(1), F.length(truth)).cast("double")


def base_name(path: Column) -> Column:
    """The last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """A file name without its last suffix; a leading dot begins no suffix, a final one none either."""
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+\z", "")


def format_bytes(n: Column) -> Column:
    """Bytes for people, in decimal units; rounded as whole numbers, halves up."""

    def by(unit: int, digits: int, name: str) -> Column:
        step = unit // 10**digits
        k = F.floor((n + F.lit(step // 2)) / F.lit(step)).cast("bigint")
        return F.format_string(f"%d.%0{digits}d {name}", F.floor(k / F.lit(10**digits)), k % 10**digits)

    return F.when(n >= 10**9, by(10**9, 2, "GB")).when(n >= 10**6, by(10**6, 1, "MB")).otherwise(by(10**3, 1, "KB"))


def mask_labels(ids: Column, prompt_length: Column, pad: Column) -> Column:
    """Token ids with the prompt and padding replaced by the ignored label."""
    from pagelens.constants import IGNORED_LABEL

    return F.transform(ids, lambda x, i: F.when((i < prompt_length) | F.coalesce(x == pad, F.lit(False)), IGNORED_LABEL).otherwise(x))


def truncate_right(ids: Column, most: int, has_vision: Column) -> Column:
    """At most ``most`` ids; too long rows with vision tensors raise, since image tokens would lose their pairs."""
    long = F.size(ids) > most
    return F.when(long & has_vision, F.raise_error(F.lit("vision inputs can't be truncated"))).when(long, F.slice(ids, 1, most)).otherwise(ids)
