"""Column functions on text: folding, filling, codes, durations, fees, legal references, dates and names.

All but nfc and similarity are built-in expressions. Marker lists are arguments.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=1)
def _decomposed() -> tuple[str, str]:
    """Letters that are one base letter and combining marks, and these base letters."""
    source, target = [], []
    for cp in range(0x00C0, 0x10000):
        whole = unicodedata.normalize("NFD", chr(cp))
        base = "".join(c for c in whole if unicodedata.category(c) != "Mn")
        if whole != chr(cp) and len(base) == 1:
            source.append(chr(cp))
            target.append(base)
    return "".join(source), "".join(target)


def strip_marks(x: Column) -> Column:
    source, target = _decomposed()
    return F.regexp_replace(F.translate(x, source, target), r"\p{Mn}+", "")


def fold(x: Column) -> Column:
    """Without marks and in lower case; the barred d stays."""
    return F.lower(strip_marks(x))


def fold_d(x: Column) -> Column:
    """fold, with the barred d as d, trimmed."""
    return F.trim(fold(F.translate(x, "đĐ", "dD")))


def squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def _class(points: list[int]) -> str:
    """A regular expression's class of code points, in runs."""
    runs: list[list[int]] = []
    for cp in sorted(points):
        if runs and cp == runs[-1][1] + 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "[" + "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


@lru_cache(maxsize=1)
def _uncomposed() -> tuple[str, str]:
    """A pattern of the characters without which composition changes nothing, and one of what composition changes: characters with another form, marks out of order, and marks that join a letter
    before them, other marks of lower order between."""
    order: dict[int, list[int]] = {}
    joins: dict[int, list[int]] = {}
    other = []
    for cp in range(0x80, 0x30000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        if rank := unicodedata.combining(c):
            order.setdefault(rank, []).append(cp)
        if unicodedata.normalize("NFC", c) != c:
            other.append(cp)
        elif (parts := unicodedata.decomposition(c)) and not parts.startswith("<") and " " in parts:
            base, mark = (int(p, 16) for p in parts.split())
            joins.setdefault(mark, []).append(base)
    # a letter with marks of its own joins a mark of lower order too, which moves in front of these
    ordered = [m for m in joins if unicodedata.combining(chr(m))]
    letters = sorted({cp for bases in joins.values() for cp in bases} | {cp for cp in range(0xC0, 0x2000) if unicodedata.decomposition(chr(cp))})
    for cp in letters:
        last = max(unicodedata.combining(c) for c in unicodedata.normalize("NFD", chr(cp)))
        for m in ordered:
            if unicodedata.combining(chr(m)) < last and unicodedata.normalize("NFC", chr(cp) + chr(m)) != chr(cp) + chr(m):
                joins[m].append(cp)
    ranks = sorted(order)
    below = {r: [cp for q in ranks if q < r for cp in order[q]] for r in ranks}
    out = [_class(other)]
    out += [_class(order[r]) + _class(below[r]) for r in ranks if below[r]]
    for mark, bases in joins.items():
        rank = unicodedata.combining(chr(mark))
        between = below.get(rank, [])
        # a letter joins its mark through others of lower order; letters that have joined one already stand for themselves
        out.append(_class(bases) + (_class(between) + "*" if between else "") + f"\\x{{{mark:x}}}")
    hangul = _class([0xAC00 + 28 * i for i in range(399)])
    rows = sorted({cp >> 8 for cp in other})  # whole rows of 256 characters, as a class of few runs is quick to test
    around = _class([cp for row in rows for cp in range(row << 8, (row + 1) << 8)])
    return rf"[\p{{M}}\x{{1100}}-\x{{11ff}}]|{around}", "|".join([*out, r"[\x{1100}-\x{1112}][\x{1161}-\x{1175}]", hangul + r"[\x{11a8}-\x{11c2}]"])


def not_composed(x: Column) -> Column:
    """Whether a text differs from its composed form (NFC)."""
    needed, whole = _uncomposed()
    return x.rlike(needed) & x.rlike(whole)


@F.pandas_udf(T.StringType())
def nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda v: v if v is None else unicodedata.normalize("NFC", v))


def composed(x: Column) -> Column:
    """A text in its composed form (NFC); only texts with characters that composition can change go through Python."""
    return F.coalesce(nfc(F.when(x.rlike(_uncomposed()[0]), x)), x)


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(p, q):
        return round(difflib.SequenceMatcher(None, p, q).ratio(), 3) if p and q else None

    return pd.Series([one(p, q) for p, q in zip(a, b, strict=True)], dtype="float64")


def similarity(a: Column, b: Column) -> Column:
    """Matching-blocks ratio of the folded names to three digits; null where a name is blank."""
    return _ratio(fold(a), fold(b))


def is_filled(x: Column, kind: str = "string") -> Column:
    """Not null, and not an empty string, array or map."""
    if kind.startswith(("array", "map")):
        return x.isNotNull() & (F.size(x) > 0)
    return x.isNotNull() & (x.cast("string") != "")


def first_filled(*xs: Column) -> Column:
    """The first value that is not blank, trimmed; else the empty string."""
    return F.coalesce(*[F.nullif(F.trim(x.cast("string")), F.lit("")) for x in xs], F.lit(""))


def is_true_flag(x: Column, words: Sequence[str] = ("true", "1", "yes", "co", "có")) -> Column:
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin(*words), F.lit(False))


#: The three code grammars.
CODE_LOOSE = r"\b\d{1,2}\.\d{3,6}\b"
CODE_STRICT = r"\b\d\.\d{6}\b"
CODE_WHOLE = r"^\d{1,2}\.\d{3,6}$"


def codes(x: Column, pattern: str = CODE_LOOSE) -> Column:
    return F.regexp_extract_all(x, F.lit(pattern), F.lit(0))


def code_norm(x: Column, pattern: str = CODE_LOOSE) -> Column:
    """The first code in a text, else the trimmed text."""
    return first_filled(F.regexp_extract(x, pattern, 0), x)


def pad_code(x: Column, decimals: int = 6) -> Column:
    """A code with its part behind the point filled up with zeros."""
    parts = F.split(F.trim(x), r"\.", 2)
    return F.when(F.size(parts) == 2, F.concat(parts[0], F.lit("."), F.rpad(parts[1], decimals, "0"))).otherwise(F.trim(x))


def earliest(x: Column, markers: Sequence[str], least: int = 1) -> Column:
    """1-based place of the earliest marker that stands at `least` or later; null without one."""
    places = [F.locate(m, x, least) for m in markers]
    return F.least(*[F.when(p > 0, p) for p in places], F.lit(None).cast("int")) if places else F.lit(None).cast("int")


def cut_at(x: Column, markers: Sequence[str], least: int = 1) -> Column:
    """The text before the earliest marker, trimmed. Composed first, so that places in the folded text are places in it."""
    x = nfc(x)
    at = earliest(fold(x), [m.lower() for m in markers], least)
    return F.trim(F.when(at.isNotNull(), F.substring(x, F.lit(1), at - 1)).otherwise(x))


def name_from_snippet(snippet: Column, code: Column, markers: Sequence[str], duration: str, code_pattern: str = CODE_LOOSE) -> Column:
    """The name behind a code: up to the earliest marker, duration or further code, without edge punctuation."""
    at = F.instr(snippet, code)
    rest = F.when(at > 0, F.substring(snippet, at + F.length(code), F.length(snippet))).otherwise(snippet)
    rest = cut_at(rest, markers, 8)
    stops = [F.regexp_instr(rest, F.lit(p)) for p in (duration, code_pattern)]
    stop = F.least(*[F.when(p >= 10, p) for p in stops])
    rest = F.when(stop.isNotNull(), F.substring(rest, F.lit(1), stop - 1)).otherwise(rest)
    return F.regexp_replace(squeeze(rest), r"^[\s\-–:;.,|]+|[\s\-–:;.,|]+$", "")


def replace_pairs(x: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """All replacements in order."""
    for old, new in pairs:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def replaced_in_order(x: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """All replacements one after another, over one array of pairs: for long tables. An earlier one may make or spoil a later match."""
    if not pairs:
        return x
    table = F.array(*[F.struct(F.lit(old).alias("old"), F.lit(new).alias("new")) for old, new in pairs])
    return F.aggregate(table, x, lambda acc, p: F.replace(acc, p["old"], p["new"]))


def before_bell(x: Column) -> Column:
    """A cell that control marks part: its first part that is not blank; else the text."""
    parts = F.filter(F.transform(F.split(x, "\x07"), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(x.contains("\x07"), F.coalesce(F.get(parts, F.lit(0)), F.lit(""))).otherwise(x)


def repaired_name(x: Column, code: Column, pairs: Sequence[tuple[str, str]], bleed: str, overrides: Column | None = None, least: int = 12) -> Column:
    """A name out of a scanned table: the one that overrides hold for its code, else its text mended.

    The part before control marks, spaces squeezed, pairs replaced in order, composed, cut where another column runs into it
    (pattern bleed, behind at least `least` characters), without punctuation at the ends. overrides: map of code to name.
    Null is empty. A composed text does not go through Python.
    """
    y = replaced_in_order(squeeze(before_bell(F.coalesce(x, F.lit("")))), pairs)
    y = composed(y)
    at = F.regexp_instr(y, F.lit(bleed))
    y = F.when(at > least, F.substring(y, F.lit(1), at - 1)).otherwise(y)
    y = F.regexp_replace(y, r"^[ \-–—;,.|]+|[ \-–—;,.|]+$", "")
    return y if overrides is None else F.coalesce(F.try_element_at(overrides, code), y)


def cleaned_title(x: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """struct(title, fault): the text mended as above, or null and why not: only_control or control_character."""
    y = before_bell(x)
    fault = F.when(x.contains("\x07") & (y == ""), "only_control").when(y.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"), "control_character")
    z = composed(F.trim(replaced_in_order(y, pairs)))
    return F.struct(F.when(fault.isNull(), z).alias("title"), fault.alias("fault"))


def has_control(x: Column) -> Column:
    return x.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]")


def duration_candidate(x: Column, pattern: str, near: int = 220) -> Column:
    """struct(value, confidence): the first duration; its confidence is high within the first `near` characters."""
    at = F.regexp_instr(x, F.lit(pattern))
    return F.when(at > 0, F.struct(F.regexp_extract(x, pattern, 0).alias("value"), F.when(at <= near, "high").otherwise("medium").alias("confidence")))


def unambiguous_duration(x: Column, pattern: str, longest: int = 140) -> Column:
    """At most one token, a whole match and not long."""
    return (F.length(x) <= longest) & (F.regexp_count(x, F.lit(pattern)) <= 1) & x.rlike(f"^(?:{pattern})[.\\s]*$")


def duration_tokens(x: Column, pattern: str, clock: str) -> Column:
    """Durations without those that are times of the day."""
    return F.filter(F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), lambda t: ~t.rlike(clock))


def marked_level(x: Column, labels: dict[str, str], mark: str = "[xX]", within: int = 700) -> Column:
    """The one level whose label has a mark before or behind it; null for none or several."""
    head = F.substring(x, 1, within)
    hit = {v: head.rlike(rf"(?iu)(?<!\S){mark}\s*{label}|{label}\s*{mark}(?!\S)") for v, label in labels.items()}
    n = sum((h.cast("int") for h in hit.values()), F.lit(0))
    return F.when(n == 1, F.coalesce(*[F.when(h, v) for v, h in hit.items()]))


def fee_excerpt(x: Column, markers: Sequence[str], within: int = 750, chars: int = 260) -> Column:
    """The text from the first marker within some characters on; composed first, as places are found in the folded text."""
    x = nfc(x)
    at = earliest(fold(x), [m.lower() for m in markers])
    return F.when(at <= within, F.trim(F.substring(x, at, F.lit(chars))))


def safe_fee(x: Column, markers: Sequence[str]) -> Column:
    """The marker that is the whole text, else null: anything more is not safe to copy."""
    f = squeeze(fold(x))
    return F.coalesce(*[F.when(f.rlike(rf"^{m}[.;]?$"), m) for m in markers])


def legal_refs(x: Column, kinds: Sequence[tuple[str, str]], dated: Sequence[tuple[str, str]] = ()) -> Column:
    """Canonical references, kind by kind, each once: (pattern, form), where {n} in the form stands for the n-th group.

    Spaces within the groups of kinds go, as they come from line breaks; those of dated ones are kept.
    """
    parts = [_formed(x, p, form, True) for p, form in kinds] + [_formed(x, p, form, False) for p, form in dated]
    return F.array_distinct(F.concat(*parts))


def _formed(x: Column, pattern: str, form: str, tight: bool) -> Column:
    pieces = re.split(r"\{(\d)\}", form)
    first = F.regexp_extract_all(x, F.lit(pattern), F.lit(int(pieces[1])))
    groups = {n: F.regexp_extract_all(x, F.lit(pattern), F.lit(n)) for n in map(int, pieces[1::2])}

    def one(_, i: Column) -> Column:
        parts = [F.lit(t) if n % 2 == 0 else F.get(groups[int(t)], i) for n, t in enumerate(pieces) if t]
        if tight:
            parts = [F.regexp_replace(p, r"\s+", "") if n % 2 else p for n, p in enumerate(parts, 0 if pieces[0] else 1)]
        return F.concat(*parts)

    return F.coalesce(F.transform(first, one), F.array().cast("array<string>"))


def money(x: Column, unit: str) -> Column:
    return F.regexp_extract_all(x, F.lit(rf"(\d{{1,3}}(?:[.,]\d{{3}})*)\s*{unit}"), F.lit(1))


def window_around(x: Column, code: Column, before: int = 120, after: int = 1100) -> Column:
    at = F.instr(x, code)
    start = F.greatest(at - before, F.lit(1))
    return F.when(at > 0, F.substring(x, start, at - start + F.length(code) + after))


def until_next_code(x: Column, code: Column, longest: int = 1800, pattern: str = CODE_LOOSE) -> Column:
    at = F.instr(x, code)
    rest = F.substring(x, at + F.length(code), F.length(x))
    stop = F.regexp_instr(rest, F.lit(pattern))
    body = F.when(stop > 0, F.substring(rest, F.lit(1), stop - 1)).otherwise(rest)
    return F.when(at > 0, F.substring(F.concat(code, body), 1, longest))


def section(x: Column, heading: str) -> Column:
    """Text of a Markdown section up to the next heading."""
    return F.trim(F.regexp_extract(x, rf"(?is)(?:^|\n)#+[ \t]*{heading}[^\n]*\n(.*?)(?=\n#+[ \t]|\z)", 1))


def labelled_value(x: Column, label: str, further: int = 4) -> Column:
    """What stands behind a label on its line, else the first filled of the next lines."""
    lines = F.transform(F.split(x, r"\r?\n"), lambda v: F.trim(v))
    at = F.array_position(F.transform(lines, lambda v: v.rlike(rf"(?iu)^{label}\s*:?")), True).cast("int")
    same = F.trim(F.regexp_replace(F.get(lines, at - 1), rf"(?iu)^{label}\s*:?", ""))
    below = F.get(F.filter(F.slice(lines, at + 1, F.lit(further)), lambda v: v != ""), F.lit(0))
    return F.when(at > 0, first_filled(same, F.when(at < F.size(lines), below)))


def dmy(x: Column) -> Column:
    """ISO date text to dd/mm/yyyy; other text stays."""
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}"), F.concat_ws("/", F.substring(x, 9, 2), F.substring(x, 6, 2), F.substring(x, 1, 4))).otherwise(x)


def iso_prefix(x: Column) -> Column:
    return F.regexp_extract(x, r"^(\d{4}-\d{2}-\d{2})", 1)


def first_date(x: Column, patterns: Sequence[str]) -> Column:
    """ISO date of the first of several patterns with groups day, month, year."""
    def one(p: str) -> Column:
        d, m, y = (F.regexp_extract(x, p, i) for i in (1, 2, 3))
        return F.when(d != "", F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))

    return F.coalesce(*map(one, patterns))


def effective_date(x: Column, patterns: Sequence[str], from_signing: str, signed: Column) -> Column:
    """A stated date, else the signing date (whether the text says so or is silent): struct(date, basis)."""
    stated = first_date(fold(x), patterns)
    basis = F.when(stated.isNotNull(), "stated").when(fold(x).rlike(from_signing), "signing").otherwise("default")
    return F.struct(F.coalesce(stated, signed).alias("date"), basis.alias("basis"))


def html_escape(x: Column) -> Column:
    return replace_pairs(x, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")])


def any_marker(x: Column, markers: Sequence[str]) -> Column:
    """Whether the folded text holds any marker."""
    f = fold(x)
    out = F.lit(False)
    for m in markers:
        out = out | f.contains(m.lower())
    return F.coalesce(out, F.lit(False))


def first_match(x: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Value of the first (value, regex) that a text matches, case-insensitively."""
    out = F.when(F.lit(False), F.lit(default))
    for value, pattern in rules:
        out = out.when(x.rlike(f"(?iu){pattern}"), value)
    return out.otherwise(default)
