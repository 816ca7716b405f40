"""Scalar functions of the domain as Column builders; all run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as v


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value, which is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def level(pct: Column) -> Column:
    """Achievement level 1 to 7 of a percentage; null outside 0 to 100 or for null."""
    bands = reduce(lambda c, b: c.when(pct >= b[1], b[0]), sorted(v.LEVEL_FROM.items(), reverse=True), F.when(~pct.between(0, 100), F.lit(None).cast("int")))
    return bands.cast("int")


def strict_level(pct: Column) -> Column:
    """As ``level``, but fails the job on a percentage outside 0 to 100."""
    return F.when(pct.isNotNull() & ~pct.between(0, 100), F.raise_error(F.concat(F.lit("percentage out of range 0-100: "), pct.cast("string"))).cast("int")).otherwise(level(pct))


def least_percentage(lvl: Column) -> Column:
    """Least percentage of an achievement level."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in v.LEVEL_FROM.items() for x in pair]), lvl)


def subject_name(key: Column) -> Column:
    """Display name of a subject or language key; unknown keys become words in title case."""
    names = F.create_map(*[F.lit(x) for pair in {**v.SUBJECT_NAMES, **v.LANGUAGE_NAMES}.items() for x in pair])
    title = lambda c: F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
    out = F.when(F.map_contains_key(names, key) & ~key.isin(list(v.LANGUAGE_NAMES)), F.try_element_at(names, key))
    for suffix, label in v.VARIANTS.items():
        base = F.regexp_replace(key, f"{suffix}$", "")
        out = out.when(key.endswith(suffix), F.concat(F.coalesce(F.try_element_at(names, base), F.initcap(base)), F.lit(f" {label}")))
    return out.otherwise(F.coalesce(F.try_element_at(names, key), title(key)))


def strip(text: Column) -> Column:
    """Text without white space at its ends."""
    return F.trim(text, F.lit(" \t\n\r\x0b\x0c"))


def squeeze(text: Column) -> Column:
    """Trimmed, lower case, runs of white space as one space."""
    return strip(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def strip_year_suffix(title: Column, year: Column) -> Column:
    """Without a final "Prospectus YEAR" or "YEAR Prospectus"."""
    y = year.cast("string")
    for parts in ((F.lit(r"(?i)\s*Prospectus\s*"), y, F.lit(r"\s*$")), (F.lit(r"(?i)\s*"), y, F.lit(r"\s*Prospectus\s*$"))):
        title = F.regexp_replace(strip(title), F.concat(*parts), F.lit(""))
    return strip(title)


def strip_suffix(title: Column) -> Column:
    """Without a final "Prospectus"."""
    return strip(F.regexp_replace(title, r"(?i)\s*Prospectus\s*$", ""))


def last_segment(url: Column) -> Column:
    """Last path segment of a URL, slashes at its end ignored."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def density(chars: Column, width: Column, height: Column) -> Column:
    """Characters per unit of area; 0 without area."""
    return F.coalesce(F.try_divide(chars.cast("double"), width * height), F.lit(0.0))


def distinct_hits(text: Column, phrases: list[str]) -> Column:
    """How many of the phrases occur in the text, in any case."""
    low = F.lower(text)
    return reduce(lambda a, b: a + b, [F.contains(low, F.lit(p.lower())).cast("int") for p in phrases], F.lit(0))


def numeric_ratio(text: Column) -> Column:
    """Digits among digits and letters; 0 with neither."""
    digits, letters = F.regexp_count(text, F.lit(r"\p{Nd}")), F.regexp_count(text, F.lit(r"\p{L}"))
    return F.coalesce(F.try_divide(digits.cast("double"), digits + letters), F.lit(0.0))


def strip_markers(text: Column, markers: Column) -> Column:
    """Text with each footnote marker removed, in the given order."""
    return F.aggregate(F.coalesce(markers, F.array().cast("array<string>")), text, lambda t, m: F.replace(t, m, F.lit("")))


def quote(c: Column) -> Column:
    """A column's text as a regular expression that matches it."""
    return F.regexp_replace(c, r"([\\.\[\]{}()*+\-?^$|#&~])", r"\\$1")


def all_words_present(phrase: Column, low: Column) -> Column:
    """Whether all words of the phrase occur in lower-case text, in any order."""
    return F.forall(F.filter(F.split(F.lower(phrase), r"(?U)\s+"), lambda w: w != ""), lambda w: F.regexp_like(low, F.concat(F.lit(r"(?U)\b"), quote(w), F.lit(r"\b"))))


def resolve_header(text: Column, markers: Column) -> Column:
    """Subject or language of a column header, null unless the whole header is known."""
    known = {**{s.replace("_", " "): s for s in v.SUBJECTS}, **v.HEADER_ALIASES, **{x: x for x in v.LANGUAGE_NAMES}}
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), squeeze(strip_markers(text, markers)))


def resolve_merged_header(text: Column, markers: Column) -> Column:
    """Subjects of a header, several where slashes divide it; empty where none is known."""
    parts = F.filter(F.transform(F.split(text, "/"), lambda p: strip(p)), lambda p: p != "")
    parts = F.when(F.size(parts) > 1, parts).otherwise(F.array(text))
    return F.coalesce(F.filter(F.transform(parts, lambda p: resolve_header(p, markers)), lambda s: s.isNotNull()), F.array().cast("array<string>"))


def interpret_cell(text: Column, markers: Column, not_accepted: Column, alternatives: Column) -> Column:
    """struct(kind, level, raw): a cell rejects a subject, offers it as an alternative, asks a level, or says nothing."""
    none = F.array().cast("array<string>")
    stripped = strip(F.coalesce(text, F.lit("")))
    matchable = strip_markers(stripped, markers)
    found = F.regexp_extract(matchable, r"(?U)\b([1-7])\b", 1)
    lvl = F.when(found != "", found.cast("int"))
    rejected = F.exists(F.coalesce(not_accepted, none), lambda p: all_words_present(p, F.lower(matchable)))
    offered = F.exists(F.coalesce(alternatives, none), lambda p: F.regexp_like(matchable, F.concat(F.lit(r"(?U)\b"), quote(p), F.lit(r"\b"))))
    kind = F.when(stripped == "", "empty").when(rejected, "not_accepted").when(offered & lvl.isNotNull(), "alternative").when(lvl.isNotNull(), "level").otherwise("empty")
    return F.struct(kind.alias("kind"), F.when(kind.isin("alternative", "level"), lvl).alias("level"), F.when(stripped == "", text).otherwise(stripped).alias("raw"))


SCORE_CANDIDATE = r"(?U)\b(1[4-9]|[23]\d|4[0-8])\b(?!\s*%)"


def score_candidates(text: Column) -> Column:
    """Plausible score numbers, 14 to 48, that no percent sign follows."""
    return F.transform(F.regexp_extract_all(text, F.lit(SCORE_CANDIDATE), 1), lambda s: s.cast("int"))


_PHRASES = "|".join(re.escape(p) for p, _ in v.ALIASES)


def all_aliases(text: Column) -> Column:
    """Slugs of the subjects named in a text, longest names first where they overlap, in order of place."""
    names = F.create_map(*[F.lit(x) for pair in dict(reversed(v.ALIASES)).items() for x in pair])
    return F.transform(F.regexp_extract_all(squeeze(text), F.lit(rf"(?U)\b({_PHRASES})\b"), 1), lambda p: F.element_at(names, p))


def longest_alias(text: Column) -> Column:
    """Slug of the longest subject name in a text, null without one."""
    low = squeeze(text)
    return F.coalesce(*[F.when(F.regexp_like(low, F.lit(rf"(?U)\b{re.escape(p)}\b")), s) for p, s in v.ALIASES])


def detect_markers(text: Column, markers: Column) -> Column:
    """Footnote markers in a text, longest first, each using up what it matches."""
    ordered = F.array_sort(F.array_distinct(markers), lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    start = F.struct(text.alias("rest"), F.array().cast("array<string>").alias("found"))
    step = lambda acc, m: F.when((m != "") & F.contains(acc["rest"], m), F.struct(F.replace(acc["rest"], m, F.lit("")).alias("rest"), F.array_append(acc["found"], m).alias("found"))).otherwise(acc)
    return F.aggregate(ordered, start, step, lambda acc: acc["found"])


def names_equal(a: Column, b: Column) -> Column:
    """Names are equal where one normalised name holds the other; null equals only null."""
    x, y = squeeze(a), squeeze(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.contains(x, y) | F.contains(y, x))


def set_key(c: Column) -> Column:
    """An array as a set, as text that is equal for equal sets."""
    return F.to_json(F.array_sort(F.array_distinct(c)))


def score_key(c: Column) -> Column:
    """Score thresholds as a set; a missing and a null subject are the same."""
    return F.to_json(F.array_sort(F.array_distinct(F.transform(c, lambda e: F.concat_ws(":", e["min_score"].cast("string"), F.nullif(e["requires_subject"], F.lit("")))))))


def remove_detections(markdown: Column) -> Column:
    """Markdown with the token of each detection tag in the tag's place."""
    return F.regexp_replace(markdown, r"<\|det\|>([^<\s]+)(?:\s*\[[^\]]*\])?\s*<\|/det\|>", "$1")


def table_rows(markdown: Column) -> Column:
    """Rows of cells of the pipe tables in Markdown, without divider rows."""
    lines = F.filter(F.transform(F.split(markdown, r"\r?\n"), lambda x: strip(x)), lambda x: x.startswith("|"))
    cells = F.transform(lines, lambda x: F.transform(F.split(F.regexp_replace(x, r"^\|+|\|+$", ""), r"\|"), lambda c: strip(c)))
    return F.filter(cells, lambda r: ~F.forall(r, lambda c: F.regexp_like(c, F.lit(r"^:?-+:?$"))))


def looks_reversed(token: Column, code_pattern: Column) -> Column:
    """Whether a token was read backwards: as a code, as a percentage cell, or as a known word."""
    whole = F.concat(F.lit("^(?:"), code_pattern, F.lit(")$"))
    code = ~F.regexp_like(token, whole) & F.regexp_like(F.reverse(token), whole)
    return F.coalesce((token != "") & (code | F.regexp_like(token, F.lit(r"^\)\+?%\d{2}\($")) | F.lower(token).isin("detpecca", "ton", "detpecca ton")), F.lit(False))


def advance(c: str = "") -> Column:
    """Position of a rotated character along its line."""
    return F.col(f"{c}a") * F.col(f"{c}e") + F.col(f"{c}b") * F.col(f"{c}f")


def perpendicular(c: str = "") -> Column:
    """Position of a rotated character across its line, to a tenth."""
    return F.bround(-F.col(f"{c}b") * F.col(f"{c}e") + F.col(f"{c}a") * F.col(f"{c}f"), 1)


def rotation(c: str = "") -> Column:
    """Rotation of a character's matrix, to hundredths."""
    return F.concat_ws(",", *[F.bround(F.col(f"{c}{k}"), 2).cast("string") for k in "abcd"])
