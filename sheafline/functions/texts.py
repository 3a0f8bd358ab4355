"""Scalar text functions as Column expressions. Patterns carry (?U) so that classes are Unicode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def rx(pattern: str, ignore_case: bool = True) -> str:
    """A pattern with Unicode classes and, if wanted, Unicode case folding."""
    return ("(?iuU)" if ignore_case else "(?U)") + pattern


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def nonspace_chars(text: Column) -> Column:
    """Characters that are no white space; null counts as none."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""))


def prepare(text: Column) -> Column:
    """Path separators, underscores and hyphens as blanks."""
    return F.regexp_replace(text, r"[_\-/\\]+", " ")


def probe_text(text: Column, most: int = 20_000) -> Column:
    """Control characters as blanks, cut to ``most`` characters: a sampling rule of the intake."""
    return F.substring(F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " "), 1, most)


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def to_number(text: Column) -> Column:
    """A number with a decimal comma, thin or no-break spaces and a real minus sign; null where it is none."""
    return F.regexp_replace(F.regexp_replace(F.translate(text, "−,", "-."), "[    \t]", ""), r"^\+", "").try_cast("double")


def sign_key(text: Column) -> Column:
    """A reading without the signs that recognition confuses."""
    return F.regexp_replace(F.translate(F.lower(text), "⌀ø∅,−–—", "ooo.---"), r"\s+", "")


# Look-alike Cyrillic letters and their Latin counterparts.
CYRILLIC, LATIN = "АВЕКМНОРСТУХавеикмнорстух", "ABEKMHOPCTYXaveukmhopctyx"
CYR_ALIKE, LAT_ALIKE = "АВЕКМНОРСТУХаеорсух", "ABEKMHOPCTYXaeopcyx"


def fold_homoglyphs(text: Column) -> Column:
    """Lower case, Cyrillic look-alikes as Latin."""
    return F.lower(F.translate(text, CYR_ALIKE, LAT_ALIKE))


def mixed_script_words(text: Column) -> Column:
    """How many words hold both Latin and Cyrillic letters."""
    return F.regexp_count(text, F.lit(r"(?U)(?:[a-zA-Z][а-яёА-ЯЁ]|[а-яёА-ЯЁ][a-zA-Z])"))


# Words that open a part of a document.
PART_WORDS = ("глава", "раздел", "приложение", "chapter", "section", "appendix")


def is_header(text: Column) -> Column:
    """A heading by its look: at most 200 characters, and a number before a title in capitals, a part word with something after it, capitals only, or a short label with a colon."""
    t = F.trim(text)
    first, second = F.substring_index(t, " ", 1), F.substring_index(F.substring_index(t, " ", 2), " ", -1)
    numbered = F.translate(first, "0123456789.", "") == ""
    titled = numbered & ~first.startswith(".") & (first != second) & second.rlike(r"^\p{Lu}")
    part = F.lower(first).isin(*PART_WORDS) & (F.length(t) > F.length(first))
    capitals = (F.length(t) > 3) & ~t.rlike(r"[^\p{Lu}\p{Nd} .,-]") & t.rlike(r"\p{Lu}")
    label = t.endswith(":") & F.length(t).between(4, 81) & ~t.rlike("[.!?]")
    return F.length(t).between(1, 200) & (titled | part | capitals | label)


def assignment(text: Column) -> Column:
    """struct(base_var, expression) of ``X = expression``; null fields otherwise."""
    flat = F.regexp_replace(text, "\n", " ")
    pattern = r"^\s*([A-Za-zА-Яа-яΑ-ω][A-Za-z0-9_\\{}]*)\s*=\s*(.+)$"
    var, expr = F.regexp_extract(flat, pattern, 1), F.trim(F.regexp_extract(flat, pattern, 2))
    return F.struct(F.nullif(var, F.lit("")).alias("base_var"), F.nullif(expr, F.lit("")).alias("expression"))


def latex_prose_share(text: Column) -> Column:
    """The share of letters that stand in runs of four or more outside commands: high for prose caught in formula markup."""
    bare = F.regexp_replace(text, r"\\[A-Za-z]+", " ")
    joined = F.regexp_replace(bare, r"[^\p{L}]+", " ")
    long = F.aggregate(F.regexp_extract_all(joined, F.lit(r"\p{L}{4,}"), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x))
    return long / F.greatest(F.lit(1), F.length(F.regexp_replace(joined, " ", "")))


def stem(word: Column, n: int = 5) -> Column:
    return F.substring(F.lower(word), 1, n)
