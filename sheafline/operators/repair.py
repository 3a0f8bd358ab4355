"""Repairs of recognised technical text: alphabets inside words, designations, dimensions, glued words, mangled formulas, broken JSON.

Every repair is a pure function of a string (and a vocabulary); ``apply`` runs them in Arrow batches and says what was changed.
"""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters that look alike, Latin and Cyrillic.
LOOKS = {**dict(zip("ABCEHKMOPTXYaceopxy", "АВСЕНКМОРТХУасеорху", strict=True))}
LOOKS_BACK = {c: x for x, c in LOOKS.items()}
MOST_READINGS = 4096
WORD = re.compile(r"[^\W\d_]+")


def readings(word: str) -> list[str]:
    """All ways to read a word's look-alike letters; only the word itself if there are too many."""
    options = [(c, o) if (o := LOOKS.get(c) or LOOKS_BACK.get(c)) else (c,) for c in word]
    n = 1
    for o in options:
        n *= len(o)
    return ["".join(p) for p in product(*options)] if n <= MOST_READINGS else [word]


def pure_readings(word: str) -> list[str]:
    """The readings of a word in one alphabet: two at most, whatever its length."""
    out = []
    for looks, own in ((LOOKS_BACK, "[A-Za-z]"), (LOOKS, "[А-Яа-яЁё]")):
        r = "".join(c if re.match(own, c) else looks.get(c, c) for c in word)
        if one_alphabet(r) and re.search(own, r):
            out.append(r)
    return out


def one_alphabet(word: str) -> bool:
    return not (re.search("[A-Za-z]", word) and re.search("[А-Яа-яЁё]", word))


def mixed_words(text: str, vocabulary: frozenset[str]) -> str:
    """Words of two alphabets replaced by their reading of one alphabet, if exactly one reading is in the vocabulary; else if exactly one reading has one alphabet."""

    def fix(m: re.Match) -> str:
        w = m[0]
        if one_alphabet(w):
            return w
        pure = pure_readings(w)
        known = [r for r in pure if r.lower() in vocabulary]
        return known[0] if len(known) == 1 else pure[0] if len(pure) == 1 else w

    return WORD.sub(fix, text)


CODE = re.compile(r"(?<![\w.])([A-ZА-ЯЁ0-9]{4})[. ]([\dOОЗЗбБlI]{6})\.([\dOОЗбБlI]{3})(?!\w)")
DIGITS = {ord("O"): "0", ord("О"): "0", ord("З"): "3", ord("б"): "6", ord("Б"): "6", ord("l"): "1", ord("I"): "1"}
TO_CYRILLIC = {ord(x): c for x, c in LOOKS.items()} | {ord("0"): "О", ord("3"): "З"}
STANDARD = re.compile(r"(?<!\w)([ГrГ][OОo0][CСc][TТт])(\s+P|\s+Р)?\s*(\d[\d.\-–]*)")


def designations(text: str) -> str:
    """Document numbers with four Cyrillic letters, six and three digits, and standards, in their proper letters and digits."""
    t = CODE.sub(lambda m: f"{m[1].translate(TO_CYRILLIC)}.{m[2].translate(DIGITS)}.{m[3].translate(DIGITS)}", text)
    return STANDARD.sub(lambda m: f"ГОСТ{' Р' if m[2] else ''} {m[3]}", t)


SUPER = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻", "0123456789+-")


def dimensions(text: str) -> str:
    """Diameter and tolerance signs, fits and threads in Latin letters, decimal commas in deviations, scales 1:n, superscript powers."""
    t = re.sub(r"[øØ∅]\s?(?=\d)", "⌀", text)
    t = re.sub(r"\+\s?/\s?[-−–]", "±", t)
    t = re.sub(r"(?<![\wА-Яа-я])М(?=\d+(?:[.,]\d+)?(?:\s?[xх×]\s?\d|\b))", "M", t)
    t = re.sub(r"(?<=\d)\s?[хx]\s?(?=\d)", "×", t)
    t = re.sub(r"(?<=\d)([Нн])(?=\d{1,2}\b)", lambda m: "H" if m[1] == "Н" else "h", t)
    t = re.sub(r"([±+-]\d)\.(\d)", r"\1,\2", t)
    t = re.sub(r"R[аa]\s?(?=\d)", "Ra ", t)
    t = re.sub(r"(?<!\d)[lI7]\s?:\s?(\d+(?:[.,]\d+)?)(?!\d)", lambda m: f"1:{m[1]}" if m[1] in ("1", "2", "2,5", "4", "5", "10", "20", "25", "40", "50", "100") else m[0], t)
    return re.sub(r"10([⁻⁺]?[⁰¹²³⁴⁵⁶⁷⁸⁹]+)", lambda m: f"10^{m[1].translate(SUPER)}", t)


@lru_cache(16)
def longest_word(vocabulary: frozenset[str]) -> int:
    return max(map(len, vocabulary), default=0)


def split_glued(token: str, vocabulary: frozenset[str], least: int = 2) -> list[str]:
    """A glued token as the fewest vocabulary words that make it up (longer first words on a tie); the token itself if there are none."""
    low, n = token.lower(), len(token)
    if low in vocabulary or n < 2 * least:
        return [token]
    most = longest_word(vocabulary)
    best: list[tuple[int, int] | None] = [(0, 0)] + [None] * n
    for end in range(1, n + 1):
        for start in range(max(0, end - most), end):
            before = best[start]
            if before is not None and end - start >= least and low[start:end] in vocabulary:
                cand = (before[0] + 1, start)
                if best[end] is None or cand < best[end]:
                    best[end] = cand
    if best[n] is None:
        return [token]
    out, at = [], n
    while at:
        start = best[at][1]
        out.append(token[start:at])
        at = start
    return out[::-1]


def unglue(text: str, vocabulary: frozenset[str]) -> str:
    return WORD.sub(lambda m: " ".join(split_glued(m[0], vocabulary)) if len(m[0]) > 6 and m[0].lower() not in vocabulary else m[0], text)


def mangled_prose(text: str) -> str:
    """Prose in formula markup read as prose; anything that relates or computes is left as it is."""
    if "\\" not in text or re.search(r"=|\\(?:frac|sqrt|sum|int|leq?|geq?|cdot)", text):
        return text
    t = re.sub(r"\\(?:text|mathrm|mathit|mathbf|operatorname|mathsf)\s*\{([^{}]*)\}", lambda m: " " + (m[1].replace(" ", "").replace("~", " ") if re.fullmatch(r"\s*(?:\S\s+)+\S?\s*", m[1]) else m[1]) + " ", text)
    t = re.sub(r"\\[;,: !]|\\q?quad|~", " ", t)
    t = re.sub(r"\{\s*\\(?:bf|it|rm|sf|tt|sc|em|cal|boldmath)(?![A-Za-z])([^{}]*)\}", r" \1 ", t)
    return text if "\\" in t else " ".join(t.split())


def salvage_json(text: str | None) -> str | None:
    """The first balanced JSON value in a text; of a cut list the complete items; null if there is nothing to save."""
    if not text:
        return None
    start = next((i for i, c in enumerate(text) if c in "{["), None)
    if start is None:
        return None
    decoder = json.JSONDecoder()
    try:
        return json.dumps(decoder.raw_decode(text, start)[0], ensure_ascii=False)
    except ValueError:
        pass
    if text[start] == "[" or (m := re.search(r"\[", text[start:])):
        at = start + 1 if text[start] == "[" else start + m.end()
        items = []
        while True:
            at += len(text[at:]) - len(text[at:].lstrip(" \n\t,"))
            try:
                item, at = decoder.raw_decode(text, at)
            except ValueError:
                break
            items.append(item)
        return json.dumps(items, ensure_ascii=False) if items else None
    body = text[start:]
    for end in (m.start() for m in reversed(list(re.finditer(",", body)))):
        try:
            return json.dumps(json.loads(body[:end] + "}"), ensure_ascii=False)
        except ValueError:
            continue
    return None


def containment(short: str, long: str, least: int = 3) -> float:
    """The share of ``short`` that stands in ``long`` in the same order, in stretches of at least ``least`` characters."""
    if not short:
        return 0.0
    return sum(b.size for b in difflib.SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks() if b.size >= least) / len(short)


CHANGES = T.StructType([T.StructField("text", T.StringType()), T.StructField("changed", T.BooleanType())])


def apply(df: DataFrame, text: str, *repairs: Callable[[str], str], out: str = "repaired") -> DataFrame:
    """Adds ``out`` = struct(text, changed): the repairs one after the other; null stays null and is not changed."""

    @F.pandas_udf(CHANGES)
    def run(texts: pd.Series) -> pd.DataFrame:
        got = []
        for t in texts:
            r = t
            for f in repairs if t is not None else ():
                r = f(r)
            got.append((r, r != t))
        return pd.DataFrame(got, columns=["text", "changed"])

    return df.withColumn(out, run(F.col(text)))


def vocabulary_of(word_list: DataFrame, most: int = 2_000_000) -> frozenset[str]:
    """The word list as a set for the repairs; a table that does not grow, refused above ``most`` words."""
    rows = word_list.filter("word is not null").select(F.lower("word")).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the word list has more than {most} words")
    return frozenset(r[0] for r in rows)
