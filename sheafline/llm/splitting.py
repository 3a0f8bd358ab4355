"""Oversized items cut at natural boundaries, with exact spans and overlap; and an audit of pieces that are stored already.

One text is described by two arrays. ``size[i]`` is the prefix sum of what the first ``i`` code points weigh (1 each for
``chars``; 1 at the start of each token for ``tokens``); ``boundary`` is the sorted list of offsets where a cut is natural, one list
for each class: paragraph, line, sentence, word. A piece starts at s; its limit is found by binary search in the prefix
sums, its end by binary search for the last boundary under the limit, trying the classes in order within ``REACH``
characters of the limit (words anywhere in the piece). Without any boundary it is cut hard, but not between a base and its
combining marks. The next piece starts at the first word start within ``overlap`` before that end.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.operators.facts import slices

REACH = 120
TOKEN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]")
BREAKS = (regex.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*"), regex.compile(r"(?:\r\n|\r|\n)\s*"), regex.compile(r"[.!?…;]['\"»”)\]]*\s+"), regex.compile(r"\s+"))


class Text:
    """The arrays of one text."""

    def __init__(self, text: str, unit: str = "chars"):
        self.text, self.n = text, len(text)
        if unit == "tokens":
            marks = np.zeros(self.n + 1, dtype=np.int64)
            marks[[m.start() + 1 for m in TOKEN.finditer(text)]] = 1
            self.size = np.cumsum(marks)
        else:
            self.size = np.arange(self.n + 1)
        self.breaks = [np.fromiter((m.end() for m in b.finditer(text)), dtype=np.int64) for b in BREAKS]
        self.spaces = np.cumsum([0, *(c.isspace() for c in text)])

    def measure(self, start: int, end: int) -> int:
        """Tokens or code points in [start, end); a token is counted where it starts, a cut one in both pieces."""
        return int(self.size[end] - self.size[start]) + int(self.size[start + 1] == self.size[start] and self.inside(start) and self.size[-1] != self.n)

    def inside(self, at: int) -> bool:
        return 0 < at < self.n and self.text[at - 1].isalpha() and self.text[at].isalpha()

    def blank(self, start: int, end: int) -> bool:
        return end <= start or self.spaces[end] - self.spaces[start] == end - start

    def furthest(self, start: int, limit: int) -> int:
        """The last offset up to which a piece from ``start`` holds no more than ``limit``."""
        # a token that a cut has opened counts again where the piece starts inside it
        opened = int(self.size[-1] != self.n and self.inside(start) and self.size[start + 1] == self.size[start])
        return int(np.searchsorted(self.size, int(self.size[start]) - opened + limit, side="right")) - 1

    def step_back(self, start: int, end: int, overlap: int, limit: int) -> int:
        """Where the piece after [start, end) begins: the first word start within ``overlap``, else as far back as it allows; ``end`` if from there nothing new would fit."""
        if not overlap:
            return end
        # the last offset of that size is where the token after it starts, so no token is opened again
        low = max(start + 1, int(np.searchsorted(self.size, int(self.size[end]) - overlap, side="right")) - 1)
        words = self.breaks[3]
        i = int(np.searchsorted(words, low, side="left"))
        back = int(words[i]) if i < len(words) and words[i] < end else low
        while back < end - 1 and unicodedata.combining(self.text[back]):
            back += 1
        return back if self.furthest(back, limit) > end else end

    def last_before(self, level: int, low: int, high: int) -> int:
        """The last boundary of a class in (low, high], or -1."""
        b = self.breaks[level]
        i = int(np.searchsorted(b, high, side="right")) - 1
        return int(b[i]) if i >= 0 and b[i] > low else -1


def split(text: str, limit: int, overlap: int = 0, unit: str = "chars") -> list[tuple[int, int]]:
    """Spans [start, end) that cover the text, none over ``limit``; one span if it fits, none if it is empty or limit < 1."""
    if not text or limit < 1:
        return []
    t = Text(text, unit)
    if t.size[-1] <= limit:
        return [(0, t.n)]
    overlap = max(0, min(overlap, limit - 1))
    out: list[tuple[int, int]] = []
    start = before = 0
    while True:
        high = t.furthest(start, limit)
        if high >= t.n:
            out.append((start, t.n))
            return out
        end = -1
        for level in range(3):
            end = t.last_before(level, max(start, high - REACH), high)
            if end > 0:
                break
        if end < 0:
            end = t.last_before(3, start, high)
        # the white space of a boundary may be cut off, but it must make progress past the last piece
        if end <= max(start, before):
            end = high
            while end > start + 1 and unicodedata.combining(text[end]):
                end -= 1
            if end <= max(start + 1, before):
                end = high
        out.append((start, end))
        start, before = t.step_back(start, end, overlap, limit), end


def audit(text: str | None, limit: int | None, overlap: int | None, pieces: list[tuple[int, int]], unit: str = "chars") -> list[str]:
    """Defects of stored pieces, ordered by start: unsplit, over, gap, overlap, midword. Null or unlimited texts have none."""
    if text is None or limit is None or limit < 1:
        return []
    t = Text(text, unit)
    pieces = sorted((max(0, min(a, t.n)), max(0, min(b, t.n))) for a, b in pieces if a is not None and b is not None)
    if not pieces:
        return ["unsplit"] if t.size[-1] > limit else []
    got = set()
    covered, before = 0, None
    for a, b in pieces:
        if t.measure(a, b) > limit if b > a else False:
            got.add("over")
        if a > covered and not t.blank(covered, a):
            got.add("gap")
        elif before is not None and (a >= before or a < before - (overlap or 0)):
            got.add("overlap")
        low = max(a, b - REACH)
        if t.inside(b) and t.spaces[b] - t.spaces[low] > 0:
            got.add("midword")
        covered, before = max(covered, b), b
    if not t.blank(covered, t.n):
        got.add("gap")
    return sorted(got)


def with_limits(units: DataFrame, limits: DataFrame) -> DataFrame:
    """Units with max_size, overlap and unit of their profile; the table of limits is a setting of a few rows."""
    lim = limits.groupBy("profile").agg(F.first("unit").alias("unit"), F.min("max_size").alias("max_size"), F.min("overlap").alias("overlap"))
    return units.join(F.broadcast(lim), "profile")


def split_units(units: DataFrame, limits: DataFrame) -> DataFrame:
    """(unit_no, piece, pieces, char_start, char_end, text): each unit in pieces under its profile's limit.

    A unit that fits is one piece; empty and null texts, units without a number and units of an unknown profile give no rows; repeated rows of a unit give their pieces each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cut = ((no, text, split(text, int(size), int(over), unit)) for no, text, size, over, unit in pdf.itertuples(index=False))
            rows = ((no, i, len(spans), a, b, text[a:b]) for no, text, spans in cut for i, (a, b) in enumerate(spans))
            yield from slices(rows, ["unit_no", "piece", "pieces", "char_start", "char_end", "text"])

    sized = with_limits(units.select("unit_no", "profile", "text"), limits).filter("unit_no is not null and text is not null and max_size is not null")
    return sized.select("unit_no", "text", "max_size", F.coalesce("overlap", F.lit(0)).alias("overlap"), "unit").mapInPandas(run, "unit_no long, piece int, pieces int, char_start int, char_end int, text string")


def stored_pieces(fragments: DataFrame) -> DataFrame:
    """(source_unit_id, pieces): the spans stored for each unit, once per fragment_id as last delivered."""
    spans = fragments.select("fragment_id", "fragment_no", "updated_at", F.explode("position.source_spans").alias("s"))
    spans = spans.select("fragment_id", "fragment_no", "updated_at", "s.source_unit_id", "s.char_start", "s.char_end").filter("source_unit_id is not null")
    latest = spans.groupBy("source_unit_id", "fragment_id").agg(F.max_by(F.struct("fragment_no"), F.struct("updated_at", "fragment_no")).alias("m"))
    keep = spans.join(latest.select("source_unit_id", "fragment_id", F.col("m.fragment_no").alias("fragment_no")), ["source_unit_id", "fragment_id", "fragment_no"])
    return keep.select("source_unit_id", "fragment_id", "char_start", "char_end").distinct().groupBy("source_unit_id").agg(F.collect_list(F.struct("char_start", "char_end")).alias("pieces"))


def defects(units: DataFrame, fragments: DataFrame, limits: DataFrame) -> DataFrame:
    """(unit_no, defect): what is wrong with the stored pieces of each unit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for no, text, size, over, unit, pieces in pdf.itertuples(index=False):
                spans = [] if pieces is None else [(p["char_start"], p["char_end"]) for p in pieces]
                out.extend((no, d) for d in audit(text, int(size), int(over), spans, unit))
            yield pd.DataFrame(out, columns=["unit_no", "defect"])

    sized = with_limits(units.select("unit_no", "source_unit_id", "profile", "text"), limits).filter("unit_no is not null and text is not null and max_size is not null")
    both = sized.join(stored_pieces(fragments), "source_unit_id", "left")
    return both.select("unit_no", "text", "max_size", F.coalesce("overlap", F.lit(0)).alias("overlap"), "unit", "pieces").mapInPandas(run, "unit_no long, defect string")


def repaired(units: DataFrame, fragments: DataFrame, limits: DataFrame) -> DataFrame:
    """(unit_no, piece, pieces, char_start, char_end): new pieces for every unit whose stored pieces are wrong or missing."""
    bad = defects(units, fragments, limits).select("unit_no").distinct()
    return split_units(units.join(bad, "unit_no", "left_semi"), limits).drop("text")


def found(units: DataFrame, fragments: DataFrame, limits: DataFrame) -> DataFrame:
    return defects(units, fragments, limits).distinct()
